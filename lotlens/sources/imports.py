"""CSV imports of sales, permits and appeals: exact row numbers, header aliases, raw and normalised values, rejections."""

from __future__ import annotations

import csv
import io
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.functions import text as T

# The header names that each field may have, best first.
SALES = {
    "revenue_object_id": ["Revenue Object ID", "Revenue Object", "Receipt Number", "Receipt #"], "document_number": ["Document Number", "Document #", "Document No"],
    "county_name": ["County", "County Name"], "municipality_name": ["Municipality", "Municipality Name"], "transfer_date": ["Transfer Date", "Conveyance Date", "Sale Date"],
    "recording_date": ["Recording Date", "Recorded Date"], "consideration": ["Consideration", "Sale Price", "Value"], "property_type": ["Property Type"],
    "conveyance_type": ["Conveyance Type", "Conveyance"], "deed_type": ["Deed Type", "Deed"], "grantor_name": ["Grantor", "Seller"], "grantee_name": ["Grantee", "Buyer"],
    "parcel_number": ["Parcel Number", "Parcel #", "Official Parcel Number", "PIN"],
    "property_address": ["Property Address", "Property Address 1", "Physical Address", "Address", "Site Address"], "legal_description": ["Legal Description", "Legal"],
    "school_district_name": ["School District", "School District Name"], "arms_length": ["Arms Length", "Arms Length Indicator", "Arms-Length Indicator"],
    "usable_sale": ["Usable Sale", "Usable Sale Indicator", "Usable Indicator"],
}
PERMITS = {
    "permit_number": ["Permit Number", "Permit #", "Permit ID"], "issuing_jurisdiction": ["Issuing Jurisdiction", "Jurisdiction", "Municipality"], "permit_type": ["Permit Type"],
    "permit_subtype": ["Permit Subtype", "Subtype"], "work_class": ["Work Class", "Project Type"], "permit_status": ["Permit Status", "Status"],
    "description": ["Description", "Work Description"], "owner_name": ["Owner Name", "Owner"], "contractor_name": ["Contractor Name", "Contractor"],
    "parcel_number": ["Parcel Number", "Parcel #", "PIN", "Tax Key"], "site_address": ["Address", "Site Address", "Property Address"],
    "applied_date": ["Applied Date", "Application Date", "Filed Date"], "issued_date": ["Issued Date", "Issue Date"], "finaled_date": ["Finaled Date", "Final Date", "Closed Date"],
    "status_date": ["Status Date", "Last Status Date"], "permit_year": ["Permit Year", "Year"], "declared_valuation": ["Declared Valuation", "Project Valuation"],
    "estimated_cost": ["Estimated Cost", "Project Cost"],
}
APPEALS = {
    "appeal_number": ["Appeal Number", "Appeal #", "Case Number"], "docket_number": ["Docket Number", "Docket", "BOR Docket"], "appeal_level": ["Appeal Level", "Appeal Stage", "Board Type"],
    "appeal_reason": ["Appeal Reason", "Reason", "Basis"], "outcome": ["Outcome", "Decision", "Board Decision"], "filing_date": ["Filing Date", "Filed Date", "Appeal Date"],
    "hearing_date": ["Hearing Date", "Board Hearing Date"], "decision_date": ["Decision Date", "Board Decision Date"], "tax_year": ["Tax Year", "Assessment Year", "Year"],
    "value_before": ["Assessed Value Before", "Current Assessed Value", "Assessed Value"], "requested_value": ["Requested Assessed Value", "Requested Value", "Claimed Value"],
    "decided_value": ["Decided Assessed Value", "Final Value", "Board Value"], "parcel_number": ["Parcel Number", "Parcel #", "PIN", "Tax Key"],
    "site_address": ["Address", "Site Address", "Property Address"], "owner_name": ["Owner Name", "Owner"], "representative_name": ["Representative Name", "Agent"], "notes": ["Notes", "Comments"],
}

_ROWS = "path string, sha256 string, row_number long, names array<string>, n_cells int, blank boolean, cells map<string,string>"


def plain_name(name: str, loose: bool) -> str:
    """A header as it is compared.  Loose (permits, appeals): lower case, closing : and # dropped, runs of blanks, _ and - as one blank."""
    name = name.strip()
    return re.sub(r"[\s_-]+", " ", name.lower().rstrip(":#")).strip() if loose else name


def _files(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str, list[str], Iterator[list[str]]]]:
    """Path, sha256, header and data rows of each file; text is decoded piece by piece, one file at a time."""
    csv.field_size_limit(1 << 30)
    for batch in batches:
        for i in range(batch.num_rows):
            path, digest, content = (batch.column(k)[i].as_py() for k in range(3))
            reader = csv.reader(io.TextIOWrapper(io.BytesIO(content or b""), "utf-8-sig", "replace", newline=""))
            yield path, digest, next(reader, []), filter(None, reader)  # blank lines are no rows and have no number


def _batch(columns: list, kinds: list[pa.DataType], fields: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=fields)


def _parse(batches: Iterable[pa.RecordBatch], loose: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.map_(pa.string(), pa.string())]
    fields = [x.split()[0] for x in _ROWS.split(", ")]
    for path, digest, header, rows in _files(batches):
        names, number = [plain_name(n, loose) for n in header], 0
        for held in iter(lambda: list(itertools.islice(rows, 2000)), []):  # noqa: B023
            n = len(held)
            first = [list(dict(reversed(list(zip(names, cells, strict=False)))).items()) for cells in held]  # of equal names the first
            yield _batch([[path] * n, [digest] * n, range(number + 1, number + n + 1), [names] * n, [len(c) for c in held], [not any(x.strip() for x in c) for c in held], first], kinds, fields)
            number += n


def csv_rows(spark: SparkSession, path: str, loose: bool = False) -> DataFrame:
    """Every data row of every file: path, sha256 of the file, row number from 1, header names, and cells by name."""
    return _contents(spark, path).mapInArrow(lambda it: _parse(it, loose), _ROWS)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), "content")


def file_error(names: list[str], locators: list[str], anchors: list[str]) -> str | None:
    """What is wrong with a header: it must not have blank or repeated names, and of locators and of anchors, if there are any, at least one."""
    if "" in names:
        return "blank_header"
    if len(set(names)) < len(names):
        return "duplicate_header"
    if locators and not set(locators) & set(names):
        return "no_locator_header"
    return "no_anchor_header" if anchors and not set(anchors) & set(names) else None


def _bind(batches: Iterable[pa.RecordBatch], keys: dict[str, list[str]], loose: bool, locators: list[str], anchors: list[str], fields: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int32(), *[pa.string()] * len(keys)]
    for path, digest, header, rows in _files(batches):
        names, number = [plain_name(n, loose) for n in header], 0
        error = file_error(names, locators, anchors)
        places = [[names.index(a) for a in al if a in names] for al in keys.values()]
        for held in iter(lambda: list(itertools.islice(rows, 2000)), []):  # noqa: B023
            n = len(held)
            sizes = [len(c) for c in held]
            raw = [[next((c[i] for i in at if i < size), None) for c, size in zip(held, sizes, strict=True)] if at else pa.nulls(n, pa.string()) for at in places]
            yield _batch([[path] * n, [digest] * n, range(number + 1, number + n + 1), sizes, [not any(x.strip() for x in c) for c in held], [error] * n, [len(names)] * n, *raw], kinds, fields)
            number += n


def bind(spark: SparkSession, path: str, aliases: dict[str, list[str]], loose: bool, locators: list[str] = (), anchors: list[str] = ()) -> DataFrame:
    """Every data row of every file with a raw column for each field (the first alias in the header wins) and file_error for headers that fail.

    Headers must not be blank or repeated; of ``locators`` and of ``anchors`` at least one field must be bound.
    """
    keys = {f: [plain_name(a, loose) for a in al] for f, al in aliases.items()}
    any_of = lambda fields: [a for f in fields for a in keys[f]]
    schema = "path string, sha256 string, row_number long, n_cells int, blank boolean, file_error string, n_names int, " + ", ".join(f"{f}_raw string" for f in keys)
    fields = [x.split()[0] for x in schema.split(", ")]
    return _contents(spark, path).mapInArrow(lambda it: _bind(it, keys, loose, any_of(locators), any_of(anchors), fields), schema)


def import_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales rows with raw and normalised values, import_status and rejection_reason; rejected rows are kept."""
    rows = bind(spark, path, SALES, loose=False)
    raw = lambda f: F.col(f"{f}_raw")
    plain = {f"{f}_norm": T.collapsed(raw(f)) for f in SALES if f not in ("transfer_date", "recording_date", "consideration", "parcel_number", "property_address", "legal_description", "arms_length", "usable_sale")}
    rows = rows.withColumns(plain | {
        "transfer_date": P.strict_date(raw("transfer_date")), "recording_date": P.strict_date(raw("recording_date")), "consideration": P.money(raw("consideration"), parentheses=False),
        "parcel_number_norm": T.parcel_key(raw("parcel_number")), "crosswalk_key": T.crosswalk_key(raw("parcel_number")), "address_norm": T.sale_address_key(raw("property_address")),
        "legal_norm": T.sale_legal_key(raw("legal_description")), "arms_length": T.boolean_token(raw("arms_length")), "usable_sale": T.boolean_token(raw("usable_sale")),
    })
    identified = F.coalesce("parcel_number_norm", "address_norm", T.collapsed(raw("legal_description"))).isNotNull()
    reason = (
        F.when(F.col("file_error").isNotNull(), F.col("file_error"))
        .when(F.col("n_cells") > F.col("n_names"), "extra_columns").when(F.col("blank"), "blank_row")
        .when(T.collapsed(raw("transfer_date")).isNull(), "transfer_date_missing").when(F.col("transfer_date").isNull(), "transfer_date_unparseable")
        .when(T.collapsed(raw("recording_date")).isNotNull() & F.col("recording_date").isNull(), "recording_date_unparseable")
        .when(T.collapsed(raw("consideration")).isNull(), "consideration_missing").when(F.col("consideration").isNull(), "consideration_unparseable")
        .when(~identified, "no_identifier")
    )
    return _status(rows, reason)


def _status(rows: DataFrame, reason: Column) -> DataFrame:
    out = rows.withColumn("rejection_reason", reason)
    return out.withColumn("import_status", F.when(F.col("rejection_reason").isNull(), "loaded").otherwise("rejected")).drop("blank", "file_error")


def _warned(rows: DataFrame, codes: dict[str, Column]) -> DataFrame:
    shape = {"missing_columns": F.col("n_cells") < F.col("n_names"), "extra_columns": F.col("n_cells") > F.col("n_names")}
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), code) for code, c in (codes | shape).items()])
    return rows.withColumn("import_warnings", F.array_sort(F.array_distinct(F.concat("__bad", F.array_compact(found))))).drop("__bad")


def _parsed(rows: DataFrame, dates: list[str], years: dict[str, bool], amounts: list[str]) -> DataFrame:
    """Optional fields parsed; the names of those that are there but cannot be parsed are kept for _warned()."""
    fields = [*dates, *years, *amounts]
    clean = lambda f: F.col(f"__{f}")
    out = rows.withColumns({f"__{f}": T.without_null_tokens(F.col(f"{f}_raw")) for f in fields})
    out = out.withColumns({f: P.flexible_date(clean(f)) for f in dates} | {f: P.year_number(clean(f), one) for f, one in years.items()} | {f: P.money(clean(f)) for f in amounts})
    out = out.withColumn("__bad", F.array_compact(F.array(*[F.when(clean(f).isNotNull() & F.col(f).isNull(), f"{f}_unparseable") for f in fields])))
    return out.drop(*[f"__{f}" for f in fields])


def import_permits(spark: SparkSession, path: str) -> DataFrame:
    """Permit rows; fields that cannot be parsed warn, and a row is rejected only if blank, without locator or without time."""
    rows = bind(spark, path, PERMITS, True, ["parcel_number", "site_address"], ["applied_date", "issued_date", "finaled_date", "status_date", "permit_year"])
    rows = _parsed(rows, ["applied_date", "issued_date", "finaled_date", "status_date"], {"permit_year": False}, ["declared_valuation", "estimated_cost"])
    year, differs = P.derived_year(F.col("permit_year"), F.col("issued_date"), F.col("finaled_date"), F.col("status_date"), F.col("applied_date"))
    rows = _warned(rows, {"permit_year_mismatch": differs})
    clean = lambda f: T.without_null_tokens(F.col(f"{f}_raw"))
    rows = rows.withColumns({"permit_year": year, "parcel_number_norm": T.parcel_key(clean("parcel_number")), "address_norm": T.site_address_key(clean("site_address")), "status_norm": P.permit_status(clean("permit_status"))})
    located = F.coalesce("parcel_number_norm", "address_norm").isNotNull()
    reason = F.when(F.col("file_error").isNotNull(), F.col("file_error")).when(F.col("blank"), "blank_row").when(~located, "no_locator").when(F.col("permit_year").isNull(), "no_temporal_anchor")
    return _status(rows, reason)


def import_appeals(spark: SparkSession, path: str) -> DataFrame:
    """Appeal rows, as permits, that need an appeal signal (number, docket, level, reason or outcome) as well."""
    signal = ["appeal_number", "docket_number", "appeal_level", "appeal_reason", "outcome"]
    rows = bind(spark, path, APPEALS, True, ["parcel_number", "site_address"], ["filing_date", "hearing_date", "decision_date", "tax_year", *signal])
    rows = _parsed(rows, ["filing_date", "hearing_date", "decision_date"], {"tax_year": True}, ["value_before", "requested_value", "decided_value"])
    year, differs = P.derived_year(F.col("tax_year"), F.col("decision_date"), F.col("hearing_date"), F.col("filing_date"))
    clean = lambda f: T.without_null_tokens(F.col(f"{f}_raw"))
    rows = rows.withColumns({"outcome_norm": P.appeal_outcome(clean("outcome")), "level_norm": P.appeal_level(clean("appeal_level")), "reason_norm": P.appeal_reason(clean("appeal_reason"))})
    change, odd = P.value_change(F.col("decided_value"), F.col("value_before"), F.col("outcome_norm"))
    rows = _warned(rows, {"tax_year_mismatch": differs, "increase_with_reduction_outcome": odd})
    rows = rows.withColumns({"tax_year": year, "value_change": change, "parcel_number_norm": T.parcel_key(clean("parcel_number")), "address_norm": T.site_address_key(clean("site_address")), "parcel_id": F.lit(None).cast("string")})
    located = F.coalesce("parcel_number_norm", "address_norm").isNotNull()
    some = F.coalesce(*[clean(f) for f in signal]).isNotNull()
    reason = (
        F.when(F.col("file_error").isNotNull(), F.col("file_error")).when(F.col("blank"), "blank_row").when(~located, "no_locator")
        .when(F.col("tax_year").isNull(), "no_temporal_anchor").when(~some, "no_appeal_signal")
    )
    return _status(rows, reason)


def import_summary(rows: DataFrame) -> DataFrame:
    """(kind, name, n): rows by status, by rejection reason and by warning, from one scan."""
    entry = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("name"))
    entries = F.array(entry("status", F.col("import_status")), entry("reason", F.col("rejection_reason")))
    if "import_warnings" in rows.columns:
        entries = F.concat(entries, F.transform("import_warnings", lambda w: entry("warning", w)))
    counted = rows.select(F.explode(entries).alias("e")).where("e.name is not null")
    return counted.groupBy("e.kind", "e.name").agg(F.count("*").alias("n"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = ("sha256", "row_number")) -> DataFrame:
    """old rows whose key is not in new, and all new rows: importing the same bytes twice changes nothing."""
    keys = list(keys)
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def json_artifacts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents with the file they come from; a bad file is a row with _corrupt_record and does not fail the job."""
    read = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return read.select("*", F.col("_metadata.file_path").alias("file_path"))


def unread_pages(pages: DataFrame, after: int, most: int, status: str = "status_code", parsed: str | None = "parsed_at", page_id: str = "page_id") -> DataFrame:
    """The next ``most`` pages to parse in id order: status 200, id beyond the resume point, not parsed yet if asked."""
    rows = pages.where((F.col(status) == 200) & (F.col(page_id) > after))
    return (rows.where(F.col(parsed).isNull()) if parsed else rows).orderBy(page_id).limit(most)
