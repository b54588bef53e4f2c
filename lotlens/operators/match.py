"""Entity match: cascades of keys, syncs with what was matched before, audit and context."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.functions.parsing import confidence_tier, price_gap_flag
from lotlens.operators.pick import best_row


# The tiers of matching sales to parcels and what a match of each is worth; below ACCEPT a match needs review.
TIERS = {"exact_parcel_number": 1.0, "parcel_number_crosswalk": 0.95, "normalized_address": 0.9, "normalized_legal_description": 0.8}
ACCEPT = 0.85


def _long(df: DataFrame, row_id: str, keys: list[Column]) -> DataFrame:
    """(row_id, level, key) for each key that is known."""
    pairs = F.array(*[F.struct(F.lit(k).alias("level"), c.cast("string").alias("key")) for k, c in enumerate(keys)])
    return df.select(row_id, F.explode(pairs).alias("__p")).select(row_id, "__p.level", "__p.key").where("key is not null")


def cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, float, Column, Column]], accept: float = ACCEPT) -> DataFrame:
    """All candidates of the first tier that hits: left id, right id, method, confidence, match_rank, is_primary, review_status.

    tiers: (method, confidence, key of left rows, key of right rows).  A single candidate with confidence >= accept is
    primary and auto_accepted; others need review.  Null keys never match; left ids are distinct.  All tiers are one join
    on (tier, key): first with the distinct keys of the right side, from which each left row keeps its first tier, then
    with the candidates of that one key, ranked once for all left rows that share it.
    """
    methods = F.array(*[F.lit(t[0]) for t in tiers])
    worth = F.array(*[F.lit(float(t[1])) for t in tiers])
    theirs = _long(right, right_id, [t[3] for t in tiers]).distinct()
    of_key = Window.partitionBy("level", "key")
    theirs = theirs.withColumns({"match_rank": F.row_number().over(of_key.orderBy(right_id)), "__n": F.count("*").over(of_key)})
    known = theirs.where("match_rank = 1").select("level", "key")
    first = _long(left, left_id, [t[2] for t in tiers]).join(known, ["level", "key"]).groupBy(left_id).agg(F.min(F.struct("level", "key")).alias("m"))
    found = first.select(left_id, "m.level", "m.key").join(theirs, ["level", "key"])
    confidence = F.element_at(worth, F.col("level") + 1)
    sure = (F.col("__n") == 1) & (confidence >= accept)
    status = F.when(sure, "auto_accepted").otherwise("needs_review")
    return found.select(left_id, right_id, F.element_at(methods, F.col("level") + 1).alias("method"), confidence.alias("confidence"), "match_rank", sure.alias("is_primary"), status.alias("review_status"))


def unique_cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, Column, list[Column]]]) -> DataFrame:
    """left id, right id and method of the first tier whose key has exactly one right row; ambiguous keys fall through.

    tiers: (method, key of left rows, keys of right rows).  Left rows without such a tier are left out.
    """
    hits = []
    for level, (method, a, keys) in enumerate(tiers):
        pairs = reduce(DataFrame.unionByName, [right.select(right_id, k.alias("__key")) for k in keys]).where("__key is not null")
        index = pairs.groupBy("__key").agg(F.min(right_id).alias(right_id), F.max(right_id).alias("__last")).where(F.col(right_id) == F.col("__last"))
        hits.append(left.select(left_id, a.alias("__key")).join(index, "__key").select(left_id, right_id, F.lit(level).alias("level"), F.lit(method).alias("method")))
    every = reduce(DataFrame.unionByName, hits)
    return every.groupBy(left_id).agg(F.min(F.struct("level", "method", right_id)).alias("m")).select(left_id, f"m.{right_id}", "m.method")


def sync(new: DataFrame, old: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys and action: insert, update, delete or keep, by a full outer join and null-safe comparison."""
    n = new.select(*keys, F.struct(*values).alias("__new"))
    o = old.select(*keys, F.struct(*values).alias("__old"))
    both = n.join(o, keys, "full_outer")
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"__new.{v}").eqNullSafe(F.col(f"__old.{v}"))
    action = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(same, "keep").otherwise("update")
    return both.select(*keys, action.alias("action"))


def flag_sync(new: DataFrame, old: DataFrame, keys: list[str], active: str = "is_active") -> DataFrame:
    """Exclusions after a re-run: vanished ones become inactive, those that reappear active again.

    old: keys and ``active``.  action: insert, keep, reactivate, deactivate, or none for what was inactive and still is.
    """
    n = new.select(*keys, F.lit(True).alias("__now")).distinct()
    both = n.join(old.select(*keys, F.col(active).alias("__was")), keys, "full_outer")
    now, was = F.col("__now").isNotNull(), F.col("__was")
    action = F.when(was.isNull(), "insert").when(now & was, "keep").when(now, "reactivate").when(was, "deactivate").otherwise("none")
    return both.select(*keys, now.alias(active), action.alias("action"))


def review_outcome(status: Column, n_matches: Column, best: Column, accept: float = 0.85) -> Column:
    """Review state of a transaction: reviewed is never overwritten; else unresolved, ambiguous, low_confidence or unreviewed."""
    return F.when(status == "reviewed", "reviewed").when(n_matches == 0, "unresolved").when(n_matches > 1, "ambiguous").when(best < accept, "low_confidence").otherwise("unreviewed")


def best_match(matches: DataFrame, key: str) -> DataFrame:
    """One match a transaction: primary first, then rank (nulls last), then confidence."""
    at = Window.partitionBy(key).orderBy(F.desc("is_primary"), F.asc_nulls_last("match_rank"), F.desc("confidence"))
    return matches.withColumn("__n", F.row_number().over(at)).where("__n = 1").drop("__n")


def dossier_match(matches: DataFrame, key: str, row_id: str) -> DataFrame:
    """The match that a dossier shows: primary, known confidence, confidence, rank (nulls last), smallest id."""
    order = [F.desc("is_primary"), F.desc_nulls_last("confidence"), F.asc_nulls_last("match_rank"), F.asc(row_id)]
    return best_row(matches.withColumn("is_primary", F.coalesce("is_primary", F.lit(False))), [key], order)


def audit(transactions: DataFrame, matches: DataFrame, key: str, status: str = "review_status", sample: int = 3, accept: float = ACCEPT) -> DataFrame:
    """(section, name, n, sample_ids): totals, review states, methods and tiers of the best match, and the review queue.

    Methods and tiers are those of matched transactions.  The queue holds what needs review: unresolved without a match,
    ambiguous with several, low_confidence where the best is below ``accept`` or unknown; a transaction may be in two
    classes.  Only classes of the queue have the first ``sample`` ids.
    """
    candidates = matches.groupBy(key).agg(F.count("*").alias("__n"))
    best = best_match(matches, key).select(key, "method", "confidence", F.lit(True).alias("__matched"))
    rows = transactions.select(key, F.col(status).alias("__status")).join(best, key, "left").join(candidates, key, "left")
    matched, waits = F.col("__matched").isNotNull(), F.col("__status").eqNullSafe("needs_review")
    low = F.coalesce(F.col("confidence") < accept, F.lit(True))
    entry = lambda section, name: F.struct(F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name.cast("string")).alias("name"))
    entries = F.array_compact(F.array(
        F.when(matched, entry("totals", "matched")).otherwise(entry("totals", "unmatched")), F.when(F.col("__status").isNotNull(), entry("review_status", F.col("__status"))), F.when(matched, entry("method", F.col("method"))),
        F.when(matched, entry("tier", confidence_tier(F.col("confidence")))), F.when(~matched & waits, entry("queue", "unresolved")), F.when(matched & waits & (F.col("__n") > 1), entry("queue", "ambiguous")), F.when(matched & waits & low, entry("queue", "low_confidence")),
    ))
    each = rows.select(key, F.inline(entries)).withColumn("__label", F.concat_ws("/", "section", "name"))
    found = first_ids(each, "__label", key, sample)
    section = F.substring_index("__label", "/", 1)
    return found.select(section.alias("section"), F.expr("substring(__label, length(substring_index(__label, '/', 1)) + 2)").alias("name"), "n", F.when(section == "queue", F.col("sample_ids")).alias("sample_ids"))


def sale_signals(sales: DataFrame, facts: DataFrame) -> DataFrame:
    """sales (txn, parcel_id, yr, price) with context: facts at all, a fact of the year, permits, appeals, price gap, area.

    facts: parcel_id, yr, area, v, recent_permit (boolean), appeals (number).  The area is that of the year, else the newest known.
    """
    known = F.nullif("area", F.lit(""))
    newest = facts.groupBy("parcel_id").agg(F.max_by(known, F.when(known.isNotNull(), F.col("yr"))).alias("__newest"), F.lit(True).alias("__any"))
    year = facts.select("parcel_id", "yr", known.alias("__area"), "v", "recent_permit", "appeals", F.lit(True).alias("__year"))
    rows = sales.join(year, ["parcel_id", "yr"], "left").join(newest, "parcel_id", "left")
    no = F.lit(False)
    return rows.select(
        *sales.columns, F.coalesce("__any", no).alias("has_context"), F.coalesce("__year", no).alias("has_year"),
        F.coalesce("recent_permit", no).alias("has_permit"), F.coalesce(F.col("appeals") > 0, no).alias("has_appeal"), price_gap_flag(F.col("price"), F.col("v")).alias("has_gap"),
        F.coalesce("__area", "__newest", F.lit("UNKNOWN")).alias("area"),
    )


def area_signals(signals: DataFrame) -> DataFrame:
    """For each area the sales with a fact of their year, how many carry each signal, and the rates."""
    n, names = F.count("*"), ["permit", "appeal", "gap"]
    counts = [F.count_if(f"has_{x}").alias(f"n_{x}") for x in names]
    return signals.where("has_year").groupBy("area").agg(n.alias("n"), *counts, *[F.round(F.count_if(f"has_{x}") / n, 4).alias(f"{x}_rate") for x in names])


def context_years(sales: DataFrame, facts: DataFrame, years: int = 2, newest: int = 5) -> DataFrame:
    """(txn, fact_yr, fact columns): facts within ``years`` of the sale's year, or the parcel's ``newest`` if none is.

    sales: txn, parcel_id, yr; facts: one row a parcel and year.
    """
    order = Window.partitionBy("parcel_id").orderBy(F.desc("yr"))
    ranked = facts.withColumn("__rank", F.row_number().over(order)).withColumnRenamed("yr", "fact_yr")
    both = sales.select("txn", "parcel_id", "yr").join(ranked, "parcel_id").withColumn("__near", F.abs(F.col("fact_yr") - F.col("yr")) <= years)
    any_near = F.max("__near").over(Window.partitionBy("txn"))
    return both.withColumn("__some", any_near).where(F.col("__near") | (~F.col("__some") & (F.col("__rank") <= newest))).drop("__rank", "__near", "__some", "yr")


def first_ids(df: DataFrame, by: str, row_id: str, most: int) -> DataFrame:
    """For each group its count and its first ``most`` ids; only those are ever collected."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(row_id))).where(F.col("__n") <= most)
    ids = ranked.groupBy(by).agg(F.array_join(F.sort_array(F.collect_list(row_id)), ",").alias("sample_ids"))
    return df.groupBy(by).agg(F.count("*").alias("n")).join(ids, by)
