"""A table of Parquet files in buckets by key, changed bucket by bucket, with a pointer to each version written last.

A version is a small document that names, for each bucket, the folder its files are in.  A change writes new folders for
the buckets it touches and then the document; until that is there, readers see the version before, and other buckets
keep their files.  The document's name is the version's number and it is put there only if there is none, so of two
writers one fails.  Everything goes through Spark's file systems.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "__bucket"


@dataclass(frozen=True)
class Version:
    number: int
    token: str | None
    schema: StructType
    folders: dict[int, str]  # of each bucket that has rows
    counts: dict[str, int]


class Conflict(RuntimeError):
    """Another writer made the version first."""


class KeyedTable:
    """A table below ``root`` with one row for each value of ``keys``; rows are put into buckets by ``bucket_by``, some of the keys.

    The number of buckets is fixed when the table is made; a bucket should be small enough to be rewritten for one change
    (a table of 100 TB: some 10,000 of them).
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], bucket_by: list[str] | None = None, buckets: int = 64):
        self.spark, self.root, self.keys, self.bucket_by, self.buckets = spark, root.rstrip("/"), list(keys), list(bucket_by or keys), buckets
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError("bucket_by must be keys")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        path = self._path(name)
        return [s.getPath().getName() for s in self._fs(path).listStatus(path)] if self._fs(path).exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def version(self, number: int | None = None) -> Version | None:
        """A version, the newest one if no number is given; None if there is none."""
        known = self.versions()
        if not known or (number is not None and number not in known):
            return None
        number = known[-1] if number is None else number
        said = json.loads(self.spark.read.option("wholetext", True).text(f"{self.root}/versions/{number:010d}.json").first()[0])
        return Version(number, said["token"], StructType.fromJson(said["schema"]), {int(k): v for k, v in said["folders"].items()}, said["counts"])

    def _commit(self, version: Version) -> None:
        made = {"token": version.token, "schema": json.loads(version.schema.json()), "folders": version.folders, "counts": version.counts}
        path, draft = self._path(f"versions/{version.number:010d}.json"), self._path(f"versions/draft-{uuid.uuid4().hex}")
        out = self._fs(draft).create(draft)
        out.write(bytearray(json.dumps(made).encode()))
        out.close()
        hadoop, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        try:  # a rename that does not overwrite: readers never see half a document, and of two writers one fails
            hadoop.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, path, gateway.new_array(hadoop.Options.Rename, 0))
        except Exception as e:
            self._fs(draft).delete(draft, False)
            raise Conflict(f"version {version.number} of {self.root} is already there") from e

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def read(self, number: int | None = None, buckets: set[int] | None = None) -> DataFrame | None:
        """The rows of a version (of some buckets only, if asked for); None if there is no version."""
        found = self.version(number)
        return None if found is None else self._rows(found, buckets)

    def _rows(self, version: Version, buckets: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/data/{folder}/{BUCKET}={b}" for b, folder in sorted(version.folders.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*paths)

    def _touched(self, *rows: DataFrame) -> set[int]:
        """The buckets of rows: at most as many numbers as there are buckets."""
        each = [r.select(self.bucket().alias("b")).distinct() for r in rows]
        return {r.b for r in reduce(DataFrame.union, each).distinct().collect()}

    def _replaced(self, old: Version | None, buckets: set[int], rows: DataFrame, token: str | None, counts: dict[str, int]) -> Version:
        """Write ``rows`` as all that the buckets hold, and commit."""
        number = 1 if old is None else old.number + 1
        folder = f"{number:010d}-{uuid.uuid4().hex}"
        if buckets:
            rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        written = {int(n.split("=")[1]) for n in self._names(f"data/{folder}") if n.startswith(f"{BUCKET}=")}
        folders = {b: f for b, f in (old.folders if old else {}).items() if b not in buckets} | dict.fromkeys(sorted(written), folder)
        schema = StructType([f for f in rows.schema.fields])
        version = Version(number, token, schema, folders, counts)
        self._commit(version)
        return version

    def _aligned(self, old: Version | None, new: DataFrame) -> DataFrame:
        """new with the columns of the table, in their order and types; columns that the table lacks are an error."""
        if old is None:
            return new
        more = set(new.columns) - set(old.schema.names)
        if more:
            raise ValueError(f"columns that the table lacks: {sorted(more)}")
        return new.select(*[(F.col(f"`{f.name}`") if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in old.schema.fields])

    def upsert(self, new: DataFrame, token: str | None = None) -> Version:
        """Rows of ``new`` in place of those with their keys, or beside them; keys must not repeat in new, nulls equal nulls.

        counts of the version: inserted and updated.  With the token of the newest version nothing is done: a batch that
        is tried again after it was committed changes nothing.
        """
        old = self.version()
        if old is not None and token is not None and old.token == token:
            return old
        new = self._aligned(old, new)
        if old is None:
            return self._replaced(None, set(range(self.buckets)), new, token, {"inserted": new.count(), "updated": 0})
        buckets = self._touched(new)
        now = self._rows(old, buckets)
        mine = new.select(*[F.col(f"`{k}`").alias(f"__n{i}") for i, k in enumerate(self.keys)])
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__n{i}")) for i, k in enumerate(self.keys)])
        kept = now.join(mine, same, "left_anti")
        updated = now.join(mine, same, "left_semi").count()
        return self._replaced(old, buckets, kept.unionByName(new), token, {"inserted": new.count() - updated, "updated": updated})

    def replace(self, scope: DataFrame, new: DataFrame, token: str | None = None) -> Version:
        """All rows whose ``bucket_by`` values are in ``scope`` give way to those of ``new``, which must lie in the scope.

        counts: deleted and inserted.
        """
        old = self.version()
        if old is not None and token is not None and old.token == token:
            return old
        new = self._aligned(old, new)
        ids = scope.select(*[F.col(f"`{c}`") for c in self.bucket_by]).distinct()
        asked = ids.select(*[F.col(f"`{c}`").alias(f"__s{i}") for i, c in enumerate(self.bucket_by)])
        inside = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(self.bucket_by)])
        if not new.join(asked, inside, "left_anti").isEmpty():
            raise ValueError("new rows outside the scope")
        if old is None:
            return self._replaced(None, set(range(self.buckets)), new, token, {"deleted": 0, "inserted": new.count()})
        buckets = self._touched(ids)
        now = self._rows(old, buckets)
        kept = now.join(asked, inside, "left_anti")
        deleted = now.join(asked, inside, "left_semi").count()
        return self._replaced(old, buckets, kept.unionByName(new), token, {"deleted": deleted, "inserted": new.count()})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` versions and the folders that none of these names, those of failed writes too.

        Not to be run beside a writer or a reader of an older version.
        """
        known = self.versions()
        used = {f for v in known[-keep:] for f in self.version(v).folders.values()}
        gone = [f"versions/{v:010d}.json" for v in known[:-keep]] + [f"data/{n}" for n in self._names("data") if n not in used]
        for name in gone:
            path = self._path(name)
            self._fs(path).delete(path, True)
        return gone
