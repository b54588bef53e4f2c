"""URL filter: rules for hosts and paths, then a blocked Bloom filter before an exact hash join with listed URLs.

Everything is DataFrame expressions.  The filter is a table with one row for each block of 256 bits; a URL picks one
block and one bit in each of its four words, so a probe is one equi-join with a small table.  Only possible hits reach
the exact join, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS_PER_BLOCK, BITS_PER_KEY = 4, 16
#: The filter is broadcast while its rows (a number and four words each) stay below this; beyond, it is joined by shuffle.
MAX_FILTER_BYTES = 64 << 20
ROW_BYTES = 8 * (WORDS_PER_BLOCK + 1)
SALTS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; '' for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; '' for null or without ://."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host and path without scheme, fragment, leading www., tracking parameters (utm_*) and closing slashes; null stays null."""
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, "(^|&)utm_[^&]*", ""), "^&", "")
    where = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(url.isNotNull(), F.concat(where, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(host and path of the longest rule that fits, its verdict), null if none does; a rule list is short, URLs are not."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _bits(key: Column) -> list[Column]:
    """The bit of a key in each word, as a mask, from six bits of a second hash each."""
    second = F.xxhash64(F.lit(11), key)
    spots = [F.shiftrightunsigned(second, 6 * k).bitwiseAND(63).cast("int") for k in range(WORDS_PER_BLOCK)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), spot) for spot in spots]


def bloom_table(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w3): the filter of the distinct keys in ``listed``."""
    masks = _bits(F.col(key))
    rows = listed.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *[m.alias(f"__w{k}") for k, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"__w{k}").alias(f"__w{k}") for k in range(WORDS_PER_BLOCK)])


def flag_listed(urls: DataFrame, listed: DataFrame, key: str, row_id: str, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """urls with a boolean ``__listed``: whether ``key`` is among the keys of ``listed``; a null key is not.

    Rows that the filter refuses never shuffle.  Possible hits of one key are dealt over SALTS tasks by ``row_id``.
    """
    keys = listed.select(F.col(key).alias("__key")).where("__key is not null").distinct()
    n = keys.count()
    blocks = max(1, -(-n * BITS_PER_KEY // (64 * WORDS_PER_BLOCK)))
    table = bloom_table(keys, "__key", blocks)
    if blocks * ROW_BYTES <= max_filter_bytes:
        table = F.broadcast(table)
    # The row itself travels as one struct, so its columns may have any names.
    rows = urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{row_id}`").alias("id"))
    probed = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).join(table, "block", "left")
    passes = F.lit(True)
    for k, m in enumerate(_bits(F.col("key"))):
        passes = passes & (F.col(f"__w{k}").bitwiseAND(m) == m)
    probed = probed.select("row", "key", "id", F.coalesce(passes & F.col("key").isNotNull(), F.lit(False)).alias("maybe"))
    salted = keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    maybe = probed.where("maybe").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    exact = maybe.join(salted, (F.col("key") == F.col("__key")) & (F.col("salt") == F.col("__salt")), "left").select("row.*", F.col("__key").isNotNull().alias("__listed"))
    return exact.unionByName(probed.where("not maybe").select("row.*", F.lit(False).alias("__listed")))


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url", page_id: str = "page_id", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """pages with host, path, canonical_url, rule, listed and verdict; such columns are replaced.

    verdict is that of the longest fitting rule, else block for URLs whose canonical form is in the column
    ``canonical_url`` of ``listed`` (repeated and null entries do not matter), else allow.  Null urls have empty host and
    path, no rule and verdict allow.  Repeated rows stay, and so do all other columns; empty tables are fine.
    """
    made = ["host", "path", "canonical_url", "rule", "listed", "verdict"]
    own = [c for c in pages.columns if c.lower() not in made]
    parsed = pages.select(*[F.col(f"`{c}`") for c in own]).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "canonical_url": canonical(F.col(url))})
    found = flag_listed(parsed, listed, "canonical_url", page_id, max_filter_bytes).withColumnRenamed("__listed", "listed")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return found.withColumns({"rule": rule, "verdict": F.coalesce(verdict, method)})
