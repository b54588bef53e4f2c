"""The registered queries of this subpackage, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.llm import chat, codes, decontam, langid, lines, media, merkle, packing, quality, simhash, toxicity, urls, warc
from lotlens.runtime import cut, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that overlap; documents without overlap have none."""
    return decontam.overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)


#: (host, path, verdict)
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: Pages on these hosts make the list of canonical URLs.
LISTED_HOSTS = r"^(www\.|m\.|blog\.)?(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select(urls.canonical(F.col("url")).alias("canonical_url"))
    return urls.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "listed")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    found = chat.conversations(chat.as_tree(said.unionByName(extra)))

    @F.arrow_udf("struct<n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long>")
    def read(formatted: pa.Array, loss: pa.Array) -> pa.Array:
        names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        rows = []
        for text, spans in zip(formatted.to_pylist(), loss.to_pylist(), strict=True):
            turns, trained = chat.read_back(text, [(x["start"], x["end"]) for x in spans])
            whole, under = "".join(f"{role}\n{said}\n" for role, said in turns), "".join(trained)
            sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append(dict(zip(names, (len(turns), sha(whole), len(under), sha(under), len(text)), strict=True)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.array(rows, pa.struct(list(zip(names, kinds, strict=True))))

    return found.select(F.col("tree").alias("conv_id"), read("formatted", "loss").alias("d")).select("conv_id", "d.*")


def op7_media_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), media.encode(F.col("text")).alias("media"))
    return files.select("doc_id", "n_bytes", media.digest(F.col("media")).alias("d")).select("doc_id", "n_bytes", "d.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def _fold(n: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.learn(docs.where(_fold(5) != 0), table(spark, sf_dir, "labels"))
    found = toxicity.classify(docs.withColumn("held_out", _fold(5) == 0), model)
    return found.select("doc_id", "held_out", "score", "predicted", "flagged")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs.where(_fold(4) != 2), table(spark, sf_dir, "labels"))
    found = quality.classify(docs.withColumn("held_out", _fold(4) == 2), model)
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(_fold(4) != 2))
    return langid.identify(docs.withColumn("held_out", _fold(4) == 2), model).select("doc_id", "held_out", "lang_pred", "score")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives say of each page; a payload that does not fit its digest would show in digest_ok."""
    found = warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"), "digest_ok", "error")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = codes.learn(table(spark, sf_dir, "embeddings"), keep=("label",))
    found = cut(codes.encode(model))
    by_label = found.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    both = found.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = merkle.leaf_of(parts)
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(_fold(3) == 0, merkle.leaf_of([*parts[:-1], lower])).otherwise(leaf).alias("shown"))
    made = merkle.build(rows, "lang", "doc_id", keep=["shown"])
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    folded = merkle.as_hex(F.col("folded"))
    found = merkle.prove(made, "shown")
    return found.select(
        "doc_id", merkle.as_hex(F.col("leaf")).alias("leaf"), merkle.as_hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(merkle.as_hex(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == root).alias("verified"),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_url_filter": op5_url_filter,
    "op6_chat_format": op6_chat_format,
    "op7_media_tiff": op7_media_tiff,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_warc": op11_warc,
    "op12_vector_codes": op12_vector_codes,
    "op13_merkle": op13_merkle,
}

_TRIM = r"regexp_replace(regexp_replace({}, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_QUADS = "||".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
_FIELD = "coalesce(cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || cast({0} as varchar), '-')"
#: CRC-32 of a short ASCII text, a bit at a time: DuckDB has no function for it.
_CRC = """xor(list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(range(1, length({0}) + 1), lambda i: [cast(ascii(substr({0}, cast(i as integer), 1)) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295)"""
_LEAF_SQL = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"

#: The two rounds and the last assignment of op12: books0 -> near0 -> books1 -> near1 -> books2 -> near2.
_NEAR = """
near{k} as (
  select vec_id, part, min_by(entry, d * 64 + entry) as entry, min(d) as d from (
    select c.vec_id, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) as d
    from comps c join books{k} b on c.part = b.part and c.pos = b.pos group by all) group by vec_id, part)"""
_BOOKS = """,
books{n} as (
  select b.part, b.entry, b.pos, coalesce(m.v, b.v) as v from books{k} b left join (
    select c.part, n.entry, c.pos, cast((sum(c.v) - ((sum(c.v) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as v
    from comps c join near{k} n on c.vec_id = n.vec_id and c.part = n.part group by all) m
  on b.part = m.part and b.entry = m.entry and b.pos = m.pos)"""

SQL = {
    "op11_warc": f"""
with p as (select page_id, url, coalesce(html, '') as html from pages),
d as (select *, octet_length(encode(html)) as n, sha1(html) as h from p),
r as (select *, max(page_id) over (partition by n, h) as first from d)
select page_id, n as payload_bytes,
       array_to_string(list_transform(list_transform(range(8), lambda i: cast('0x' || substr(h, cast(i as integer) * 5 + 1, 5) as integer)), lambda v: {_QUADS}), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to,
       case when page_id = first then true end as digest_ok, cast(null as varchar) as error
from r""",
    "op12_vector_codes": f"""
with kept as (
  select vec_id, label, embedding, row_number() over (order by vec_id) - 1 as n from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
flat as (select vec_id, n, len(embedding) // 16 as wide, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as spot from kept),
comps as materialized (
  select vec_id, n, spot // wide as part, spot % wide as pos, cast(floor(256 * cast(x as double)) as bigint) as v from flat),
books0 as (select part, n as entry, pos, v from comps where n < 64),
{_NEAR.format(k=0)}{_BOOKS.format(n=1, k=0)},
{_NEAR.format(k=1)}{_BOOKS.format(n=2, k=1)},
{_NEAR.format(k=2)},
coded as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from near2 group by vec_id),
named as (select k.vec_id, k.label, code, error from coded join kept k on coded.vec_id = k.vec_id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(v as varchar), ',' order by part, entry, pos)) from books2) as codebooks_sha256
from named""",
    "op13_merkle": f"""
with recursive leaves as materialized (
  select doc_id, coalesce('1' || lang, '0') as tree, {_LEAF_SQL.format("text")} as leaf,
         case when {_CRC.format("cast(doc_id as varchar)")} % 3 = 0 then {_LEAF_SQL.format(_LOW.format("text"))} else {_LEAF_SQL.format("text")} end as shown
  from documents),
nodes as (
  select tree, 0 as level, row_number() over (partition by tree order by doc_id) - 1 as idx, leaf as digest, count(*) over (partition by tree) as n from leaves
  union all
  select tree, any_value(level) + 1, idx // 8, sha256(string_agg(digest, '' order by idx)), (any_value(n) + 7) // 8 from nodes where n > 1 group by tree, idx // 8),
subroots as materialized (select tree, level as height, digest from nodes where n = 1),
tops as (
  select 0 as level, row_number() over (order by tree) - 1 as idx, digest, count(*) over () as n from subroots
  union all
  select any_value(level) + 1, idx // 8, sha256(string_agg(digest, '' order by idx)), (any_value(n) + 7) // 8 from tops where n > 1 group by idx // 8),
top_of as (select tree, row_number() over (order by tree) - 1 as idx from subroots),
runs as materialized (
  select tree, level, idx, digest, idx // 8 as up from nodes where n > 1
  union all select 'top', level, idx, digest, idx // 8 from tops where n > 1),
start as (
  select l.doc_id, l.leaf, l.shown, l.tree, row_number() over (partition by l.tree order by l.doc_id) - 1 as idx, s.height, s.digest as subroot
  from leaves l join subroots s on l.tree = s.tree),
climb as (
  select doc_id, tree as own, height, 0 as depth, case when height > 0 then tree else 'top' end as tree, 0 as level,
         case when height > 0 then idx else (select t.idx from top_of t where t.tree = start.tree) end as idx, shown as folded, '' as proof from start
  union all
  select doc_id, own, height, depth + 1, case when up_top then 'top' else tree end, case when up_top then 0 else level + 1 end,
         case when up_top then top_idx else idx // 8 end, folded, proof
  from (
    select c.doc_id, any_value(c.own) as own, any_value(c.height) as height, any_value(c.depth) as depth, any_value(c.tree) as tree, any_value(c.level) as level,
           any_value(c.idx) as idx, any_value(t.idx) as top_idx, any_value(c.tree <> 'top' and c.level + 1 = c.height) as up_top,
           sha256(string_agg(case when r.idx = c.idx then c.folded else r.digest end, '' order by r.idx)) as folded,
           any_value(c.proof) || coalesce(string_agg(r.digest, '' order by r.idx) filter (where r.idx <> c.idx), '') as proof
    from climb c join runs r on r.tree = c.tree and r.level = c.level and r.up = c.idx // 8 join top_of t on t.tree = c.own
    group by c.doc_id) x),
ends as (select doc_id, max_by(folded, depth) as folded, max_by(proof, depth) as proof from climb group by doc_id)
select s.doc_id, s.leaf, s.subroot, (select digest from tops where n = 1) as root, sha256(e.proof) as proof_sha256, e.folded as folded_root,
       e.folded = (select digest from tops where n = 1) as verified
from start s join ends e on s.doc_id = e.doc_id""",
    "op5_url_filter": rf"""
with parts as (
  select page_id, url, coalesce({_LOW.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
         regexp_replace(regexp_replace(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') as query
  from pages),
keyed as (
  select *, case when url is not null then regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
         case when query <> '' then '?' || query else '' end end as key
  from parts),
listed as (select distinct key from keyed where regexp_matches(host, '{LISTED_HOSTS}')),
ruled as (
  select k.*, l.key is not null as listed,
         case when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/7') then 'example.com/en/7'
              when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/de/8') then 'example.net/de/8'
              when (host = 'com' or host like '%.com') and starts_with(path, '/en/') then 'com/en/'
              when (host = 'net' or host like '%.net') and starts_with(path, '/de/') then 'net/de/'
              when (host = 'org' or host like '%.org') and starts_with(path, '/es/') then 'org/es/' end as rule
  from keyed k left join listed l on k.key = l.key)
select page_id, host, path, rule, listed,
       case when rule in ('com/en/', 'example.net/de/8', 'org/es/') then 'block' when rule is not null then 'allow'
            when listed then 'block' else 'allow' end as verdict
from ruled""",
    "op6_chat_format": r"""
with rows as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
said as (
  select conv_id, row_number() over (partition by conv_id order by turn, role, text) as n, coalesce(role, '') as role,
         coalesce(text, '') as text from rows),
sized as (
  select *, length(regexp_replace(regexp_replace(text, '<(\\*)(\||/?s>)', 'XX\1\2', 'g'), '\[(\\*)(/?INST\])', 'XX\1\2', 'g')) as stored
  from said)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(role) + 4 + stored + 8) as bigint) as formatted_chars
from sized group by conv_id""",
    "op1_line_dedup": rf"""
with parts as (select doc_id, row_number() over () as row, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select doc_id, row, generate_subscripts(parts, 1) as pos, unnest(parts) as line from parts),
keyed as (select *, {_LOW.format(_TRIM.format("line"))} as key from lines),
hot as (select key, max(doc_id) as keep from keyed where length(key) >= 40 group by key having count(distinct row) >= 5),
marked as (select k.*, h.key is not null and h.keep <> k.doc_id as gone from keyed k left join hot h on k.key = h.key)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by row, doc_id""",
}
