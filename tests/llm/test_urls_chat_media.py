from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotlens.llm import chat, media, queries, urls


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Com/en/x?q#f": ("a.com", "/en/x", "com/en/", "block"), "https://x.example.com/en/7": ("x.example.com", "/en/7", "example.com/en/7", "allow"),
        "x://net/de/8": ("net", "/de/8", "net/de/", "allow"), "x://q.example.net/de/8": ("q.example.net", "/de/8", "example.net/de/8", "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"), "http://É.org/es/": ("É.org", "/es/", "org/es/", "block"),
        "http://notcom/en/": ("notcom", "/en/", None, "allow"), "http://listed.test/a/?utm_source=x": ("listed.test", "/a/", None, "block"), "http://www.listed.test/a#z": ("www.listed.test", "/a", None, "block"), "http://q?": ("q", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(cases)] + [(None, None, "old", 1)], "page_id long, url string, verdict string, w0 int")
    listed = spark.createDataFrame([("listed.test/a",), ("listed.test/a",), (None,)], "canonical_url string")
    for limit in (1 << 26, 0):
        got = urls.judge(df, listed, queries.URL_RULES, max_filter_bytes=limit)
        by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
        assert [by[i] for i in range(len(cases))] == list(cases.values()) and by[None][3] == "allow"
        assert got.columns[:3] == ["page_id", "url", "w0"]
    assert urls.judge(df.where("false"), listed, queries.URL_RULES).count() == 0
    assert urls.judge(df, listed.where("false"), []).where("verdict = 'block'").count() == 0


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    got = urls.flag_listed(keys, keys.where("id % 4 = 0"), "key", "id")
    assert got.where("__listed <> (id % 4 = 0)").count() == 0
    blocks = -(-5000 * urls.BITS_PER_KEY // 256)
    table = urls.bloom_table(keys.where("id % 4 = 0"), "key", blocks)
    probed = keys.where("id % 4 <> 0").withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).join(table, "block")
    for k, m in enumerate(urls._bits(F.col("key"))):
        probed = probed.where(F.col(f"__w{k}").bitwiseAND(m) == m)
    assert probed.count() < 0.02 * 15_000


def test_escaping_is_reversible():
    rng = random.Random(1)
    parts = ["<", "|", "\\", "[", "INST]", "/", "s>", "a", ">", "end", "|>", "\n", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        turns = [(text, text[::-1]), ("assistant", text), ("user", ""), ("assistant", "")]
        formatted, spans = chat.format_turns(turns)
        back, under = chat.read_back(formatted, spans)
        assert back == turns and under == ([text[::-1]] if text == "assistant" else []) + [text, ""]
        body = chat.escape(text)
        assert not any(c in body for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def tree(spark, rows):
    return spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")


def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "good", 0.9), ("t", 3, 1, "assistant", "bad", 0.1), ("t", 4, 2, "user", "thanks", None), ("t", 5, 3, "user", "hm", 5.0)]
    rows += [("loop", 1, 2, "user", "a", 1.0), ("loop", 2, 1, "user", "b", 1.0), ("loop", 3, 2, "user", "c", 1.0), ("lost", 7, 99, "user", "x", 1.0), ("self", 1, 1, None, None, 1.0), (None, 1, None, "user", "n", 0.0), ("t", 1, None, "user", "q", 0.0)]
    got = {(r["tree"], r["rank"]): (r["leaf"], r["formatted"]) for r in chat.conversations(tree(spark, rows), branches=2).collect()}
    turn = lambda role, text: f"<|{role}|>{text}<|end|>\n"
    assert got == {
        ("t", 1): (5, turn("user", "q") + turn("assistant", "bad") + turn("user", "hm")), ("t", 2): (4, turn("user", "q") + turn("assistant", "good") + turn("user", "thanks")),
        ("lost", 1): (7, turn("user", "x")), ("self", 1): (1, turn("", "")), (None, 1): (1, turn("user", "n")),
    }
    assert chat.conversations(tree(spark, [])).count() == 0


def test_long_chain_and_star(spark):
    rows = [("chain", i, i - 1 if i else None, "user", str(i), 0.0) for i in range(300)] + [("star", i, 0 if i else None, "user", str(i), float(i)) for i in range(200)]
    got = {r["tree"]: r["formatted"] for r in chat.conversations(tree(spark, rows)).collect()}
    assert got["chain"] == "".join(f"<|user|>{i}<|end|>\n" for i in range(300))
    assert got["star"] == "<|user|>0<|end|>\n<|user|>199<|end|>\n"


def test_repeated_turns_stay(spark):
    flat = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    got = chat.conversations(chat.as_tree(flat)).collect()
    assert [len(chat.read_back(r["formatted"], [])[0]) for r in got] == [3]


@pytest.mark.parametrize("n", [0, 1, 3, 254, 255, 256, 257, 3837, 3838, 3839, 20_000])
def test_codecs(n):
    rng = np.random.default_rng(n)
    for k in (2, 7, 256):
        data = rng.integers(0, k, n, dtype=np.uint8).tobytes()
        assert media.unpack_bits(media.pack_bits(data)) == data
        assert media.lzw_decode(media.lzw_encode(data)) == data


@pytest.mark.parametrize("compression", list(media.CODES))
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, (16, 32)])
@pytest.mark.parametrize("order", ["<", ">"])
def test_pages_round_trip(compression, predictor, tile, order):
    rng = np.random.default_rng(1)
    for dtype in (np.uint8, np.uint16):
        stack = [rng.integers(0, 200, (150, 50, s), dtype=dtype) for s in (1, 3)]
        got = list(media.read_pages(media.write_pages(stack, compression, predictor, tile, order)))
        assert all((p.samples == s).all() for p, s in zip(got, stack, strict=True)) and [p.tiled for p in got] == [tile is not None] * 2


def test_damaged_files(spark):
    good = media.write_pages([np.zeros((4, 64, 3), np.uint8)])
    loop = bytearray(good)
    loop[-4:] = loop[4:8]
    files = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"II*")), (3, None), (4, bytearray(good[:40])), (5, loop), (None, bytearray(good))], "doc_id long, media binary")
    rows = media.pages(files).collect()
    assert {(r["doc_id"], r["page"], r["error"] is not None) for r in rows} == {(1, 0, False), (2, None, True), (3, None, True), (4, None, True), (5, 0, False), (5, None, True), (None, 0, False)}
    got = {r["doc_id"]: r["d"] for r in files.select("doc_id", media.digest(F.col("media")).alias("d")).collect()}
    assert got[1]["payload_bytes"] == 768 and got[2] is None and got[3] is None and got[5] is None
    assert media.pages(files.where("false")).count() == 0


def test_bad_fields_are_errors():
    """Sizes of zero, missing or huge ones, no samples, and a file without a directory."""
    page = np.zeros((4, 64, 3), np.uint8)

    def changed(tag, value, tile=None):
        data = bytearray(media.write_pages([page], tile=tile))
        at = next(i for i in range(8, len(data) - 12) if data[i : i + 2] == tag.to_bytes(2, "little") and data[i + 2 : i + 4] in (b"\3\0", b"\4\0") and data[i + 4 : i + 8] == b"\1\0\0\0")
        data[at : at + 2] = (tag if value is not None else 65000).to_bytes(2, "little")
        data[at + 8 : at + 12] = (value or 0).to_bytes(4, "little")
        return bytes(data)

    bad = [changed(media.ROWS_PER_STRIP, 0), changed(media.TILE_WIDTH, 0, (16, 16)), changed(media.TILE_LENGTH, None, (16, 16)), changed(media.SAMPLES, 0), changed(media.WIDTH, 1 << 30)]
    bad += [changed(media.TILE_LENGTH, 1 << 30, (64, 16)), b"II*\0\0\0\0\0"]
    for data in bad:
        assert [r[-1] is not None for r in media._page_rows(data)] == [True]


def test_every_layout_holds_the_payload():
    payload = media.payload_of("läuft " * 9000)
    assert {c for c, _, _ in media.LAYOUTS} == set(media.CODES)
    for layout in set(media.LAYOUTS):
        assert b"".join(p.samples.tobytes() for p in media.read_pages(media.stored(payload, layout))) == payload


def test_op7_contract(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_media_tiff(spark, sf).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))


def test_long_text_has_many_pages(odd):
    text = odd.where("doc_id = 10").first()["text"] * 3
    docs = odd.where("doc_id = 10").withColumn("text", F.repeat("text", 3))
    rows = media.pages(docs.select("doc_id", media.encode(F.col("text")).alias("media"))).orderBy("page").collect()
    assert len(rows) == 3 and b"".join(bytes(r["pixels"]) for r in rows).decode().rstrip(" ") == text


def test_columns_named_like_the_filters(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", 5, 6, 7, 8), (2, None, 5, 6, 7, 8)], "page_id long, url string, __block int, __w0 int, block int, key int")
    listed = spark.createDataFrame([("a.b/c",)], "canonical_url string")
    got = {r["page_id"]: r for r in urls.judge(pages, listed, []).collect()}
    assert [got[1][c] for c in ("verdict", "__block", "__w0", "block", "key")] == ["block", 5, 6, 7, 8] and got[2]["verdict"] == "allow"
