"""WARC archives: exact round trips, revisits, damage and odd rows."""

from __future__ import annotations

import uuid
from collections import defaultdict
from pathlib import Path

import pytest
import zstandard
from lotlens.llm import warc


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def test_round_trip_of_odd_rows(spark, odd, folder):
    warc.write(odd, folder, key="doc_id", url="source", payload="text", archive_bytes=5000)
    found = rows_of(warc.read(spark, folder))
    given = rows_of(odd)
    assert len(found) == len(given) and not any(r["error"] for r in found)
    groups = defaultdict(list)
    for r in given:
        groups[(r["text"] or "").encode()].append(r["doc_id"])
    first = {text: max((k for k in keys if k is not None), default=None) for text, keys in groups.items()}
    want = []
    for r in given:
        body = (r["text"] or "").encode()
        kept = r["doc_id"] == first[body]
        want.append((str(r["doc_id"]) if r["doc_id"] is not None else None, r["source"], "response" if kept else "revisit", None if kept else str(first[body]), len(body), warc.payload_digest(body), body if kept else b""))
    got = [(r["key"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], bytes(r["payload"])) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["digest_ok"] for r in found if r["record_type"] == "response")
    assert len({r["archive"] for r in found}) > 1


def test_shuffled_revisits_agree(spark, odd, folder, monkeypatch):
    monkeypatch.setattr(warc, "MAX_BROADCAST_ROWS", 0)
    warc.write(odd, folder, key="doc_id", url="source", payload="text")
    got = {(r["key"], r["record_type"], r["refers_to"], r["payload_digest"]) for r in rows_of(warc.read(spark, folder))}
    monkeypatch.undo()
    warc.write(odd, f"{folder}b", key="doc_id", url="source", payload="text")
    assert got == {(r["key"], r["record_type"], r["refers_to"], r["payload_digest"]) for r in rows_of(warc.read(spark, f"{folder}b"))}


def test_empty_table(spark, none):
    assert warc.archived(none, key="doc_id", url="source", payload="text").count() == 0


def test_each_record_stands_alone(spark, folder):
    """A record is read from its place alone, with the dictionary of the archive's first frame."""
    text = [f"<html><body><p>Page number {k} of the same site, with the same words.</p></body></html>" for k in range(300)]
    pages = spark.createDataFrame([(k, f"http://a.example/{k}\r\nX: y", t) for k, t in enumerate(text)], "page_id long, url string, html string").coalesce(1)
    warc.write(pages, folder)
    raw = next(Path(folder.removeprefix("file://")).glob("part-*")).read_bytes()
    assert raw[:4] == warc.DICTIONARY_MAGIC and raw.endswith(warc.EMPTY_FRAME)
    size = int.from_bytes(raw[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    for r in rows_of(warc.read(spark, folder)):
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(raw[r["offset"] : r["offset"] + r["length"]])
        headers, _, payload = warc.parse(one)
        assert payload.decode() == text[int(r["key"])]
        assert headers["warc-target-uri"] == f"http://a.example/{r['key']}%0D%0AX: y"


def test_dictionary_shortens_records():
    records = [warc.render(str(k), f"http://a.example/{k}", f"<p>body {k}</p>".encode(), "A" * 32, "2020-01-01T00:00:00Z") for k in range(500)]
    dictionary = zstandard.ZstdCompressionDict(warc.build_dictionary(records))
    plain = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert sum(len(zstandard.ZstdCompressor(dict_data=dictionary).compress(r)) for r in records) < plain / 2
    assert warc.build_dictionary([]) == b"" and warc.build_dictionary([b"few"]) == b"few"


def test_damage_is_reported(spark, tmp_path):
    pack = zstandard.ZstdCompressor(write_checksum=True)
    good = warc.render("1", "u", b"body", warc.payload_digest(b"body"), "2020-01-01T00:00:00Z")
    wrong = warc.render("2", "u", b"other", warc.payload_digest(b"body"), "2020-01-01T00:00:00Z")
    frame = pack.compress(good)
    for k, raw in enumerate([frame + pack.compress(b"no record") + frame, frame + frame[:-9], frame + b"junk of some length", pack.compress(wrong), b"", warc.EMPTY_FRAME]):
        (tmp_path / f"part-{k}").write_bytes(raw)
    found = rows_of(warc.read(spark, f"file://{tmp_path}"))
    by = defaultdict(list)
    for r in found:
        by[r["archive"][-1]].append(r)
    assert [bool(r["error"]) for r in by["0"]] == [False, True, False]
    assert [bool(r["error"]) for r in by["1"]] == [False, True] and [bool(r["error"]) for r in by["2"]] == [False, True]
    assert [r["digest_ok"] for r in by["3"]] == [False] and "4" not in by and "5" not in by


def test_keys_of_text_and_other_columns(spark, folder):
    rows = [("a b/ü%", "x", None, 1), (None, None, "", 2), ("z", "x", "", 3)]
    pages = spark.createDataFrame(rows, "`page.id` string, url string, html string, sha int")
    warc.write(pages, folder, key="page.id")
    got = {(r["key"], r["record_type"], r["refers_to"], r["url"]) for r in rows_of(warc.read(spark, folder))}
    assert got == {("a b/ü%", "revisit", "z", "x"), (None, "revisit", "z", None), ("z", "response", None, "x")}
