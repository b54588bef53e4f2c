"""WARC archives with a Zstandard dictionary: each record is a frame of its own, the dictionary leads in a skippable frame.

Records of equal payloads are stored once; the others are revisits that name it.  Payloads are not shuffled while the
revisits are few enough to be broadcast: a task packs the pages it has scanned into archives of bounded size.  The text
writer puts each archive into a file, ended by an empty skippable frame, so that Spark's commit protocol and any of its
file systems hold for archives too.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.runtime import cut, scratch

#: Fixed values of the file formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = b"P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed when its frames reach this size; it is read back as one value, so it must fit a task.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is built from about so many records drawn at random, of each of which so many bytes of payload are taken;
#: that bounds what the driver gets from all tasks together (8 MB) and decides about nothing but the archives' size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 8192, 65536
LEVEL = 3
#: Revisits are broadcast up to this many (some 60 bytes each); beyond, pages meet them by a shuffle.
MAX_BROADCAST_ROWS = 500_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    """A value for one header line: what would break the line is percent-encoded."""
    return "".join(urllib.parse.quote(c) if c < " " or c == "\x7f" else c for c in value)


def _record_id(key: str | None) -> str:
    return "<urn:page>" if key is None else f"<urn:page:{urllib.parse.quote(key, safe='')}>"


def _key_of(record_id: str | None) -> str | None:
    head, _, key = (record_id or "").strip("<>").partition("page:")
    return urllib.parse.unquote(key) if head == "urn:" else None


def render(key: str | None, url: str | None, payload: bytes, digest: str, date: str, size: int | None = None, refers_to: str | None = None, revisit: bool = False) -> bytes:
    """A record as bytes: a response with its payload, or a revisit with the response's head only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n".encode()
    block += b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(key)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcError(ValueError):
    """An archive or a record that cannot be read."""


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of a record, names in lower case."""

    def fields(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
        return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}

    head, found, rest = record.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise WarcError("no WARC header")
    warc = fields(head)
    size = warc.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        raise WarcError("Content-Length is missing or beyond the record")
    http, _, payload = rest[: int(size)].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the records' common strings; the records themselves where they are too few; empty for none."""
    if sum(map(len, records)) == 0:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, records)) // 8)), records, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICTIONARY_MAGIC + len(body).to_bytes(4, "little") + body


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its block headers."""
    kind = bytes(data[at : at + 4])
    if 0x184D2A50 <= int.from_bytes(kind, "little") <= 0x184D2A5F:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    elif kind == FRAME_MAGIC:
        end, last = at + zstandard.frame_header_size(data[at : at + 18]), False
        while not last:
            if end + 3 > len(data):
                raise WarcError("archive ends inside a frame")
            head = int.from_bytes(data[end : end + 3], "little")
            last = bool(head & 1)
            end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        end += 4 * (data[at + 4] >> 2 & 1)
    else:
        raise WarcError("no frame")
    if end > len(data):
        raise WarcError("archive ends inside a frame")
    return end


def frames(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, stored length, record) of each record; damage ends the archive with a WarcError."""
    data, at, reader = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = _frame_end(data, at)
            if data[at : at + 4] == DICTIONARY_MAGIC:
                body = bytes(data[at + 8 : end])
                body = reader.decompressobj().decompress(body) if body[:4] == FRAME_MAGIC else body
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            elif data[at : at + 4] == FRAME_MAGIC:
                yield at, end - at, reader.decompressobj().decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise WarcError(str(e)) from None
        at = end


def _assigned(pages: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(pages that keep their payload, revisits with their digest, size and the key of the response, number of pages)."""
    keyed = pages.withColumn("sha", F.unhex(F.sha1("payload")))
    keys = cut(keyed.select("key", "url", "sha", F.octet_length("payload").cast("long").alias("size")))
    first = keys.groupBy("sha", "size").agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = cut(keys.join(first, ["sha", "size"]).where("not key <=> first"))
    gone = again.select("key", "sha").distinct()
    if again.count() <= MAX_BROADCAST_ROWS:
        gone = F.broadcast(gone)
    kept = keyed.alias("p").join(gone.alias("g"), F.col("p.key").eqNullSafe(F.col("g.key")) & (F.col("p.sha") == F.col("g.sha")), "left_anti")
    return kept, again, keys.count()


def _sample(pages: DataFrame, n: int) -> DataFrame:
    """About SAMPLE_RECORDS of n pages, each with a piece of its payload, drawn by a hash of the row and its place."""
    share = min(1.0, SAMPLE_RECORDS / max(1, n))
    drawn = F.xxhash64("payload", "key", F.monotonically_increasing_id()) <= min(2**63 - 1, int(2**64 * share) - 2**63)
    spot = F.pmod(F.xxhash64("payload"), F.greatest(F.lit(1), F.octet_length("payload") - SAMPLE_BYTES)).cast("int") + 1
    return pages.where(drawn).select(F.col("key").cast("string"), "url", F.substring("payload", spot, F.lit(SAMPLE_BYTES)).alias("part"))


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each page to archives in ``folder``, which must not exist.

    Of the records of equal payloads that with the largest key is the response, the others are revisits of it.  A null
    payload is an empty one; a null key comes before all others; rows that repeat the largest key with the same payload
    are all responses.  A null url has no header; control characters of urls are percent-encoded.  Other columns are not
    read.  An empty table gives no archive.
    """
    col = lambda name: F.col(f"`{name}`")
    own = pages.select(col(key).alias("key"), col(url).cast("string").alias("url"), F.coalesce(col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    kept, again, n = _assigned(own)
    dictionary = build_dictionary([render(r.key, r.url, bytes(r.part), payload_digest(bytes(r.part)), date) for r in _sample(own, n).collect()])
    none = F.lit(None)
    rows = kept.select(F.col("key").cast("string"), "url", "sha", F.lit(False).alias("revisit"), none.cast("string").alias("first"), none.cast("long").alias("size"), "payload")
    rows = rows.unionByName(again.select(F.col("key").cast("string"), "url", "sha", F.lit(True).alias("revisit"), F.col("first").cast("string"), "size", F.lit(b"").alias("payload")))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=given, write_checksum=True, write_content_size=True)
        head = _dictionary_frame(dictionary) if dictionary else b""
        archive = bytearray()
        for batch in batches:
            columns = [batch.column(k) for k in range(7)]
            for k in range(batch.num_rows):
                name, where, sha, revisit, first, size, body = (c[k].as_py() for c in columns)
                digest = base64.b32encode(sha).decode()
                if not archive:
                    archive += head
                archive += packer.compress(render(name, where, body, digest, date, size, first, revisit))
                if len(archive) >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(archive)], pa.binary())], ["archive"])
                    archive = bytearray()
        if archive:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(archive)], pa.binary())], ["archive"])

    out = rows.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string"))
    out.write.option("lineSep", EMPTY_FRAME.decode("ascii")).option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


RECORD_COLUMNS = (
    "archive string, offset long, length long, record_type string, key string, refers_to string, url string, payload_bytes long, payload_digest string, digest_ok boolean, payload binary, error string"
)
_RECORD_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.string()]


def _read_record(record: bytes, with_payload: bool) -> tuple:
    warc, http, payload = parse(record)
    kind, digest = warc.get("warc-type"), warc.get("warc-payload-digest", "").removeprefix("sha1:")
    size = int(http["content-length"]) if kind == "revisit" and http.get("content-length", "").isdigit() else len(payload)
    ok = payload_digest(payload) == digest if kind == "response" else None
    refers = _key_of(warc.get("warc-refers-to"))
    return kind, _key_of(warc.get("warc-record-id")), refers, warc.get("warc-target-uri"), size, digest or None, ok, payload if with_payload else None, None


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives in ``folder``, with its place; ``digest_ok`` tells whether a response's payload fits.

    A revisit's size and digest are those of the payload it stands for.  A damaged record or archive gives a row with only
    its place and ``error``; after damage to a frame the rest of that archive is not read.
    """

    def rows(archive: bytes) -> Iterator[tuple]:
        at = 0
        try:
            for offset, length, record in frames(archive):
                at = offset + length
                try:
                    yield offset, length, *_read_record(record, with_payload)
                except ValueError as e:
                    yield offset, length, *[None] * 8, str(e)
        except WarcError as e:
            yield at, None, *[None] * 8, str(e)

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")]

        def batch_of(path: str, found: list[tuple]) -> pa.RecordBatch:
            cols = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), _RECORD_TYPES[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), *cols], names)

        for batch in batches:
            for k in range(batch.num_rows):
                path, found, held = batch.column(0)[k].as_py(), [], 0
                for row in rows(batch.column(1)[k].as_py()):
                    found.append(row)
                    held += len(row[9] or b"")
                    if len(found) >= 2000 or held >= 8 << 20:
                        yield batch_of(path, found)
                        found, held = [], 0
                if found:
                    yield batch_of(path, found)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(of, RECORD_COLUMNS)


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", with_payload: bool = False) -> DataFrame:
    """The records of pages, written to a new folder of the application and read back."""
    folder = scratch(pages.sparkSession, "warc")
    write(pages, folder, key, url, payload)
    return read(pages.sparkSession, folder, with_payload)
