"""TIFF media columns: files in a binary column, one row for each page.

The reader walks the chain of image directories, decodes strips or tiles (none, PackBits, LZW, deflate), undoes the
horizontal predictor and yields the samples of each page.  The writer stores pages in strips or tiles the same ways.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the TIFF format: field types and their sizes, tags, and compression codes.
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4)}
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
CODES = {"none": 1, "lzw": 5, "deflate": 8, "packbits": 32773}
_DECODE_AS = {1: "none", 5: "lzw", 8: "deflate", 32946: "deflate", 32773: "packbits"}

#: The payload layout: rows of 64 pixels with three samples, pages of at most so many rows.
ROW_PIXELS, ROW_SAMPLES, PAGE_ROWS, STRIP_ROWS = 64, 3, 1024, 128
ROW_BYTES = ROW_PIXELS * ROW_SAMPLES


class TiffError(ValueError):
    """The bytes are no TIFF file, or use something that is not supported."""


def unpack_bits(data: bytes) -> bytes:
    out, i, n = [], 0, len(data)
    while i < n:
        head = data[i]
        if head < 128:
            out.append(data[i + 1 : i + 2 + head])
            i += 2 + head
        elif head > 128:
            out.append(data[i + 1 : i + 2] * (257 - head))
            i += 2
        else:
            i += 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while run < 128 and i + run < n and data[i + run] == data[i]:
            run += 1
        if run >= 3:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        j = i
        while j < n and j - i < 128 and not (j + 2 < n and data[j] == data[j + 1] == data[j + 2]):
            j += 1
        out += bytes((j - i - 1,)) + data[i:j]
        i = j
    return bytes(out)


_CLEAR, _END = 256, 257


def _width(entries: int) -> int:
    """Bits of the next code after so many table entries: one more when the newest entry is 510, 1022 or 2046."""
    return min(12, max(9, (entries + 259).bit_length()))


def lzw_decode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first, width growing one code early."""
    out, table, width, held, bits, last = [], [], 9, 0, 0, None
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == _END:
            break
        if code == _CLEAR:
            table, width, last = [], 9, None
            continue
        if code < 256:
            now = bytes((code,))
        elif code - 258 < len(table):
            now = table[code - 258]
        elif last is not None and code - 258 == len(table):
            now = last + last[:1]
        else:
            raise TiffError("bad LZW code")
        out.append(now)
        if last is not None:
            table.append(last + now[:1])
        last = now
        width = _width(len(table) + 1)  # the encoder is one entry ahead
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits, width = bytearray(), 0, 0, 9
    table: dict[bytes, int] = {}

    def put(code: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    code_of = lambda s: s[0] if len(s) == 1 else table[s]
    put(_CLEAR)
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if len(longer) == 1 or longer in table:
            word = longer
            continue
        put(code_of(word))
        table[longer] = 258 + len(table)
        word = data[i : i + 1]
        if 257 + len(table) == 4093:
            width = 12
            put(code_of(word))
            put(_CLEAR)
            table, width, word = {}, 9, b""
        else:
            width = _width(len(table))
    if word:
        put(code_of(word))
        width = _width(len(table) + 1)
    put(_END)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


#: Bytes that a codec gives for a stored one, at most.
MAX_RATIO = {"none": 1, "packbits": 64, "lzw": 1400, "deflate": 1100}
MAX_SAMPLES = 1024
_DECODERS = {
    "none": lambda data, most: data[:most], "packbits": lambda data, most: unpack_bits(data), "lzw": lambda data, most: lzw_decode(data),
    "deflate": lambda data, most: zlib.decompressobj().decompress(data, most),
}
_ENCODERS = {"none": bytes, "packbits": pack_bits, "lzw": lzw_encode, "deflate": lambda d: zlib.compress(d, 1)}


@dataclass
class Page:
    number: int
    samples: np.ndarray  # (length, width, samples), uint8 or uint16
    compression: str
    predictor: int
    tiled: bool


class _Reader:
    def __init__(self, data: bytes):
        if len(data) < 8 or data[:2] not in (b"II", b"MM"):
            raise TiffError("no TIFF header")
        self.data, self.order = data, "<" if data[:2] == b"II" else ">"
        magic, self.first = struct.unpack_from(self.order + "HI", data, 2)
        if magic != 42:
            raise TiffError("no TIFF header")

    def directory(self, at: int) -> tuple[dict[int, tuple], int]:
        if at + 2 > len(self.data):
            raise TiffError("directory outside the file")
        (n,) = struct.unpack_from(self.order + "H", self.data, at)
        fields = {}
        if at + 6 + 12 * n > len(self.data):
            raise TiffError("directory outside the file")
        for k in range(n):
            tag, kind, count = struct.unpack_from(self.order + "HHI", self.data, at + 2 + 12 * k)
            if kind not in TYPES:
                continue
            code, size = TYPES[kind]
            where = at + 10 + 12 * k
            if size * count > 4:
                (where,) = struct.unpack_from(self.order + "I", self.data, where)
            if where + size * count > len(self.data):
                raise TiffError("field outside the file")
            fields[tag] = struct.unpack_from(f"{self.order}{count}{code}", self.data, where)
        return fields, struct.unpack_from(self.order + "I", self.data, at + 2 + 12 * n)[0]

    def page(self, number: int, f: dict[int, tuple]) -> Page:
        one = lambda tag, default=None: f[tag][0] if f.get(tag) else default
        width, length, samples = one(WIDTH), one(LENGTH), one(SAMPLES, 1)
        bits, code, predictor, planar = f.get(BITS, (1,)), one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1)
        if not width or not length or not 0 < samples <= MAX_SAMPLES or set(bits) not in ({8}, {16}) or code not in _DECODE_AS or predictor not in (1, 2) or planar not in (1, 2):
            raise TiffError("unsupported page")
        kind = np.dtype("u1" if bits[0] == 8 else self.order + "u2")
        tiled = TILE_WIDTH in f
        across, down = (one(TILE_WIDTH), one(TILE_LENGTH)) if tiled else (width, min(one(ROWS_PER_STRIP, length), length))
        offsets, sizes = (f.get(TILE_OFFSETS, ()), f.get(TILE_BYTES, ())) if tiled else (f.get(STRIP_OFFSETS, ()), f.get(STRIP_BYTES, ()))
        if not across or not down or across < 1 or down < 1:
            raise TiffError("parts without a size")
        nx, ny = -(-width // across), -(-length // down)
        planes, each = (samples, 1) if planar == 2 else (1, samples)
        if len(offsets) != nx * ny * planes or len(sizes) != len(offsets):
            raise TiffError("parts do not cover the page")
        # What a page may take in memory follows from the bytes that are stored for it, whatever its fields say.
        most = MAX_RATIO[_DECODE_AS[code]] * sum(sizes) + ROW_BYTES
        if length * width * samples * kind.itemsize > most or across * down * each * kind.itemsize > most:
            raise TiffError("page too large for its bytes")
        out = np.zeros((length, width, samples), kind.newbyteorder("="))
        for k, (at, size) in enumerate(zip(offsets, sizes, strict=True)):
            if at + size > len(self.data):
                raise TiffError("part outside the file")
            plane, y, x = k // (nx * ny), k // nx % ny, k % nx
            rows = down if tiled else min(down, length - y * down)
            need = rows * across * each * kind.itemsize
            raw = _DECODERS[_DECODE_AS[code]](self.data[at : at + size], need)
            if len(raw) < need:
                raise TiffError("part is too short")
            part = np.frombuffer(raw, kind, rows * across * each).reshape(rows, across, each).astype(out.dtype)
            if predictor == 2:
                part = np.cumsum(part, axis=1, dtype=out.dtype)
            h, w = min(rows, length - y * down), min(across, width - x * across)
            channels = slice(plane, plane + 1) if planar == 2 else slice(None)
            out[y * down : y * down + h, x * across : x * across + w, channels] = part[:h, :w]
        return Page(number, out, _DECODE_AS[code], predictor, tiled)


def read_pages(data: bytes) -> Iterator[Page]:
    """The pages of a file in the order of its directories; TiffError if it is damaged or uses something else."""
    reader = _Reader(data)
    at, seen, number = reader.first, set(), 0
    if not at:
        raise TiffError("no directory")
    while at:
        if at in seen:
            raise TiffError("directories run in a circle")
        seen.add(at)
        fields, following = reader.directory(at)
        try:
            yield reader.page(number, fields)
        except (zlib.error, struct.error, IndexError, TypeError, ValueError) as e:
            raise TiffError(str(e)) from e
        number, at = number + 1, following


def write_pages(pages: Iterable[np.ndarray], compression: str = "deflate", predictor: int = 2, tile: tuple[int, int] | None = None, order: str = "<") -> bytes:
    """A file with these pages of shape (length, width, samples), uint8 or uint16; ``tile``: (width, length), else strips."""
    out = bytearray(b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0)
    link = 4
    for page in pages:
        length, width, samples = page.shape
        down, across = (tile[1], tile[0]) if tile else (STRIP_ROWS, width)
        offsets, sizes = [], []
        for y in range(0, length, down):
            for x in range(0, width, across):
                part = page[y : y + down, x : x + across]
                if tile:
                    part = np.pad(part, ((0, down - part.shape[0]), (0, across - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
                raw = _ENCODERS[compression](part.astype(part.dtype.newbyteorder(order)).tobytes())
                offsets.append(len(out))
                sizes.append(len(raw))
                out += raw + b"\0" * (len(raw) % 2)
        fields = [(WIDTH, "I", [width]), (LENGTH, "I", [length]), (BITS, "H", [8 * page.dtype.itemsize] * samples), (COMPRESSION, "H", [CODES[compression]])]
        fields += [(PHOTOMETRIC, "H", [2 if samples == 3 else 1]), (SAMPLES, "H", [samples]), (PLANAR, "H", [1]), (PREDICTOR, "H", [predictor])]
        if tile:
            fields += [(TILE_WIDTH, "I", [across]), (TILE_LENGTH, "I", [down]), (TILE_OFFSETS, "I", offsets), (TILE_BYTES, "I", sizes)]
        else:
            fields += [(STRIP_OFFSETS, "I", offsets), (ROWS_PER_STRIP, "I", [down]), (STRIP_BYTES, "I", sizes)]
        entries = bytearray()
        for tag, code, values in sorted(fields):
            raw = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(raw) > 4:
                where = len(out)
                out += raw
                raw = struct.pack(order + "I", where)
            entries += struct.pack(order + "HHI", tag, 3 if code == "H" else 4, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def payload_of(text: str | None) -> bytes:
    """The text as UTF-8, filled up with blanks to a positive multiple of a row."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // ROW_BYTES)) * ROW_BYTES)


#: Ways to store a payload: (compression, predictor, tile).  A payload's checksum picks one, so equal texts are stored alike.
LAYOUTS = [("lzw", 2, None), ("packbits", 1, None), ("none", 1, (16, 16)), ("deflate", 2, (32, 64)), ("lzw", 1, (64, 32)), ("packbits", 2, (16, 32))] + [("deflate", 2, None)] * 26


def stored(payload: bytes, layout: tuple | None = None) -> bytes:
    compression, predictor, tile = layout or LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW_PIXELS, ROW_SAMPLES)
    return write_pages((rows[a : a + PAGE_ROWS] for a in range(0, len(rows), PAGE_ROWS)), compression, predictor, tile)


def page_feature(samples: np.ndarray) -> str:
    """Size, mean of each sample in thousandths, and the counts of the values in sixteen equal ranges."""
    length, width, each = samples.shape
    top = np.iinfo(samples.dtype).bits - 4
    counts = np.bincount((samples.reshape(-1) >> top).astype(np.int64), minlength=16)
    means = samples.reshape(-1, each).sum(0, dtype=np.int64) * 1000 // (length * width)
    return f"{width}x{length}x{each}:{','.join(map(str, means.tolist()))}:{','.join(map(str, counts.tolist()))}"


def encode(text: Column) -> Column:
    """The TIFF file that holds a text; equal texts give equal bytes."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([stored(payload_of(t.as_py())) for t in texts], pa.binary())

    return of(text)


PAGE_COLUMNS = "page int, width int, length int, samples int, bits int, compression string, predictor int, tiled boolean, feature string, pixels binary, error string"


def _page_rows(media: bytes | None) -> Iterator[tuple]:
    try:
        for p in read_pages(media or b""):
            length, width, each = p.samples.shape
            yield p.number, width, length, each, 8 * p.samples.dtype.itemsize, p.compression, p.predictor, p.tiled, page_feature(p.samples), p.samples.tobytes(), None
    except TiffError as e:
        yield (*[None] * 10, str(e))


def pages(files: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """One row for each page of each file: key, number, layout, a feature string, and the samples as bytes.

    A null, empty or damaged file gives a last row with only key and error, after the pages before the damage.  Repeated
    files give repeated rows; other columns are not read; an empty table gives no rows.
    """
    names = [c.split()[0] for c in PAGE_COLUMNS.split(", ")]
    types = [pa.int32()] * 5 + [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.binary(), pa.string()]

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = list(_page_rows(batch.column(1)[k].as_py()))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                keys = pa.array([batch.column(0)[k].as_py()] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([keys, *cols], names=["key", *names])

    own = files.select(F.col(key).cast("long").alias("key"), F.col(media).alias("media"))
    return own.mapInArrow(of, f"key long, {PAGE_COLUMNS}").withColumnRenamed("key", key)


_DIGEST = "struct<payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string>"


def digest(media: Column) -> Column:
    """What the pages of a file hold together: size and hashes of all samples, of the file, and the pages' features.

    Null for a null or damaged file.
    """

    @F.arrow_udf(_DIGEST)
    def of(files: pa.Array) -> pa.Array:
        out = []
        for f in files:
            rows = list(_page_rows(f.as_py()))
            if rows and rows[-1][-1] is not None:
                out.append(None)
                continue
            payload, raw = b"".join(r[9] for r in rows), f.as_py()
            values = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), ";".join(r[8] for r in rows))
            out.append(dict(zip(("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"), values, strict=True)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        return pa.array(out, pa.struct(list(zip(names, kinds, strict=True))))

    return of(media)
