"""GeoTIFF: a small codec, a Spark data source that reads blocks of rows, and a scan of binary files.

`spark.read.format("geotiff").load(path)` gives a row for each block of ROWS image rows: the header's columns,
row_off, col_off, h, w and the samples as band-sequential bytes in native little-endian order. Options: bands
("3,1": numbers from 1, in this order), rows (rows of a block), image (only this file stem).
Only the strips or tiles that a block needs are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import list_files, open_input, retry

ROWS = 512
# TIFF tags, their value types, and GDAL's.
TAGS = {"width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "strip_offsets": 273, "samples": 277, "rows_per_strip": 278, "strip_counts": 279, "planar": 284, "predictor": 317, "tile_width": 322, "tile_height": 323, "tile_offsets": 324, "tile_counts": 325, "format": 339, "scale": 33550, "tiepoint": 33922, "matrix": 34264, "geokeys": 34735, "nodata": 42113}
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 16: "Q", 17: "q"}
KINDS = {1: "u", 2: "i", 3: "f"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
PROJECTED_KEY, GEOGRAPHIC_KEY = 3072, 2048


@dataclass
class Header:
    """What the first image directory of a file says."""

    order: str
    width: int
    height: int
    count: int
    dtype: np.dtype
    compression: int
    predictor: int
    planar: int
    block_width: int
    block_height: int
    offsets: list[int]
    counts: list[int]
    nodata: float | None = None
    srid: int | None = None
    transform: tuple[float, ...] | None = None  # a, b, c, d, e, f
    tags: dict = field(default_factory=dict, repr=False)

    @property
    def bounds(self) -> tuple[float, float, float, float] | None:
        if self.transform is None:
            return None
        a, b, c, d, e, f = self.transform
        xs = [c, c + a * self.width, c + b * self.height, c + a * self.width + b * self.height]
        ys = [f, f + d * self.width, f + e * self.height, f + d * self.width + e * self.height]
        return min(xs), min(ys), max(xs), max(ys)


class Ranges:
    """Random access to a file's bytes, from memory or storage."""

    def __init__(self, source: bytes | str):
        self.data = source if isinstance(source, bytes) else None
        if self.data is None:
            self.file = retry(lambda: open_input(source))

    def read(self, at: int, size: int) -> bytes:
        if self.data is not None:
            return self.data[at : at + size]
        return retry(lambda: self._get(at, size))

    def _get(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def close(self) -> None:
        if self.data is None:
            self.file.close()


def header(src: Ranges) -> Header:
    """The first directory; classic and big files, either byte order."""
    head = src.read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    big = struct.unpack(order + "H", head[2:4])[0] == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    n = struct.unpack(order + ("Q" if big else "H"), src.read(at, 8 if big else 2))[0]
    size, inline = (20, 8) if big else (12, 4)
    raw = src.read(at + (8 if big else 2), n * size)
    tags: dict[int, tuple | bytes] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + ("HHQ" if big else "HHI"), raw, k * size)
        code = TYPES.get(kind)
        if code is None:
            continue
        width = 1 if code == "s" else struct.calcsize("=" + code)
        value = raw[k * size + size - inline : k * size + size]
        if width * count > inline:
            value = src.read(struct.unpack(order + ("Q" if big else "I"), value)[0], width * count)
        tags[tag] = value[:count] if code == "s" else struct.unpack_from(f"{order}{count}{code}" if len(code) == 1 else order + code * count, value)
    get = lambda name, default=None: tags.get(TAGS[name], default)
    width, height = get("width")[0], get("height")[0]
    samples = get("samples", (1,))[0]
    bits, kind = get("bits", (1,))[0], get("format", (1,))[0]
    if bits % 8:
        raise ValueError(f"{bits} bits a sample are not supported")
    tiled = TAGS["tile_offsets"] in tags
    out = Header(
        order, width, height, samples, np.dtype(f"{order}{KINDS.get(kind, 'u')}{bits // 8}"), get("compression", (1,))[0], get("predictor", (1,))[0], get("planar", (1,))[0],
        get("tile_width")[0] if tiled else width, get("tile_height")[0] if tiled else min(get("rows_per_strip", (height,))[0], height),
        list(get("tile_offsets" if tiled else "strip_offsets")), list(get("tile_counts" if tiled else "strip_counts")), tags=tags,
    )
    if (text := get("nodata")) is not None:
        try:
            out.nodata = float(bytes(text).split(b"\0")[0])
        except ValueError:
            out.nodata = None
    if (m := get("matrix")) is not None:
        out.transform = (m[0], m[1], m[3], m[4], m[5], m[7])
    elif (s := get("scale")) is not None and (t := get("tiepoint")) is not None:
        out.transform = (s[0], 0.0, t[3] - t[0] * s[0], 0.0, -s[1], t[4] + t[1] * s[1])
    keys = get("geokeys") or ()
    found = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    code = found.get(PROJECTED_KEY) or found.get(GEOGRAPHIC_KEY)
    out.srid = code if code and code != 32767 else None
    return out


def unlzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bits first, 256 resets and 257 ends."""
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, size, before = [], 9, b""
    buffer = bits = 0
    for byte in data:
        buffer = (buffer << 8 | byte) & 0xFFFFFFFF
        bits += 8
        while bits >= size:
            code = buffer >> (bits - size) & ((1 << size) - 1)
            bits -= size
            if code == 256:
                del table[258:]
                size, before = 9, b""
            elif code == 257:
                return b"".join(out)
            else:
                entry = table[code] if code < len(table) else before + before[:1]
                out.append(entry)
                if before:
                    table.append(before + entry[:1])
                before = entry
                size = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    """The inverse of unlzw."""
    out, buffer, bits, size = bytearray(), 0, 0, 9
    table = {bytes([i]): i for i in range(256)}
    following = 258

    def put(code: int) -> None:
        nonlocal buffer, bits
        buffer = buffer << size | code
        bits += size
        while bits >= 8:
            out.append(buffer >> (bits - 8) & 255)
            bits -= 8
        buffer &= (1 << bits) - 1

    put(256)
    word = b""
    for byte in data:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = following
        following += 1
        size = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
        if following == 4094:
            put(256)
            table = {bytes([i]): i for i in range(256)}
            following, size = 258, 9
        word = bytes([byte])
    if word:
        put(table[word])
        following += 1
        size = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if bits:
        out.append(buffer << (8 - bits) & 255)
    return bytes(out)


def unpackbits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2
    return bytes(out)


def _block(src: Ranges, h: Header, number: int, rows: int, samples: int) -> np.ndarray:
    """(rows, block_width, samples) of one strip or tile."""
    raw = src.read(h.offsets[number], h.counts[number])
    if h.compression == LZW:
        raw = unlzw(raw)
    elif h.compression in (DEFLATE, OLD_DEFLATE):
        raw = zlib.decompress(raw)
    elif h.compression == PACKBITS:
        raw = unpackbits(raw)
    elif h.compression != NONE:
        raise ValueError(f"compression {h.compression} is not supported")
    x = np.frombuffer(raw, h.dtype, rows * h.block_width * samples).reshape(rows, h.block_width, samples)
    if h.predictor == 2:
        x = np.cumsum(x, axis=1, dtype=h.dtype.newbyteorder("=")).astype(h.dtype.newbyteorder("="))
    elif h.predictor != 1:
        raise ValueError(f"predictor {h.predictor} is not supported")
    return x


def read_rows(src: Ranges, h: Header, first: int, last: int, bands: list[int] | None = None) -> np.ndarray:
    """(bands, last - first, width) of some image rows; bands are numbered from 1."""
    bands = bands or list(range(1, h.count + 1))
    across = -(-h.width // h.block_width)
    down = -(-h.height // h.block_height)
    tiled = TAGS["tile_offsets"] in h.tags
    out = np.zeros((len(bands), last - first, h.width), h.dtype.newbyteorder("="))
    for by in range(first // h.block_height, -(-last // h.block_height)):
        top = by * h.block_height
        rows = h.block_height if tiled else min(h.block_height, h.height - top)
        a, b = max(top, first), min(top + rows, last, h.height)
        for bx in range(across):
            left, width = bx * h.block_width, min(h.block_width, h.width - bx * h.block_width)
            if h.planar == 1:
                x = _block(src, h, by * across + bx, rows, h.count)[a - top : b - top, :width]
                out[:, a - first : b - first, left : left + width] = x[:, :, [k - 1 for k in bands]].transpose(2, 0, 1)
            else:
                for i, k in enumerate(bands):
                    x = _block(src, h, (k - 1) * across * down + by * across + bx, rows, 1)
                    out[i, a - first : b - first, left : left + width] = x[a - top : b - top, :width, 0]
    return out


def read(source: bytes | str, bands: list[int] | None = None) -> tuple[Header, np.ndarray]:
    src = Ranges(source)
    try:
        h = header(src)
        return h, read_rows(src, h, 0, h.height, bands)
    finally:
        src.close()


def write(data: np.ndarray, transform: tuple[float, ...] | None = None, srid: int | None = None, nodata: float | None = None, compression: int = DEFLATE) -> bytes:
    """A (bands, height, width) array as a little-endian strip file, bands in planes."""
    data = data if data.ndim == 3 else data[None]
    bands, height, width = data.shape
    rows = max(1, min(height, (1 << 18) // max(1, width * data.itemsize)))
    pack = {NONE: bytes, LZW: lzw, DEFLATE: zlib.compress}[compression]
    body, offsets, counts = bytearray(b"II*\0\0\0\0\0"), [], []
    little = np.ascontiguousarray(data, data.dtype.newbyteorder("<"))
    for band in little:
        for top in range(0, height, rows):
            part = pack(band[top : top + rows].tobytes())
            offsets.append(len(body))
            counts.append(len(part))
            body += part + b"\0" * (len(part) % 2)
    kind = {"u": 1, "i": 2, "f": 3, "b": 1}[data.dtype.kind]
    tags: list[tuple[int, int, list]] = [
        (256, 4, [width]), (257, 4, [height]), (258, 3, [data.itemsize * 8] * bands), (259, 3, [compression]), (262, 3, [1]), (273, 4, offsets), (277, 3, [bands]),
        (278, 4, [rows]), (279, 4, counts), (284, 3, [2 if bands > 1 else 1]), (339, 3, [kind] * bands),
    ]
    if transform is not None:
        a, b, c, d, e, f = transform
        tags += [(33550, 12, [a, -e, 0.0]), (33922, 12, [0.0, 0.0, 0.0, c, f, 0.0])] if b == d == 0 and e < 0 < a else [(34264, 12, [a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0])]
    if srid is not None:
        geographic = 4000 <= srid < 5000
        tags.append((34735, 3, [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, GEOGRAPHIC_KEY if geographic else PROJECTED_KEY, 0, 1, srid]))
    if nodata is not None:
        tags.append((42113, 2, list(f"{nodata:.17g}".encode() + b"\0")))
    directory, extra = b"", bytearray()
    at = len(body)
    after = at + 2 + 12 * len(tags) + 4
    for tag, code, values in sorted(tags):
        raw = bytes(values) if code == 2 else struct.pack(f"<{len(values)}{TYPES[code]}", *values)
        if len(raw) > 4:
            directory += struct.pack("<HHII", tag, code, len(values), after + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            directory += struct.pack("<HHI", tag, code, len(values)) + raw.ljust(4, b"\0")
    body[4:8] = struct.pack("<I", at)
    return bytes(body) + struct.pack("<H", len(tags)) + directory + b"\0\0\0\0" + bytes(extra)


_HEADER = [("path", pa.string()), ("image_name", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("bands", pa.int32()), ("dtype", pa.string()), ("nodata", pa.float64()), ("srid", pa.int32()), ("transform", pa.list_(pa.float64())), ("bounds", pa.list_(pa.float64()))]
_DATA = [("row_off", pa.int64()), ("col_off", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("data", pa.binary())]
HEADER_SCHEMA = "path string, image_name string, width int, height int, bands int, dtype string, nodata double, srid int, transform array<double>, bounds array<double>"
BLOCK_SCHEMA = HEADER_SCHEMA + ", row_off long, col_off long, h int, w int, data binary"


def name_of(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] else name


def _head_row(path: str, h: Header, bands: list[int] | None) -> list:
    return [path, name_of(path), h.width, h.height, len(bands) if bands else h.count, h.dtype.name, h.nodata, h.srid, list(h.transform) if h.transform else None, list(h.bounds) if h.transform else None]


def _batch(rows: list[list], schema: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(schema)], [n for n, _ in schema])


@dataclass
class Blocks(InputPartition):
    path: str
    first: int
    last: int

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.bands = [int(b) for b in options["bands"].split(",")] if options.get("bands") else None
        self.rows = int(options.get("rows", ROWS))
        self.image = options.get("image")

    def partitions(self) -> list[Blocks]:
        out = []
        for path in (f for p in self.paths for f in list_files(p, (".tif", ".tiff"))):
            if self.image and name_of(path) != self.image:
                continue
            src = Ranges(path)
            h = header(src)
            src.close()
            out += [Blocks(path, k, min(k + self.rows, h.height)) for k in range(0, max(1, h.height), self.rows)]
        return out or [Blocks("", 0, 0)]

    def read(self, part: Blocks) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        src = Ranges(part.path)
        h = header(src)
        data = read_rows(src, h, part.first, part.last, self.bands)
        src.close()
        row = [*_head_row(part.path, h, self.bands), part.first, 0, part.last - part.first, h.width, data.astype(data.dtype.newbyteorder("<")).tobytes()]
        yield _batch([row], _HEADER + _DATA)


class GeoTiffSource(DataSource):
    """The data source `geotiff`."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema) -> GeoTiffReader:
        return GeoTiffReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoTiffSource)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """The header of every file below a path that Spark can read, one row each; unreadable files are left to `errors`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows.append(_head_row(name, header(Ranges(content)), None) + [None])
                except (ValueError, TypeError, struct.error, IndexError) as error:
                    rows.append([name, name_of(name), *[None] * 8, str(error) or type(error).__name__])
            if rows:
                yield _batch(rows, [*_HEADER, ("error", pa.string())])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{tif,tiff}").load(path)
    return files.select("path", "content").mapInArrow(run, HEADER_SCHEMA + ", error string")
