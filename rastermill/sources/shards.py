"""Sample shards: tar files of npy, JSON and GeoJSON members, written and read by tasks.

A member costs 512 bytes of header and its size rounded up to 512, so a shard's size is known before it is
written. A task writes a shard under a temporary name and renames it; only shards that successful tasks report are
committed, so a task that runs twice leaves the same file.
"""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import attempt_name, resolve


def npy(x: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(x), allow_pickle=False)
    return out.getvalue()


def from_npy(data: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)


def encode_array(x: np.ndarray) -> str:
    """An array as tagged JSON."""
    return json.dumps({"_type": "ndarray", "data": x.tolist(), "dtype": str(x.dtype), "shape": list(x.shape)})


def decode_array(text: str) -> np.ndarray:
    found = json.loads(text)
    return np.array(found["data"], found["dtype"]).reshape(found["shape"])


def json_length(text: Column) -> Column:
    """Characters of a string as ASCII JSON, quotes included."""
    count = lambda chars: F.length(F.regexp_replace(text, chars, ""))
    short = count(r'[^"\\\n\r\t\x08\f]')  # two characters each
    long = count(r"[ -~\n\r\t\x08\f]")  # six each, and six more beyond the first plane
    beyond = count(r"[\x{0}-\x{FFFF}]")
    return F.length(text) + short + 5 * long + 6 * beyond + 2


def estimated_size(image_bytes: Column, label_bytes: Column, metadata_length: Column) -> Column:
    """Bytes by which a sample counts for shard rotation: arrays and metadata, without targets and vectors."""
    return (image_bytes + label_bytes + metadata_length).cast("long")


WRITTEN = "split string, shard_id int, path string, size_bytes long, patch_count long"


#: Ends of the names of compressed shards, and pyarrow's name of the codec.
CODECS = {".zst": "zstd", ".gz": "gzip"}
SAMPLES_AT_ONCE = 1000
BYTES_AT_ONCE = 1 << 22


def codec_of(path: str) -> str | None:
    return next((codec for end, codec in CODECS.items() if path.endswith(end)), None)


_EMPTY = tarfile.TarInfo("").tobuf()
_EMPTY_SUM = 256 + sum(_EMPTY[:148]) + sum(_EMPTY[156:]) - sum(_EMPTY[124:136])


def tar_member(name: str, data: bytes) -> bytes:
    """A member as tarfile writes it; plain names are put into the header of an empty one."""
    raw = name.encode("utf-8", "surrogateescape")
    if not name.isascii() or not 0 < len(raw) <= 100 or "/" in name or len(data) >= 8**11:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        head = info.tobuf()
    else:
        size = b"%011o\0" % len(data)
        head = raw + _EMPTY[len(raw) : 124] + size + _EMPTY[136:148] + b"%06o\0 " % (_EMPTY_SUM + sum(raw) + sum(size)) + _EMPTY[156:]
    return head + data + bytes(-len(data) % 512)


class _After:
    """A stream that begins with bytes which have been read already."""

    def __init__(self, first: bytes, rest):
        self.first, self.rest = first, rest

    def read(self, size: int) -> bytes:
        out, self.first = self.first[:size], self.first[size:]
        return out or self.rest.read(size)


def tar_members(source) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the members of a tar stream; from the first header that is not a plain one on, by tarfile."""
    while len(head := source.read(512)) == 512 and head[0]:
        plain = head[156:157] == b"0" and head[257:263] == b"ustar\0" and not head[345] and not head[124] & 0x80 and head[:100].isascii()
        if not plain or int(head[148:156].rstrip(b"\0 ") or b"0", 8) != 256 + sum(head[:148]) + sum(head[156:]):
            with tarfile.open(fileobj=_After(head, source), mode="r|") as tar:
                for info in tar:
                    yield info.name, tar.extractfile(info).read()
                    tar.members.clear()  # tarfile remembers every header that it has read
            return
        size = int(head[124:136].rstrip(b"\0 "), 8)
        data = source.read(size + -size % 512)
        if len(data) < size:
            raise tarfile.ReadError("unexpected end of data")
        yield head[: head.index(b"\0") if head[99] == 0 else 100].decode(), data[:size]


def write_shards(samples: DataFrame, folder: str, dealt: bool = False) -> DataFrame:
    """Write samples (split, shard_id, file, patch_ord, patch_id, members map<string,binary>) and describe each shard.

    Shards are dealt to tasks by (split, shard_id) and stream: a task holds one Arrow batch. Samples that are dealt
    already stand in order within the tasks, so that the caller can shuffle less than the members. A file's name
    that ends in .zst or .gz is compressed; size_bytes is that of the file. The result is to be stored once;
    computing it writes.
    """
    rows = samples.select("split", "shard_id", "file", "patch_ord", "patch_id", "members")
    if not dealt:
        rows = rows.repartition("split", "shard_id").sortWithinPartitions("split", "shard_id", "patch_ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sink, written, done, fs, at, own = None, None, 0, [], None, "", ""

        def close() -> None:
            # Two empty blocks, and whole records.
            sink.write(bytes(1024 + -(written + 1024) % tarfile.RECORDSIZE))
            sink.close()
            done[-1][3] = fs.get_file_info(own).size
            fs.move(own, at)

        for batch in batches:
            column = batch.column(5)
            ends, names, items = column.offsets.to_pylist(), column.keys.to_pylist(), column.items.to_pylist()
            for k, (split, shard, name, patch) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True)):
                if (split, shard) != key:
                    if sink is not None:
                        close()
                    key = (split, shard)
                    path = f"{folder}/{split}/{name}"
                    fs, at = resolve(path)
                    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    own = attempt_name(at)
                    sink, written = fs.open_output_stream(own, compression=codec_of(at), buffer_size=1 << 18), 0
                    done.append([split, shard, path, 0, 0])
                for member, data in sorted(zip(names[ends[k] : ends[k + 1]], items[ends[k] : ends[k + 1]], strict=True)):
                    block = tar_member(f"{patch}.{member}", data)
                    sink.write(block)
                    written += len(block)
                done[-1][4] += 1
        if sink is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate([pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()])], ["split", "shard_id", "path", "size_bytes", "patch_count"])

    return rows.mapInArrow(run, WRITTEN)


def read_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, patch_id, members map<string,binary>) of every sample of some shards, a task for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.binary())

        def rows(path: str, patches: list, ends: list, names: list, items: list) -> pa.RecordBatch:
            members = pa.MapArray.from_arrays(pa.array([*ends, len(names)], pa.int32()), pa.array(names, pa.string()), pa.array(items, pa.binary())).cast(kind)
            return pa.RecordBatch.from_arrays([pa.array([path] * len(patches)), pa.array(patches), members], ["file", "patch_id", "members"])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = resolve(path)
                with fs.open_input_stream(at, compression=codec_of(at), buffer_size=1 << 18) as source:
                    patches, ends, names, items, held = [], [], [], [], 0
                    for name, data in tar_members(source):
                        stem, _, member = name.partition(".")
                        if not patches or stem != patches[-1]:
                            # A sample is whole when the next one begins.
                            if len(patches) >= SAMPLES_AT_ONCE or held > BYTES_AT_ONCE:
                                yield rows(path, patches, ends, names, items)
                                patches, ends, names, items, held = [], [], [], [], 0
                            patches.append(stem)
                            ends.append(len(names))
                        names.append(member)
                        items.append(data)
                        held += len(data)
                    if patches:
                        yield rows(path, patches, ends, names, items)

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return files.mapInArrow(run, "file string, patch_id string, members map<string,binary>")
