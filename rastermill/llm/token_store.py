"""Token ids in sorted-string-table shards.

Documents are dealt to shards by ranges of doc_id. Within a shard they are sorted, encoded and written
as one file. All numbers are little-endian. Layout:

    data block*   entries of ascending keys, then the restart offsets and their number
    index block   last key, offset and stored size of each data block (sparse index)
    Bloom filter  over the document keys
    footer        fixed size: offsets and sizes of the index and the filter, counts, magic

A key is doc_id as 8 big-endian bytes with the sign bit flipped (so byte order is id order), a byte
that is 0 for a null id, and a 4-byte number that tells rows of one id apart. An entry holds the length of the
prefix shared with the key before, the rest of the key, the number of ids and the ids as unsigned
16- or 32-bit integers. Every RESTART-th key is whole, so a block can be searched by bisection.
Blocks are compressed by zstd.

Cases: null counts as empty text, which is stored as the end id alone; rows that repeat a doc_id are all
stored, ordered by a hash of the text; null ids come first; an empty table gives no file and an empty result;
very long texts make one large block; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import resolved, scratch, sliced
from .words import mix

END_ID = 2
BLOCK_BYTES = 1 << 16
RESTART = 16
BLOOM_BITS, BLOOM_HASHES = 10, 7
MAGIC = b"RMSSTBL1"
FOOTER = struct.Struct("<QQQQQQB7x8s")
#: Distinct words whose ids a Python worker remembers.
MEMO = 600_000
BATCH_BYTES = 1 << 20
#: Text of one shard, if no number of shards is given.
SHARD_BYTES = 256 << 20


def _class(kind: str) -> str:
    """The Latin-1 characters of a Unicode general category, as a character class's inside."""
    return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)


class WordEncoder:
    """The ids of a text from a `tokenizers` file, remembered by word.

    For tokenizers that lower-case, drop white space and cut words as CUT says before the model sees them: then
    the ids of a text are those of its words in order. Texts beyond Latin-1 or with special tokens are cut at
    blanks only, and the library does the rest.
    """

    LETTERS, NUMBERS, SPACES = _class("L"), _class("N"), r"\t-\r \x85\xa0"
    CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
    SIMPLE = re.compile(f"[{LETTERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.memo: dict[str, bytes] = {}
        # Ids that end a word, where the vocabulary marks word ends.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(size, bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        # The cut is the library's own only if it says so on every Latin-1 character between others.
        probe = "".join(f"aB{chr(c)}9{chr(c)}. " for c in range(256)) + "Don't we'll '' x's"
        pieces = self.CUT.findall(probe.lower())
        self.cuts = self._ids([probe])[0] == b"".join(self._ids(pieces))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are letters only: encoded in one go and cut at the ids that end words."""
        raw = self._ids([" ".join(words)])[0]
        at = (np.flatnonzero(self.ends[np.frombuffer(raw, self.type)]) + 1) * self.type.itemsize
        if len(at) != len(words):
            return self._ids(words)
        at = [0, *at.tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _words(self, text: str) -> list[str]:
        if self.cuts and "<|" not in text:
            try:
                text.encode("latin-1")
                return self.CUT.findall(text.lower())
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of self.type."""
        words, ends = [], [0]
        for t in texts:
            words += self._words(t)
            ends.append(len(words))
        found = list(map(self.memo.get, words))
        holes = [k for k, ids in enumerate(found) if ids is None]
        new = list({words[k] for k in holes})
        simple = list(filter(self.SIMPLE.fullmatch, new)) if self.cuts and self.ends.any() else []
        for lo in range(0, len(simple), 2048):
            part = simple[lo : lo + 2048]
            self.memo.update(zip(part, self._letters(part), strict=True))
        rest = [w for w in new if w not in self.memo]
        self.memo.update(zip(rest, self._ids(rest), strict=True))
        for k in holes:
            found[k] = self.memo[words[k]]
        out = [b"".join(found[lo:hi]) for lo, hi in zip(ends, ends[1:], strict=False)]
        if len(self.memo) > MEMO:  # keep what the last batch used
            self.memo = {w: self.memo[w] for w in set(words)}
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def key_of(doc_id: int | None, number: int) -> bytes:
    head = bytes(9) if doc_id is None else struct.pack(">QB", (doc_id + (1 << 63)) & ((1 << 64) - 1), 1)
    return head + struct.pack(">I", number)


def id_of(key: bytes) -> int | None:
    value, known = struct.unpack(">QB", key[:9])
    return value - (1 << 63) if known else None


def _bits(keys: np.ndarray, size: int) -> np.ndarray:
    """(len(keys), BLOOM_HASHES) bit numbers for 64-bit key hashes."""
    h = mix(keys)
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def _hash(doc_id: int | None) -> int:
    return zlib.crc32(b"null") if doc_id is None else doc_id & ((1 << 64) - 1)


class Writer:
    """Writes one shard from ascending keys."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes = array("Q")
        self.docs = self.ids = 0
        self._clear()

    def _clear(self) -> None:
        self.parts, self.size, self.restarts, self.count, self.last = [], 0, [], 0, b""

    def add(self, key: bytes, ids: bytes, width: int) -> None:
        shared = 0
        if self.count % RESTART == 0:
            self.restarts.append(self.size)
        else:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        n = len(ids) // width
        entry = struct.pack("<BBBI", shared, len(key) - shared, width, n) + key[shared:]
        self.parts += (entry, ids)
        self.size += len(entry) + len(ids)
        self.last, self.count = key, self.count + 1
        self.hashes.append(_hash(id_of(key)))
        self.docs += 1
        self.ids += n
        if self.size >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.count:
            raw = b"".join(self.parts) + np.array([*self.restarts, len(self.restarts)], "<u8").tobytes()
            data = zstandard.ZstdCompressor(level=1).compress(raw)
            self.out.write(data)
            self.index.append((self.last, self.at, len(data)))
            self.at += len(data)
            self._clear()

    def close(self) -> None:
        self.flush()
        index = b"".join(struct.pack("<13sQQ", *x) for x in self.index)
        size = max(64, len(self.hashes) * BLOOM_BITS)
        bloom = np.zeros(size, bool)
        if self.hashes:
            for lo in range(0, len(self.hashes), 1 << 16):
                bloom[_bits(np.array(self.hashes[lo : lo + (1 << 16)], np.uint64), size)] = True
        bits = np.packbits(bloom).tobytes()
        self.out.write(index)
        self.out.write(bits)
        self.out.write(FOOTER.pack(self.at, len(index), self.at + len(index), size, self.docs, self.ids, 1, MAGIC))


class Reader:
    """Reads one shard: in order, or one document by bisection."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        tail = self._read(end - FOOTER.size, FOOTER.size)
        at, size, bloom, bits, self.docs, self.ids, _, magic = FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        raw = self._read(at, size)
        self.index = [struct.unpack_from("<13sQQ", raw, k) for k in range(0, size, 29)]
        self.size, self.bloom_at = bits, bloom

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, k: int) -> tuple[bytes, np.ndarray]:
        raw = zstandard.ZstdDecompressor().decompress(self._read(*self.index[k][1:]))
        n = int.from_bytes(raw[-8:], "little")
        return raw[: -8 * (n + 1)], np.frombuffer(raw, "<u8", n, len(raw) - 8 * (n + 1))

    @staticmethod
    def entries(raw: bytes, at: int = 0) -> Iterator[tuple[bytes, np.ndarray]]:
        key = b""
        while at < len(raw):
            shared, rest, width, n = struct.unpack_from("<BBBI", raw, at)
            key = key[:shared] + raw[at + 7 : at + 7 + rest]
            at += 7 + rest
            yield key, np.frombuffer(raw, f"<u{width}", n, at)
            at += n * width

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.index)):
            for key, ids in self.entries(self.block(k)[0]):
                yield id_of(key), ids

    def may_hold(self, doc_id: int | None) -> bool:
        if not hasattr(self, "bloom"):
            self.bloom = np.unpackbits(np.frombuffer(self._read(self.bloom_at, -(-self.size // 8)), np.uint8))
        return bool(self.bloom[_bits(np.array([_hash(doc_id)], np.uint64), self.size)].all())

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every row of doc_id."""
        import bisect

        if not self.may_hold(doc_id):
            return []
        first, found = key_of(doc_id, 0), []
        for k in range(bisect.bisect_left([x[0] for x in self.index], first), len(self.index)):
            raw, restarts = self.block(k)
            whole = [raw[int(r) + 7 : int(r) + 20] for r in restarts]
            at = int(restarts[max(0, bisect.bisect_right(whole, first) - 1)])
            for key, ids in self.entries(raw, at):
                if key[:9] == first[:9]:
                    found.append(ids)
                elif key > first:
                    return found
        return found


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shards: int | None = None) -> list[tuple[str, int, int]]:
    """Write the shards below path; returns (file, documents, ids) of each in id order.

    A task writes under a name of its own, and only the names that successful tasks report count, so a
    lost executor or a second attempt leaves at most an unused file. One short row per shard
    reaches the driver. Without a number of shards there are as many as shuffle partitions, or more if that is needed
    to keep them at about SHARD_BYTES of text. Ranges are cut by (doc_id, hash of the text), so that rows of one
    doc_id may fill several shards.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    order = [F.asc_nulls_first("doc_id"), F.asc("h")]
    ordered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")

    def run(batches):
        enc, writer, first, last, number = encoder(tokenizer), None, None, (), 0
        end = np.array([end_id], enc.type).tobytes()
        for part in sliced(batches, "text", BATCH_BYTES):
            if writer is None:
                fs, base = resolved(path)
                fs.create_dir(base, recursive=True)
                name = f"{path}/part-{uuid.uuid4().hex}.sst"
                sink = fs.open_output_stream(resolved(name)[1], compression=None)
                writer, first = Writer(sink), (part.column(0)[0].as_py(), part.column(2)[0].as_py())
            for doc, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist()), strict=True):
                number = number + 1 if last == (doc,) else 0
                last = (doc,)
                writer.add(key_of(doc, number), ids + end, enc.type.itemsize)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, writer.docs, writer.ids)] + [pa.array([x], pa.int64()) for x in first], ["file", "docs", "ids", "first", "h"])

    made = ordered.mapInArrow(run, "file string, docs long, ids long, first long, h long").collect()
    made.sort(key=lambda r: (r["first"] is not None, r["first"] or 0, r["h"]))
    return [(r["file"], r["docs"], r["ids"]) for r in made]


def read(spark, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from the files."""
    starts, total = [], 0
    for k, (name, _, ids) in enumerate(files):
        starts.append((k, name, total))
        total += ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not starts:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                fs, base = resolved(name)
                with fs.open_input_file(base) as source:
                    rows = []
                    for doc, ids in Reader(source).scan():
                        rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 8192:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    return spark.createDataFrame(starts, "k int, file string, start long").repartition(len(starts), "k").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write docs to shards in the shared folder and describe what the files hold."""
    spark = docs.sparkSession
    return read(spark, write(docs, scratch(spark, "tokens"), tokenizer, end_id))
