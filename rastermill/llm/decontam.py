"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed in blocks of whole documents. A block's postings are sorted by term and
position and stored in the shared folder; positions count words, with a gap between documents
that no match can cross. The test items are the query set, taken in blocks of bounded size
against all index blocks. For a window of consecutive item words the shortest postings list is
expanded to candidate places; the other lists, shifted by their offset in the window, are
intersected in ascending length. Places that survive are exact phrase matches. Proximity
matches have at least 8 words of a window within 2 words of their place.

No row leaves its block, so nothing is shuffled, and a frequent word is only a longer list
of one block.

Cases: null or wordless text has no words and no hit; a very long text is a block of its own; places that
tie are all reported; an item of fewer than `width` words is one
window; equal items share their windows and are all reported; repeated rows are judged alike;
an empty table of items leaves everything clean; a null item_id is reported as the empty
string; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_stored, fresh, sliced, stored, utf8
from .words import word_hashes

WIDTH = 10
GAP = 64
BLOCK_BYTES = 4 << 20
#: Words of test items handled in one pass over the index, and broadcast with it (about 120 MB at most).
QUERY_WORDS = 1_000_000
EXPAND = 1 << 21


class Windows:
    """Distinct windows of test items: term numbers by width, and the items each belongs to."""

    def __init__(self, ids: list[str], words: np.ndarray, counts: np.ndarray, width: int):
        self.vocabulary = np.unique(words)
        terms = np.searchsorted(self.vocabulary, words).astype(np.int64)
        self.items = sorted(set(ids))
        number = {x: k for k, x in enumerate(self.items)}
        found: dict[int, dict[bytes, set[int]]] = {}
        at = 0
        for name, n in zip(ids, counts, strict=True):
            size = min(int(n), width)
            for k in range(at, at + int(n) - size + 1) if n else ():
                found.setdefault(size, {}).setdefault(terms[k : k + size].tobytes(), set()).add(number[name])
            at += int(n)
        self.groups = []
        for size, windows in sorted(found.items()):
            table = np.frombuffer(b"".join(windows), np.int64).reshape(-1, size)
            of = [np.array(sorted(x)) for x in windows.values()]
            self.groups.append((table, np.concatenate([[0], np.cumsum([len(x) for x in of])]), np.concatenate(of)))


def index_block(doc_ids: pa.Array, raw: np.ndarray, offsets: np.ndarray) -> dict:
    """The postings of some documents: terms in ascending order, the length of each list, all positions."""
    words, counts = word_hashes(raw, offsets)
    place = np.arange(len(words)) + np.repeat(np.arange(len(counts)) * GAP, counts)
    order = np.argsort(words, kind="stable")
    words = words[order]
    head = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))) if len(words) else np.empty(0, np.int64)
    return {
        "doc_ids": doc_ids.to_pylist(),
        "n_words": counts.tolist(),
        "terms": words[head].tobytes(),
        "lengths": np.diff(np.append(head, len(words))).astype(np.int32).tobytes(),
        "positions": place[order].astype(np.int64 if len(place) and place[-1] >= 1 << 31 else np.int32).tobytes(),
        "wide": bool(len(place) and place[-1] >= 1 << 31),
    }


INDEX_SCHEMA = "doc_ids array<long>, n_words array<int>, terms binary, lengths binary, positions binary, wide boolean"


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of (doc_id, text) rows: the postings of every word."""

    def run(batches):
        for part in sliced(batches, "text", BLOCK_BYTES):
            raw, offsets = utf8(part.column(1))
            block = index_block(part.column(0), raw, offsets)
            yield pa.RecordBatch.from_pydict({k: pa.array([v], type=t) for (k, v), t in zip(block.items(), _TYPES, strict=True)})

    return stored(docs.select("doc_id", "text").mapInArrow(run, INDEX_SCHEMA), "postings")


_TYPES = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]


def intersect(table: np.ndarray, length: np.ndarray, begin: np.ndarray, position: np.ndarray, key: np.ndarray, stride: int):
    """(window, place) of every exact match of the windows in `table`."""
    size = length[table]
    live = np.flatnonzero(size.min(axis=1) > 0)
    order = np.argsort(size[live], axis=1, kind="stable")
    rare = table[live, order[:, 0]]
    total = np.cumsum(length[rare])
    lo = 0
    while lo < len(live):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + EXPAND, "right")))
        n = length[rare[lo:hi]]
        w = np.repeat(np.arange(lo, hi), n)
        at = position[np.repeat(begin[rare[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] - order[w, 0]
        for step in range(1, table.shape[1]):
            if not len(w):
                break
            j = order[w, step]
            want = table[live[w], j] * stride + at + j
            found = np.searchsorted(key, want)
            ok = key[np.minimum(found, len(key) - 1)] == want
            w, at = w[ok], at[ok]
        yield live[w], at
        lo = hi


def nearby(table: np.ndarray, length: np.ndarray, begin: np.ndarray, position: np.ndarray, key: np.ndarray, stride: int, least: int, slop: int):
    """(window, place) where at least `least` words of a window stand within `slop` words of their place.

    Any width - least + 1 words of the window have one that takes part, so the occurrences of the rarest of them
    give all places to try.
    """
    size = length[table]
    width = table.shape[1]
    live = np.flatnonzero((size > 0).sum(axis=1) >= least)
    order = np.argsort(size[live], axis=1, kind="stable")
    for k in range(width - least + 1):
        lead = order[:, k]
        rare = table[live, lead]
        total = np.cumsum(length[rare])
        lo = 0
        while lo < len(live):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + EXPAND // 8, "right")))
            n = length[rare[lo:hi]]
            w = np.repeat(np.arange(lo, hi), n)
            at = position[np.repeat(begin[rare[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] - lead[w]
            shift = np.arange(-slop, slop + 1)
            w, at = np.repeat(w, len(shift)), (at[:, None] + shift).reshape(-1)
            met = np.zeros(len(w), np.int32)
            for j in range(width):
                want = table[live[w], j] * stride + at + j + 2 * slop + width
                met += np.searchsorted(key, want + slop, "right") > np.searchsorted(key, want - slop)
                # Whoever cannot reach `least` any more goes at once.
                ok = met + (width - 1 - j) >= least
                w, at, met = w[ok], at[ok], met[ok]
            yield live[w], at
            lo = hi


def judge(block: dict, windows: Windows, least: int, slop: int) -> tuple[np.ndarray, list[set[str]], list[set[str]]]:
    """One pass over a block: which places are hit, and each document's items matched exactly and nearly."""
    counts = np.array(block["n_words"], np.int64)
    terms = np.frombuffer(block["terms"], np.uint64)
    lengths = np.frombuffer(block["lengths"], np.int32).astype(np.int64)
    position = np.frombuffer(block["positions"], np.int64 if block["wide"] else np.int32).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(counts)[:-1])) + np.arange(len(counts)) * GAP
    end = int(start[-1] + counts[-1] + GAP) if len(counts) else 0
    vocabulary = windows.vocabulary
    at = np.searchsorted(vocabulary, terms)
    has = (at < len(vocabulary)) & (vocabulary[np.minimum(at, max(0, len(vocabulary) - 1))] == terms) if len(vocabulary) else np.zeros(len(terms), bool)
    picked = np.repeat(has, lengths)
    length = np.zeros(len(vocabulary), np.int64)
    length[at[has]] = lengths[has]
    begin = np.cumsum(length) - length
    position = position[picked]
    stride = end + 4 * GAP
    key = np.repeat(np.arange(len(vocabulary)), length) * stride + position
    cover = np.zeros(end + GAP, np.int32)
    exact: list[set[int]] = [set() for _ in counts]
    near: list[set[int]] = [set() for _ in counts]

    def note(into, w, place, first, items):
        doc = np.searchsorted(start, place, "right") - 1
        for d, k in np.unique(np.stack([doc, w], axis=1), axis=0) if len(w) else ():
            into[d].update(items[first[k] : first[k + 1]].tolist())

    if len(key):
        for table, first, items in windows.groups:
            for w, place in intersect(table, length, begin, position, key, stride):
                np.add.at(cover, place, 1)
                np.add.at(cover, place + table.shape[1], -1)
                note(exact, w, place, first, items)
            if least and table.shape[1] == WIDTH:
                # Places are moved so that one before the first word is no other term's.
                moved = key + 2 * slop + WIDTH
                for w, place in nearby(table, length, begin, position, moved, stride, least, slop):
                    # No matching word stands behind this point, and the next document starts farther on.
                    note(near, w, place + WIDTH + slop, first, items)
    name = lambda x: {windows.items[k] for k in x}
    return np.cumsum(cover)[:end] > 0, [name(x) for x in exact], [name(x) for x in near]


RESULT_SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, near_items array<string>"
STATE_SCHEMA = INDEX_SCHEMA + ", cover binary, items array<array<string>>, near array<array<string>>"
_LISTS = pa.list_(pa.list_(pa.string()))


def lookup(index: DataFrame, windows: Windows, least: int, slop: int, last: bool) -> DataFrame:
    """One pass of a block of test items over the stored index.

    The last pass gives a row for each document; the others add what they found to the index rows,
    so that with many blocks of items a word hit by two of them still counts once.
    """
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                counts = np.array(block["n_words"], np.int64)
                hit, exact, near = judge(block, shared.value, least, slop)
                if block.get("cover") is not None:
                    hit |= np.unpackbits(np.frombuffer(block["cover"], np.uint8), count=len(hit)).astype(bool)
                    exact = [a | set(b) for a, b in zip(exact, block["items"], strict=True)]
                    near = [a | set(b) for a, b in zip(near, block["near"], strict=True)]
                items = pa.array([sorted(x) for x in exact], pa.list_(pa.string()))
                close = pa.array([sorted(n - e) for n, e in zip(near, exact, strict=True)], pa.list_(pa.string()))
                if not last:
                    rest = [batch.slice(k, 1).column(i) for i in range(len(_TYPES))]
                    state = [pa.array([np.packbits(hit).tobytes()], pa.binary()), pa.array([items.to_pylist()], _LISTS), pa.array([close.to_pylist()], _LISTS)]
                    yield pa.RecordBatch.from_arrays([*rest, *state], [*batch.schema.names[: len(_TYPES)], "cover", "items", "near"])
                    continue
                start = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64) + np.arange(len(counts)) * GAP
                sums = np.concatenate(([0], np.cumsum(hit)))
                n_hit = sums[start + counts] - sums[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["doc_ids"], pa.int64()), pa.array(counts), pa.array(n_hit.astype(np.int64)), items, close],
                    ["doc_id", "n_words", "n_hit", "items", "near_items"],
                )

    return index.mapInArrow(run, RESULT_SCHEMA if last else STATE_SCHEMA)


def query_blocks(items: DataFrame, width: int) -> Iterator[Windows]:
    """The test items as blocks of at most QUERY_WORDS words (a longer item stands alone), one at a time.

    Tasks cut and hash the words; the driver holds the hashes of one block.
    """

    def run(batches):
        for part in sliced(batches, "text", BLOCK_BYTES):
            words, counts = word_hashes(*utf8(part.column(1)))
            cut = np.cumsum(counts)[:-1]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in np.split(words, cut)], pa.binary())], ["id", "words"])

    ids, parts, total, made = [], [], 0, 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").mapInArrow(run, "id string, words binary")
    for row in rows.toLocalIterator(prefetchPartitions=True):
        words = np.frombuffer(row["words"], np.uint64)
        if ids and total + len(words) > QUERY_WORDS:
            yield Windows(ids, np.concatenate(parts), np.array([len(p) for p in parts]), width)
            ids, parts, total, made = [], [], 0, made + 1
        ids.append(row["id"])
        parts.append(words)
        total += len(words)
    if ids or not made:
        yield Windows(ids, np.concatenate([*parts, np.empty(0, np.uint64)]), np.array([len(p) for p in parts], int), width)


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: int = 8, slop: int = 2) -> DataFrame:
    """doc_id, n_words, n_hit, items (matched exactly) and near_items (only by proximity) for every document."""
    out = build_index(docs)
    blocks = query_blocks(items, width)
    block = next(blocks)
    while (after := next(blocks, None)) is not None:
        before, out = out, stored(lookup(out, block, least, slop, False), "postings")
        drop_stored(before)
        block = after
    return lookup(out, block, least, slop, True)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The matches of every document with a digest of its items."""
    found = matches(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs none of whose words a test item hits, with their columns.

    A doc_id that any of its rows makes contaminated goes as a whole.
    """
    name = fresh(docs, "bad")
    bad = matches(docs, items, least=0).where("n_hit > 0").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad[name]), "left_anti")
