"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is normalised as the model says (a blank becomes the mark U+2581, one mark is put in front) and cut
into marked words: a run of marks with the characters up to the next mark. No piece of the model
holds a mark behind another character, so words are independent. The distinct words of a
batch are sorted, which is a depth-first walk of their trie, and the forward table of a word starts
as that of the word before it, cut to their common prefix.

The forward table has, for each prefix, the last piece of the prefix's best segmentation. A step from
piece s to piece t scores 0 if merging s + t by the model's scores gives [s, t] again, else minus
infinity. Merge segmentations have the property that a sequence is the segmentation of its text exactly
if all its neighbouring pairs are, and so each prefix has exactly one finite path; the best path is the
one the `sentencepiece` library finds for a merge (BPE) model. Adding up the scores of pieces as a
unigram model does would give other segmentations for such a model. Characters
that no piece holds stand alone and become their bytes' pieces.

Cases: null and empty text have no pieces and decode to the empty text; ties cannot occur;
repeated rows get equal results; very long words grow only their own table; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import sliced

MARK = "▁"
#: Distinct words that a Python worker remembers, the bytes of these words with their ids, and pairs of pieces.
MEMO = 800_000
#: Words remembered where the workers stay for other stages.
SMALL_MEMO = 200_000
MEMO_BYTES = 1 << 25
PAIRS = 400_000
BATCH_BYTES = 1 << 20


class Model:
    """Pieces and scores of a sentencepiece model file of type BPE."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.byte_of and i not in self.control}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece of this model crosses words")
        self.unknown = sp.unk_id()
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        # Sizes of the pieces by their last three characters, the longest first; those of two and one are always tried.
        by_end: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                by_end.setdefault(p[-3:], {2, 1}).add(len(p))
        self.sizes = {end: tuple(sorted(found, reverse=True)) for end, found in by_end.items()}
        single = {p for p in self.ids if len(p) == 1}
        self.known = single
        self.pairs: dict[tuple[str, str], bool] = {}
        # Marks with what follows them; a line break is no piece, so it always stands alone.
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if "\n" not in single and not any("\n" in p for p in self.ids) else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0
        self.most = MEMO
        # One string for each piece, so that remembered pairs hold no copies.
        self.same = {p: p for p in self.ids}
        self.coded = {p: self.id_bytes(p) for p in self.ids}

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by merging: highest score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, s: str, t: str) -> bool:
        """Whether the step from s to t has a finite score; s is empty where t stands first."""
        found = self.pairs.get((s, t))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[s, t] = self.merged(s + t) == ([s, t] if s else [t])
        return found

    def solve(self, words: list[str]) -> None:
        """Remember the ids of new words, walked in sorted order with a shared forward table."""
        table = [""]  # table[i]: last piece of the first i characters
        before = ""
        pairs, pieces, sizes, coded = self.pairs, self.same, self.sizes, self.coded
        for word in sorted(words):
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            del table[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                last = word[end - 1]
                if last in self.known:
                    for size in sizes.get(word[max(0, end - 3) : end], (2, 1)):
                        start = end - size
                        if start >= 0:
                            t = pieces.get(word[start:end])
                            if t is not None:
                                s = table[start]
                                found = pairs.get((s, t))
                                if self.follows(s, t) if found is None else found:
                                    last = t
                                    break
                table.append(last)
            before = word
            path, end = [], len(word)
            while end:
                t = table[end]
                path.append(coded[t] if t in coded else self.id_bytes(t))
                end -= len(t)
            path.reverse()
            ids = self.memo[word] = b"".join(path)
            self.memo_bytes += len(word) + len(ids)

    def id_bytes(self, piece: str) -> bytes:
        return np.array(self.id_of(piece), "<u4").tobytes()

    def id_of(self, piece: str) -> tuple[int, ...]:
        if piece in self.ids:
            return (self.ids[piece],)
        if not self.bytes:
            return (self.unknown,)
        return tuple(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))

    def words(self, text: str) -> list[str]:
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        words, ends = [], [0]
        for t in texts:
            words += self.words(t or "")
            ends.append(len(words))
        found = list(map(self.memo.get, words))
        holes = [k for k, ids in enumerate(found) if ids is None]
        self.solve(list({words[k] for k in holes}))
        for k in holes:
            found[k] = self.memo[words[k]]
        out = [np.frombuffer(b"".join(found[lo:hi]), "<u4") for lo, hi in zip(ends, ends[1:], strict=False)]
        if len(self.memo) > self.most or self.memo_bytes > MEMO_BYTES:  # keep what the last batch used
            self.memo = {w: self.memo[w] for w in set(words)}
            self.memo_bytes = sum(len(w) + len(ids) for w, ids in self.memo.items())
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; runs of byte pieces are decoded together, bad ones become U+FFFD."""
        if not hasattr(self, "raw"):
            self.raw = [b"" if i in self.control else bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode("utf-8") for i, p in enumerate(self.pieces)]
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.empty(0, "<u4")]).astype(np.int32)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of docs with `piece_ids` (a column of docs of that name is replaced), the ids of every row's whole text."""
    docs = docs.drop("piece_ids")

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            column = id_lists(model(path).encode(part.column(part.schema.get_field_index("text")).to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, "piece_ids"])

    return docs.mapInArrow(run, docs.selectExpr("*", "CAST(NULL AS ARRAY<INT>) AS piece_ids").schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of encoded with `decoded` (likewise replaced), the text of its piece_ids; null ids give null."""
    encoded = encoded.drop("decoded")

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("piece_ids"))
            texts = [model(path).decode(np.asarray(x.values)) if x.is_valid else None for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, encoded.selectExpr("*", "CAST(NULL AS STRING) AS decoded").schema)


def encode_decode(docs: DataFrame, path: str, memo: int = SMALL_MEMO) -> DataFrame:
    """decode(encode(docs)) in one pass: a task has one Python worker instead of two, and ids do not travel twice."""
    docs = docs.drop("piece_ids", "decoded")

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            m = model(path)
            m.most = memo
            ids = m.encode(part.column(part.schema.get_field_index("text")).to_pylist())
            column = id_lists(ids)
            texts = pa.array([m.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, column, texts], [*part.schema.names, "piece_ids", "decoded"])

    return docs.mapInArrow(run, docs.selectExpr("*", "CAST(NULL AS ARRAY<INT>) AS piece_ids", "CAST(NULL AS STRING) AS decoded").schema)


SUMMARY_SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, n_decoded long, decoded_crc32 long, same boolean"


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Each document encoded and decoded: number and crc32 of its ids (32-bit little-endian), code points and
    crc32 of the decoded UTF-8 text, and whether that is the text."""

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            m = model(path)
            m.most = MEMO
            texts = part.column(1).to_pylist()
            rows = []
            for doc, text, ids in zip(part.column(0).to_pylist(), texts, m.encode(texts), strict=True):
                back = m.decode(ids)
                rows.append((doc, len(ids), zlib.crc32(ids.tobytes()), len(back), zlib.crc32(back.encode("utf-8")), back == (text or "")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.bool_()], strict=True)],
                ["doc_id", "n_pieces", "ids_crc32", "n_decoded", "decoded_crc32", "same"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SUMMARY_SCHEMA)
