"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from Spark, the log-probability matrix (buckets x languages) is broadcast, and a
batch of texts is scored in numpy as a sparse matrix product: each n-gram is one entry of a
row, gathered from the matrix and summed per document.

Cases: null text or text without a letter gives ``und`` with score 0; ties go to the first
language in sorted order; repeated rows get equal results; very long texts are scored whole, in
slices; without training rows every text is ``und``; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced, stored

BUCKETS = 1 << 16
#: Bound of the training sample: documents of each language. Beyond it a hash of doc_id chooses.
MAX_DOCS_PER_LANG = 2000
#: Languages of one block of the matrix (16 MB); all languages are learned, block by block.
BLOCK_LANGS = 64
#: Log-probabilities gathered at once, so that a very long text needs no more memory than a short one.
ENTRIES = 1 << 21
BATCH_BYTES = 1 << 20
_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, first entry of each text, letters of each text).

    Every letter gives its unigram, the bigram with the character before it and the trigram
    with both neighbours; all that is not a letter counts as one blank character.
    """
    lowered = [(t or "").lower() for t in texts]
    code = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _alpha()[code]
    code = np.where(letter, code, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    ends = 1 + np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))
    bounds = np.searchsorted(at, np.concatenate(([1], ends)))
    a, b, c = code[at - 1], code[at], code[at + 1]
    one = b * np.uint64(0x9E3779B97F4A7C15)
    two = (one ^ (a + np.uint64(0x51ED270B))) * np.uint64(0xBF58476D1CE4E5B9)
    three = (two ^ (c + np.uint64(0x2545F491))) * np.uint64(0x94D049BB133111EB)
    ids = np.empty((len(at), 3), np.int32)
    for k, h in enumerate((one, two, three)):
        ids[:, k] = (h >> np.uint64(48)).astype(np.int32)
    return ids, bounds[:-1], np.diff(bounds)


def fit(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> tuple[list[str], list[np.ndarray]]:
    """Languages and, for each block of BLOCK_LANGS of them, the log-probabilities (buckets + 1 prior row, languages).

    Priors come from all labelled rows. What reaches the driver grows with the languages, not with the rows.
    """
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], []
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, max_docs_per_lang / sizes[k]))])
    index = F.create_map(*[F.lit(x) for i, k in enumerate(langs) for x in (k, i)])
    chosen = docs.where(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20)
    ).select("text", F.element_at(index, F.col("lang")).alias("k"))

    def count(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            ids, _, n = ngrams(part.column(0).to_pylist())
            k = np.repeat(np.asarray(part.column(1)).astype(np.int64), n)
            entry, times = np.unique((ids + (k * BUCKETS)[:, None]).reshape(-1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((entry // BUCKETS).astype(np.int32)), pa.array((entry % BUCKETS).astype(np.int32)), pa.array(times.astype(np.int64))], ["k", "bucket", "n"])

    counted = stored(chosen.mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    seen = counted.select("bucket").distinct().count()  # at most BUCKETS
    total = sum(sizes.values())
    blocks = []
    for lo in range(0, len(langs), BLOCK_LANGS):
        hi = min(len(langs), lo + BLOCK_LANGS)
        rows = counted.where((F.col("k") >= lo) & (F.col("k") < hi)).toPandas()
        counts = np.zeros((BUCKETS, hi - lo))
        counts[rows["bucket"], rows["k"] - lo] = rows["n"]
        matrix = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(seen, 1)))
        prior = np.log(np.array([sizes[k] for k in langs[lo:hi]], float) / total)
        blocks.append(np.vstack([matrix, prior]).astype(np.float32))
    return langs, blocks


def sums(ids: np.ndarray, n: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """(texts, languages) sums of the log-probabilities of each text's n-grams, by slices of bounded size."""
    out = np.zeros((len(n), matrix.shape[1]))
    row = np.repeat(np.arange(len(n)), n)
    step = max(1, ENTRIES // max(1, matrix.shape[1]))
    for lo in range(0, len(row), step):
        part, of = ids[lo : lo + step], row[lo : lo + step]
        entry = matrix[part[:, 0]]
        entry += matrix[part[:, 1]]
        entry += matrix[part[:, 2]]
        head = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        out[of[head]] += np.add.reduceat(entry, head, axis=0, dtype=np.float64)
    return out


def score(texts: list[str | None], langs: list[str], matrix: np.ndarray | list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability, to 9 places; blocks of languages one after another."""
    blocks = matrix if isinstance(matrix, list) else [matrix]
    ids, _, n = ngrams(texts)
    has = n > 0
    if not len(langs):
        return ["und"] * len(texts), np.zeros(len(texts))
    best, top, mass, first = np.zeros(len(texts), int), np.full(len(texts), -np.inf), np.zeros(len(texts)), 0
    for block in blocks:
        out = sums(ids, n, block) + block[BUCKETS]
        k = out.argmax(axis=1)
        high = out[np.arange(len(texts)), k]
        new = np.maximum(top, high)
        mass = mass * np.exp(top - new) + np.exp(out - new[:, None]).sum(axis=1)
        best = np.where(high > top, first + k, best)
        top, first = new, first + block.shape[1]
    return [langs[b] if h else "und" for b, h in zip(best, has, strict=True)], np.where(has, np.round(1.0 / mass, 9), 0.0)


def predict(docs: DataFrame, langs: list[str], matrix: list[np.ndarray]) -> DataFrame:
    """doc_id, lang_pred and score of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches):
        langs, matrix = shared.value
        for part in sliced(batches, "text", BATCH_BYTES):
            pred, p = score(part.column(1).to_pylist(), langs, matrix)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(p)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows whose crc32(doc_id) mod 5 is not 0."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    langs, matrix = fit(docs.where(fold != 0), max_docs_per_lang)
    return predict(docs, langs, matrix).select("doc_id", (F.coalesce(fold, F.lit(1)) == 0).alias("held_out"), "lang_pred", "score")
