"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Learned filters of WIDTH bytes run over every position; each
chunk of CHUNK bytes keeps the maximum of every filter, and chunks start every CHUNK / 2
bytes, so they overlap and together cover the whole text. The mean, maximum and minimum
over the chunks of a text enter one hidden layer and a sigmoid. A filter over one-hot bytes is a
table of 256 weights for each of its positions, so the convolution is WIDTH table look-ups.

Cases: null counts as empty text; an empty text is WIDTH zero bytes; repeated rows get equal
scores; very long texts are read whole, tile by tile; a score equal to the bound is accepted; contradicting labels of one document count as the lower one; a null label is no
label; without both classes in the training rows the score is the share of label 1 (0.5
without any row); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, sliced, utf8

WIDTH = 5
FILTERS = 24
HIDDEN = 16
CHUNK = 256
HALF = CHUNK // 2
#: Bound of the training sample: labelled documents of each class, chosen by a hash of doc_id. Their
#: texts are used whole; scoring reads all chunks of all documents.
MAX_DOCS_PER_CLASS = 1000
EPOCHS = 12
ACCEPT = 0.7
BATCH_BYTES = 1 << 20
#: Positions convolved at once, so that the sums stay in cache and memory is bounded.
TILE = 1 << 14


def pooled(raw: np.ndarray, offsets: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(maximum of each filter over each chunk, first chunk of each text)."""
    n = np.diff(offsets)
    size = np.maximum(n, WIDTH)
    start = np.concatenate(([0], np.cumsum(size + WIDTH - 1)))
    padded = np.zeros(start[-1] + WIDTH, np.uint8)
    padded[np.repeat(start[:-1] - offsets[:-1], n) + np.arange(len(raw))] = raw
    blocks = -(-(size - WIDTH + 1) // HALF)
    first = np.concatenate(([0], np.cumsum(blocks)))
    at = np.repeat(start[:-1], blocks) + HALF * (np.arange(first[-1]) - np.repeat(first[:-1], blocks))
    top = np.empty((len(at), filters.shape[2]), np.float32)
    # Positions whose filter would leave the text: never the maximum.
    tail = ((start[:-1] + size)[:, None] + np.arange(1 - WIDTH, WIDTH - 1)).reshape(-1)
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, start[-1], TILE)), len(at)))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        a, b = at[lo], at[hi] if hi < len(at) else start[-1]
        conv = np.take(filters[0], padded[a:b], axis=0)
        more = np.empty_like(conv)
        for j in range(1, WIDTH):
            np.take(filters[j], padded[a + j : b + j], axis=0, out=more, mode="clip")
            conv += more
        conv[tail[np.searchsorted(tail, a) : np.searchsorted(tail, b)] - a] = -np.inf
        top[lo:hi] = np.maximum.reduceat(conv, at[lo:hi] - a, axis=0)
    chunks = np.maximum(blocks - 1, 1)
    lead = np.concatenate(([0], np.cumsum(chunks)))
    left = np.repeat(first[:-1], chunks) + np.arange(lead[-1]) - np.repeat(lead[:-1], chunks)
    right = np.minimum(left + 1, np.repeat(first[1:], chunks) - 1)
    return np.maximum(top[left], top[right]), lead[:-1]


def combine(p: np.ndarray, first: np.ndarray, model: dict) -> np.ndarray:
    """One probability for each text from the pooled filters of its chunks."""
    n = np.diff(np.append(first, len(p)))
    a = np.maximum(p + model["bias"], 0)
    z = np.hstack([np.add.reduceat(a, first, axis=0) / n[:, None], np.maximum.reduceat(a, first, axis=0), np.minimum.reduceat(a, first, axis=0)])
    h = np.maximum(z @ model["w1"] + model["b1"], 0)
    return 1 / (1 + np.exp(-np.clip(h @ model["w2"] + model["b2"], -30, 30).astype(np.float64)))


def augmented(chunks: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts and one short slice of each, so that the length of a text tells little."""
    more = []
    for text in chunks:
        raw = text[rng.integers(len(text))]
        raw = raw[raw != 0]
        size = int(rng.integers(12, 160))
        at = int(rng.integers(0, max(1, len(raw) - size)))
        out = np.zeros((1, CHUNK), np.uint8)
        out[0, : len(raw[at : at + size])] = raw[at : at + size]
        more.append(out)
    return chunks + more, np.concatenate([labels, labels])


def train(chunks: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Fit the network to texts given as (chunks, CHUNK) byte arrays, by Adam on the log loss."""
    rng = np.random.default_rng(seed)
    chunks, labels = augmented(chunks, labels, rng)
    length = np.array([np.count_nonzero(c[-1]) for c in chunks])
    short = np.array([len(c) == 1 for c in chunks])
    share = float(labels.mean()) if len(labels) else 0.5
    if len(labels) == 0 or share in (0.0, 1.0):
        return {"constant": share}
    par = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)),
        "bias": np.zeros(FILTERS),
        "w1": rng.normal(0, 0.15, (3 * FILTERS, HIDDEN)),
        "b1": np.full(HIDDEN, 0.1),
        "w2": rng.normal(0, 0.3, HIDDEN),
        "b2": np.zeros(()),
    }
    par = {k: v.astype(np.float32) for k, v in par.items()}
    mean = {k: np.zeros_like(v) for k, v in par.items()}
    var = {k: np.zeros_like(v) for k, v in par.items()}
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), 32):
            ids = order[lo : lo + 32]
            x = np.vstack([chunks[i] for i in ids])
            n = np.array([len(chunks[i]) for i in ids])
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            doc = np.repeat(np.arange(len(ids)), n)
            m = CHUNK - WIDTH + 1
            arg = np.empty((len(x), FILTERS), np.int64)
            p = np.empty((len(x), FILTERS), np.float32)
            for k in range(0, len(x), 64):
                part = x[k : k + 64]
                conv = np.take(par["filters"][0], part[:, :m], axis=0)
                for j in range(1, WIDTH):
                    conv += np.take(par["filters"][j], part[:, j : j + m], axis=0)
                # Beyond a short text's end only its first position may stand for it.
                conv[(np.arange(m) > np.maximum(length[ids][doc[k : k + 64], None] - WIDTH, 0)) & short[ids][doc[k : k + 64], None]] = -np.inf
                arg[k : k + 64] = conv.argmax(axis=1)
                p[k : k + 64] = np.take_along_axis(conv, arg[k : k + 64, None, :], axis=1)[:, 0]
            p += par["bias"]
            a = np.maximum(p, 0)
            top, low = np.maximum.reduceat(a, first, axis=0), np.minimum.reduceat(a, first, axis=0)
            z = np.hstack([np.add.reduceat(a, first, axis=0) / n[:, None], top, low])
            u = z @ par["w1"] + par["b1"]
            h = np.maximum(u, 0)
            y = 1 / (1 + np.exp(-np.clip(h @ par["w2"] + par["b2"], -30, 30)))
            d = (y - labels[ids]) * weight[ids] / len(ids)
            du = (d[:, None] * par["w2"]) * (u > 0)
            dz = du @ par["w1"].T
            da = dz[doc, :FILTERS] / n[doc, None] + dz[doc, FILTERS : 2 * FILTERS] * (a == top[doc]) + dz[doc, 2 * FILTERS :] * (a == low[doc])
            dp = (da * (p > 0)).astype(np.float32)
            grad = {"w2": h.T @ d, "b2": d.sum(), "w1": z.T @ du + 1e-4 * par["w1"], "b1": du.sum(axis=0), "bias": dp.sum(axis=0), "filters": np.zeros_like(par["filters"])}
            rows, cols = np.nonzero(dp)
            for j in range(WIDTH):
                np.add.at(grad["filters"][j], (x[rows, arg[rows, cols] + j], cols), dp[rows, cols])
            step += 1
            rate = 0.01 * (0.5 if epoch >= epochs * 0.6 else 1.0)
            for k in par:
                mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                var[k] = 0.999 * var[k] + 0.001 * grad[k] ** 2
                par[k] = (par[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return par


def spread(raw: np.ndarray) -> np.ndarray:
    """All overlapping chunks of a text, zero-filled at the end."""
    at = np.arange(max(0, -(-len(raw) // HALF) - 2) + 1) * HALF
    out = np.zeros((len(at), CHUNK), np.uint8)
    for k, i in enumerate(at):
        part = raw[i : i + CHUNK]
        out[k, : len(part)] = part
    return out


def fit(docs: DataFrame, labels: DataFrame, max_docs_per_class: int = MAX_DOCS_PER_CLASS) -> dict:
    """The network fitted to a bounded sample of the documents that have a label."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("y") == 1, F.lit(max_docs_per_class / max(1, sizes.get(1, 0)))).otherwise(F.lit(max_docs_per_class / max(1, sizes.get(0, 0))))
    chosen = known.where(unit < rate)  # about 2 * max_docs_per_class ids: bounded, so it may be broadcast

    def cut(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            raw, offsets = utf8(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([spread(raw[a:b]).tobytes() for a, b in zip(offsets, offsets[1:], strict=False)], pa.binary())],
                ["doc_id", "y", "chunks"],
            )

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Rows that repeat a doc_id are one example, so that the bound holds for them too.
    texts = texts.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "y")
    rows = texts.mapInArrow(cut, "doc_id long, y int, chunks binary").toPandas()
    rows = rows.sort_values(["doc_id", "y", "chunks"])
    return train([np.frombuffer(c, np.uint8).reshape(-1, CHUNK) for c in rows["chunks"]], rows["y"].to_numpy(np.float32))


def score_texts(column: pa.Array, model: dict) -> np.ndarray:
    """Probability of label 1 for each text of an Arrow column, to 6 places: sums in another order differ by less."""
    if "constant" in model:
        return np.full(len(column), model["constant"])
    raw, offsets = utf8(column)
    return np.round(combine(*pooled(raw, offsets, model["filters"]), model), 6)


def score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """All columns of docs and, in a column of that name, the score of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            p = score_texts(part.column(part.schema.get_field_index("text")), shared.value)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [*part.schema.names, name])

    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias(name)).schema)


def in_training_fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 4 != 2


def classify(docs: DataFrame, labels: DataFrame, max_docs_per_class: int = MAX_DOCS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from the labels whose crc32(doc_id) mod 4 is not 2."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels.select("doc_id", "quality").where(in_training_fold()), max_docs_per_class)
    return score(docs, model).select(
        "doc_id",
        F.coalesce(~in_training_fold(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, with their columns."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality").where(in_training_fold()))
    name = fresh(docs, "score")
    return score(docs, model, name).where(F.col(name) >= ACCEPT).drop(name)
