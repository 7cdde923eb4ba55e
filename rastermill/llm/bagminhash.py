"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

Signature. Every distinct shingle of a document with multiplicity w owns Poisson processes over
the weight axis, discretised to whole weights and split hierarchically into the shells
[0, 1), [1, 2), [2, 4), [4, 8), ... A shell's process has its width as rate, and its points, drawn
from a hash of (shingle, shell, point number), carry a time, a cell of the weight axis and a
component. A point counts if its cell lies below w. Each component keeps its earliest point; two
documents agree in a component with exactly the probability of their weighted Jaccard
similarity. Points arrive in ascending time, so a process stops once it is later than all
components: about one hash for each shingle instead of one for each shingle and component.

Candidates. Equal texts become one node first. BANDS bands of ROWS components are grouped; two texts of
similarity 0.8 share no band with probability below 1e-5. Every member of a bucket is compared with the member that
has fewest rare shingles: the same few nodes in the many buckets of a group, and those nearest to what its members were copied from, so a group
costs a few pairs for each member. From then on only buckets that still hold several classes count. A small one's members of
different classes are all compared. In a large one the members outside the main class are compared with all members of
other classes, in rounds, with classes joined in between; so no link between members is lost. An exact bound
keeps hopeless pairs from being formed: of the n shingles of x let u be those that at most RARE texts hold.
Pairs that share such a rare shingle come from its short list. All others share a = n - u at most, so y
can only be similar if n_y <= a_x (1 + t) / t - n_x, and the other way round. The comparison itself is an
intersection of whole shingle multisets in the JVM. Members that this bound cannot tell apart and that still are not similar
cost a pair each, which is the price of losing none.

Classes are the connected components of the links; the class id is the least doc_id.

Cases: null counts as empty text; a text of fewer than five words is one shingle of all its
words; texts without a word have no shingle and are alike only if they are equal; equal texts are
always in one class; rows that repeat a doc_id with equal text are one document, and with different
texts join the classes of those texts; rows with a null doc_id are left out; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop_stored, fresh, released, sliced, stored, utf8
from .words import mix, shingles, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
COMPONENTS = BANDS * ROWS
BATCH_BYTES = 1 << 20
#: Buckets of at most so many members are compared at once, all pairs of different classes; larger ones in rounds.
SMALL = 8
#: A shingle that at most so many texts of shared buckets hold counts as rare.
RARE = 8
GRAMS_AT_ONCE = 1 << 18


def multisets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, multiplicity) sorted by row and shingle, and the number of shingles of each row."""
    words, counts = word_hashes(raw, offsets)
    h, row = shingles(words, counts, SHINGLE)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    head = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))) if len(h) else np.empty(0, np.int64)
    return row[head], h[head], np.diff(np.append(head, len(h))), np.bincount(row, minlength=len(counts))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, m: int = COMPONENTS) -> np.ndarray:
    """(rows, m) identities of the earliest points; rows without a shingle hold zeros."""
    best = np.full(rows * m, np.inf)
    who = np.zeros(rows * m, np.uint64)
    shells = np.frexp(np.maximum(weight - 1, 0).astype(np.float64))[1] + 1  # [0,1) and one more for each doubling
    k = np.repeat(np.arange(len(row)), shells)
    shell = np.arange(len(k)) - np.repeat(np.cumsum(shells) - shells, shells)
    low = np.where(shell > 0, np.left_shift(1, np.maximum(shell - 1, 0)), 0).astype(np.int64)
    rate = np.maximum(low, 1)
    doc, limit = row[k], weight[k]
    state = mix(shingle[k] + np.uint64(0x9E3779B97F4A7C15) * (shell + 1).astype(np.uint64))
    time = np.zeros(len(k))
    number = 0
    present = np.unique(row)
    while len(doc):
        number += 1
        state = mix(state + np.uint64(0xD1B54A32D192ED03))
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        place = mix(state ^ np.uint64(0xA0761D6478BD642F))
        counts = low + (place >> np.uint64(32)).astype(np.int64) % rate < limit
        slot = doc * m + ((place & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)
        s, t, i = slot[counts], time[counts], state[counts]
        better = t < best[s]
        s, t, i = s[better], t[better], i[better]
        order = np.lexsort((t, s))
        s, t, i = s[order], t[order], i[order]
        first = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.empty(0, bool)
        best[s[first]], who[s[first]] = t[first], i[first]
        latest = np.full(rows, -1.0)
        latest[present] = best.reshape(rows, m)[present].max(axis=1)
        go = time < latest[doc]
        doc, limit, state, time, low, rate = doc[go], limit[go], state[go], time[go], low[go], rate[go]
        present = np.unique(doc)
    return who.reshape(rows, m)


def bands(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of ROWS components each."""
    out = np.zeros((len(sig), BANDS), np.uint64)
    for j in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, j::ROWS] + np.uint64(j + 1))
    return mix(out + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, text key (128 bits), band hashes and number of shingles of every document; stored."""

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            raw, offsets = utf8(part.column(1))
            row, shingle, weight, total = multisets(raw, offsets)
            band = bands(signatures(row, shingle, weight, len(total)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(total) * BANDS + 1, BANDS), pa.int32()), pa.array(band.reshape(-1)), mask=pa.array(total == 0))
            yield pa.RecordBatch.from_arrays([part.column(0), text_keys(raw, offsets), lists, pa.array(total, pa.int64())], ["doc_id", "key", "bands", "n"])

    found = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id long, key binary, bands array<long>, n long")
    return stored(found, "bands")


def text_keys(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    view = raw.tobytes()
    return pa.array([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(offsets, offsets[1:], strict=False)], pa.binary())


def gram_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id, grams) of the texts in chosen (id, key, rep): a multiset as the set of its numbered shingles; stored.

    The k-th occurrence of a shingle is an element of its own, so the overlap of two multisets is the size of an intersection.
    """

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            raw, offsets = utf8(part.column(2))
            same = np.array([a == b for a, b in zip(text_keys(raw, offsets).to_pylist(), part.column(1).to_pylist(), strict=True)])
            row, shingle, weight, total = multisets(raw, offsets)
            at = np.repeat(np.arange(len(row)), weight)
            number = np.arange(len(at)) - np.repeat(np.cumsum(weight) - weight, weight)
            gram = np.where(number > 0, mix(shingle[at] + number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), shingle[at]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(total))), pa.int32()), pa.array(gram))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "grams"]).filter(pa.array(same))

    rows = docs.join(chosen.select("id", "key", F.col("rep").alias("doc_id")), "doc_id")
    # Rows that repeat a doc_id with equal text are one; of the texts of a doc_id, run takes the one that is meant.
    texts = rows.groupBy("id", F.xxhash64("text").alias("h")).agg(F.first("key").alias("key"), F.first("text").alias("text"))
    return stored(texts.select("id", "key", "text").mapInArrow(run, "id long, grams array<long>"), "grams")


def similarities(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose multisets reach the similarity; the overlap is counted on whole sets."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb")).alias("s")
    found = pairs.join(left, "a").join(right, "b").select("a", "b", both, (F.size("ga") + F.size("gb")).alias("n"))
    return found.where(F.col("s") >= (F.col("n") - F.col("s")) * F.lit(least)).select("a", "b")


def tasks(df: DataFrame, rows: int, each: int) -> int:
    """Tasks for so many rows: enough for the cluster, and `each` rows a task at most."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each))


EDGES_PER_TASK = 500_000


def components(links: DataFrame) -> DataFrame:
    """(node, class) of every linked node: least id reached, by alternating large and small stars.

    The number of tasks follows the measured number of edges.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    n, before = edges.count(), None
    while True:
        parts = tasks(edges, n, EDGES_PER_TASK)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        last, edges = edges, stored(small.coalesce(parts), "edges")
        drop_stored(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("class"))
        n, before = now[0], now


def rare_grams(sets: DataFrame) -> DataFrame:
    """(gram, id) of the grams that at most RARE of the sets hold; stored."""

    def run(batches):
        for batch in released(batches):
            column = batch.column(1)
            ids, ends, gram = np.asarray(batch.column(0)), np.asarray(column.offsets), np.asarray(column.values)
            # Offsets are 32 bits wide, which the product exceeds from 8,192 rows on.
            step = max(1, len(ids) * GRAMS_AT_ONCE // max(1, int(ends[-1] - ends[0])))
            for lo in range(0, len(ids), step):
                hi = min(len(ids), lo + step)
                g, row = gram[ends[lo] : ends[hi]], np.repeat(np.arange(lo, hi), np.diff(ends[lo : hi + 1]))
                order = np.argsort(g, kind="stable")
                g, row = g[order], row[order]
                head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.empty(0, np.int64)
                held = np.diff(np.append(head, len(g)))
                each = np.repeat(held, held)
                # A gram that is frequent here already needs one row only.
                keep = each <= RARE
                keep[head] = True
                count = np.where(each <= RARE, 1, RARE + 1)[keep]
                yield pa.RecordBatch.from_arrays([pa.array(g[keep]), pa.array(ids[row[keep]]), pa.array(count, pa.int64())], ["gram", "id", "c"])

    found = stored(sets.select("id", "grams").mapInArrow(run, "gram long, id long, c long"), "shingles")
    few = found.groupBy("gram").agg(F.sum("c").alias("df")).where(F.col("df") <= RARE).select("gram")
    held = stored(found.join(few, "gram", "left_semi").select("gram", "id"), "rare")
    drop_stored(found)
    return held


def sharing_rare(held: DataFrame, node: DataFrame, least: float) -> DataFrame:
    """(a, b) that share rare grams and can reach the similarity: they share at most the smaller rest besides."""
    lists = held.groupBy("gram").agg(F.sort_array(F.collect_list("id")).alias("x")).where(F.size("x") > 1)  # RARE at most
    both = F.flatten(F.transform("x", lambda x: F.transform(F.filter("x", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    pairs = lists.select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("s"))
    of = lambda k: node.select(F.col("id").alias(k), F.col("n").alias("n_" + k), (F.col("n") - F.col("u")).alias("rest_" + k))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b")
    return pairs.where((F.least("rest_a", "rest_b") + F.col("s")) * F.lit((1 + least) / least) + F.lit(1e-6) >= F.col("n_a") + F.col("n_b")).select("a", "b")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id of every document; documents of one class id are near-duplicates."""
    docs = docs.select("doc_id", "text")
    known = described(docs)
    # A distinct text is one node, with a number of its own.
    rep = known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    rep = stored(rep.withColumn("id", F.monotonically_increasing_id()), "representatives")
    spread = lambda df, *more: df.select("id", "n", *more, F.explode("bands").alias("band"))
    fits = lambda x, y: F.least(x, y) >= F.greatest(x, y) * F.lit(least)

    # The nodes that share a bucket, with what the bound needs.
    entry = spread(rep.where("bands IS NOT NULL"))
    shared = entry.groupBy("band").agg(F.count("*").alias("size")).where("size > 1").select("band")
    node = stored(rep.join(entry.join(shared, "band", "left_semi").select("id").distinct(), "id", "left_semi"), "nodes")
    sets = gram_sets(docs, node)
    held = rare_grams(sets)
    u = F.coalesce("u", F.lit(0))
    reach = F.floor((F.col("n") - u) * F.lit((1 + least) / least) + F.lit(1e-6)) - F.col("n")
    node = stored(node.join(held.groupBy("id").agg(F.count("*").alias("u")), "id", "left").withColumn("reach", reach).withColumn("u", u), "nodes")

    def able(x, y):
        """Whether nodes that share no rare shingle can be similar."""
        return (x["n"] <= y["reach"]) & (y["n"] <= x["reach"]) & fits(x["n"], y["n"])

    def compared(pairs: DataFrame) -> DataFrame:
        return stored(similarities(pairs.distinct(), sets, least), "links")

    # Every member of a bucket against the one that has fewest rare shingles.
    bucket = spread(node, "u", "reach").groupBy("band").agg(F.min(F.struct("u", "id", "n", "reach")).alias("center"))
    star = spread(node, F.struct("id", "n", "reach").alias("own")).join(bucket, "band").where((F.col("center.id") != F.col("id")) & able(F.col("center"), F.col("own")))
    star = star.select(F.least("center.id", "id").alias("a"), F.greatest("center.id", "id").alias("b"))
    classed = components(compared(star.unionByName(sharing_rare(held, node, least))))

    def with_class(df: DataFrame, column: str = "id", name: str = "class") -> DataFrame:
        to = classed.select(F.col("node").alias("_node"), F.col("class").alias("_class"))
        return df.join(to, df[column] == to["_node"], "left").withColumn(name, F.coalesce("_class", column)).drop("_node", "_class")

    def merged(links: DataFrame) -> DataFrame:
        return components(links.unionByName(classed.select(F.col("node").alias("a"), F.col("class").alias("b"))))

    # What is left are buckets with several classes. The class that most members have is the bucket's main class.
    node = stored(with_class(node), "nodes")
    share = spread(node, "class").groupBy("band", "class").agg(F.count("*").alias("c"))
    mixed = share.groupBy("band").agg(F.sum("c").alias("size"), F.max(F.struct("c", "class"))["class"].alias("main"), F.count("*").alias("classes"))
    mixed = stored(mixed.where("classes > 1").select("band", "size", "main"), "mixed")
    few = spread(node, "reach", "class").join(mixed.where(F.col("size") <= SMALL).select("band"), "band")
    lists = few.groupBy("band").agg(F.collect_list(F.struct("id", "n", "reach", "class")).alias("x"))  # SMALL at most
    other = lambda x, y: (y["id"] > x["id"]) & (y["class"] != x["class"]) & able(x, y)
    paired = F.flatten(F.transform("x", lambda x: F.transform(F.filter("x", lambda y: other(x, y)), lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))))
    links = compared(lists.select(F.explode(paired).alias("p")).select("p.a", "p.b"))
    if not links.isEmpty():
        classed = merged(links)
    hot = mixed.where(F.col("size") > SMALL)
    if not hot.isEmpty():
        # Outsiders: members of hot buckets that are not in the main class.
        def refreshed(rows: DataFrame) -> DataFrame:
            return with_class(with_class(rows.drop("class")), "main", "main").where("class <> main")

        first = refreshed(spread(node, "u", "reach", "class").join(hot.select("band", "main"), "band").where("class <> main"))
        # Sizes by steps of 5 %, with the largest reach: who fits none of these has no partner in the bucket.
        step = F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(1.05).item()))
        bins = spread(node, "reach").groupBy("band", step.alias("bin")).agg(F.min("n").alias("least_n"), F.max("reach").alias("most_reach"), F.count("*").alias("size"))
        bins = bins.join(hot.select("band"), "band", "left_semi")
        alone = (bins["size"] == 1) & (bins["least_n"] == first["n"])  # a step that may hold this member only
        partner = (first["band"] == bins["band"]) & (first["reach"] >= bins["least_n"]) & (first["n"] <= bins["most_reach"]) & ~alone
        left = stored(first.join(bins, partner, "left_semi").select("band", "id", "n", "u", "reach", "class", "main"), "left")
        width = 2 * SMALL
        while not left.isEmpty():
            pick = left.withColumn("k", F.row_number().over(Window.partitionBy("band").orderBy("u", "id"))).where(F.col("k") <= width)
            pick = stored(pick.select("band", F.struct("id", "n", "reach", "class").alias("pick")), "picks")
            now = spread(with_class(node.drop("class")), "reach", "class").select("band", F.struct("id", "n", "reach", "class").alias("own"))
            pairs = now.join(pick, "band").where((F.col("own.class") != F.col("pick.class")) & able(F.col("own"), F.col("pick")))
            links = compared(pairs.select(F.least("own.id", "pick.id").alias("a"), F.greatest("own.id", "pick.id").alias("b")))
            if not links.isEmpty():
                classed = merged(links)
            rest = left.join(pick.select("band", "pick.id"), ["band", "id"], "left_anti")
            left = stored(refreshed(rest).select("band", "id", "n", "u", "reach", "class", "main"), "left")
            width *= 2  # few rounds, with classes joined in between
    # Different texts of one doc_id join their classes.
    own = known.select("doc_id", "key").distinct().groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1").select("doc_id")
    own = known.join(own, "doc_id", "left_semi").select("doc_id", "key").distinct().join(rep.select("key", "id"), "key").select("doc_id", "id")
    least_own = own.groupBy("doc_id").agg(F.min("id").alias("a"))
    joined = stored(own.join(least_own, "doc_id").where("a <> id").select("a", F.col("id").alias("b")), "joined")
    if not joined.isEmpty():
        classed = merged(joined)
    found = with_class(rep.select("id", "key", "rep"))
    name = found.groupBy("class").agg(F.min("rep").alias("class_id"))
    found = found.join(name, "class").select("key", "class_id")
    out = known.select("doc_id", "key").join(found, "key")
    return out.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs of each class, that of the least doc_id, with its columns; rows without a doc_id stay.

    Where a doc_id repeats, the row with the least hash of all its columns stays, whatever the order of the rows.
    """
    name = fresh(docs, "kept")
    found = classes(docs).where("doc_id = class_id").select(F.col("doc_id").alias(name))
    kept = docs.where("doc_id IS NOT NULL").join(found, docs["doc_id"] == found[name], "left_semi")
    if not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        row = F.struct(*[F.col(c) for c in docs.columns])
        kept = kept.groupBy("doc_id").agg(F.min_by(row, F.struct(F.xxhash64(*docs.columns), F.to_json(row))).alias("_row")).select("_row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))
