"""Dataset state as append-only tables and the views over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("trn", "val", "tst")
SHARD_LIMIT = 2 * 1024**3


def latest_status(log: DataFrame) -> DataFrame:
    """(image_id, status, reason): the last entry of each image by (ts, seq)."""
    return log.groupBy("image_id").agg(F.max_by(F.struct("status", "reason"), F.struct("ts", "seq")).alias("s")).select("image_id", "s.*")


def status_counts(log: DataFrame) -> DataFrame:
    return latest_status(log).groupBy("status").agg(F.count("*").alias("n_images"))


def split_counts(patches: DataFrame) -> DataFrame:
    """(split, n, share) of all three splits; shares are 0 while there is no patch."""
    spine = patches.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    counts = patches.groupBy("split").agg(F.count("*").alias("n"))
    out = spine.join(counts, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))  # one row
    return out.join(F.broadcast(total)).select("split", "n", F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(F.lit(0.0)).alias("share"))


def image_shards(patches: DataFrame) -> DataFrame:
    """(image_id, n_trn, n_val, n_tst, shards): patches of each image by split and its shards in order."""
    counts = [F.count_if(F.col("split") == s).alias(f"n_{s}") for s in SPLITS]
    return patches.groupBy("image_id").agg(*counts, F.sort_array(F.collect_set("shard_id")).alias("shards"))


def shard_table(patches: DataFrame) -> DataFrame:
    """(split, shard_id, patch_count, size_bytes, images, cumulative): accounting of every shard."""
    # Images are made distinct first, so that no shard's patches meet in one place.
    images = patches.select("split", "shard_id", "image_id").distinct().groupBy("split", "shard_id").agg(F.count("*").alias("images"))
    sums = patches.groupBy("split", "shard_id").agg(F.count("*").alias("patch_count"), F.sum("size_bytes").alias("size_bytes"))
    over = Window.partitionBy("split").orderBy("shard_id")
    return sums.join(images, ["split", "shard_id"]).withColumn("cumulative", F.sum("patch_count").over(over))


def bytes_by_split(shards: DataFrame) -> DataFrame:
    return shards.groupBy("split").agg(F.sum("size_bytes").alias("size_bytes"))


def open_shard(shards: DataFrame, limit: int = SHARD_LIMIT) -> DataFrame:
    """The open shard with most room of each split."""
    over = Window.partitionBy("split").orderBy("size_bytes", "shard_id")
    return shards.where((F.col("status") == "OPEN") & (F.col("size_bytes") < limit)).withColumn("k", F.row_number().over(over)).where("k = 1").drop("k")


def next_shard(shards: DataFrame) -> DataFrame:
    return shards.groupBy("split").agg((F.max("shard_id") + 1).alias("next_id"))


def pack(patches: DataFrame, limit: int = SHARD_LIMIT, lanes: int = 1) -> DataFrame:
    """patches (patch_ord, split, size_bytes, ...) with lane and shard_id, filled greedily in order.

    A shard closes when the next patch would exceed the limit; a first patch that is too large
    skips a shard number, as a writer that rotates before writing does. Filling is sequential within a
    split and lane, and streams: a task holds one Arrow batch. lanes > 1 deals the patches of a split to
    independent sequences by a hash of their order, for parallel packing and writing.
    """
    lane = F.pmod(F.xxhash64("patch_ord"), F.lit(lanes)).cast("int")
    dealt = patches.withColumn("lane", lane).repartition("split", "lane").sortWithinPartitions("split", "lane", "patch_ord")
    schema = dealt.withColumn("shard_id", F.lit(0)).schema

    def run(batches: Iterator[pa.RecordBatch]):
        key, shard, fill = None, 0, 0
        for batch in batches:
            names = batch.schema.names
            splits, at = batch.column(names.index("split")).to_pylist(), batch.column(names.index("lane")).to_pylist()
            out = np.empty(batch.num_rows, np.int32)
            for k, (name, size) in enumerate(zip(zip(splits, at, strict=True), batch.column(names.index("size_bytes")).to_pylist(), strict=True)):
                if name != key:
                    key, shard, fill = name, 0, 0
                if fill + size > limit:
                    shard, fill = shard + 1, 0
                out[k] = shard
                fill += size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*names, "shard_id"])

    return dealt.mapInArrow(run, schema)


def consistency(images: DataFrame, shards: DataFrame, stats: DataFrame, running: DataFrame) -> DataFrame:
    """(split, from_images, from_shards, from_statistics, from_running, issues) of each split.

    The four inputs have (split, n); running counts training patches only.
    """
    spine = images.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    for name, part in (("from_images", images), ("from_shards", shards), ("from_statistics", stats), ("from_running", running)):
        spine = spine.join(part.groupBy("split").agg(F.sum("n").alias(name)), "split", "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    differs = lambda other, text: F.when(F.col("from_images") != F.col(other), F.concat("split", F.lit(": images="), F.col("from_images").cast("string"), F.lit(f" {text}="), F.col(other).cast("string")))
    ran = F.when((F.col("split") == "trn") & (F.col("from_images") != F.col("from_running")), F.concat(F.lit("running="), F.col("from_running").cast("string"), F.lit(" images="), F.col("from_images").cast("string")))
    return spine.withColumn("issues", F.array_compact(F.array(differs("from_shards", "shards"), differs("from_statistics", "statistics"), ran)))


def remaining_images(images: DataFrame, log: DataFrame) -> DataFrame:
    """The images that the log does not have as completed."""
    return images.join(latest_status(log).where("status = 'completed'"), "image_id", "left_anti")


def remaining_patches(patches: DataFrame, done: DataFrame) -> DataFrame:
    return patches.join(done.select("image_id", "x", "y"), ["image_id", "x", "y"], "left_anti")


def failed_images(images: DataFrame, log: DataFrame) -> DataFrame:
    """The images to try again: those whose last status is failed."""
    return images.join(latest_status(log).where("status = 'failed'"), "image_id", "left_semi")


def summary(log: DataFrame) -> DataFrame:
    """(total, successful, skipped, failed) of a run's images; `legacy` failed also counts the skipped."""
    last = latest_status(log)
    n = lambda s: F.count_if(F.col("status") == s)
    return last.agg(F.count("*").alias("total"), n("completed").alias("successful"), n("skipped").alias("skipped"), n("failed").alias("failed"), (n("failed") + n("skipped")).alias("legacy_failed"))
