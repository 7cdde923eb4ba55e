"""Sampling for reports."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def stratified_sample(patches: DataFrame, images_per_split: int = 3, samples_per_split: int = 3) -> DataFrame:
    """Up to samples_per_split patches of each split, spread evenly over its first images; first images get the rest."""
    images = patches.select("split", "image_id").distinct()
    rank = F.row_number().over(Window.partitionBy("split").orderBy("image_id"))
    chosen = images.withColumn("i", rank).where(F.col("i") <= images_per_split)
    chosen = chosen.withColumn("m", F.count("*").over(Window.partitionBy("split")))
    quota = F.greatest(F.floor(F.lit(samples_per_split) / F.col("m")), F.lit(1)) + F.when(F.col("i") <= F.lit(samples_per_split) % F.col("m"), 1).otherwise(0)
    joined = patches.join(F.broadcast(chosen.select("split", "image_id", quota.alias("quota"))), ["split", "image_id"])  # a few rows
    order = Window.partitionBy("split", "image_id").orderBy("x", "y", "size_bytes", "shard_id")
    return joined.withColumn("k", F.row_number().over(order)).where("k <= quota").drop("k", "quota")


def spread_shards(n: int, most: int) -> list[int]:
    """Up to `most` evenly spaced of n shard numbers."""
    return list(range(n)) if n <= most else [int(x) for x in np.linspace(0, n - 1, most)]


def random_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows chosen by a seed (a report, so a limit is the feature)."""
    return df.orderBy(F.rand(seed)).limit(n)


def patch_gallery(spark: SparkSession, shard_paths: list[str], n: int, most_shards: int = 3, seed: int = 0) -> bytes:
    """A PNG of n patches chosen by a seed from up to most_shards evenly spaced shards."""
    from ..sources.png import displayed, gallery, png
    from ..sources.shards import from_npy, read_shards

    chosen = [shard_paths[k] for k in spread_shards(len(shard_paths), most_shards)]
    rows = random_rows(read_shards(spark, chosen).select("patch_id", F.col("members")["image_patch.npy"].alias("image")), n, seed).collect()
    return png(gallery([displayed(from_npy(r["image"])) for r in sorted(rows, key=lambda r: r["patch_id"])]))


def validation_report(cells: DataFrame, chosen: DataFrame, target: DataFrame) -> str:
    """Text of an image's chosen cells: their number, mean class shares against the target, and the cells' rectangles."""
    picked = cells.join(chosen.select("image_id", "cell_id"), ["image_id", "cell_id"])
    rows = picked.groupBy("class_name").agg(F.avg("share").alias("share")).join(target.withColumnRenamed("share", "goal"), "class_name").orderBy("class_name").collect()
    n = chosen.select("image_id", "cell_id").distinct().count()
    return "\n".join([f"validation cells: {n}", *[f"{r['class_name']}: {r['share']:.4f} (target {r['goal']:.4f})" for r in rows]])
