"""A dataset that grows with a folder of pair files.

Each line of a JSON file is one pair {"image", "label", "metadata"}. Every micro-batch runs the tiling plan over its new
pairs; the stream's checkpoint names the files seen, and images that the state has as completed are left out, so a
batch that runs twice adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.tiler import Tiler

PAIR_SCHEMA = "image string, label string, metadata map<string,string>"


def pair_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(PAIR_SCHEMA).json(folder)


def grow(spark: SparkSession, folder: str, checkpoint: str, patch_size: tuple[int, int], **settings) -> StreamingQuery:
    """Process all pair files that are there now and were not before, then stop."""

    def batch(df: DataFrame, number: int) -> None:
        rows = df.dropDuplicates(["image"]).collect()  # paths of a micro-batch's pairs, no pixels
        pairs = [{"image": r["image"], "label": r["label"], "metadata": r["metadata"] or {}} for r in rows]
        if pairs:
            Tiler(spark, pairs, patch_size, **settings).create_tiles()

    return pair_stream(spark, folder).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
