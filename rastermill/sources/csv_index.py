"""The headerless `image;label[;targets...][;vector]` index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def index_line(image: Column, label: Column, target_paths: Column, vector: Column) -> Column:
    """One line; null vector and empty targets are left out."""
    return F.concat_ws(";", image, label, target_paths, vector)


def read_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line's parts) image, label, targets and vector of ragged lines; a last .geojson is the vector."""
    parts = F.split("value", ";")
    rest = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    is_vector = F.endswith(F.element_at(parts, -1), F.lit(".geojson")) & (F.size(parts) > 2)
    count = F.size(rest) - is_vector.cast("int")
    return spark.read.text(path).select(parts[0].alias("image"), parts[1].alias("label"), F.slice(rest, F.lit(1), count).alias("targets"), F.when(is_vector, F.element_at(parts, -1)).alias("vector"))
