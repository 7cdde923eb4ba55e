"""Band selection and stacking of exploded pixels and of band arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(pixels: DataFrame, indices: list[int]) -> DataFrame:
    """The bands of `indices` (from 1, in their order) renumbered from 1; a repeated index repeats the band."""
    order = F.array(*[F.lit(i) for i in indices])
    places = F.filter(F.transform(order, lambda b, k: F.when(b == F.col("band"), (k + 1).cast("int"))), lambda p: p.isNotNull())
    return pixels.where(F.col("band").isin(indices)).withColumn("band", F.explode(places))


def project_array(bands: Column, indices: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(i) for i in indices]), lambda i: F.element_at(bands, i))


def stack(single: list[DataFrame]) -> DataFrame:
    """Single-band pixels (image_id, x, y, v) as bands 1, 2, ... of one raster."""
    return reduce(DataFrame.unionByName, [df.withColumn("band", F.lit(k)) for k, df in enumerate(single, 1)])
