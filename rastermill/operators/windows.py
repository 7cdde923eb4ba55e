"""Sliding windows, grid cells and label coverage.

Coverage counts pixels once into cells of gcd(patch, stride) pixels (a partial aggregate, so little is shuffled) and
explodes only these counts to the windows that hold them, never single pixels.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cell_bound, floor_div


def windows(images: DataFrame, patch: tuple[int, int], stride: int) -> DataFrame:
    """(image_id, x, y, w, h) of every window of images (image_id, width, height), also those that overhang."""
    full = images.where("width > 0 AND height > 0")
    ys = full.select("image_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.lit(stride))).alias("y"))
    xs = ys.select("image_id", F.explode(F.sequence(F.lit(0), F.col("width") - 1, F.lit(stride))).alias("x"), "y")
    return xs.select("image_id", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.lit(patch[1]).alias("w"), F.lit(patch[0]).alias("h"))


def patch_count(width: Column, height: Column, stride: int) -> Column:
    """Number of windows, later discarded ones included."""
    return (F.ceil(width / F.lit(stride)) * F.ceil(height / F.lit(stride))).cast("long")


def grid_cells(images: DataFrame, grid: int) -> DataFrame:
    """(image_id, gx, gy, cell_id, minx, miny, maxx, maxy) of the grid over each image."""
    axis = F.sequence(F.lit(0), F.lit(grid - 1))
    cells = images.select("*", F.explode(axis).alias("gx")).select("*", F.explode(axis).alias("gy"))
    bound = lambda g, size: cell_bound(F.col(g[0]) + g[1], F.col(size), grid)
    return cells.select(
        "image_id", "gx", "gy", F.concat_ws("_", "gx", "gy").alias("cell_id"),
        bound(("gx", 0), "width").alias("minx"), bound(("gy", 0), "height").alias("miny"),
        bound(("gx", 1), "width").alias("maxx"), bound(("gy", 1), "height").alias("maxy"),
    )


def with_cell(wins: DataFrame, images: DataFrame, grid: int) -> DataFrame:
    """wins with gx, gy and cell_id of each window's top left pixel; images is small and joined by image_id."""
    of = lambda at, size: floor_div(F.col(at), F.col(size).cast("double") / F.lit(float(grid)))
    out = wins.join(images.select("image_id", "width", "height"), "image_id")
    out = out.withColumn("gx", of("x", "width")).withColumn("gy", of("y", "height")).drop("width", "height")
    return out.withColumn("cell_id", F.concat_ws("_", "gx", "gy"))


def tiles_of(lo: Column, hi: Column, patch: int, stride: int) -> Column:
    """Indexes of the windows that hold the whole pixel range [lo, hi]."""
    first = F.greatest(F.ceil((hi + 1 - patch) / F.lit(stride)), F.lit(0)).cast("long")
    last = F.floor(lo / F.lit(stride)).cast("long")
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def window_sums(pixels: DataFrame, keys: list[str], sums: dict[str, Column], patch: tuple[int, int], stride: int) -> DataFrame:
    """Sums over the pixels of each window that has any; pixels has the keys, x and y."""
    gy, gx = gcd(patch[0], stride), gcd(patch[1], stride)
    cell = pixels.groupBy(*keys, F.floor(F.col("x") / gx).alias("cx"), F.floor(F.col("y") / gy).alias("cy")).agg(*[v.alias(k) for k, v in sums.items()])
    xs = F.explode(tiles_of(F.col("cx") * gx, F.col("cx") * gx + gx - 1, patch[1], stride))
    ys = F.explode(tiles_of(F.col("cy") * gy, F.col("cy") * gy + gy - 1, patch[0], stride))
    each = cell.select(*keys, "cy", *sums, xs.alias("i")).select(*keys, "i", *sums, ys.alias("j"))
    by = each.groupBy(*keys, (F.col("i") * stride).alias("x"), (F.col("j") * stride).alias("y"))
    return by.agg(*[F.sum(k).alias(k) for k in sums])


def coverage(labels: DataFrame, images: DataFrame, patch: tuple[int, int], stride: int) -> DataFrame:
    """(image_id, x, y, n_labelled) of every window of the images; background is 0 and 255 counts as labelled."""
    counts = window_sums(labels.where("class_id <> 0"), ["image_id"], {"n_labelled": F.count("*")}, patch, stride)
    spine = windows(images, patch, stride).select("image_id", "x", "y")
    return spine.join(counts, ["image_id", "x", "y"], "left").withColumn("n_labelled", F.coalesce("n_labelled", F.lit(0)))


def kept(covered: DataFrame, patch: tuple[int, int], discard_empty: bool = True, threshold: float | None = 0.01, label_bands: int = 1) -> DataFrame:
    """The windows that pass the patch filter; padding counts in the share, equal is kept."""
    size = patch[0] * patch[1] * label_bands
    out = covered.withColumn("share", F.col("n_labelled") / F.lit(float(size))) if size else covered.limit(0).withColumn("share", F.lit(0.0))
    if discard_empty:
        out = out.where("n_labelled > 0")
    return out if threshold is None else out.where(F.col("share") >= threshold)


def masked_labels(bands: DataFrame, labels: DataFrame, nodata: float | None, ignore: int = 255) -> DataFrame:
    """labels with `ignore` where all bands of the image equal nodata; without nodata they stay."""
    if nodata is None:
        return labels
    void = bands.groupBy("image_id", "x", "y").agg(F.bool_and(F.col("v") == nodata).alias("void")).where("void")
    out = labels.join(void, ["image_id", "x", "y"], "left")
    return out.withColumn("class_id", F.when(F.col("void"), F.lit(ignore)).otherwise(F.col("class_id"))).drop("void")


def valid_pixels(bands: DataFrame, nodata: float) -> DataFrame:
    """(image_id, x, y) of the pixels with data in any band."""
    return bands.groupBy("image_id", "x", "y").agg(F.bool_or(F.col("v") != nodata).alias("ok")).where("ok").drop("ok")


def padded(pixels: DataFrame, width: Column, height: Column, extent: tuple[int, int] | None = None) -> DataFrame:
    """Patches (key, x, y, v) padded to width x height by repeating their edge: each pixel of the edge goes to the places outside that clamp to it.

    The edge is that of extent (width, height), where the patches' size is known: a pixel that a patch lacks is then
    nowhere in the result. Without extent it is the last pixel that a patch has. Exploded places are never joined: Spark
    sizes them as the rows before the explode and would broadcast them all.
    """
    if extent:
        at = pixels.select("key", "x", "y", "v", F.lit(extent[0]).alias("pw"), F.lit(extent[1]).alias("ph"))
    else:
        dims = pixels.groupBy("key").agg((F.max("x") + 1).alias("pw"), (F.max("y") + 1).alias("ph"))
        at = pixels.join(dims, "key").select("key", "x", "y", "v", "pw", "ph")
    at = at.where("key IS NOT NULL AND x >= 0 AND x < pw AND y >= 0 AND y < ph")
    to = lambda c, end, size: F.explode(F.sequence(F.col(c).cast("int"), F.when(F.col(c) == F.col(end) - 1, F.greatest(size, F.col(end)) - 1).otherwise(F.col(c)).cast("int")))
    xs = at.select("key", "y", "v", "pw", "ph", to("x", "pw", width).alias("x"))
    return xs.select("key", "x", to("y", "ph", height).alias("y"), "v")
