"""Class shares of images and grid cells, and band statistics kept as partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import CLASS_IDS
from .windows import grid_cells

PRESENT = 0.01
#: Images whose grid lines are broadcast; a row has two arrays of grid size.
BROADCAST_IMAGES = 20_000


def _named(class_ids: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted((v, k) for k, v in class_ids.items()) for x in pair])


def _spine(keys: DataFrame, class_ids: dict[str, int]) -> DataFrame:
    return keys.withColumn("class_name", F.explode(F.array(*[F.lit(k) for k in class_ids])))


def image_distribution(labels: DataFrame, class_ids: dict[str, int] = CLASS_IDS) -> DataFrame:
    """(image_id, class_name, share): shares among the pixels whose code is listed; all 0 if there is none."""
    counts = labels.groupBy("image_id", "class_id").agg(F.count("*").alias("n"))
    named = counts.withColumn("class_name", F.try_element_at(_named(class_ids), F.col("class_id").cast("int")))
    total = named.where("class_name IS NOT NULL").groupBy("image_id").agg(F.sum("n").alias("total"))
    every = _spine(named.select("image_id").distinct(), class_ids).join(total, "image_id", "left").join(named.drop("class_id"), ["image_id", "class_name"], "left")
    return every.select("image_id", "class_name", F.coalesce(F.col("n") / F.col("total"), F.lit(0.0)).alias("share"))


def cell_counts(labels: DataFrame, images: DataFrame, grid: int) -> DataFrame:
    """(image_id, gx, gy, class_id, n): pixels by cell bounds; pixels outside all bounds are left out.

    Bounds are cut to whole pixels, so the cell of a column is found by comparing it with the grid's lines. The lines of
    the images come to the pixels by a broadcast while there are few images (BROADCAST_IMAGES), so that each task counts its
    own pixels and only counts are shuffled.
    """
    axis = F.sequence(F.lit(0), F.lit(grid - 1))
    size = images.select("image_id", "width", "height")

    def lines(name: str) -> Column:
        return F.transform(axis, lambda g: F.least((g + 1) * (F.col(name).cast("double") / F.lit(float(grid))), F.col(name).cast("double")).cast("int"))

    size = size.withColumn("lx", lines("width")).withColumn("ly", lines("height")).drop("width", "height")
    few = size.limit(BROADCAST_IMAGES + 1).count() <= BROADCAST_IMAGES
    marked = labels.join(F.broadcast(size) if few else size, "image_id")
    cell = lambda at, name: F.size(F.filter(F.col(name), lambda b: b <= F.col(at)))
    out = marked.withColumn("gx", cell("x", "lx")).withColumn("gy", cell("y", "ly")).where((F.col("gx") < grid) & (F.col("gy") < grid))
    return out.groupBy("image_id", "gx", "gy", "class_id").agg(F.count("*").alias("n"))


def cell_distribution(labels: DataFrame, images: DataFrame, grid: int, class_ids: dict[str, int] = CLASS_IDS) -> DataFrame:
    """(image_id, gx, gy, cell_id, class_name, share, pixel_count): shares among all pixels of the cell."""
    counts = cell_counts(labels, images, grid)
    total = counts.groupBy("image_id", "gx", "gy").agg(F.sum("n").alias("pixel_count"))
    named = counts.withColumn("class_name", F.try_element_at(_named(class_ids), F.col("class_id").cast("int"))).drop("class_id").where("class_name IS NOT NULL")
    spine = _spine(grid_cells(images, grid).select("image_id", "gx", "gy", "cell_id"), class_ids)
    out = spine.join(total, ["image_id", "gx", "gy"], "left").join(named, ["image_id", "gx", "gy", "class_name"], "left")
    return out.select("image_id", "gx", "gy", "cell_id", "class_name", F.coalesce(F.col("n") / F.col("pixel_count"), F.lit(0.0)).alias("share"), F.coalesce("pixel_count", F.lit(0)).cast("long").alias("pixel_count"))


def target_distribution(shares: DataFrame) -> DataFrame:
    """(class_name, share): the mean of the images' shares, each image counting once."""
    return shares.groupBy("class_name").agg(F.avg("share").alias("share"))


def present_classes(cells: DataFrame, least: float = PRESENT) -> DataFrame:
    """(image_id, cell_id, classes): sorted names of the classes above the bound."""
    found = F.sort_array(F.collect_set(F.when(F.col("share") > least, F.col("class_name"))))
    return cells.groupBy("image_id", "cell_id").agg(found.alias("classes"))


def band_partials(window_band_sums: DataFrame, patch: tuple[int, int], fill: float = 0.0) -> DataFrame:
    """(prefix, band, n, s, ss, patches) from (prefix, band, x, y, s, ss, n) of each kept training window.

    Padding counts as `fill` in every window, so the pixel number is that of the whole window.
    """
    size = patch[0] * patch[1]
    gap = F.lit(size) - F.col("n")
    by = window_band_sums.withColumn("s", F.col("s") + gap * fill).withColumn("ss", F.col("ss") + gap * (fill * fill))
    return by.groupBy("prefix", "band").agg(F.sum(F.lit(size)).alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.count("*").alias("patches"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """The partial sums of several runs as one."""
    return partials.groupBy("prefix", "band").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "patches")])


def finalize(partials: DataFrame) -> DataFrame:
    """(prefix, band, mean, std, n, patches) of merged partial sums; population deviation."""
    mean = F.col("s") / F.col("n")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("ss") / F.col("n") - mean * mean))
    return partials.where("n > 0").select("prefix", "band", mean.alias("mean"), std.alias("std"), "n", "patches")
