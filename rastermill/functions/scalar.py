"""Scalar expressions with the exact rounding that the tiling rules need."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Class names and codes of label rasters.
CLASS_IDS = {"background": 0, "fore": 1, "hydro": 2, "road": 3, "building": 4}
IGNORE = 255
#: Common names of imagery bands.
COMMON_NAMES = ("coastal", "blue", "green", "red", "rededge", "yellow", "pan", "nir", "nir08", "nir09", "cirrus", "swir16", "swir22", "lwir", "lwir11", "lwir12")
BAND_NAMES = {"1": "red", "2": "green", "3": "blue", "4": "nir", "R": "red", "G": "green", "B": "blue", "N": "nir"}


def floor_div(x: Column, d: Column) -> Column:
    """Floor division of doubles as by fmod: not floor(x / d), which can be one too large or small."""
    x, d = x.cast("double"), d.cast("double")
    return F.floor((x - x % d) / d + F.lit(0.5)).cast("int")


def cell_bound(g: Column, size: Column, grid: int) -> Column:
    """First pixel of grid line g: the cell size is divided first, then multiplied and cut, at most size."""
    return F.least(g * (size.cast("double") / F.lit(float(grid))), size.cast("double")).cast("int")


def stem(path: Column) -> Column:
    """File name without folders and its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def label_type(path: Column) -> Column:
    """raster, vector or null, by the suffix (case counts)."""
    return F.when(path.rlike(r"\.tiff?$"), "raster").when(path.rlike(r"\.(geojson|gpkg)$"), "vector")


def patch_key(prefix: Column, image: Column, x: Column, y: Column) -> Column:
    return F.concat_ws("_", prefix, image, x.cast("string"), y.cast("string"))


def shard_path(prefix: Column, split: Column, shard_id: Column) -> Column:
    return F.format_string("%s-%s-%06d.tar", prefix, split, shard_id.cast("int"))


def erosion_distance(pixel_size: Column, target_gap: float | None = None, max_gsd: float = 1.0) -> Column:
    """Metres to shrink a footprint by: none for coarse pixels, half the wanted gap, else a pixel up to 0.6."""
    by = F.lit(target_gap / 2.0) if target_gap is not None else F.least(pixel_size, F.lit(0.6))
    return F.when(pixel_size > max_gsd, F.lit(0.0)).otherwise(by)


def common_name(band: Column) -> Column:
    """Common name of a band given as number, letter or name; null if unknown."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(BAND_NAMES.items())])
    low = F.lower(band)
    return F.coalesce(F.try_element_at(table, F.upper(band)), F.when(low.isin(*COMMON_NAMES), low))


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two rectangles, in percent; 0 if both are empty."""
    w = F.greatest(F.least(a["maxx"], b["maxx"]) - F.greatest(a["minx"], b["minx"]), F.lit(0.0))
    h = F.greatest(F.least(a["maxy"], b["maxy"]) - F.greatest(a["miny"], b["miny"]), F.lit(0.0))
    area = lambda r: (r["maxx"] - r["minx"]) * (r["maxy"] - r["miny"])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, F.lit(100.0) * (w * h) / union).otherwise(F.lit(0.0))


def epsg_tag(srid: Column) -> Column:
    return F.concat(F.lit("urn:ogc:def:crs:EPSG::"), srid.cast("string"))


def snap(x: Column, grid: float = 0.01) -> Column:
    """x on the nearest multiple of grid."""
    return F.round(F.round(x / F.lit(grid)) * F.lit(grid), 9)


def drifts(train_share: Column, target: float = 0.8, threshold: float = 0.03) -> Column:
    return F.abs(train_share - F.lit(target)) > F.lit(threshold)
