"""Validation, overlap and clipping of image-label pairs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import iou


def pair_status() -> Column:
    """struct(valid, special_case, reason) from img_w, img_h, lab_w, lab_h, img_srid, lab_srid, label_type and label_ok.

    label_ok is the vector layer's check (some features, all valid); rasters are checked by their size. A raster pair
    without georeference is valid as a special case if both have one size.
    """
    image_ok = (F.col("img_w") > 0) & (F.col("img_h") > 0)
    raster_ok = (F.col("lab_w") > 0) & (F.col("lab_h") > 0)
    vector = F.col("label_type") == "vector"
    referenced = F.col("img_srid").isNotNull() & F.col("lab_srid").isNotNull()
    aligned = (F.col("img_w") == F.col("lab_w")) & (F.col("img_h") == F.col("lab_h"))

    def status(valid: bool, special: bool, reason: str) -> Column:
        return F.struct(F.lit(valid).alias("valid"), F.lit(special).alias("special_case"), F.lit(reason).alias("reason"))

    return (
        F.when(~image_ok, status(False, False, "invalid image"))
        .when(vector & ~F.col("label_ok"), status(False, False, "invalid label"))
        .when(vector & ~referenced, status(False, False, "no georeference for vector label or image"))
        .when(vector, status(True, False, "valid"))
        .when(~raster_ok, status(False, False, "invalid label"))
        .when(~referenced & aligned, status(True, True, "not georeferenced but aligned"))
        .when(~referenced, status(False, False, "no georeference and not aligned"))
        .otherwise(status(True, False, "valid"))
    )


def _box(prefix: str) -> dict[str, Column]:
    return {k: F.col(prefix + k) for k in ("minx", "miny", "maxx", "maxy")}


def overlaps(pairs: DataFrame, image: str = "i", label: str = "l") -> DataFrame:
    """pairs with iou (percent) and the common rectangle ominx ... omaxy, null where they do not meet."""
    a, b = _box(image), _box(label)
    low = {k: F.greatest(a[k], b[k]) for k in ("minx", "miny")}
    high = {k: F.least(a[k], b[k]) for k in ("maxx", "maxy")}
    meets = (low["minx"] <= high["maxx"]) & (low["miny"] <= high["maxy"])
    return pairs.withColumns({"iou": iou(a, b)} | {f"o{k}": F.when(meets, v) for k, v in (low | high).items()})


def clip_window(a: Column, c: Column, e: Column, f: Column, width: Column, height: Column, box: dict[str, Column]) -> dict[str, Column]:
    """Pixel window (col_off, row_off, width, height) of a map rectangle in a north-up raster, cut to it."""
    col0 = F.greatest(F.floor((box["minx"] - c) / a + 1e-9), F.lit(0))
    row0 = F.greatest(F.floor((box["maxy"] - f) / e + 1e-9), F.lit(0))
    col1 = F.least(F.ceil((box["maxx"] - c) / a - 1e-9), width)
    row1 = F.least(F.ceil((box["miny"] - f) / e - 1e-9), height)
    return {"col_off": col0.cast("long"), "row_off": row0.cast("long"), "w": F.greatest(col1 - col0, F.lit(0)).cast("long"), "h": F.greatest(row1 - row0, F.lit(0)).cast("long")}


def pixel_x(x: Column, a: Column, c: Column) -> Column:
    return (x - c) / a


def pixel_y(y: Column, e: Column, f: Column) -> Column:
    return (y - f) / e


#: Radius of the sphere of EPSG:3857.
_R = 6378137.0


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 degrees to EPSG:3857 metres."""
    return F.radians(lon) * _R, F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * _R


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres to EPSG:4326 degrees."""
    return F.degrees(x / _R), F.degrees(F.atan(F.exp(y / _R)) * 2 - F.lit(1.5707963267948966))
