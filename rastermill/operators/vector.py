"""Vector features as rectangles in pixel units: class values, overlay, window join, clipping, erosion, splats.

General polygons go through rastermill.operators.targets; what is a rectangle stays in built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import snap

MIN_WIDTH = 1.5


def resolve_field(wanted: list[str] | str, columns: list[str]) -> str:
    """The one wanted attribute that the layer has."""
    wanted = [wanted] if isinstance(wanted, str) else wanted
    found = [c for c in columns if c in set(wanted)]
    if len(found) != 1:
        raise ValueError(f"attribute field must be one of {wanted}; the layer has {found or 'none of them'}")
    return found[0]


def burn_values(features: DataFrame, field: str, values: list, continuous: bool = True) -> DataFrame:
    """features with burn_val: the place of the attribute's value in `values`, counted from 1; others are dropped."""
    spark = features.sparkSession
    rows = [(str(v), i + 1 if continuous else int(v)) for i, v in enumerate(values)]
    table = spark.createDataFrame(rows, "_value string, burn_val int")
    return features.join(F.broadcast(table), F.col(field).cast("string") == F.col("_value")).drop("_value")


def rect_pixels(features: DataFrame, images: DataFrame) -> DataFrame:
    """features exploded to the pixels (x, y) whose centre lies in the rectangle and the image."""
    half = F.lit(0.5)
    x0, x1 = F.ceil(F.col("minx") - half), F.floor(F.col("maxx") - half)
    y0, y1 = F.ceil(F.col("miny") - half), F.floor(F.col("maxy") - half)
    at = features.join(images.select("image_id", "width", "height"), "image_id")
    at = at.withColumns({"_x0": F.greatest(x0, F.lit(0)), "_x1": F.least(x1, F.col("width") - 1), "_y0": F.greatest(y0, F.lit(0)), "_y1": F.least(y1, F.col("height") - 1)})
    at = at.where("_x0 <= _x1 AND _y0 <= _y1")
    xs = at.withColumn("x", F.explode(F.sequence(F.col("_x0").cast("long"), F.col("_x1").cast("long"))))
    return xs.withColumn("y", F.explode(F.sequence(F.col("_y0").cast("long"), F.col("_y1").cast("long")))).drop("_x0", "_x1", "_y0", "_y1", "width", "height")


def overlay(features: DataFrame, images: DataFrame) -> DataFrame:
    """(image_id, x, y, class_id) of burned pixels; ascending burn values with the last on top is their maximum."""
    return rect_pixels(features, images).groupBy("image_id", "x", "y").agg(F.max("burn_val").alias("class_id"))


def window_features(features: DataFrame, images: DataFrame, patch: tuple[int, int], stride: int) -> DataFrame:
    """(features' columns, x, y) of each window a rectangle meets; touching counts.

    Every rectangle is exploded to the windows that its bounds reach, a number that depends on its own size only, so
    there is no join of windows and features.
    """

    def reach(lo: str, hi: str, size: int, limit: str) -> Column:
        first = F.greatest(F.ceil((F.col(lo) - size) / F.lit(stride)), F.lit(0)).cast("long")
        last = F.least(F.floor(F.col(hi) / F.lit(stride)), F.ceil(F.col(limit) / F.lit(stride)) - 1).cast("long")
        places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.explode(F.transform(places, lambda i: i * stride))

    at = features.join(images.select("image_id", "width", "height"), "image_id")
    xs = at.withColumn("x", reach("minx", "maxx", patch[1], "width"))
    return xs.withColumn("y", reach("miny", "maxy", patch[0], "height")).drop("width", "height")


def clip_to_window(joined: DataFrame, patch: tuple[int, int], grid: float = 0.01) -> DataFrame:
    """The rectangles of window_features cut to their window, snapped; is_truncated says whether any part was cut off."""
    x1, y1 = F.col("x") + patch[1], F.col("y") + patch[0]
    cut = {"cminx": F.greatest("minx", "x"), "cminy": F.greatest("miny", "y"), "cmaxx": F.least(F.col("maxx"), x1), "cmaxy": F.least(F.col("maxy"), y1)}
    truncated = (F.col("minx") < F.col("x")) | (F.col("miny") < F.col("y")) | (F.col("maxx") > x1) | (F.col("maxy") > y1)
    out = joined.withColumn("is_truncated", truncated).withColumns(cut).where("cminx <= cmaxx AND cminy <= cmaxy")
    return out.withColumns({k: snap(F.col(k), grid) for k in cut})


def erode(features: DataFrame, distance: Column, eroded: Column, min_area: float = 4.0) -> DataFrame:
    """Rectangles shrunk by distance where `eroded` holds; those that would get too small stay as they are."""
    area = (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))
    w, h = F.col("maxx") - F.col("minx") - distance * 2, F.col("maxy") - F.col("miny") - distance * 2
    small = (w <= 0) | (h <= 0) | (w * h < min_area) | (F.least(w, h) < MIN_WIDTH) | (area < 3 * min_area)
    out = features.withColumn("_do", eroded & (distance > 0) & ~small).withColumn("_by", F.when(F.col("_do"), distance).otherwise(F.lit(0.0)))
    cut = {"minx": F.col("minx") + F.col("_by"), "miny": F.col("miny") + F.col("_by"), "maxx": F.col("maxx") - F.col("_by"), "maxy": F.col("maxy") - F.col("_by")}
    return out.withColumns(cut).withColumnRenamed("_do", "is_eroded").drop("_by")


def corners(features: DataFrame) -> DataFrame:
    """(image_id, feature_id, k, px, py): the four corners in ring order."""
    ring = F.array(*[F.struct(F.lit(k).alias("k"), F.col(x).alias("px"), F.col(y).alias("py")) for k, (x, y) in enumerate([("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy")])])
    return features.select("image_id", "feature_id", F.explode(ring).alias("c")).select("image_id", "feature_id", "c.*")


def edge_samples(features: DataFrame) -> DataFrame:
    """(image_id, px, py): points along each edge, both ends included, two for each pixel of length (at least the start)."""
    pts = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny")]
    edges = F.array(*[F.struct(F.col(a).alias("x0"), F.col(b).alias("y0"), F.col(c).alias("x1"), F.col(d).alias("y1")) for (a, b), (c, d) in zip(pts, pts[1:], strict=False)])
    edge = features.select("image_id", "feature_id", F.explode(edges).alias("e")).select("image_id", "e.*")
    n = F.greatest(F.floor(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * 2), F.lit(1)).cast("int")
    each = edge.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    t = F.when(F.col("n") > 1, F.col("k") / (F.col("n") - 1)).otherwise(F.lit(0.0))
    return each.select("image_id", (F.col("x0") + t * (F.col("x1") - F.col("x0"))).alias("px"), (F.col("y0") + t * (F.col("y1") - F.col("y0"))).alias("py"))


def splat(points: DataFrame, images: DataFrame, sigma: float, radius: int) -> DataFrame:
    """(image_id, x, y, weight): Gaussian splats of points summed and cut at 1.

    The stencil stands around the point's pixel, moved inside the image; the distance is to the point itself.
    """
    at = points.join(images.select("image_id", "width", "height"), "image_id")
    centre = lambda p, size: F.least(F.greatest(F.col(p).cast("long"), F.lit(radius)), F.col(size) - radius - 1)
    around = lambda p, size: F.explode(F.sequence(centre(p, size) - radius, centre(p, size) + radius))
    each = at.withColumn("x", around("px", "width")).withColumn("y", around("py", "height"))
    d2 = F.pow(F.col("x") - F.col("px"), F.lit(2.0)) + F.pow(F.col("y") - F.col("py"), F.lit(2.0))
    w = F.exp(-d2 / F.lit(2 * sigma * sigma))
    return each.groupBy("image_id", "x", "y").agg(F.least(F.sum(w), F.lit(1.0)).alias("weight"))


def properties_json(props: Column, dropped: tuple[str, ...] = ("geometry", "extent_geometry", "burn_val")) -> Column:
    """The attributes of a feature as compact JSON, without internal columns."""
    return F.to_json(F.map_filter(props, lambda k, v: ~k.isin(*dropped)))


def feature_collections(clipped: DataFrame, srid: int | None, props: Column) -> DataFrame:
    """(image_id, x, y, geojson): one FeatureCollection for each window, features in id order."""
    ring = F.array(*[F.array(F.col(a), F.col(b)) for a, b in [("cminx", "cminy"), ("cmaxx", "cminy"), ("cmaxx", "cmaxy"), ("cminx", "cmaxy"), ("cminx", "cminy")]])
    one = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    many = clipped.groupBy("image_id", "x", "y").agg(F.sort_array(F.collect_list(F.struct(F.col("feature_id").alias("id"), one.alias("f")))).alias("fs"))
    parts = [F.lit("FeatureCollection").alias("type"), F.transform("fs", lambda s: s["f"]).alias("features")]
    if srid:
        parts.append(F.struct(F.lit("name").alias("type"), F.struct(F.lit(f"urn:ogc:def:crs:EPSG::{srid}").alias("name")).alias("properties")).alias("crs"))
    return many.select("image_id", "x", "y", F.to_json(F.struct(*parts)).alias("geojson"))
