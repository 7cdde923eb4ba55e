"""Supervision rasters of building and road polygons.

Polygons come as (image_id, feature_id, rings): rings of (x, y) pixel coordinates. Targets of bounded reach are made
by tile: each polygon goes to the tiles it can affect, so a large image is many tasks. The signed distance is not bounded and
is made by image, whose mask must fit a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels

TILE = 256
MAX_DISTANCE_M = 10.0
SIGMA = 3.0


def rect_rings(features: DataFrame) -> DataFrame:
    """Rectangles (minx ... maxy) as polygons."""
    pt = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    ring = F.array(pt("minx", "miny"), pt("maxx", "miny"), pt("maxx", "maxy"), pt("minx", "maxy"), pt("minx", "miny"))
    return features.withColumn("rings", F.array(ring))


def pixel_rings(features: DataFrame) -> DataFrame:
    """Rings in map units to pixel units by the image's affine a, c, e, f."""
    return features.withColumn("rings", F.transform("rings", lambda r: F.transform(r, lambda p: F.array((p[0] - F.col("c")) / F.col("a"), (p[1] - F.col("f")) / F.col("e")))))


def _rings(value) -> kernels.Polygon:
    return [np.array([np.asarray(p, float) for p in ring]).reshape(-1, 2) for ring in value]


def with_tiles(polygons: DataFrame, images: DataFrame, halo: int, tile: int = TILE) -> DataFrame:
    """polygons exploded to the tiles (tx, ty) that lie within halo pixels of their bounds; width and height are added."""
    at = polygons.join(images.select("image_id", "width", "height"), "image_id")
    lo = lambda k: F.array_min(F.transform(F.col("rings")[0], lambda p: p[k])) - halo
    hi = lambda k: F.array_max(F.transform(F.col("rings")[0], lambda p: p[k])) + halo

    def axis(k: int, size: str):
        first = F.greatest(F.floor(lo(k) / F.lit(tile)), F.lit(0))
        last = F.least(F.floor(hi(k) / F.lit(tile)), F.floor((F.col(size) - 1) / F.lit(tile)))
        return F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")))

    return at.withColumn("tx", axis(0, "width")).withColumn("ty", axis(1, "height"))


TILE_SCHEMA = "image_id long, role string, row_off long, col_off long, h int, w int, dtype string, data binary"


def dual_distance(polygons: DataFrame, images: DataFrame, reach: float, sigma: float = SIGMA, tile: int = TILE) -> DataFrame:
    """Raster tiles (role edt) of exp(-(d1 + d2) / sigma) as float64."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        image, tx, ty = key
        x0, y0 = int(tx) * tile, int(ty) * tile
        w, h = min(tile, int(frame["width"].iloc[0]) - x0), min(tile, int(frame["height"].iloc[0]) - y0)
        ordered = frame.sort_values("feature_id")
        near, second = kernels.two_nearest([_rings(r) for r in ordered["rings"]], w, h, reach, x0, y0, (int(frame["width"].iloc[0]), int(frame["height"].iloc[0])))
        data = kernels.dual_weight(near, second, reach, sigma)
        return pd.DataFrame([(image, "edt", y0, x0, h, w, "float64", data.tobytes())], columns=_COLUMNS)

    return with_tiles(polygons, images, int(reach) + 1, tile).groupBy("image_id", "tx", "ty").applyInPandas(run, TILE_SCHEMA)


_COLUMNS = ["image_id", "role", "row_off", "col_off", "h", "w", "dtype", "data"]


def by_image(polygons: DataFrame, images: DataFrame, role: str) -> DataFrame:
    """One raster for each image with polygons: role sdf, roads, boundary, vertices or burned."""
    made = {
        "sdf": lambda p, v, w, h: kernels.signed_distance(kernels.union_mask(p, w, h)),
        "roads_centerline_weight": lambda p, v, w, h: kernels.road_weight(p, w, h),
        "boundary": lambda p, v, w, h: kernels.boundary_map(p, w, h),
        "vertices": lambda p, v, w, h: kernels.vertex_map(p, w, h),
        "burned": lambda p, v, w, h: kernels.rasterize(p, v, w, h).astype(float),
    }[role]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("feature_id")
        w, h = int(frame["width"].iloc[0]), int(frame["height"].iloc[0])
        values = ordered["burn_val"].tolist() if "burn_val" in ordered else [1] * len(ordered)
        data = made([_rings(r) for r in ordered["rings"]], values, w, h)
        return pd.DataFrame([(key[0], role, 0, 0, h, w, "float64", np.ascontiguousarray(data).tobytes())], columns=_COLUMNS)

    return polygons.join(images.select("image_id", "width", "height"), "image_id").groupBy("image_id").applyInPandas(run, TILE_SCHEMA)


def stored_bytes(tiles: DataFrame) -> DataFrame:
    """Tiles as they are stored: uint8 of 0 to 255, but float32 for sdf."""

    def run(frames):
        for frame in frames:
            kinds, datas = [], []
            for role, data in zip(frame["role"], frame["data"], strict=True):
                x = np.frombuffer(data, np.float64)
                kinds.append("float32" if role == "sdf" else "uint8")
                datas.append((x.astype(np.float32) if role == "sdf" else kernels.to_byte(x)).tobytes())
            yield frame.assign(dtype=kinds, data=datas)

    return tiles.mapInPandas(run, TILE_SCHEMA)


def tile_pixels(tiles: DataFrame, zeros: bool = False) -> DataFrame:
    """(image_id, role, x, y, value) of float64 tiles; zeros are left out unless asked for."""

    def run(frames):
        for frame in frames:
            for r in frame.itertuples():
                x = np.frombuffer(r.data, np.float64).reshape(r.h, r.w)
                ys, xs = np.nonzero(np.ones_like(x) if zeros else x)
                yield pd.DataFrame({"image_id": r.image_id, "role": r.role, "x": xs + r.col_off, "y": ys + r.row_off, "value": x[ys, xs]})

    return tiles.mapInPandas(run, "image_id long, role string, x long, y long, value double")


def building_targets(polygons: DataFrame, images: DataFrame, pixel_size: float) -> DataFrame:
    """All building rasters, as stored; the distance's reach is MAX_DISTANCE_M in pixels."""
    out = dual_distance(polygons, images, MAX_DISTANCE_M / abs(pixel_size))
    for role in ("boundary", "vertices", "sdf"):
        out = out.unionByName(by_image(polygons, images, role))
    return stored_bytes(out)


def road_targets(polygons: DataFrame, images: DataFrame, pixel_size: float, max_gsd: float = 1.0) -> DataFrame:
    """The road raster, as stored; none for pixels coarser than max_gsd."""
    return stored_bytes(by_image(polygons.where(F.lit(abs(pixel_size)) <= F.lit(max_gsd)), images, "roads_centerline_weight"))
