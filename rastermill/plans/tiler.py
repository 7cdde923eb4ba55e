"""From image-label pairs to training patches.

Two phases. The first reads headers, validates, clips and rasterizes labels, and counts classes; what reaches the
driver is a row for each image. The second deals the kept windows (narrow rows) to shards and each task reads its windows
straight from the files, so no pixel is ever shuffled.
"""

from __future__ import annotations

import io
import json
import tarfile
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.scalar import CLASS_IDS, IGNORE
from ..operators import analysis, manifest, split, validate, windows
from ..sources import geotiff, vectors
from ..sources.files import attempt_name, file_key, read_bytes, resolve, retry, write_bytes
from ..sources.shards import estimated_size, json_length, npy
from .state import State

HEADERS = "image_id string, path string, width int, height int, bands int, dtype string, nodata double, srid int, transform array<double>, error string"


@dataclass
class Settings:
    """Everything a run depends on but its inputs."""

    patch_size: tuple[int, int]
    stride: int | None = None
    bands_requested: list[str] = field(default_factory=lambda: ["red", "green", "blue", "nir"])
    band_indices: list[int] | None = None
    grid_size: int = 16
    val_ratio: float = 0.1
    class_balance_weight: float = 0.5
    spatial_weight: float = 0.5
    attr_field: list[str] | str | None = None
    attr_values: list | None = None
    erosion_classes: list[str] | None = None
    target_gap_m: float | None = None
    max_gsd_for_erosion: float = 1.0
    min_erosion_area_m2: float = 4.0
    building_class_val: int | None = None
    road_class_val: int | None = None
    class_ids: dict[str, int] = field(default_factory=lambda: dict(CLASS_IDS))
    discard_empty: bool = True
    label_threshold: float | None = 0.01
    split: str = "trn"
    prefix: str = "sample"
    output_dir: str | None = None
    output_format: str = "tar"
    val_strategy: str = "spatial"
    val_seed: int | None = None
    shard_limit: int = manifest.SHARD_LIMIT
    shard_lanes: int = 1
    csv_compression: int = geotiff.DEFLATE

    def __post_init__(self) -> None:
        if self.output_format not in ("tar", "csv"):
            raise ValueError("output_format must be tar or csv")
        if self.val_strategy not in ("spatial", "random"):
            raise ValueError("val_strategy must be spatial or random")
        if not self.output_dir:
            raise ValueError("output_dir is needed")
        self.stride = self.stride or max(self.patch_size)
        self.split = self.split if self.split in ("trn", "tst") else "trn"


@lru_cache(maxsize=16)
def _opened(path: str, run: str) -> tuple[geotiff.Ranges, geotiff.Header]:
    """An open file; `run` names the job, so that a later job sees a file that has changed."""
    src = geotiff.Ranges(path)
    return src, geotiff.header(src)


@lru_cache(maxsize=8)
def _band_rows(path: str, run: str, first: int, last: int, bands: tuple[int, ...] | None) -> np.ndarray:
    src, h = _opened(path, run)
    return geotiff.read_rows(src, h, first, last, list(bands) if bands else None)


def read_window(path: str, run: str, x: int, y: int, w: int, h: int, fill: float, limit: tuple[int, int, int, int], bands: tuple[int, ...] | None = None) -> np.ndarray:
    """(bands, h, w) of a window within limit (col_off, row_off, width, height); what lies outside is `fill`.

    Rows are read in runs of the window's height, which the windows of one row share.
    """
    _, head = _opened(path, run)
    col0, row0, width, height = limit
    n = len(bands) if bands else head.count
    out = np.full((n, h, w), fill, head.dtype.newbyteorder("="))
    rows, cols = min(h, height - y), min(w, width - x)
    if rows > 0 and cols > 0:
        part = _band_rows(path, run, row0 + y, row0 + y + rows, bands)
        out[:, :rows, :cols] = part[:, :, col0 + x : col0 + x + cols]
    return out


def _stac_paths(path: str, wanted: list[str]) -> list[str] | None:
    """The single-band files of a STAC item in the wanted order; null if path is no item."""
    remote = path.startswith(("http://", "https://"))
    if not path.endswith(".json") and (not remote or path.lower().endswith((".tif", ".tiff"))):
        return None
    item = json.loads(read_bytes(path))
    if item.get("type") != "Feature":
        return None
    found = {}
    for asset in item.get("assets", {}).values():
        bands = asset.get("eo:bands") or []
        if len(bands) == 1 and "common_name" in bands[0]:
            found[bands[0]["common_name"]] = asset["href"]
    if missing := [b for b in wanted if b not in found]:
        raise ValueError(f"bands not available: {missing}")
    base = path.rsplit("/", 1)[0]
    return [href if "://" in href or href.startswith("/") else f"{base}/{href}" for href in (found[b] for b in wanted)]


def _is_void(image: np.ndarray, nodata: float) -> np.ndarray:
    """Pixels at which every band has the nodata value."""
    return (np.isnan(image) if np.isnan(nodata) else image == nodata).all(axis=0)


def _void_rows(path: str, run: str, nodata: float, col: int, row: int, w: int, h: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, void pixels) of an image's window, by blocks of rows."""
    for top in range(0, h, geotiff.ROWS):
        last = min(h, top + geotiff.ROWS)
        parts = [_band_rows(p, run, row + top, row + last, None) for p in path.split("|")]
        yield top, _is_void(np.concatenate(parts)[:, :, col : col + w], nodata)


class Tiler:
    """create_tiles() makes a dataset from pairs [{image, label, metadata}], retry_failed_images() tries failures again."""

    def __init__(self, spark: SparkSession, pairs: list[dict], patch_size: tuple[int, int], **settings):
        self.spark = spark
        self.settings = Settings(patch_size, **settings)
        self.pairs = pairs
        names = [geotiff.name_of(p["image"]) for p in pairs]
        if len(set(names)) < len(names):
            raise ValueError("images must have distinct names")
        self.folder = f"{self.settings.output_dir.rstrip('/')}/{self.settings.prefix}"
        self.state = State(spark, f"{self.folder}/state")

    # Phase 1

    def _pairs(self, only: set[str] | None = None) -> DataFrame:
        rows = [(k, geotiff.name_of(p["image"]), p["image"], p["label"], {a: str(b) for a, b in (p.get("metadata") or {}).items()}) for k, p in enumerate(self.pairs)]
        schema = "pair_ord int, image_id string, image string, label string, metadata map<string,string>"
        df = self.spark.createDataFrame([r for r in rows if only is None or r[1] in only], schema)
        return df.repartition(max(1, min(df.count(), 1024)), "image_id")

    @staticmethod
    def _headers(paths: DataFrame, wanted: list[str]) -> DataFrame:
        """(image_id, path) with the header's columns; a STAC item's bands are named in `path`, joined by |."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for image, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    try:
                        parts = retry(lambda p=path: _stac_paths(p, wanted)) or [path]
                        heads = []
                        for p in parts:
                            src = geotiff.Ranges(p)
                            heads.append(geotiff.header(src))
                            src.close()
                        h = heads[0]
                        if any((o.width, o.height, o.srid) != (h.width, h.height, h.srid) for o in heads):
                            raise ValueError("bands of the item differ in size or CRS")
                        rows.append((image, "|".join(parts), h.width, h.height, len(parts) if len(parts) > 1 else h.count, h.dtype.name, h.nodata, h.srid, list(h.transform) if h.transform else None, None))
                    except Exception as error:  # a bad file is this pair's status, not the run's end
                        rows.append((image, path, None, None, None, None, None, None, None, f"{type(error).__name__}: {error}"[:300]))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=[c.split(" ")[0] for c in HEADERS.split(", ")]), schema=_arrow(HEADERS), preserve_index=False)

        return paths.mapInArrow(run, HEADERS)

    def _features(self, pairs: DataFrame) -> DataFrame:
        """Polygons of all vector labels: (image_id, layer, feature_id, rings, props, srid, reason, layer_no)."""
        rows = [(r["image_id"], r["label"]) for r in pairs.where(F.col("label").rlike(r"\.(geojson|gpkg)$")).select("image_id", "label").toLocalIterator()]
        out = self.spark.createDataFrame([], vectors.FEATURE_SCHEMA.replace("image_name string, ", "") + ", image_id string").drop("file")
        for suffix, reader in ((".geojson", vectors.read_geojson), (".gpkg", vectors.read_geopackage)):
            files = sorted({p for _, p in rows if p.endswith(suffix)})
            if files:
                found = reader(self.spark, files if suffix == ".geojson" else "{" + ",".join(files) + "}" if len(files) > 1 else files[0])
                # By the whole path: labels of several folders may have one name, and images may share a label.
                names = self.spark.createDataFrame([(i, file_key(p)) for i, p in rows if p.endswith(suffix)], "image_id string, file string")
                out = out.unionByName(found.drop("image_name").join(names, "file").drop("file"))
        return out

    def prepare(self, pairs: DataFrame, batch: int) -> DataFrame:
        """A row for each pair: status, reason, geometry of the common window, label path and target paths."""
        s = self.settings
        images = self._headers(pairs.select("image_id", F.col("image").alias("path")), s.bands_requested)
        raster = pairs.where(F.col("label").rlike(r"\.tiff?$"))
        labels = self._headers(raster.select("image_id", F.col("label").alias("path")), []).select("image_id", *[F.col(c).alias("lab_" + c) for c in ("path", "width", "height", "dtype", "srid", "transform", "error")])
        features = self._features(pairs)
        good = vectors.usable(features)
        layer = features.groupBy("image_id").agg(F.count_if(F.col("reason").isNull() & (F.col("layer_no") == 0)).alias("n_ok"), F.max("srid").alias("vec_srid"), F.min(F.when(F.col("layer_no") == 0, F.col("reason"))).alias("vec_reason"))
        box = vectors.extents(features.withColumnRenamed("image_id", "image_name")).withColumnRenamed("image_name", "image_id").select("image_id", *[F.col(c).alias("v" + c) for c in ("minx", "miny", "maxx", "maxy")])
        joined = pairs.join(images, "image_id").join(labels, "image_id", "left").join(layer, "image_id", "left").join(box, "image_id", "left")
        kind = F.when(F.col("label").rlike(r"\.tiff?$"), "raster").when(F.col("label").rlike(r"\.(geojson|gpkg)$"), "vector")
        joined = joined.withColumns({
            "label_type": kind, "img_w": F.coalesce("width", F.lit(0)), "img_h": F.coalesce("height", F.lit(0)), "lab_w": F.coalesce("lab_width", F.lit(0)), "lab_h": F.coalesce("lab_height", F.lit(0)),
            "img_srid": F.when(F.col("transform").isNotNull(), F.col("srid")), "lab_srid": F.when(kind == "vector", F.col("vec_srid")).otherwise(F.when(F.col("lab_transform").isNotNull(), F.col("lab_srid"))), "label_ok": F.coalesce(F.col("n_ok") > 0, F.lit(False)),
        }).withColumn("check", validate.pair_status())
        t, lt = F.col("transform"), F.col("lab_transform")
        edges = lambda t, w, h: {"minx": t[2], "maxx": t[2] + t[0] * w, "maxy": t[5], "miny": t[5] + t[4] * h}
        a = edges(t, F.col("img_w"), F.col("img_h"))
        vec = {k: F.col("v" + k) for k in ("minx", "miny", "maxx", "maxy")}
        to_image = (F.col("img_srid") == 3857) & (F.col("lab_srid") == 4326)
        from_image = (F.col("img_srid") == 4326) & (F.col("lab_srid") == 3857)
        for x, y in (("minx", "miny"), ("maxx", "maxy")):
            mx, my = validate.to_web_mercator(vec[x], vec[y])
            lx, ly = validate.from_web_mercator(vec[x], vec[y])
            vec[x], vec[y] = F.when(to_image, mx).when(from_image, lx).otherwise(vec[x]), F.when(to_image, my).when(from_image, ly).otherwise(vec[y])
        ras = edges(lt, F.col("lab_w"), F.col("lab_h"))
        b = {k: F.when(F.col("label_type") == "vector", vec[k]).otherwise(ras[k]) for k in vec}
        boxed = validate.overlaps(joined.withColumns({f"i{k}": v.cast("double") for k, v in a.items()} | {f"l{k}": v.cast("double") for k, v in b.items()}))
        special = F.col("check.special_case")
        whole = {"col_off": F.lit(0), "row_off": F.lit(0), "w": F.col("img_w"), "h": F.col("img_h")}
        box = {k: F.col("o" + k) for k in ("minx", "miny", "maxx", "maxy")}
        cut = validate.clip_window(t[0], t[2], t[4], t[5], F.col("img_w"), F.col("img_h"), box)
        lcut = validate.clip_window(lt[0], lt[2], lt[4], lt[5], F.col("lab_w"), F.col("lab_h"), box)
        pick = lambda k, c: F.when(special, whole[k]).otherwise(c[k]).cast("long")
        out = boxed.withColumns({"c_" + k: pick(k, cut) for k in whole} | {"l_" + k: F.when(F.col("label_type") == "raster", pick(k, lcut)) for k in whole})
        crs = (F.col("img_srid") != F.col("lab_srid")) & ~((F.col("label_type") == "vector") & F.col("img_srid").isin(3857, 4326) & F.col("lab_srid").isin(3857, 4326))
        rotated = (t[1] != 0) | (t[3] != 0) | (t[0] <= 0) | (t[4] >= 0)
        reason = (
            F.when(kind.isNull(), F.lit("label type not supported"))
            .when(F.col("error").isNotNull(), F.concat(F.lit("image: "), F.col("error")))
            .when(F.col("lab_error").isNotNull(), F.concat(F.lit("label: "), F.col("lab_error")))
            .when(~F.col("check.valid"), F.coalesce(F.concat(F.col("check.reason"), F.lit(": "), F.col("vec_reason")), F.col("check.reason")))
            .when(~special & crs, F.lit("unsupported CRS: image and label differ"))
            .when(~special & rotated, F.lit("rotated rasters are not supported"))
            .when(~special & (F.col("iou") > 0) & (F.col("label_type") == "raster") & ((F.col("c_w") != F.col("l_w")) | (F.col("c_h") != F.col("l_h"))), F.lit("image and label differ in size after clipping"))
        )
        skipped = ~special & ((F.coalesce("iou", F.lit(0.0)) == 0) | (F.col("c_w") == 0) | (F.col("c_h") == 0))
        out = out.withColumn("status", F.when(reason.isNotNull(), "failed").when(skipped, "skipped").otherwise("ready")).withColumn("reason", F.coalesce(reason, F.when(skipped, "no overlap")))
        keep = ["pair_ord", "image_id", "path", "bands", "dtype", "nodata", "srid", "transform", "metadata", "label_type", "status", "reason", "lab_path", "lab_dtype", "c_col_off", "c_row_off", "c_w", "c_h", "l_col_off", "l_row_off"]
        table = f"{self.folder}/tmp/prepared-{batch}"
        out.select(*keep).write.mode("overwrite").parquet(table)
        ready = self.spark.read.parquet(table)
        return self._with_vector_labels(ready, good, batch)

    def _with_vector_labels(self, ready: DataFrame, features: DataFrame, batch: int) -> DataFrame:
        """Rasterize the vector labels of ready pairs to files, with erosion and targets, one image a task."""
        s = self.settings
        folder = f"{self.folder}/tmp/labels-{batch}"
        cols = ["image_id", "path", "nodata", "srid", "transform", "c_col_off", "c_row_off", "c_w", "c_h"]
        todo = ready.where("status = 'ready' AND label_type = 'vector'").select(*cols, F.col("srid").alias("to_srid")).drop("srid")
        fields = [s.attr_field] if isinstance(s.attr_field, str) else s.attr_field
        rows = features.join(todo, "image_id").withColumn("rings", _projected("rings", "srid", "to_srid")).select("image_id", "feature_id", "rings", "props", "path", "nodata", "transform", "c_col_off", "c_row_off", "c_w", "c_h", "to_srid")
        job = uuid.uuid4().hex
        values = {str(v): k + 1 for k, v in enumerate(s.attr_values or [])}
        eroding = {values[str(v)] for v in (s.erosion_classes or []) if str(v) in values}

        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            image = key[0]
            try:
                first = frame.iloc[0]
                ta, _, tc, _, te, tf = first["transform"]
                w, h = int(first["c_w"]), int(first["c_h"])
                c0, f0 = tc + ta * first["c_col_off"], tf + te * first["c_row_off"]
                px = min(ta, -te)
                by = 0.0 if px > s.max_gsd_for_erosion else s.target_gap_m / 2 if s.target_gap_m is not None else min(px, 0.6)
                polygons, burn, source = [], [], []
                for r in frame.sort_values("feature_id").itertuples():
                    value, props = 1, dict(r.props)
                    if fields and values:
                        have = [f for f in fields if f in props]
                        if len(have) != 1:
                            raise ValueError(f"attribute field must be one of {fields}; the layer has {have or 'none of them'}")
                        value = values.get(str(props[have[0]]))
                        if value is None:
                            continue
                    rings = [np.array([np.asarray(p, float) for p in ring]).reshape(-1, 2) for ring in r.rings]
                    if value in eroding:
                        rings = kernels.eroded(rings, by, s.min_erosion_area_m2)
                    polygons.append([(ring - (c0, f0)) / (ta, te) for ring in rings])
                    burn.append(value)
                    source.append({"type": "Feature", "id": int(r.feature_id), "properties": props, "box": kernels.bounds(polygons[-1]), "rings": [ring.tolist() for ring in rings]})
                move = (ta, 0.0, c0, 0.0, te, f0)
                srid = None if pd.isna(first["to_srid"]) else int(first["to_srid"])

                def save(name: str, data: np.ndarray, nodata: float | None = None) -> str:
                    path = f"{folder}/{image}/{name}.tif"
                    write_bytes(path, geotiff.write(data, move, srid, nodata))
                    return path

                burned = kernels.rasterize(polygons, burn, w, h).astype(np.uint8)
                if not pd.isna(first["nodata"]):
                    # A label counts only where the image has data.
                    for top, void in _void_rows(first["path"], job, first["nodata"], int(first["c_col_off"]), int(first["c_row_off"]), w, h):
                        burned[top : top + len(void)][void] = 0
                label = save("label", burned, 255)
                write_bytes(f"{folder}/{image}/vectors.json", json.dumps(source).encode())
                made = {}
                buildings = [p for p, v in zip(polygons, burn, strict=True) if v == s.building_class_val]
                roads = [p for p, v in zip(polygons, burn, strict=True) if v == s.road_class_val]
                if s.building_class_val is not None:
                    reach = 10.0 / abs(ta)
                    made["building_edt"] = save("building_edt", kernels.to_byte(kernels.dual_weight(*kernels.two_nearest(buildings, w, h, reach), reach)))
                    made["building_boundary"] = save("building_boundary", kernels.to_byte(kernels.boundary_map(buildings, w, h)))
                    made["building_vertices"] = save("building_vertices", kernels.to_byte(kernels.vertex_map(buildings, w, h)))
                    made["building_sdf"] = save("building_sdf", kernels.signed_distance(kernels.union_mask(buildings, w, h)).astype(np.float32))
                if s.road_class_val is not None and abs(ta) <= s.max_gsd_for_erosion:
                    made["roads_centerline_weight"] = save("roads_centerline_weight", kernels.to_byte(kernels.road_weight(roads, w, h)))
                return pd.DataFrame([(image, label, f"{folder}/{image}/vectors.json", json.dumps(made), None)], columns=_LABEL_COLUMNS)
            except ValueError as error:
                return pd.DataFrame([(image, None, None, None, str(error)[:300])], columns=_LABEL_COLUMNS)

        made = rows.groupBy("image_id").applyInPandas(run, "image_id string, v_path string, v_vectors string, v_targets string, v_error string")
        table = f"{self.folder}/tmp/labels-{batch}.parquet"
        made.write.mode("overwrite").parquet(table)
        out = ready.join(self.spark.read.parquet(table), "image_id", "left")
        bad = (F.col("status") == "ready") & (F.col("label_type") == "vector") & F.col("v_path").isNull()
        return out.withColumn("reason", F.when(bad, F.coalesce("v_error", F.lit("no usable polygon"))).otherwise(F.col("reason"))).withColumn("status", F.when(bad, F.when(F.col("v_error").isNull(), "skipped").otherwise("failed")).otherwise(F.col("status")))

    def _label_counts(self, ready: DataFrame) -> DataFrame:
        """Partial counts of the labels: kind 'cell' (gx, gy, class_id, n) by cell bounds and 'tile' (cx, cy, n labelled)."""
        s = self.settings
        tx, ty = gcd(s.patch_size[1], s.stride), gcd(s.patch_size[0], s.stride)
        grid, job = s.grid_size, uuid.uuid4().hex
        parts = ready.select("image_id", F.coalesce("v_path", "lab_path").alias("path"), F.coalesce(F.when(F.col("v_path").isNull(), F.col("l_col_off")), F.lit(0)).alias("col"), F.coalesce(F.when(F.col("v_path").isNull(), F.col("l_row_off")), F.lit(0)).alias("row"), "c_w", "c_h")
        parts = parts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c_h") - 1, F.lit(geotiff.ROWS).cast("long"))).alias("top")).repartition("image_id", "top")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    w, h = r["c_w"], r["c_h"]
                    last = min(h, r["top"] + geotiff.ROWS)
                    x = _band_rows(r["path"], job, r["row"] + r["top"], r["row"] + last, (1,))[0][:, r["col"] : r["col"] + w].astype(np.int64)
                    line = lambda size: np.array([int(min((g + 1) * (size / grid), size)) for g in range(grid)])
                    gx, gy = np.searchsorted(line(w), np.arange(w), "right"), np.searchsorted(line(h), np.arange(r["top"], last), "right")
                    rows = []
                    key = ((np.minimum(gy, grid)[:, None] * (grid + 1) + np.minimum(gx, grid)) << 20) + np.clip(x, -1, (1 << 19) - 1) + 1
                    for k, n in zip(*np.unique(key, return_counts=True), strict=True):
                        b, a = divmod(int(k) >> 20, grid + 1)
                        if a < grid and b < grid:
                            rows.append(("cell", r["image_id"], a, b, (int(k) & ((1 << 20) - 1)) - 1, int(n)))
                    ys, xs = np.nonzero(x)
                    wide = w // tx + 1
                    for k, n in zip(*np.unique(((ys + r["top"]) // ty) * wide + xs // tx, return_counts=True), strict=True):
                        rows.append(("tile", r["image_id"], int(k) % wide, int(k) // wide, 0, int(n)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _COUNT_TYPES, strict=True)] if rows else [pa.array([], t) for t in _COUNT_TYPES], _COUNT_NAMES)

        return parts.mapInArrow(run, "kind string, image_id string, i int, j int, class_id int, n long")

    def analyse(self, ready: DataFrame, batch: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(class shares of the images, cell shares, kept windows); the counts are stored once and small."""
        s = self.settings
        path = f"{self.folder}/tmp/counts-{batch}"
        self._label_counts(ready).groupBy("kind", "image_id", "i", "j", "class_id").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(path)
        counts = self.spark.read.parquet(path)
        images = ready.select("image_id", F.col("c_w").alias("width"), F.col("c_h").alias("height"))
        named = F.try_element_at(F.create_map(*[F.lit(v) for p in sorted((v, k) for k, v in s.class_ids.items()) for v in p]), F.col("class_id"))
        cell = counts.where("kind = 'cell'").withColumn("class_name", named)
        by_image = cell.where("class_name IS NOT NULL").groupBy("image_id", "class_name").agg(F.sum("n").alias("n"))
        total = by_image.groupBy("image_id").agg(F.sum("n").alias("total"))
        spine = images.select("image_id", F.explode(F.array(*map(F.lit, s.class_ids))).alias("class_name"))
        shares = spine.join(by_image, ["image_id", "class_name"], "left").join(total, "image_id", "left").select("image_id", "class_name", F.coalesce(F.col("n") / F.col("total"), F.lit(0.0)).alias("share"))
        pixels = cell.groupBy("image_id", "i", "j").agg(F.sum("n").alias("pixels"))
        grid = windows.grid_cells(images, s.grid_size).select("image_id", F.col("gx").alias("i"), F.col("gy").alias("j"), F.explode(F.array(*map(F.lit, s.class_ids))).alias("class_name"))
        cells = grid.join(cell.groupBy("image_id", "i", "j", "class_name").agg(F.sum("n").alias("n")), ["image_id", "i", "j", "class_name"], "left").join(pixels, ["image_id", "i", "j"], "left")
        totals = images.select("image_id", windows.patch_count(F.col("width"), F.col("height"), s.stride).alias("total_patches"))
        cells = cells.select("image_id", F.col("i").alias("gx"), F.col("j").alias("gy"), "class_name", F.coalesce(F.col("n") / F.col("pixels"), F.lit(0.0)).alias("share")).join(totals, "image_id")
        tx, ty = gcd(s.patch_size[1], s.stride), gcd(s.patch_size[0], s.stride)
        tile = counts.where("kind = 'tile'").select("image_id", F.col("i").cast("long").alias("cx"), F.col("j").cast("long").alias("cy"), "n")
        xs = F.explode(windows.tiles_of(F.col("cx") * tx, F.col("cx") * tx + tx - 1, s.patch_size[1], s.stride))
        ys = F.explode(windows.tiles_of(F.col("cy") * ty, F.col("cy") * ty + ty - 1, s.patch_size[0], s.stride))
        sums = tile.select("image_id", "cy", "n", xs.alias("a")).select("image_id", "a", "n", ys.alias("b")).groupBy("image_id", (F.col("a") * s.stride).alias("x"), (F.col("b") * s.stride).alias("y")).agg(F.sum("n").alias("n_labelled"))
        covered = windows.windows(images, s.patch_size, s.stride).select("image_id", "x", "y").join(sums, ["image_id", "x", "y"], "left").withColumn("n_labelled", F.coalesce("n_labelled", F.lit(0)))
        kept = windows.with_cell(windows.kept(covered, s.patch_size, s.discard_empty, s.label_threshold), images, s.grid_size)
        table = f"{self.folder}/tmp/kept-{batch}"
        kept.write.mode("overwrite").parquet(table)
        return shares, cells, self.spark.read.parquet(table)

    def _choose(self, shares: DataFrame, cells: DataFrame, kept: DataFrame, ready: DataFrame) -> DataFrame:
        """(image_id, cell_id, ratio) of the validation cells of each image."""
        s = self.settings
        if s.split == "tst":
            return self.spark.createDataFrame([], "image_id string, cell_id string, ratio double")
        ratios = split.options(s.val_ratio)
        if s.val_strategy == "random":
            drawn = F.array(*[F.struct(F.lit(r).alias("ratio"), F.lit(c).alias("cell_id")) for r in ratios for c in split.random_cells(s.grid_size, r, s.val_seed)])
            chosen = ready.select("image_id", F.explode(drawn).alias("c")).select("image_id", "c.*")
        else:
            target = {r["class_name"]: r["share"] for r in analysis.target_distribution(shares).collect()}  # a row for each class
            chosen = split.validation_cells(cells, target, s.grid_size, ratios, s.class_ids, s.class_balance_weight, s.spatial_weight)
        chosen = chosen.select("image_id", "ratio", "cell_id")
        per_cell = kept.groupBy("image_id", "cell_id").agg(F.count("*").alias("n"))
        total = per_cell.groupBy("image_id").agg(F.sum("n").alias("total"))
        val = chosen.join(per_cell, ["image_id", "cell_id"]).groupBy("image_id").pivot("ratio", ratios).agg(F.sum("n"))
        rows = ready.select("image_id", "pair_ord").join(total, "image_id", "left").join(val, "image_id", "left").orderBy("pair_ord").collect()  # a few numbers for each image
        counts = [(r["image_id"], {x: ((r["total"] or 0) - (r[str(x)] or 0), r[str(x)] or 0) for x in ratios}) for r in rows]
        before = {r["split"]: r["n"] for r in manifest.split_counts(self.state.read("patches")).collect()}
        ratio = split.fold(counts, s.val_ratio, tuple(before[k] for k in manifest.SPLITS))
        of = self.spark.createDataFrame(list(ratio.items()) or [], "image_id string, ratio double")
        return chosen.join(of, ["image_id", "ratio"])

    # Phase 2

    def _note_length(self, item_of: Column, lab_of: Column) -> Column:
        """Characters of a patch's metadata as JSON, for shard rotation."""
        s = self.settings
        ph, pw = s.patch_size
        empty = {"patch_id": "", "pixel_coordinates": [], "patch_size": [ph, pw], "stride": s.stride, "split": "", "image_dtype": "", "label_dtype": "", "image_name": "", "sensor_type": ""}
        fixed = len(json.dumps({"patch_metadata": empty})) + 2  # ", " between the coordinates
        inner = lambda c: json_length(c) - 2
        digits = F.length(F.col("x").cast("string")) + F.length(F.col("y").cast("string"))
        key = inner(F.lit(s.prefix)) + inner(F.col("image_id")) + 3 + digits
        sensor = inner(F.coalesce(F.try_element_at("metadata", F.lit("collection")), F.lit("unknown")))
        each = lambda a, e: a + json_length(e["key"]) + json_length(e["value"]) + 4
        more = F.coalesce(F.aggregate(F.map_entries("metadata"), F.lit(0), each), F.lit(0))
        return fixed + key + digits + F.length("split") + F.length(item_of) + F.length(lab_of) + inner(F.col("image_id")) + sensor + more

    def _samples(self, kept: DataFrame, chosen: DataFrame, ready: DataFrame) -> DataFrame:
        """The kept windows with split, shard and everything a task needs to make the patch."""
        s = self.settings
        ph, pw = s.patch_size
        done = self.state.read("patches")
        wins = manifest.remaining_patches(split.assign(kept.select("image_id", "cell_id", "x", "y"), chosen, s.split == "tst"), done)
        meta = ready.select("image_id", "pair_ord", "path", "bands", "dtype", "nodata", "srid", "transform", "metadata", "lab_dtype", "c_col_off", "c_row_off", "c_w", "c_h", "l_col_off", "l_row_off", "lab_path", "v_path", "v_vectors", "v_targets")
        out = wins.join(meta, "image_id")
        n_bands = F.lit(len(s.band_indices)) if s.band_indices else F.col("bands")
        item = F.regexp_extract("dtype", r"(\d+)$", 1).cast("int") / 8
        lab_item = F.coalesce(F.regexp_extract(F.when(F.col("v_path").isNull(), F.col("lab_dtype")), r"(\d+)$", 1).cast("int") / 8, F.lit(1))
        size = estimated_size(n_bands * item * ph * pw, lab_item * ph * pw, self._note_length(item_of=F.col("dtype"), lab_of=F.when(F.col("v_path").isNull(), F.col("lab_dtype")).otherwise("uint8")))
        order = F.format_string("%010d/%010d/%010d", "pair_ord", "y", "x")
        narrow = out.select("image_id", "x", "y", "split", size.alias("size_bytes"), order.alias("patch_ord"))
        packed = manifest.pack(narrow, s.shard_limit, s.shard_lanes).select("image_id", "x", "y", "shard_id")
        start = {r["split"]: r["next_id"] for r in manifest.next_shard(self.state.read("shards")).collect()}
        first = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for p in start.items() for v in p]), F.col("split")), F.lit(0)) if start else F.lit(0)
        return out.withColumn("size_bytes", size).withColumn("patch_ord", order).join(packed, ["image_id", "x", "y"]).withColumn("shard_id", (F.col("shard_id") + first).cast("int"))

    def _write(self, samples: DataFrame) -> DataFrame:
        """Make and write the patches; a row for each patch with its band sums, and the shard's size on its last one."""
        s = self.settings
        ph, pw = s.patch_size
        folder, prefix, tar = self.folder, s.prefix, s.output_format == "tar"
        picked, job = tuple(s.band_indices) if s.band_indices else None, uuid.uuid4().hex
        dealt = samples.repartition("split", "shard_id").sortWithinPartitions("split", "shard_id", "patch_ord")

        def make(r: dict) -> tuple[str, dict[str, np.ndarray], dict, list, tuple]:
            limit = (r["c_col_off"], r["c_row_off"], r["c_w"], r["c_h"])
            fill = r["nodata"] if r["nodata"] is not None else 0
            x, y = r["x"], r["y"]
            parts = r["path"].split("|")
            if len(parts) > 1:
                image = np.concatenate([read_window(p, job, x, y, pw, ph, fill, limit, (1,)) for p in parts])
                image = image[[b - 1 for b in picked]] if picked else image
            else:
                image = read_window(parts[0], job, x, y, pw, ph, fill, limit, picked)
            own = r["v_path"] is not None
            lab_limit = (0, 0, r["c_w"], r["c_h"]) if own else (r["l_col_off"], r["l_row_off"], r["c_w"], r["c_h"])
            label = read_window(r["v_path"] if own else r["lab_path"], job, x, y, pw, ph, 0, lab_limit)
            if r["nodata"] is not None:
                label[0][_is_void(image, r["nodata"])] = IGNORE
            arrays = {"image_patch": image, "label_patch": label}
            for name, path in json.loads(r["v_targets"] or "{}").items():
                arrays[name] = read_window(path, job, x, y, pw, ph, 0, (0, 0, r["c_w"], r["c_h"]))[0]
            key = f"{prefix}_{r['image_id']}_{x}_{y}"
            meta = dict(r["metadata"] or [])
            sensor = meta.get("collection", "unknown")
            note = {"patch_id": key, "pixel_coordinates": [x, y], "patch_size": [ph, pw], "stride": s.stride, "split": r["split"], "image_dtype": str(image.dtype), "label_dtype": str(label.dtype), "image_name": r["image_id"], "sensor_type": sensor}
            a, _, c, _, e, f = r["transform"] or (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
            place = (a, 0.0, c + a * (r["c_col_off"] + x), 0.0, e, f + e * (r["c_row_off"] + y))
            found = _patch_features(r["v_vectors"], x, y, pw, ph, place, r["srid"]) if r["v_vectors"] else None
            return key, arrays, {"patch_metadata": note, **meta}, found, place

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, sink, archive, rows, fs, at, own = None, None, None, [], None, "", ""

            def close() -> None:
                if archive is not None:
                    archive.close()
                    rows[-1]["shard_bytes"] = sink.tell()
                    sink.close()
                    fs.move(own, at)

            for batch in batches:
                for r in batch.to_pylist():
                    key, arrays, note, found, place = make(r)
                    name = f"{prefix}-{r['split']}-{r['shard_id']:06d}.tar"
                    path = f"{folder}/{r['split']}/{name}"
                    if tar and (r["split"], r["shard_id"]) != current:
                        close()
                        current = (r["split"], r["shard_id"])
                        fs, at = resolve(path)
                        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                        own = attempt_name(at)
                        sink = fs.open_output_stream(own, compression=None)
                        archive = tarfile.open(fileobj=sink, mode="w|")
                    line = None
                    if tar:
                        members = {f"{k}.npy": npy(v) for k, v in arrays.items()} | {"metadata.json": json.dumps(note).encode()}
                        if found is not None:
                            members["vectors.geojson"] = json.dumps(found, separators=(",", ":")).encode()
                        for member, data in members.items():
                            info = tarfile.TarInfo(f"{key}.{member}")
                            info.size = len(data)
                            archive.addfile(info, io.BytesIO(data))
                    else:
                        entries = []
                        for k, v in arrays.items():
                            entry = f"{r['split']}/{k.removesuffix('_patch')}/{key}.tif"
                            write_bytes(f"{folder}/{entry}", geotiff.write(v, place if r["transform"] else None, r["srid"], r["nodata"] if k == "image_patch" else None, s.csv_compression))
                            entries.append(entry)
                        if found is not None:
                            entries.append(f"{r['split']}/vector/{key}.geojson")
                            write_bytes(f"{folder}/{entries[-1]}", json.dumps(found, separators=(",", ":")).encode())
                        line = ";".join(entries)
                    v = arrays["image_patch"].astype(np.float64).reshape(len(arrays["image_patch"]), -1)
                    train = r["split"] == "trn"
                    rows.append({"image_id": r["image_id"], "x": r["x"], "y": r["y"], "split": r["split"], "shard_id": r["shard_id"], "size_bytes": r["size_bytes"], "path": path if tar else None, "shard_bytes": None, "line": line, "n": v.shape[1], "s": v.sum(axis=1).tolist() if train else None, "ss": (v * v).sum(axis=1).tolist() if train else None})
                    if len(rows) >= 1024:
                        yield pa.RecordBatch.from_pylist(rows[:-1], schema=_WRITTEN)
                        rows = rows[-1:]  # the last row may yet get its shard's size
            close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_WRITTEN)

        return dealt.mapInArrow(run, "image_id string, x long, y long, split string, shard_id int, size_bytes long, path string, shard_bytes long, line string, n long, s array<double>, ss array<double>")

    def create_tiles(self, only: set[str] | None = None) -> dict:
        """Process every pair that is not completed; returns the run's counts."""
        s, spark = self.settings, self.spark
        batch = self.state.next_batch()
        everything = self._pairs(only)
        todo = manifest.remaining_images(everything, self.state.read("image_log"))
        total = everything.count()
        table = f"{self.folder}/tmp/pairs-{batch}"
        todo.write.mode("overwrite").parquet(table)
        prepared_path = f"{self.folder}/tmp/ready-{batch}"
        self.prepare(spark.read.parquet(table), batch).write.mode("overwrite").parquet(prepared_path)
        prepared = spark.read.parquet(prepared_path)
        ready = prepared.where("status = 'ready'")
        tables = ["image_log"]
        if not ready.isEmpty():
            shares, cells, kept = self.analyse(ready, batch)
            self.state.stage(batch, "class_shares", shares)
            chosen = self.state.stage(batch, "val_cells", self._choose(shares, cells, kept, ready))
            written = f"{self.folder}/tmp/written-{batch}"
            self._write(self._samples(kept, chosen, ready)).write.mode("overwrite").parquet(written)
            rows = spark.read.parquet(written)
            self.state.stage(batch, "patches", rows)
            band = rows.where("split = 'trn'").select("n", F.posexplode(F.arrays_zip("s", "ss")).alias("band", "v"))
            partial = band.groupBy((F.col("band") + 1).alias("band")).agg(F.sum("n").alias("n"), F.sum("v.s").alias("s"), F.sum("v.ss").alias("ss"), F.count("*").alias("patches"))
            self.state.stage(batch, "band_stats", partial.withColumn("prefix", F.lit(s.prefix)))
            images = rows.groupBy("split", "shard_id").agg(F.sort_array(F.collect_set("image_id")).alias("images"))
            shards = rows.groupBy("split", "shard_id").agg(F.max("path").alias("path"), F.coalesce(F.sum("shard_bytes"), F.sum("size_bytes")).alias("size_bytes"), F.count("*").alias("patch_count"))
            self.state.stage(batch, "shards", shards.join(images, ["split", "shard_id"]).withColumn("status", F.lit("CLOSED")))
            if s.output_format == "csv":
                rows.select("split", "line").write.mode("overwrite").partitionBy("split").text(f"{self.folder}/index/batch={batch}")
            tables += ["class_shares", "val_cells", "patches", "band_stats", "shards"]
        status = F.when(F.col("status") == "ready", "completed").otherwise(F.col("status"))
        log = prepared.select("image_id", status.alias("status"), "reason", F.current_timestamp().alias("ts"), (F.lit(batch) * 1_000_000_000 + F.col("pair_ord")).alias("seq"))
        self.state.stage(batch, "image_log", log)
        self.state.commit(batch, tables)
        counts = {r["status"]: r["n"] for r in prepared.groupBy(status.alias("status")).agg(F.count("*").alias("n")).collect()}
        reasons = [(r["image_id"], r["status"], r["reason"]) for r in prepared.where("status <> 'ready'").select("image_id", "status", "reason").collect()]  # a short row for each failed pair
        self.export_normalization_stats()
        write_bytes(f"{self.folder}/manifest.json", json.dumps(self.state.snapshot({"prefix": s.prefix}), default=str).encode())
        fs, at = resolve(f"{self.folder}/tmp")
        if fs.get_file_info(at).type == pafs.FileType.Directory:
            fs.delete_dir(at)
        return {"total": total, "successful": counts.get("completed", 0), "skipped": counts.get("skipped", 0), "failed": counts.get("failed", 0), "already_done": total - sum(counts.values()), "reasons": reasons}

    def retry_failed_images(self, max_retries: int = 3, sleep=time.sleep) -> dict:
        """Run the inputs whose last status is failed again, up to max_retries rounds."""
        out: dict = {"rounds": 0, "still_failed": []}
        for attempt in range(max_retries):
            failed = {r["image_id"] for r in manifest.failed_images(self._pairs(), self.state.read("image_log")).select("image_id").collect()}
            out["still_failed"] = sorted(failed)
            if not failed:
                break
            if attempt:
                sleep(min(2**attempt, 30))
            out |= self.create_tiles(failed)
            out["rounds"] += 1
        out["still_failed"] = sorted(r["image_id"] for r in manifest.failed_images(self._pairs(), self.state.read("image_log")).select("image_id").collect())
        return out

    def index_paths(self) -> list[str]:
        """The folders of the CSV index that are committed; a run that died leaves one that the next run replaces."""
        return [f"{self.folder}/index/batch={n}" for n in self.state.commits() if "patches" in self.state.tables(n)]

    def export_normalization_stats(self, path: str | None = None) -> str:
        """Write the bands' mean and deviation as JSON."""
        path = path or f"{self.folder}/{self.settings.prefix}_normalization_stats.json"
        note = {"created_at": datetime.now(UTC).isoformat(), "dataset_prefix": self.settings.prefix, "statistics": self.state.statistics()}
        write_bytes(path, json.dumps(note).encode())
        return path


_LABEL_COLUMNS = ["image_id", "v_path", "v_vectors", "v_targets", "v_error"]
_COUNT_NAMES = ["kind", "image_id", "i", "j", "class_id", "n"]
_COUNT_TYPES = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
_WRITTEN = pa.schema([("image_id", pa.string()), ("x", pa.int64()), ("y", pa.int64()), ("split", pa.string()), ("shard_id", pa.int32()), ("size_bytes", pa.int64()), ("path", pa.string()), ("shard_bytes", pa.int64()), ("line", pa.string()), ("n", pa.int64()), ("s", pa.list_(pa.float64())), ("ss", pa.list_(pa.float64()))])


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(n, kinds[t]) for n, t in (c.split(" ", 1) for c in ddl.split(", "))])


def _projected(rings: str, srid: str, to: str):
    """Rings in the CRS `to`: EPSG:4326 and EPSG:3857 into each other, all else as it is."""
    into = lambda p, f: F.array(*f(p[0], p[1]))
    forward = F.transform(rings, lambda r: F.transform(r, lambda p: into(p, validate.to_web_mercator)))
    back = F.transform(rings, lambda r: F.transform(r, lambda p: into(p, validate.from_web_mercator)))
    return F.when((F.col(srid) == 4326) & (F.col(to) == 3857), forward).when((F.col(srid) == 3857) & (F.col(to) == 4326), back).otherwise(F.col(rings))


#: Pixels of a side of the squares by which an image's features are listed.
LISTED = 256


@lru_cache(maxsize=4)
def _vectors(path: str) -> tuple[list[dict], dict[tuple[int, int], list[int]]]:
    """The features of an image, and by square the numbers of those whose box meets it."""
    found = json.loads(read_bytes(path))
    listed: dict[tuple[int, int], list[int]] = {}
    for k, feature in enumerate(found):
        minx, miny, maxx, maxy = (int(v // LISTED) for v in feature["box"])
        for a in range(minx, maxx + 1):
            for b in range(miny, maxy + 1):
                listed.setdefault((a, b), []).append(k)
    return found, listed


def _patch_features(path: str, x: int, y: int, w: int, h: int, place: tuple, srid: int | None) -> dict:
    """The features that meet a window, cut to it and snapped, as a GeoJSON collection in map units."""
    a, _, c, _, e, f = place
    box = (min(c, c + a * w), min(f, f + e * h), max(c, c + a * w), max(f, f + e * h))
    out = []
    features, listed = _vectors(path)
    squares = [(i, j) for i in range((x - 1) // LISTED, (x + w) // LISTED + 1) for j in range((y - 1) // LISTED, (y + h) // LISTED + 1)]
    for k in sorted(set().union(*(listed.get(q, ()) for q in squares))):
        feature = features[k]
        minx, miny, maxx, maxy = feature["box"]
        if minx > x + w or maxx < x or miny > y + h or maxy < y:
            continue
        rings = [kernels.clip_ring(np.array(ring), *box) for ring in feature["rings"]]
        if not len(rings[0]):
            continue
        truncated = minx < x or miny < y or maxx > x + w or maxy > y + h
        snapped = [np.round(np.round(r / 0.01) * 0.01, 9).tolist() for r in rings if len(r)]
        out.append({"type": "Feature", "properties": {"is_truncated": truncated, **feature["properties"]}, "geometry": {"type": "Polygon", "coordinates": snapped}})
    found: dict = {"type": "FeatureCollection", "features": out}
    if srid:
        found["crs"] = {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{srid}"}}
    return found
