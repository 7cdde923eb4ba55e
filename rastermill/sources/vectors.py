"""Vector layers: GeoJSON by Spark's JSON reader, GeoPackage (SQLite) by its own reader.

Features come as (image_name, layer, feature_id, rings, props, srid): rings of (x, y) of one polygon, multi-polygons
exploded, other geometries left out. A layer whose name holds "extent" gives the valid extent instead of features.
"""

from __future__ import annotations

import json
import sqlite3
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.kernels import area, self_intersects
from .files import file_key
from .geotiff import name_of

FEATURE_SCHEMA = "image_name string, layer string, feature_id long, rings array<array<array<double>>>, props map<string,string>, srid int, reason string, file string, layer_no int"
#: A layer whose name holds this gives the valid extent.
EXTENT = "extent"
_RINGS = pa.list_(pa.list_(pa.list_(pa.float64())))
_TYPES = [pa.string(), pa.string(), pa.int64(), _RINGS, pa.map_(pa.string(), pa.string()), pa.int32(), pa.string(), pa.string(), pa.int32()]
_NAMES = ["image_name", "layer", "feature_id", "rings", "props", "srid", "reason", "file", "layer_no"]


def wkb_polygons(data: bytes) -> list[list[list[list[float]]]]:
    """The polygons of a WKB geometry as rings; points, lines and empty geometries give none."""
    out: list = []

    def geometry(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        code = struct.unpack_from(order + "I", data, at + 1)[0]
        dims = 2 + (code // 1000 in (1, 3) or bool(code & 0x80000000)) + (code // 1000 in (2, 3) or bool(code & 0x40000000))
        at += 5 + 4 * bool(code & 0x20000000)
        kind = (code & 0xFFFF) % 1000
        if kind == 1:
            return at + 8 * dims
        n = struct.unpack_from(order + "I", data, at)[0]
        at += 4
        if kind == 2:
            return at + 8 * dims * n
        if kind == 3:
            rings = []
            for _ in range(n):
                m = struct.unpack_from(order + "I", data, at)[0]
                pts = np.frombuffer(data, order + "f8", m * dims, at + 4).reshape(m, dims)[:, :2]
                rings.append(pts.tolist())
                at += 4 + 8 * dims * m
            if rings and rings[0]:
                out.append(rings)
            return at
        if kind in (4, 5, 6, 7):
            for _ in range(n):
                at = geometry(at)
            return at
        raise ValueError(f"geometry type {kind} is not supported")

    if data:
        geometry(0)
    return out


def polygon_wkb(rings: list) -> bytes:
    """One polygon as little-endian WKB."""
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes() for r in rings)


def geopackage_geometry(blob: bytes | None) -> tuple[int | None, list]:
    """(srid, polygons) of a GeoPackage geometry column's value."""
    if not blob or blob[:2] != b"GP":
        return None, []
    flags = blob[3]
    srid = struct.unpack(("<" if flags & 1 else ">") + "i", blob[4:8])[0]
    envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[flags >> 1 & 7]
    return srid, [] if flags & 16 else wkb_polygons(blob[8 + envelope :])


def problem(rings: list) -> str | None:
    """Why a polygon cannot be used; repairing self-intersections is out of scope, so they are reported."""
    pts = np.asarray(rings[0], float)
    if len(pts) < 4:
        return "empty polygon"
    if self_intersects(pts):
        return "self-intersecting polygon"
    return "empty polygon" if area(pts) == 0 else None


def _rows(file: str, layer: str, number: int | None, first: int, polygons: list, props: dict, srid: int | None) -> list[tuple]:
    return [(name_of(file), layer, first + k, rings, list(props.items()), srid, problem(rings), file_key(file), number) for k, rings in enumerate(polygons)]


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], _NAMES)


def read_geopackage(spark: SparkSession, path: str) -> DataFrame:
    """All polygon features of the files below path; each file is opened from its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with tempfile.NamedTemporaryFile(suffix=".gpkg") as copy:  # SQLite needs a file; gone after this row
                    copy.write(content)
                    copy.flush()
                    db = sqlite3.connect(f"file:{copy.name}?mode=ro", uri=True)
                    rows, number, labels = [], 0, 0
                    for layer, column in db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY rowid").fetchall():
                        layer_no = None if EXTENT in layer.lower() else labels
                        labels += layer_no is not None
                        cursor = db.execute(f'SELECT * FROM "{layer}"')
                        names = [c[0] for c in cursor.description]
                        for values in cursor:
                            record = dict(zip(names, values, strict=True))
                            srid, polygons = geopackage_geometry(record.pop(column))
                            props = {k: None if v is None else str(v) for k, v in record.items()}
                            rows += _rows(file, layer, layer_no, number, polygons, props, srid)
                            number += len(polygons)
                            if len(rows) >= 4096:
                                yield _emit(rows)
                                rows = []
                    db.close()
                    if rows:
                        yield _emit(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gpkg").load(path)
    return files.select("path", "content").mapInArrow(run, FEATURE_SCHEMA)


def write_geopackage(rows: list[tuple[list, dict[str, str]]], srid: int, layer: str = "labels") -> bytes:
    """A GeoPackage file of one layer from (rings, attributes)."""
    fields = sorted({k for _, props in rows for k in props})
    with tempfile.NamedTemporaryFile(suffix=".gpkg") as copy:
        db = sqlite3.connect(copy.name)
        db.execute("PRAGMA application_id = 1196444487")
        db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT)")
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER)")
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT)")
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined')", (f"EPSG:{srid}", srid, srid))
        db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (layer, layer, srid))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (layer, srid))
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB{"".join(f", {chr(34)}{f}{chr(34)} TEXT" for f in fields)})')
        for k, (rings, props) in enumerate(rows):
            blob = b"GP\0\1" + struct.pack("<i", srid) + polygon_wkb(rings)
            db.execute(f'INSERT INTO "{layer}" VALUES ({", ".join("?" * (2 + len(fields)))})', (k, blob, *[props.get(f) for f in fields]))
        db.commit()
        db.close()
        copy.seek(0)
        with open(copy.name, "rb") as f:
            return f.read()


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """All polygon features of GeoJSON files; the CRS is its EPSG name, else 4326."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = json.loads(text)
                crs = str(((found.get("crs") or {}).get("properties") or {}).get("name") or "")
                code = crs.replace("::", ":").rsplit(":", 1)[-1]
                srid = int(code) if code.isdigit() else 4326
                rows, number, layer = [], 0, str(found.get("name") or "labels")
                for feature in found.get("features") or []:
                    g = feature.get("geometry") or {}
                    polygons = {"Polygon": lambda g: [g["coordinates"]], "MultiPolygon": lambda g: g["coordinates"]}.get(g.get("type"), lambda g: [])(g)
                    polygons = [[[list(map(float, p[:2])) for p in ring] for ring in rings] for rings in polygons if rings and rings[0]]
                    props = {k: None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in (feature.get("properties") or {}).items()}
                    rows += _rows(file, layer, None if EXTENT in layer.lower() else 0, number, polygons, props, srid)
                    number += len(polygons)
                if rows:
                    yield _emit(rows)

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.mapInArrow(run, FEATURE_SCHEMA)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """GeoPackage or GeoJSON by suffix; other suffixes are an error."""
    if path.endswith(".gpkg"):
        return read_geopackage(spark, path)
    if path.endswith(".geojson"):
        return read_geojson(spark, path)
    raise ValueError(f"{path}: labels must be .tif, .tiff, .geojson or .gpkg")


def usable(features: DataFrame) -> DataFrame:
    """The features of the label layer that can be used; `reason` of the others says why not.

    The label layer is a file's first one whose name does not hold "extent"; later ones are not read as labels.
    """
    return features.where("reason IS NULL AND layer_no = 0")


def extents(features: DataFrame) -> DataFrame:
    """(image_name, minx, miny, maxx, maxy): bounds of the extent layer, else of the label layer's features."""
    features = features.where("layer_no IS NULL OR layer_no = 0")
    pts = F.flatten(F.transform("rings", lambda r: r))
    axis = lambda k: F.transform(pts, lambda p: p[k])
    is_extent = F.col("layer_no").isNull()
    box = features.select("image_name", is_extent.alias("x"), F.array_min(axis(0)).alias("a"), F.array_min(axis(1)).alias("b"), F.array_max(axis(0)).alias("c"), F.array_max(axis(1)).alias("d"))
    pick = lambda f, k: F.coalesce(f(F.when(F.col("x"), F.col(k))), f(F.col(k)))
    return box.groupBy("image_name").agg(pick(F.min, "a").alias("minx"), pick(F.min, "b").alias("miny"), pick(F.max, "c").alias("maxx"), pick(F.max, "d").alias("maxy"))
