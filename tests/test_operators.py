"""Hand-made cases of the tiling rules."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rastermill.functions import kernels, scalar
from rastermill.operators import analysis, bands, manifest, split, vector, windows
from rastermill.sources import geotiff, png, shards, stac, vectors
from rastermill.sources.csv_index import read_index
from rastermill.sources.files import retry


def labels(spark, rows):
    return spark.createDataFrame([(0, x, y, c) for x, y, c in rows], "image_id long, x long, y long, class_id int")


def images(spark, w, h):
    return spark.createDataFrame([(0, w, h)], "image_id long, width int, height int")


def test_coverage_boundary(spark):
    covered = windows.coverage(labels(spark, [(3, 3, 1)]), images(spark, 10, 10), (10, 10), 10)
    assert windows.kept(covered, (10, 10), True, 0.01).count() == 1
    assert windows.kept(covered, (10, 10), True, 0.0101).count() == 0
    empty = windows.coverage(labels(spark, []), images(spark, 10, 10), (10, 10), 10)
    assert windows.kept(empty, (10, 10), False, 0.01).count() == 0
    assert windows.kept(empty, (10, 10), False, None).count() == 1


def test_edge_windows_and_empty_image(spark):
    assert windows.windows(images(spark, 3, 3), (2, 2), 2).count() == 4
    assert windows.windows(images(spark, 0, 3), (2, 2), 2).count() == 0


def test_floor_division(spark):
    row = spark.range(1).select(scalar.floor_div(F.lit(10), F.lit(20 / 6)).alias("c")).first()
    assert row["c"] == 2 == int(10 // (20 / 6))


def test_cell_bounds_divide_first(spark):
    cells = windows.grid_cells(images(spark, 164, 164), 20).where("gx = 14 AND gy = 0").first()
    assert cells["maxx"] == int(15 * (164 / 20)) == 122


def test_nodata_needs_all_bands(spark):
    px = spark.createDataFrame([(0, b, x, 0, v) for b, x, v in [(1, 0, 0.0), (2, 0, 0.0), (1, 1, 0.0), (2, 1, 5.0)]], "image_id long, band int, x long, y long, v double")
    out = windows.masked_labels(px, labels(spark, [(0, 0, 1), (1, 0, 1)]), 0.0).orderBy("x").collect()
    assert [r["class_id"] for r in out] == [255, 1]


def test_ratio():
    assert split.adjusted(0.1, 0.0, 0.0) == pytest.approx(0.15)
    assert split.adjusted(0.1, 0.7, 0.3) == 0.1
    assert split.adjusted(0.1, 0.83, 0.17) == 0.1
    counts = [("a", {0.1: (9, 1), 0.15000000000000002: (8, 2)}), ("b", {0.1: (9, 1), 0.15000000000000002: (8, 2)})]
    assert split.fold(counts, 0.1) == {"a": 0.15000000000000002, "b": 0.1}


def test_random_cells():
    assert len(split.random_cells(4, 0.15625, 1)) == 2
    assert len(split.random_cells(4, 0.001, 1)) == 1
    assert split.random_cells(4, 0.5, 7) == split.random_cells(4, 0.5, 7)


def test_choose_cells_covers_classes_first():
    shares = np.zeros((16, 3))
    shares[:, 0] = 1
    shares[5] = [0.4, 0.3, 0.3]
    target = shares.mean(axis=0)
    assert split.choose_cells(shares, target, 4, 64, 0.2)[0] == 5
    assert len(split.choose_cells(shares, target, 4, 64, 0.2)) == 3


def test_erosion(spark):
    d = spark.createDataFrame([(0.3,), (0.8,), (1.2,)], "px double").select(scalar.erosion_distance(F.col("px")).alias("d"), scalar.erosion_distance(F.col("px"), 1.0).alias("g")).collect()
    assert [r["d"] for r in d] == [0.3, 0.6, 0.0] and [r["g"] for r in d] == [0.5, 0.5, 0.0]
    ring = np.array([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], float)
    assert kernels.area(kernels.eroded([ring], 1.0)[0]) == pytest.approx(64)
    small = np.array([(0, 0), (3, 0), (3, 3), (0, 3), (0, 0)], float)
    assert kernels.eroded([small], 1.0)[0] is small


def test_band_statistics(spark):
    parts = spark.createDataFrame([("p", 1, 2, 3.0, 5.0, 1), ("p", 1, 2, 7.0, 25.0, 1)], "prefix string, band int, n long, s double, ss double, patches long")
    row = analysis.finalize(analysis.merge_partials(parts)).first()
    assert (row["mean"], row["std"], row["patches"]) == (2.5, pytest.approx(np.sqrt(1.25)), 2)


def test_packing(spark):
    df = spark.createDataFrame([(k, "trn", 5) for k in range(10)], "patch_ord long, split string, size_bytes long")
    rows = manifest.pack(df, 12).groupBy("shard_id").count().collect()
    assert sorted((r["shard_id"], r["count"]) for r in rows) == [(k, 2) for k in range(5)]
    big = spark.createDataFrame([(0, "trn", 20), (1, "trn", 1)], "patch_ord long, split string, size_bytes long")
    assert [r["shard_id"] for r in manifest.pack(big, 12).orderBy("patch_ord").collect()] == [1, 2]


def test_overlay_and_clip(spark):
    f = spark.createDataFrame([(1, 0, 0.0, 0.0, 3.0, 3.0, 1), (2, 0, 1.0, 1.0, 6.0, 2.0, 3)], "feature_id long, image_id long, minx double, miny double, maxx double, maxy double, burn_val int")
    burned = {(r["x"], r["y"]): r["class_id"] for r in vector.overlay(f, images(spark, 8, 8)).collect()}
    assert burned[(1, 1)] == 3 and burned[(0, 0)] == 1
    cut = vector.clip_to_window(vector.window_features(f, images(spark, 8, 8), (4, 4), 4), (4, 4)).where("feature_id = 2").orderBy("x").collect()
    assert [(r["cminx"], r["cmaxx"], r["is_truncated"]) for r in cut if r["y"] == 0] == [(1.0, 4.0, True), (4.0, 6.0, True)]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 2**31), st.floats(0.05, 0.95))
def test_distance(h, w, seed, share):
    mask = np.random.default_rng(seed).random((h, w)) < share
    got = kernels.distance(mask)
    ys, xs = np.nonzero(~mask)
    if not len(ys):
        assert not got.any()
        return
    yy, xx = np.mgrid[:h, :w]
    assert np.allclose(got, np.sqrt(((yy[..., None] - ys) ** 2 + (xx[..., None] - xs) ** 2).min(axis=-1)))


def test_signed_distance():
    mask = np.zeros((5, 5), bool)
    mask[1:4, 1:4] = True
    field = kernels.signed_distance(mask)
    assert field[2, 2] == 1.0 and field[0, 0] == pytest.approx(-np.sqrt(2) / 2)


def test_polygon_mask_of_triangle_with_hole():
    outer = np.array([(0, 0), (10, 0), (0, 10), (0, 0)], float)
    hole = np.array([(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)], float)
    mask = kernels.polygon_mask([outer, hole], 12, 12)
    assert mask[0, 0] and not mask[1, 1] and not mask[9, 9] and mask[4, 4] and not mask[11, 11]


def test_lzw():
    rng = np.random.default_rng(0)
    for data in (b"", b"a", bytes(5000), rng.integers(0, 3, 20000).astype(np.uint8).tobytes(), rng.integers(0, 256, 20000).astype(np.uint8).tobytes()):
        assert geotiff.unlzw(geotiff.lzw(data)) == data


def test_arrays_and_png():
    x = np.arange(12, dtype=np.int16).reshape(3, 4)
    assert np.array_equal(shards.decode_array(shards.encode_array(x)), x) and np.array_equal(shards.from_npy(shards.npy(x)), x)
    assert png.png(png.gallery([png.displayed(np.zeros((3, 4, 4), np.uint8))] * 5)).startswith(b"\x89PNG")


def test_wkb():
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    assert vectors.wkb_polygons(vectors.polygon_wkb([ring])) == [[ring]]
    assert vectors.wkb_polygons(b"") == []


def test_geojson_label(spark, tmp_path):
    multi = {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}
    found = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": 1, "b": None}, "geometry": multi}, {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [0, 0]}}, {"type": "Feature", "properties": None, "geometry": None}]}
    (tmp_path / "x.geojson").write_text(json.dumps(found))
    rows = vectors.read_vectors(spark, str(tmp_path / "x.geojson"))
    assert rows.count() == 2 and rows.first()["srid"] == 4326
    box = vectors.extents(rows).first()
    assert (box["minx"], box["maxx"]) == (0.0, 6.0)
    with pytest.raises(ValueError):
        vectors.read_vectors(spark, "x.shp")


def test_stac_missing_band(spark):
    item = json.dumps({"type": "Feature", "assets": {"B": {"href": "b.tif", "eo:bands": [{"common_name": "blue"}]}}})
    df = spark.createDataFrame([(1, item)], "k int, item string")
    assert stac.requested(df, "item", ["blue"]).first()["band"] == 1
    with pytest.raises(Exception, match="not available"):
        stac.requested(df, "item", ["blue", "red"]).collect()


def test_band_projection_repeats(spark):
    px = spark.createDataFrame([(0, 1, 0, 0, 5.0), (0, 2, 0, 0, 6.0)], "image_id long, band int, x long, y long, v double")
    assert [(r["band"], r["v"]) for r in bands.project(px, [2, 2, 1]).orderBy("band").collect()] == [(1, 6.0), (2, 6.0), (3, 5.0)]


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("connection reset")
        return 7

    assert retry(flaky, sleep=lambda s: None) == 7
    with pytest.raises(ValueError):
        retry(lambda: (_ for _ in ()).throw(ValueError("bad data")), sleep=lambda s: None)


def test_ragged_index(spark, tmp_path):
    (tmp_path / "i.txt").write_text("a.tif;b.tif\na.tif;b.tif;t.tif;v.geojson\na.tif;b.tif;v.geojson\n")
    rows = [(r["image"], r["targets"], r["vector"]) for r in read_index(spark, str(tmp_path / "i.txt")).collect()]
    assert rows == [("a.tif", [], None), ("a.tif", ["t.tif"], "v.geojson"), ("a.tif", [], "v.geojson")]


def test_growth(spark, tmp_path):
    from rastermill.plans.state import State
    from rastermill.streaming.growth import grow

    rng = np.random.default_rng(2)
    move = (0.5, 0.0, 100.0, 0.0, -0.5, 200.0)
    (tmp_path / "pairs").mkdir()

    def add(k):
        for name in ("im", "lab"):
            (tmp_path / f"{name}{k}.tif").write_bytes(geotiff.write(rng.integers(0, 4, (1, 32, 32)).astype(np.uint8), move, 32618))
        (tmp_path / f"pairs/{k}.json").write_text(json.dumps({"image": str(tmp_path / f"im{k}.tif"), "label": str(tmp_path / f"lab{k}.tif"), "metadata": {"collection": "c"}}))

    run = lambda: grow(spark, str(tmp_path / "pairs"), str(tmp_path / "check"), (16, 16), output_dir=str(tmp_path / "out"), prefix="g", grid_size=2).awaitTermination()
    add(0)
    run()
    add(1)
    run()
    state = State(spark, str(tmp_path / "out/g/state"))
    assert {r["image_id"] for r in state.read("patches").select("image_id").distinct().collect()} == {"im0", "im1"}
    assert state.read("patches").count() == 8


def test_pad_patch_of_a_cut_image_is_its_sql(spark, tmp_path):
    import duckdb

    from rastermill.queries import ORACLE_SQL, QUERIES

    duckdb.sql("SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet' WHERE vec_id < 150 OR vec_id = 260").write_parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.sql(f"SELECT key, x, y, v FROM ({ORACLE_SQL['pad_patch']})").fetchall()
    got = [tuple(r) for r in QUERIES["pad_patch"](spark, str(tmp_path)).select("key", "x", "y", "v").collect()]
    assert sorted(got) == sorted(want)
    assert len(want) == 70 * 130 + 70 * 25 + 70  # the whole image, one of 25 rows, one of a single row inside


def test_pad_patch_broadcasts_no_places_and_is_its_sql(spark, tmp_path):
    import duckdb

    from rastermill.queries import ORACLE_SQL, QUERIES

    odd = "SELECT * REPLACE (CASE WHEN vec_id < 3 THEN NULL ELSE -vec_id END AS vec_id) FROM e WHERE vec_id < 130"  # no image, pixels outside
    duckdb.sql("CREATE TABLE e AS FROM '/root/testdata/sf0.01/embeddings.parquet'")
    duckdb.sql(f"FROM e UNION ALL FROM e WHERE vec_id % 125 > 120 UNION ALL {odd}").write_parquet(f"{tmp_path}/embeddings.parquet")  # and rows that come twice
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.sql(f"SELECT key, x, y, v FROM ({ORACLE_SQL['pad_patch']})").fetchall()
    was = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "64k")
    try:
        got = [tuple(r) for r in QUERIES["pad_patch"](spark, str(tmp_path)).select("key", "x", "y", "v").collect()]
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", was)
    assert sorted(got) == sorted(want)


def test_padded_without_extent_goes_by_the_last_pixel(spark):
    rng = np.random.default_rng(3)
    patches = {k: rng.integers(0, 9, shape) for k, shape in enumerate([(1, 1), (3, 2), (2, 6), (7, 3), (4, 5)])}
    rows = [(k, x, y, int(a[y, x])) for k, a in patches.items() for y in range(a.shape[0]) for x in range(a.shape[1])]
    pixels = spark.createDataFrame(rows, "key long, x long, y long, v int")
    got = {(r["key"], r["x"], r["y"]): r["v"] for r in windows.padded(pixels, F.lit(5), F.lit(4)).collect()}
    padded = {k: np.pad(a, ((0, max(0, 4 - a.shape[0])), (0, max(0, 5 - a.shape[1]))), mode="edge") for k, a in patches.items()}
    assert got == {(k, x, y): a[y, x] for k, a in padded.items() for y in range(a.shape[0]) for x in range(a.shape[1])}


def test_shards_are_small_and_tarfile_reads_the_same(spark, tmp_path):
    import io
    import tarfile

    names = ["a" * 90 + ".x", "a" * 100, "b" * 150 + ".npy", "é.json", "d/e.x", "c.x"]
    items = [bytes([k]) * (700 * k) for k in range(len(names))]
    raw = b"".join(shards.tar_member(n, x) for n, x in zip(names, items, strict=True)) + bytes(1024)
    with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
        assert [(i.name, tar.extractfile(i).read()) for i in tar] == list(zip(names, items, strict=True))
    assert list(shards.tar_members(io.BytesIO(raw))) == list(zip(names, items, strict=True))
    info = tarfile.TarInfo("c.x")
    info.size = 5
    assert shards.tar_member("c.x", b"12345")[:512] == info.tobuf()

    def files(folder, end):
        n = 3000
        log = spark.range(n).select(F.lit("trn").alias("split"), F.lit(0).alias("shard_id"), F.lit(f"s.tar{end}").alias("file"), F.col("id").alias("patch_ord"), F.format_string("p%05d", "id").alias("patch_id"), F.create_map(F.lit("m.json"), F.encode(F.col("id").cast("string"), "UTF-8")).alias("members"))
        (row,) = shards.write_shards(log, str(folder)).collect()
        back = shards.read_shards(spark, [row["path"]]).collect()
        assert [(r["patch_id"], r["members"]) for r in back] == [(f"p{k:05d}", {"m.json": bytearray(str(k).encode())}) for k in range(n)]
        assert row["patch_count"] == n and row["size_bytes"] == (folder / "trn" / f"s.tar{end}").stat().st_size
        return row["size_bytes"]

    assert files(tmp_path / "plain", "") > 3000 * 1024
    assert files(tmp_path / "packed", ".zst") < 3000 * 60
