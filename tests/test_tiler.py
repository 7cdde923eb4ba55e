import json

import numpy as np
import pytest

from rastermill.plans.tiler import Tiler
from rastermill.sources import geotiff, shards, vectors
from rastermill.sources.csv_index import read_index

MOVE = (0.5, 0.0, 100.0, 0.0, -0.5, 200.0)


def square(x, y, w, h):
    """A rectangle in pixels as a ring in map units."""
    pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return [[MOVE[2] + MOVE[0] * a, MOVE[5] + MOVE[4] * b] for a, b in pts]


@pytest.fixture
def inputs(tmp_path):
    rng = np.random.default_rng(5)
    pairs = []
    for k in range(3):
        image = rng.integers(1, 200, (4, 70, 64)).astype(np.uint8)
        if k == 1:
            image[:, :4, :4] = 0
        (tmp_path / f"im{k}.tif").write_bytes(geotiff.write(image, MOVE, 32618, 0 if k == 1 else None))
        label = (rng.random((70, 64)) < 0.4).astype(np.uint8) * rng.integers(1, 5, (70, 64)).astype(np.uint8)
        (tmp_path / f"lab{k}.tif").write_bytes(geotiff.write(label, MOVE, 32618))
        pairs.append({"image": str(tmp_path / f"im{k}.tif"), "label": str(tmp_path / f"lab{k}.tif"), "metadata": {"collection": "c", "gsd": 0.5}})
    features = [{"type": "Feature", "properties": {"kind": kind}, "geometry": {"type": "Polygon", "coordinates": [square(*box)]}} for kind, box in [("road", (3.25, 3.25, 30, 6)), ("building", (20.25, 5.25, 20, 20)), ("other", (1, 1, 60, 60)), ("building", (44.25, 5.25, 10, 20))]]
    found = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32618"}}, "features": features}
    (tmp_path / "vec.geojson").write_text(json.dumps(found))
    (tmp_path / "im9.tif").write_bytes(geotiff.write(rng.integers(1, 200, (4, 70, 64)).astype(np.uint8), MOVE, 32618))
    pairs.append({"image": str(tmp_path / "im9.tif"), "label": str(tmp_path / "vec.geojson"), "metadata": {}})
    (tmp_path / "bad.tif").write_bytes(b"not a tiff")
    pairs.append({"image": str(tmp_path / "bad.tif"), "label": str(tmp_path / "lab0.tif"), "metadata": {}})
    far = (0.5, 0.0, 9000.0, 0.0, -0.5, 200.0)
    (tmp_path / "far.tif").write_bytes(geotiff.write(np.ones((4, 70, 64), np.uint8), far, 32618))
    pairs.append({"image": str(tmp_path / "far.tif"), "label": str(tmp_path / "lab0.tif"), "metadata": {}})
    return tmp_path, pairs


SETTINGS = {"stride": 16, "grid_size": 4, "val_ratio": 0.2, "label_threshold": 0.05, "attr_field": ["kind"], "attr_values": ["road", "building"], "building_class_val": 2, "road_class_val": 1}


def test_tar_run_resume_and_retry(spark, inputs):
    folder, pairs = inputs
    tiler = Tiler(spark, pairs, (32, 32), output_dir=str(folder / "out"), prefix="p", shard_limit=60_000, **SETTINGS)
    first = tiler.create_tiles()
    assert (first["total"], first["successful"], first["failed"], first["skipped"]) == (6, 4, 1, 1), first
    patches = tiler.state.read("patches").collect()
    assert {r["split"] for r in patches} == {"trn", "val"}
    keys = {(r["image_id"], r["x"], r["y"]) for r in patches}
    assert len(keys) == len(patches)
    shard_rows = tiler.state.read("shards").collect()
    assert sum(r["patch_count"] for r in shard_rows) == len(patches) and len(shard_rows) > 2
    assert all(not r["issues"] for r in tiler.state.consistency().collect())
    samples = shards.read_shards(spark, [r["path"] for r in shard_rows]).collect()
    assert len(samples) == len(patches)
    arrays = {name: geotiff.read(str(folder / f"im{name}.tif"))[1] for name in (0, 1, 2, 9)}
    labels = {name: geotiff.read(str(folder / f"lab{name}.tif"))[1][0] for name in (0, 1, 2)}
    sums = np.zeros(4)
    for s in samples:
        note = json.loads(s["members"]["metadata.json"])["patch_metadata"]
        x, y = note["pixel_coordinates"]
        image = shards.from_npy(s["members"]["image_patch.npy"])
        label = shards.from_npy(s["members"]["label_patch.npy"])
        k = int(note["image_name"][2:])
        whole = np.zeros((4, 32, 32), np.uint8)
        # The vector layer spans pixels 1 to 61, and the pair is cut to what both have.
        source = arrays[k][:, 1:61, 1:61] if k == 9 else arrays[k]
        part = source[:, y : y + 32, x : x + 32]
        whole[:, : part.shape[1], : part.shape[2]] = part
        assert np.array_equal(image, whole)
        if k in labels:
            want = np.zeros((32, 32), np.uint8)
            cut = labels[k][y : y + 32, x : x + 32]
            want[: cut.shape[0], : cut.shape[1]] = cut
            if k == 1:
                want[(whole == 0).all(axis=0)] = 255
            assert np.array_equal(label[0], want)
        else:
            assert {"building_edt.npy", "building_sdf.npy", "roads_centerline_weight.npy", "vectors.geojson"} <= set(s["members"])
        if note["split"] == "trn":
            sums += image.astype(float).sum(axis=(1, 2))
    stats = json.loads((folder / "out/p/p_normalization_stats.json").read_text())["statistics"]
    n_train = sum(r["split"] == "trn" for r in patches)
    assert np.allclose([r["mean"] for r in stats], sums / (n_train * 1024))
    again = tiler.create_tiles()
    assert again["successful"] == 0 and again["already_done"] == 4
    assert tiler.state.read("patches").count() == len(patches)
    (folder / "bad.tif").write_bytes(geotiff.write(np.ones((4, 70, 64), np.uint8), MOVE, 32618))
    retried = tiler.retry_failed_images(sleep=lambda s: None)
    assert retried["still_failed"] == [] and retried["successful"] == 1
    more = tiler.state.read("shards").collect()
    assert len({(r["split"], r["shard_id"]) for r in more}) == len(more)


def test_csv_run(spark, inputs):
    folder, pairs = inputs
    tiler = Tiler(spark, pairs[:1] + pairs[3:4], (32, 32), output_dir=str(folder / "out"), prefix="c", output_format="csv", val_strategy="random", val_seed=3, **SETTINGS)
    assert tiler.create_tiles()["successful"] == 2
    lines = read_index(spark, tiler.index_paths()).collect()
    assert len(lines) == tiler.state.read("patches").count()
    head, data = geotiff.read(str(folder / "out/c" / lines[0]["image"]))
    assert data.shape == (4, 32, 32) and head.srid == 32618


def test_settings():
    with pytest.raises(ValueError):
        Tiler(None, [{"image": "a/x.tif", "label": "l"}, {"image": "b/x.tif", "label": "l"}], (8, 8), output_dir="/tmp/x")
    with pytest.raises(ValueError):
        Tiler(None, [], (8, 8), output_dir="/tmp/x", output_format="zip")


def test_geopackage(spark, tmp_path):
    ring = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]
    bow = [[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 2.0], [0.0, 0.0]]
    (tmp_path / "a.gpkg").write_bytes(vectors.write_geopackage([([ring], {"kind": "x"}), ([bow], {"kind": "y"})], 3857))
    rows = vectors.read_geopackage(spark, str(tmp_path)).orderBy("feature_id").collect()
    assert [r["srid"] for r in rows] == [3857, 3857] and rows[0]["rings"] == [ring] and rows[0]["props"]["kind"] == "x"
    assert rows[0]["reason"] is None and "self" in rows[1]["reason"]


def test_data_source(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 99, (3, 50, 20)).astype(np.int16)
    (tmp_path / "a.tif").write_bytes(geotiff.write(x, MOVE, 32618, -1))
    geotiff.register(spark)
    rows = spark.read.format("geotiff").option("rows", 16).option("bands", "3,1").load(str(tmp_path)).orderBy("row_off").collect()
    assert [r["h"] for r in rows] == [16, 16, 16, 2]
    back = np.concatenate([np.frombuffer(r["data"], "<i2").reshape(2, r["h"], 20) for r in rows], axis=1)
    assert np.array_equal(back, x[[2, 0]])
    head = geotiff.headers(spark, str(tmp_path)).first()
    assert (head["width"], head["height"], head["nodata"], head["srid"], head["error"]) == (20, 50, -1.0, 32618, None)
