"""Rules of the tiler that need files of their own: which label a pair gets, nodata, shard sizes, remote input."""

import json
import sqlite3
import threading
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest

from rastermill.plans import tiler as plan
from rastermill.plans.tiler import Tiler
from rastermill.sources import files, geotiff, shards, vectors

from .test_tiler import MOVE, SETTINGS, square


def collection(*boxes):
    features = [{"type": "Feature", "properties": {"kind": kind}, "geometry": {"type": "Polygon", "coordinates": [square(*box)]}} for kind, box in boxes]
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32618"}}, "features": features}


def image(path, nodata=None, seed=1):
    x = np.random.default_rng(seed).integers(1, 200, (4, 64, 64)).astype(np.uint8)
    if nodata is not None:
        x[:, :32, :] = nodata
    path.write_bytes(geotiff.write(x, MOVE, 32618, nodata))
    return str(path)


def labels(spark, tiler):
    paths = [r["path"] for r in tiler.state.read("shards").collect()]
    out = {}
    for s in shards.read_shards(spark, paths).collect():
        note = json.loads(s["members"]["metadata.json"])["patch_metadata"]
        out[note["image_name"], *note["pixel_coordinates"]] = shards.from_npy(s["members"]["label_patch.npy"])[0]
    return out


def test_labels_of_one_name_in_two_folders(spark, tmp_path):
    pairs = []
    for k, box in (("p", (0, 0, 64, 64)), ("q", (0, 0, 64, 64))):
        (tmp_path / k).mkdir()
        (tmp_path / k / "lab.geojson").write_text(json.dumps(collection(("road" if k == "p" else "building", box))))
        pairs.append({"image": image(tmp_path / f"im_{k}.tif"), "label": str(tmp_path / k / "lab.geojson"), "metadata": {"note": 'é "x"\n😀'}})
    settings = SETTINGS | {"stride": 32, "label_threshold": None}
    tiler = Tiler(spark, pairs, (32, 32), output_dir=str(tmp_path / "out"), prefix="p", **settings)
    assert tiler.create_tiles()["successful"] == 2
    found = labels(spark, tiler)
    assert {int(v) for (name, *_), x in found.items() if name == "im_p" for v in np.unique(x)} == {1}
    assert {int(v) for (name, *_), x in found.items() if name == "im_q" for v in np.unique(x)} == {2}
    # A patch counts for the arrays' bytes and its metadata as JSON.
    sizes = {(r["image_id"], r["x"], r["y"]): r["size_bytes"] for r in tiler.state.read("patches").collect()}
    for s in shards.read_shards(spark, [r["path"] for r in tiler.state.read("shards").collect()]).collect():
        m = s["members"]
        note = json.loads(m["metadata.json"])["patch_metadata"]
        want = sum(shards.from_npy(m[f"{k}_patch.npy"]).nbytes for k in ("image", "label")) + len(m["metadata.json"])
        assert sizes[note["image_name"], *note["pixel_coordinates"]] == want


def test_vector_labels_do_not_count_over_nodata(spark, tmp_path):
    (tmp_path / "lab.geojson").write_text(json.dumps(collection(("road", (0, 0, 64, 64)))))
    pairs = [{"image": image(tmp_path / "im.tif", nodata=0), "label": str(tmp_path / "lab.geojson"), "metadata": {}}]
    tiler = Tiler(spark, pairs, (32, 32), output_dir=str(tmp_path / "out"), prefix="n", **(SETTINGS | {"stride": 32, "val_ratio": 0.1}))
    tiler.create_tiles()
    assert {(r["x"], r["y"]) for r in tiler.state.read("patches").collect()} == {(0, 32), (32, 32)}


def test_only_the_first_label_layer_counts(spark, tmp_path):
    ring = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]
    wide = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 0.0]]
    path = tmp_path / "a.gpkg"
    path.write_bytes(vectors.write_geopackage([([wide], {})], 3857, "Valid_Extent"))
    for name, shape in (("first", ring), ("second", wide)):
        (tmp_path / "more.bin").write_bytes(vectors.write_geopackage([([shape], {})], 3857, name))
        db = sqlite3.connect(path)
        db.execute("ATTACH ? AS m", (str(tmp_path / "more.bin"),))
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM m.{name}")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', 3857, 0, 0)", (name,))
        db.commit()
        db.close()
    found = vectors.read_geopackage(spark, str(path))
    assert [r["layer"] for r in vectors.usable(found).collect()] == ["first"]
    box = vectors.extents(found).first()
    assert (box["maxx"], box["maxy"]) == (9.0, 9.0)
    assert vectors.extents(found.where("layer_no IS NOT NULL")).first()["maxx"] == 4.0


def test_a_died_run_leaves_no_double_index_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "lab.geojson").write_text(json.dumps(collection(("road", (0, 0, 64, 64)))))
    pairs = [{"image": image(tmp_path / "im.tif"), "label": str(tmp_path / "lab.geojson"), "metadata": {}}]
    tiler = Tiler(spark, pairs, (32, 32), output_dir=str(tmp_path / "out"), prefix="c", output_format="csv", **(SETTINGS | {"stride": 32, "label_threshold": None}))
    with monkeypatch.context() as m:
        m.setattr(tiler.state, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            tiler.create_tiles()
    assert tiler.index_paths() == []
    tiler.create_tiles()
    assert spark.read.text(tiler.index_paths()).count() == 4 == spark.read.text(str(tmp_path / "out/c/index")).count()


def test_all_failures_are_reported(spark, tmp_path):
    pairs = [{"image": str(tmp_path / f"none{k}.tif"), "label": str(tmp_path / "none.doc"), "metadata": {}} for k in range(1100)]
    out = Tiler(spark, pairs, (8, 8), output_dir=str(tmp_path / "out"), prefix="f").create_tiles()
    assert out["failed"] == 1100 == len(out["reasons"])


class Ranged(SimpleHTTPRequestHandler):
    """Serves byte ranges where the path has none of `plain`, as object stores do."""

    def log_message(self, *_):
        pass

    def do_GET(self):
        wanted = self.headers.get("Range")
        if not wanted or "plain" in self.path or "missing" in self.path:
            return super().do_GET()
        with open(self.translate_path(self.path), "rb") as f:
            data = f.read()
        first, _, last = wanted.removeprefix("bytes=").partition("-")
        part = data[int(first) : int(last) + 1 if last else None]
        self.send_response(206)
        self.send_header("Content-Range", f"bytes {first}-{int(first) + len(part) - 1}/{len(data)}")
        self.send_header("Content-Length", str(len(part)))
        self.end_headers()
        self.wfile.write(part)


@pytest.fixture
def server(tmp_path):
    made = ThreadingHTTPServer(("127.0.0.1", 0), partial(Ranged, directory=str(tmp_path)))
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}"
    made.shutdown()


def test_http_ranges(tmp_path, server):
    data = bytes(range(256)) * 10
    for name in ("a.bin", "plain.bin"):
        (tmp_path / name).write_bytes(data)
        assert files.read_bytes(f"{server}/{name}") == data and files.read_bytes(f"{server}/{name}", 100, 7) == data[100:107]
    with pytest.raises(Exception, match="404"):
        files.read_bytes(f"{server}/missing")
    assert files.plain_uri("s3a://bucket/key") == files.plain_uri("s3://bucket/key") == "s3://bucket/key"


def test_stac_item_behind_http(spark, tmp_path, server):
    x = np.random.default_rng(3).integers(1, 200, (2, 64, 64)).astype(np.uint8)
    for k, name in enumerate(("red", "nir")):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.write(x[k : k + 1], MOVE, 32618))
    assets = {n: {"href": f"{server}/{n}.tif", "eo:bands": [{"common_name": n}]} for n in ("red", "nir")}
    (tmp_path / "item1").write_text(json.dumps({"type": "Feature", "assets": assets}))
    (tmp_path / "lab.geojson").write_text(json.dumps(collection(("road", (0, 0, 64, 64)))))
    pairs = [{"image": f"{server}/item1", "label": str(tmp_path / "lab.geojson"), "metadata": {}}]
    tiler = Tiler(spark, pairs, (32, 32), output_dir=str(tmp_path / "out"), prefix="s", bands_requested=["nir", "red"], **(SETTINGS | {"stride": 32}))
    assert tiler.create_tiles()["successful"] == 1
    paths = [r["path"] for r in tiler.state.read("shards").collect()]
    for s in shards.read_shards(spark, paths).collect():
        a, b = json.loads(s["members"]["metadata.json"])["patch_metadata"]["pixel_coordinates"]
        assert np.array_equal(shards.from_npy(s["members"]["image_patch.npy"]), x[::-1, b : b + 32, a : a + 32])


def test_listed_features_are_those_of_a_scan(tmp_path):
    rng = np.random.default_rng(4)
    made = []
    for k in range(400):
        a, b, w, h = *rng.uniform(-50, 900, 2), *rng.uniform(1, 300, 2)
        ring = [[a, b], [a + w, b], [a + w, b + h], [a, b + h], [a, b]]
        made.append({"properties": {"k": str(k)}, "box": [a, b, a + w, b + h], "rings": [ring]})
    path = str(tmp_path / "v.json")
    files.write_bytes(path, json.dumps(made).encode())
    for x, y, w, h in ((0, 0, 64, 64), (250, 500, 300, 20), (512, 256, 256, 256)):
        got = plan._patch_features(path, x, y, w, h, (1.0, 0, float(x), 0, 1.0, float(y)), None)
        want = [f["properties"]["k"] for f in made if f["box"][0] <= x + w and f["box"][2] >= x and f["box"][1] <= y + h and f["box"][3] >= y]
        assert [f["properties"]["k"] for f in got["features"]] == want
