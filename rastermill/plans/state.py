"""Dataset state: append-only Parquet batches, published by one small commit file each.

A batch is written below batch=<n> of each table and counts only once _commits/<n>.json is there, which a rename
puts in place. A run that dies in between leaves files that no reader sees and the next run replaces.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis, manifest
from ..sources.files import read_bytes, resolve, write_bytes

TABLES = {
    "image_log": "image_id string, status string, reason string, ts timestamp, seq long",
    "patches": "image_id string, x long, y long, split string, shard_id int, size_bytes long",
    "shards": "split string, shard_id int, path string, size_bytes long, patch_count long, status string, images array<string>",
    "band_stats": "prefix string, band int, n long, s double, ss double, patches long",
    "val_cells": "image_id string, cell_id string, ratio double",
    "class_shares": "image_id string, class_name string, share double",
}


class State:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def commits(self) -> list[int]:
        fs, at = resolve(self.folder + "/_commits")
        found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        return sorted(int(f.base_name.split(".")[0]) for f in found if f.base_name.endswith(".json"))

    def tables(self, batch: int) -> list[str]:
        """The tables of a committed batch."""
        return json.loads(read_bytes(f"{self.folder}/_commits/{batch}.json"))["tables"]

    def read(self, name: str) -> DataFrame:
        """The committed rows of a table."""
        paths = []
        for n in self.commits():
            if name in self.tables(n):
                paths.append(f"{self.folder}/{name}/batch={n}")
        if not paths:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*paths)

    def stage(self, batch: int, name: str, df: DataFrame) -> DataFrame:
        """Write a table's rows of a batch that is not committed yet, and read them."""
        path = f"{self.folder}/{name}/batch={batch}"
        columns = [c.split(" ")[0] for c in TABLES[name].split(", ")]
        df.select(*columns).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(TABLES[name]).parquet(path)

    def commit(self, batch: int, tables: list[str]) -> None:
        note = {"batch": batch, "tables": tables, "created_at": datetime.now(UTC).isoformat()}
        write_bytes(f"{self.folder}/_commits/{batch}.json", json.dumps(note).encode())

    def next_batch(self) -> int:
        return max(self.commits(), default=-1) + 1

    def statistics(self) -> list[dict]:
        """Mean and deviation of each band; a few rows for each prefix."""
        rows = analysis.finalize(analysis.merge_partials(self.read("band_stats"))).orderBy("prefix", "band").collect()
        return [r.asDict() for r in rows]

    def consistency(self) -> DataFrame:
        patches = self.read("patches")
        count = lambda df: df.groupBy("split").agg(F.count("*").alias("n"))
        shards = self.read("shards").select("split", F.col("patch_count").alias("n"))
        running = self.read("band_stats").where("band = 1").select(F.lit("trn").alias("split"), F.col("patches").alias("n"))
        return manifest.consistency(count(patches), shards, count(patches), running)

    def snapshot(self, dataset: dict) -> dict:
        """The whole state as one document; shards and counts only, so its size follows the number of images and shards."""
        shards = [r.asDict() for r in self.read("shards").orderBy("split", "shard_id").collect()]
        status = {r["status"]: r["n_images"] for r in manifest.status_counts(self.read("image_log")).collect()}
        splits = {r["split"]: {"patches": r["n"], "share": r["share"]} for r in manifest.split_counts(self.read("patches")).collect()}
        return {"dataset_info": dataset, "shards": shards, "statistics": splits, "images": status, "running_statistics": self.statistics()}
