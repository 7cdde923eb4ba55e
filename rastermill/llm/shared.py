"""Shared folder, stored intermediates and batch slicing for the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where it is unset: a temporary folder in plain local mode, else the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-cluster"):
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="rastermill-")
        else:
            _OWN[app] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; removed when the application ends."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/rastermill/{name}-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    fs.deleteOnExit(target)
    # With its scheme, so that Spark and pyarrow mean the same file system.
    return fs.makeQualified(target).toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again.

    This cuts the lineage and survives the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def resolved(path: str):
    """pyarrow's file system and path of a path that Spark's tasks see; one without scheme is local, s3a is s3."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a stored table whose readers have all finished."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/rastermill/" in folder:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(conf).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with underscores, such that df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_bytes(batch: pa.RecordBatch, column: str) -> list[int]:
    """UTF-8 bytes of each row's text, 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()


def spans(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a larger row stands alone."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one Arrow's unused memory goes back, since the worker stays for other stages."""
    yield from batches
    pa.default_memory_pool().release_unused()


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `limit` bytes of text at most."""
    for batch in released(batches):
        if batch.num_rows:
            for lo, hi in spans(row_bytes(batch, column), limit):
                yield batch.slice(lo, hi - lo)


def utf8(column: pa.Array) -> tuple:
    """(bytes as uint8 array, row offsets starting at 0) of a string column; null counts as empty."""
    import numpy as np
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
