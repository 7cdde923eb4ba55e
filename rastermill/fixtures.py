"""Virtual rasters, features and logs over the driver's tables, for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PIXELS = {
    "spark": "embeddings LATERAL VIEW posexplode(embedding) e AS p, v",
    "duckdb": "(SELECT vec_id, label, unnest(embedding) AS v, unnest(range(64)) AS p FROM embeddings)",
}
_D = {"spark": lambda x: f"{x}D", "duckdb": lambda x: f"CAST({x} AS DOUBLE)"}


def definitions(dialect: str) -> dict[str, str]:
    """SQL of every virtual table."""
    px, d = _PIXELS[dialect], _D[dialect]
    return {
        "px1": f"SELECT CAST(floor(vec_id/125) AS BIGINT) image_id, CAST(p AS BIGINT) x, CAST(vec_id % 125 AS BIGINT) y, label, CAST(v AS DOUBLE) v FROM {px}",
        "px4": f"SELECT CAST(floor(vec_id/125) AS BIGINT) image_id, CAST(1+floor(p/16) AS INT) band, CAST(p % 16 AS BIGINT) x, CAST(vec_id % 125 AS BIGINT) y, CAST(v AS DOUBLE) v FROM {px}",
        "lab1": f"SELECT CAST(floor(vec_id/125) AS BIGINT) image_id, CAST(p AS BIGINT) x, CAST(vec_id % 125 AS BIGINT) y, CAST(CASE WHEN v > 0 THEN label % 5 ELSE 0 END AS INT) class_id FROM {px}",
        "feat": f"""SELECT CAST(p_partkey AS BIGINT) feature_id, CAST(p_partkey % 4 AS BIGINT) image_id,
            (p_partkey*37 % 60)+{d('0.25')} minx, (p_partkey*53 % 120)+{d('0.25')} miny,
            (p_partkey*37 % 60)+{d('0.25')}+1+p_size % 7 maxx, (p_partkey*53 % 120)+{d('0.25')}+1+p_size % 5 maxy,
            p_type class_name, CAST(p_size AS INT) size FROM part""",
        "pair_meta": """SELECT s_suppkey pair_ord, CASE WHEN s_suppkey % 11 = 0 THEN 0 ELSE 100 END img_w, 100 img_h,
            CASE WHEN s_suppkey % 13 = 0 THEN 90 ELSE 100 END lab_w, CASE WHEN s_suppkey % 17 = 0 THEN 0 ELSE 100 END lab_h,
            CASE WHEN s_nationkey % 5 = 0 THEN CAST(NULL AS INT) ELSE 3857 END img_srid,
            CASE WHEN s_suppkey % 7 = 0 THEN CAST(NULL AS INT) ELSE 3857 END lab_srid,
            CASE WHEN s_suppkey % 3 = 0 THEN 'vector' ELSE 'raster' END label_type,
            CAST(s_suppkey*10 % 100 AS DOUBLE) iminx, CAST(s_suppkey*10 % 100 + 100 AS DOUBLE) imaxx,
            CAST(n_nationkey*20 AS DOUBLE) lminx, CAST(n_nationkey*20+150 AS DOUBLE) lmaxx
            FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
        "image_log": """SELECT o_custkey image_id, o_orderkey seq, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed' ELSE 'in_progress' END status,
            o_orderpriority reason, o_orderdate ts FROM orders""",
        "patch_log": """SELECT l_orderkey image_id, l_partkey x, l_suppkey y,
            CASE WHEN l_linenumber<=5 THEN 'trn' WHEN l_linenumber=6 THEN 'val' ELSE 'tst' END split,
            CAST(floor(l_orderkey/5000) AS INT) shard_id, CAST(l_quantity*1024 AS BIGINT) size_bytes FROM lineitem""",
        "patch_stream": """SELECT event_id patch_ord, ts, user_id image_id,
            CASE event_type WHEN 'view' THEN 'val' WHEN 'error' THEN 'tst' ELSE 'trn' END split,
            CAST(floor(value*1000) AS BIGINT) size_bytes FROM events""",
    }


_SOURCES = {"px1": "embeddings", "px4": "embeddings", "lab1": "embeddings", "feat": "part", "pair_meta": "supplier nation", "image_log": "orders", "patch_log": "lineitem", "patch_stream": "events"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One virtual table as a DataFrame."""
    for source in _SOURCES[name].split():
        spark.read.parquet(f"{sf_dir}/{source}.parquet").createOrReplaceTempView(source)
    return spark.sql(definitions("spark")[name])


def with_ctes(names: str, query: str, recursive: bool = False) -> str:
    """DuckDB SQL of a query over some virtual tables."""
    found = definitions("duckdb")
    ctes = ", ".join(f"{n} AS ({found[n]})" for n in names.split())
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{', ' if not query.lstrip().upper().startswith('SELECT') else ' '}{query}"
