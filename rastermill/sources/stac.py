"""Single-band assets of STAC items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import COMMON_NAMES

ITEM = "type string, id string, assets map<string,struct<href:string,description:string,`eo:bands`:array<struct<common_name:string,center_wavelength:double,full_width_half_max:double>>>>"


def is_item(column: str):
    """Whether a JSON text is a STAC item."""
    return F.coalesce(F.get_json_object(column, "$.type") == "Feature", F.lit(False)) & F.get_json_object(column, "$.assets").isNotNull()


def assets(items: DataFrame, column: str) -> DataFrame:
    """items' other columns and (common_name, asset, href, meta) of each asset with exactly one band of a known name.

    Of several assets with one name the last in the document counts. An item without any gives no row.
    """
    keys = [c for c in items.columns if c != column]
    parsed = items.select(*keys, F.from_json(column, ITEM).alias("_item")).select(*keys, F.posexplode(F.map_entries("_item.assets")).alias("_place", "_asset"))
    bands = F.col("_asset.value").getField("eo:bands")
    named = parsed.where((F.size(bands) == 1) & bands[0]["common_name"].isin(*COMMON_NAMES))
    row = F.struct(F.col("_asset.key").alias("asset"), F.col("_asset.value.href").alias("href"), bands[0].alias("meta"))
    return named.groupBy(*keys, bands[0]["common_name"].alias("common_name")).agg(F.max_by(row, "_place").alias("_row")).select(*keys, "common_name", "_row.*")


def requested(items: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """The assets in the order of `wanted`, with band numbers from 1; missing names raise an error at run time."""
    keys = [c for c in items.columns if c != column]
    found = assets(items, column)
    have = found.groupBy(*keys).agg(F.collect_set("common_name").alias("have"))
    missing = F.array_except(F.array(*map(F.lit, wanted)), F.coalesce("have", F.array().cast("array<string>")))
    message = F.concat(F.lit("bands not available: "), F.array_join(missing, ", "))
    checked = items.select(*keys).join(have, keys, "left").where(F.when(F.size(missing) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))) if keys else found
    number = F.array_position(F.array(*map(F.lit, wanted)), F.col("common_name")).cast("int")
    out = found.join(checked.select(*keys), keys) if keys else found
    return out.where(F.col("common_name").isin(wanted)).withColumn("band", number)
