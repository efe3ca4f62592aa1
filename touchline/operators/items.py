"""items table (P12): purchase events, one row per item. The explode is inner:
purchases with an empty or NULL items array produce no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import shard_to_date
from touchline.schema import ITEM_COLUMNS


def purchase_items(raw: DataFrame) -> DataFrame:
    item = F.col("item")
    return (
        raw.where(F.col("event_name") == F.lit("purchase"))
        .select(shard_to_date(F.col("event_date")).alias("date"), F.explode(F.col("items")).alias("item"))
        .select(
            "date",
            item.getField("item_name").alias("item_name"),
            item.getField("item_variant").alias("item_variant"),
            item.getField("quantity").alias("item_quantity"),
            item.getField("item_revenue").alias("item_revenue"),
        )
        .select(*ITEM_COLUMNS)
    )
