"""Keep one row per product, with every tie decided.

``row_number() = 1`` lets Spark keep one row per product already before the shuffle,
so a product listed millions of times costs no more than one listed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import SHOP_W


def _keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def latest_cheapest(
    rows: DataFrame, keys: tuple[str, ...] = ("product_name",), prefer_priced: bool = False
) -> DataFrame:
    """Newest load, then lowest price. A missing price counts as lowest unless
    ``prefer_priced`` is set."""
    price = F.col("sale_price")
    return _keep_first(
        rows,
        list(keys),
        [
            F.col("ingest_timestamp_utc").desc_nulls_first(),
            price.asc_nulls_last() if prefer_priced else price.asc_nulls_first(),
        ],
    )


def latest_per_product(
    rows: DataFrame, keys: tuple[str, ...] = ("product_name",)
) -> DataFrame:
    """Newest load; among its rows the lowest known price."""
    return _keep_first(
        rows,
        list(keys),
        [F.col("ingest_timestamp_utc").desc_nulls_first(), F.col("sale_price").asc_nulls_last()],
    )


def latest_by_shop(
    rows: DataFrame,
    prefer_priced: bool = False,
    keys: tuple[str, ...] = ("ecommerce_name", "product_name"),
) -> DataFrame:
    """Both rules in one pass over both shops: ``latest_per_product`` for shop W,
    ``latest_cheapest`` for every other shop."""
    missing = F.col("sale_price").isNull()
    nulls_last = missing if prefer_priced else missing & (F.col("ecommerce_name") == SHOP_W)
    return _keep_first(
        rows,
        list(keys),
        [
            F.col("ingest_timestamp_utc").desc_nulls_first(),
            nulls_last.asc(),
            F.col("sale_price").asc_nulls_first(),
        ],
    )
