"""Typed history rows and their split by shop."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.config import PROTOTYPE_LABEL, SHOP_L, SHOP_W


def history_rows(
    products: DataFrame, shop: str | Column, load_ts: dt.datetime | Column
) -> DataFrame:
    """Product rows with load time, shop and the folder columns."""
    shop = shop if isinstance(shop, Column) else F.lit(shop)
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts.isoformat())
    return products.select(
        F.col("product_name").cast("string"),
        F.col("sale_price").cast("double"),
        ts.cast("timestamp_ntz").alias("ingest_timestamp_utc"),
        shop.alias("ecommerce_name"),
    ).select("*", F.year("ingest_timestamp_utc").alias("year"),
             F.month("ingest_timestamp_utc").alias("month"))


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All shops in one DataFrame, so that one job appends to the table."""
    return reduce(DataFrame.unionByName, parts)


def product_rows(products: DataFrame, shop: str) -> DataFrame:
    """Rows for the product CSV, labelled with the short shop name."""
    return products.select(
        F.col("product_name").cast("string"),
        F.col("sale_price").cast("double"),
        F.lit(PROTOTYPE_LABEL[shop]).alias("ecommerce"),
    )


def of_shop(history: DataFrame, shop: str) -> DataFrame:
    return history.filter(F.col("ecommerce_name") == shop)


def split_catalogs(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Query side (shop L) and base side (shop W)."""
    return of_shop(history, SHOP_L), of_shop(history, SHOP_W)


def distinct_names(*catalogs: DataFrame) -> DataFrame:
    """All product names of the catalogues, once each."""
    names = [c.select("product_name") for c in catalogs]
    return reduce(DataFrame.union, names).distinct()
