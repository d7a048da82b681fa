"""Views of the driver's tables in the shapes the operators read.

``listings`` is a product history: one row per line item, sold by one of the two
shops in one of seven daily loads. Landing documents are made row by row from it, so
their number grows with the table and nothing has to be collected per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import MAP_BASE_NAME, MAP_QUERY_NAME, SHOP_L, SHOP_W
from shelflens.functions.text import day_text
from shelflens.operators.keep import spread

LAST_DAY = "2025-02-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part_name() -> Column:
    return F.concat_ws(" ", "p_brand", "p_name", "p_type", "p_size")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", _part_name().alias("product_name"), F.col("p_brand").alias("brand")
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows plus ``brand`` and the line item key."""
    item = table(spark, sf_dir, "lineitem")
    ts = F.expr("timestamp_ntz'2025-01-28 00:00:00' + make_dt_interval(l_linenumber)")
    return (
        item.join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "product_name",
            F.when(F.col("l_orderkey") % 97 != 0, F.col("l_extendedprice")).alias("sale_price"),
            ts.alias("ingest_timestamp_utc"),
            F.when(F.col("l_suppkey") % 2 == 0, SHOP_W).otherwise(SHOP_L).alias("ecommerce_name"),
            "brand",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_quantity",
        )
        .withColumn("year", F.year("ingest_timestamp_utc"))
        .withColumn("month", F.month("ingest_timestamp_utc"))
    )


def disturbed(rows: DataFrame) -> DataFrame:
    """Listings whose shop-L names differ from shop W's: upper case or word order."""
    words = F.split("product_name", " ")
    n = F.size(words)
    size, kind = F.get(words, n - 1), F.get(words, n - 2)
    name = F.array_join(F.slice(words, F.lit(2), n - 3), " ")
    moved = F.concat_ws(" ", name, F.get(words, F.lit(0)), size, kind)
    changed = (
        F.when(F.col("l_partkey") % 3 == 0, F.upper("product_name"))
        .when(F.col("l_partkey") % 3 == 1, moved)
        .otherwise(F.col("product_name"))
    )
    return rows.withColumn(
        "product_name",
        F.when(F.col("ecommerce_name") == SHOP_L, changed).otherwise(F.col("product_name")),
    )


def name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curated map that links each product name to itself, numbered by its part."""
    return (
        parts(spark, sf_dir)
        .groupBy("product_name")
        .agg(F.min("p_partkey").alias("product_no"))
        .select(
            "product_no",
            F.col("product_name").alias(MAP_QUERY_NAME),
            F.col("product_name").alias(MAP_BASE_NAME),
        )
    )


def _file(rows_shop: str) -> Column:
    tail = F.concat_ws("_", F.lit(rows_shop), F.col("l_orderkey"), F.col("l_linenumber"),
                       F.col("l_partkey"))
    return F.concat(
        F.lit("pre_landing/"), day_text(F.col("ingest_timestamp_utc")), F.lit("/"), tail,
        F.lit(".json"),
    )


def landing_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop-L documents ``(file, value)``: one per listing, with all price spellings."""
    rows = spread(listings(spark, sf_dir).filter(F.col("ecommerce_name") == SHOP_L))
    name, price = F.col("product_name"), F.col("sale_price")
    kind = F.col("l_orderkey") % 3
    first = (
        F.when(
            kind == 0,
            F.to_json(
                F.struct(
                    name.alias("name"),
                    F.concat(F.lit("฿"), F.format_number(price, 2)).alias("salePrice"),
                )
            ),
        )
        .when(
            kind == 1,
            F.to_json(
                F.struct(name.alias("name"), F.lit(0).alias("salePrice"), price.alias("price"))
            ),
        )
        .otherwise(
            F.to_json(
                F.struct(
                    F.lit("").alias("name"),
                    name.alias("product_name"),
                    F.concat(F.lit(" "), price.cast("string"), F.lit(" ")).alias("salePrice"),
                )
            )
        )
    )
    second = F.to_json(
        F.struct(
            F.concat(name, F.lit(" refill")).alias("name"),
            F.lit("0").alias("salePrice"),
            F.lit(7).alias("price"),
        )
    )
    body = F.concat(
        F.lit('{"data":{"products":{"products":['), first, F.lit(","), second,
        F.lit(',{"salePrice":5},null]}}}'),
    )
    return rows.select(_file("line_shopping").alias("file"), body.alias("value"), "l_orderkey")


def landing_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop-W documents ``(file, value)``: one per listing."""
    rows = spread(listings(spark, sf_dir).filter(F.col("ecommerce_name") == SHOP_W))
    name = F.col("product_name")

    def item(suffix: str, value: Column) -> Column:
        return F.to_json(
            F.struct(
                F.concat(name, F.lit(suffix)).alias("name"),
                F.struct(value.alias("value")).alias("price"),
            )
        )

    # to_json only writes containers: the array's brackets are taken off again.
    sample = F.to_json(F.array(F.concat(name, F.lit(" sample"))))
    body = F.concat(
        F.lit('{"products":['),
        item("", F.col("sale_price")),
        F.lit(","),
        item(" refill", F.lit("1_000")),
        F.lit(',{"name":"","price":{"value":1}},{"name":'),
        F.substring(sample, F.lit(2), F.length(sample) - 2),
        F.lit(',"price":null}]}'),
    )
    return rows.select(_file("watson").alias("file"), body.alias("value"), "l_orderkey")


def damaged(documents: DataFrame) -> DataFrame:
    """The same documents with two in ten made unreadable."""
    kind = F.col("l_orderkey") % 10
    value = (
        F.when(kind == 0, F.expr("left(value, length(value) - 5)"))
        .when(kind == 1, F.lit('{"data":{"products":{"products":{"x":1}}},"products":{"x":1}}'))
        .otherwise(F.col("value"))
    )
    return documents.withColumn("value", value)
