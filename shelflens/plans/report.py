"""The price comparison of one day, and the job that writes it."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import MAP_BASE_NAME, MAP_QUERY_NAME, SHOP_L, SHOP_W, JobConfig
from shelflens.operators.latest import latest_by_shop
from shelflens.sources.sinks import write_manifest, write_report
from shelflens.sources.tables import history_for_day, read_history, read_name_map, read_snapshots

REPORT_COLUMNS = [
    "product_no", "product_name", "price_from_line", "price_from_watson", "diff",
    "ingest_timestamp_utc",
]


def map_entries(name_map: DataFrame) -> DataFrame:
    """The name map as ``(product_no, ecommerce_name, product_name)``, a row per shop."""
    return name_map.select(
        "product_no",
        F.explode(
            F.array(
                F.struct(
                    F.lit(SHOP_L).alias("ecommerce_name"),
                    F.col(MAP_QUERY_NAME).alias("product_name"),
                ),
                F.struct(
                    F.lit(SHOP_W).alias("ecommerce_name"),
                    F.col(MAP_BASE_NAME).alias("product_name"),
                ),
            )
        ).alias("e"),
    ).select("product_no", "e.ecommerce_name", "e.product_name")


def map_join(latest: DataFrame, name_map: DataFrame) -> DataFrame:
    """Latest rows of both shops with their catalogue numbers; unmapped names drop out.

    No broadcast hint: the map grows with the catalogue, and the latest rows are
    already partitioned by the join key.
    """
    return latest.join(map_entries(name_map), ["ecommerce_name", "product_name"], "inner")


def compare(mapped: DataFrame) -> DataFrame:
    """Pair the two shops' rows of each catalogue number.

    Both sides are the same rows and the shops are told apart in the join condition,
    not by a filter per side: the work below is then planned once and its shuffle
    reused.
    """
    line, watson = mapped.alias("l"), mapped.alias("w")
    assert SHOP_L < SHOP_W
    paired = line.join(
        watson,
        (F.col("l.product_no") == F.col("w.product_no"))
        & (F.col("l.ecommerce_name") < F.col("w.ecommerce_name")),
    )
    return paired.select(
        F.col("w.product_no"),
        F.col("w.product_name"),
        F.col("l.sale_price").alias("price_from_line"),
        F.col("w.sale_price").alias("price_from_watson"),
        (F.col("l.sale_price") - F.col("w.sale_price")).alias("diff"),
        F.col("w.ingest_timestamp_utc"),
    )


def price_report(
    history: DataFrame, name_map: DataFrame, day: dt.date, prefer_priced: bool = False
) -> DataFrame:
    """Latest prices of ``day`` in both shops, and their difference."""
    rows = history_for_day(history, day).filter(
        F.col("ecommerce_name").isin(SHOP_L, SHOP_W)
    ).select("product_name", "sale_price", "ingest_timestamp_utc", "ecommerce_name")
    return compare(map_join(latest_by_shop(rows, prefer_priced), name_map))


def step_counts(history: DataFrame, name_map: DataFrame, day: dt.date) -> DataFrame:
    """Rows per shop after each step of the report ``(step, ecommerce_name, n)``.

    One pass: a product is one row with its number of listings, so it stands for its one latest
    row; each of its catalogue numbers is a mapped row, and a number's rows in both shops pair
    up. Listings are read once and shuffled once, as counts per product.
    """
    shop = F.col("ecommerce_name")
    loaded = history_for_day(history, day).filter(shop.isin(SHOP_L, SHOP_W))
    products = loaded.groupBy("ecommerce_name", "product_name").agg(F.count(F.lit(1)).alias("listings"))
    # A name's numbers are the names it is matched with: a few.
    numbers = map_entries(name_map).groupBy("ecommerce_name", "product_name").agg(
        F.collect_list("product_no").alias("numbers")
    )

    def fact(step: str, of: Column, number: Column, line: Column, watson: Column) -> Column:
        return F.struct(
            F.lit(step).alias("step"), of.alias("of"), number.alias("number"),
            line.cast("long").alias("line"), watson.cast("long").alias("watson"),
        )

    none, zero = F.lit(None).cast(name_map.schema["product_no"].dataType), F.lit(0)
    listed = F.coalesce("numbers", F.array().cast(numbers.schema["numbers"].dataType))
    facts = F.concat(
        F.array(
            fact("loaded", shop, none, F.col("listings"), zero),
            fact("latest", shop, none, F.lit(1), zero),
            fact("mapped", shop, none, F.size(listed), zero),
        ),
        F.transform(
            listed,
            lambda no: fact("compared", F.lit("both"), no, (shop == SHOP_L).cast("int"), (shop == SHOP_W).cast("int")),
        ),
    )
    summed = (
        products.join(numbers, ["ecommerce_name", "product_name"], "left")
        .select(F.explode(facts).alias("f"))
        .groupBy("f.step", "f.of", "f.number")
        .agg(F.sum("f.line").alias("line"), F.sum("f.watson").alias("watson"))
    )
    n = F.when(F.col("step") == "compared", F.col("line") * F.col("watson")).otherwise(F.col("line"))
    return (
        summed.groupBy("step", F.col("of").alias("ecommerce_name"))
        .agg(F.sum(n).alias("n"))
        .filter("n > 0")
        .select("step", "ecommerce_name", "n")
    )


def run_report(
    spark: SparkSession, config: JobConfig, day: dt.date, run_ts: dt.datetime,
    from_snapshots: bool = False,
) -> int:
    """Read history and map, write the day's report and its manifest.

    With ``from_snapshots`` the day's loads' latest rows are read instead of its listings: the
    same report where all loads came through ``store_load``. Returns the number of report rows;
    nothing is written when there are none.
    """
    if from_snapshots:
        snapshots = read_snapshots(spark, config.snapshots, config.table_format)
        history = snapshots.filter(F.col("day") == F.lit(day))
    else:
        history = read_history(spark, config.history, config.table_format)
    report = price_report(history, read_name_map(spark, config.name_map), day)
    path = config.report(day)
    rows = write_report(report, path, ["product_no", "product_name"])
    if rows:
        write_manifest(spark, config.manifest(run_ts), path, rows, run_ts)
    return rows
