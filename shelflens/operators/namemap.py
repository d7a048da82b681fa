"""Reviewed matches to the numbered name map that the report reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import MAP_BASE_NAME, MAP_QUERY_NAME, MATCH_BASE_NAME, MATCH_QUERY_NAME

BUCKET_DIGITS = 3


def number_rows(
    rows: DataFrame, keys: list[str], name: str, digits: int = BUCKET_DIGITS, after: int = 0
) -> DataFrame:
    """Number distinct rows ``after`` + 1, + 2, + 3, ... in a fixed order.

    The order is by bucket (first hex digits of a hash of the keys), then by the keys.
    Buckets are even whatever the keys are, each is numbered on its own, and only the
    16 ** digits bucket totals meet in one place.
    """
    bucket = F.substring(F.md5(F.concat_ws("\u0001", *keys)), 1, digits)
    marked = rows.withColumn("_bucket", bucket)
    totals = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # One row per bucket: a bounded set, so a single window over it is fine.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    # At most 16 ** digits offsets: small by construction.
    return (
        marked.withColumn("_i", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_i") + F.lit(after))
        .drop("_bucket", "_i", "_offset")
    )


NAMES = [MAP_QUERY_NAME, MAP_BASE_NAME]


def accepted_pairs(matches: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Distinct matched pairs in the report's column names.

    ``reviewed`` may hold a person's decisions: the two name columns and ``accepted``.
    A rejected pair is left out, an accepted one is added even if not matched.
    """
    pairs = matches.select(
        F.col(MATCH_QUERY_NAME).alias(MAP_QUERY_NAME),
        F.col(MATCH_BASE_NAME).alias(MAP_BASE_NAME),
    )
    if reviewed is not None:
        refused = reviewed.filter(~F.col("accepted")).select(*NAMES)
        pairs = pairs.join(refused, NAMES, "left_anti").unionByName(
            reviewed.filter("accepted").select(*NAMES)
        )
    return pairs.distinct()


def build_name_map(matches: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """The accepted pairs, numbered from 1."""
    pairs = accepted_pairs(matches, reviewed)
    return number_rows(pairs, NAMES, "product_no").select("product_no", *NAMES)


def new_numbers(pairs: DataFrame, numbered: DataFrame) -> DataFrame:
    """Numbers for the ``pairs`` that ``numbered`` lacks, from its greatest number on."""
    top = numbered.agg(F.max("product_no")).first()[0] or 0
    fresh = pairs.join(numbered.select(*NAMES), NAMES, "left_anti")
    return number_rows(fresh, NAMES, "product_no", after=top).select("product_no", *NAMES)


def update_name_map(pairs: DataFrame, numbered: DataFrame) -> DataFrame:
    """The map of ``pairs``: each keeps the number it ever had, new ones get new numbers.

    ``numbered`` holds every number that was ever given, also those of pairs that are matched
    no more: a number never passes to another pair, and a pair that comes back has its own.
    """
    old = numbered.join(pairs, NAMES, "left_semi").select("product_no", *NAMES)
    return old.unionByName(new_numbers(pairs, numbered))
