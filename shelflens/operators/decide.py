"""From ranked candidates to one match row per query, and its filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.config import (
    MATCH_BASE_NAME,
    MATCH_FAILED,
    MATCH_QUERY_NAME,
    MIN_SIMILARITY,
    QUERY_VECTOR_ERROR,
    RATIO_BAND,
    RATIO_MIN,
    STRICT_MIN_SIMILARITY,
)
from shelflens.functions.numbers import ieee_div


def pack_candidates(topk: DataFrame, queries: DataFrame, base: DataFrame) -> DataFrame:
    """One row per query with its ranked ``candidates`` (at most k) and their ``names``.

    ``queries`` holds ``query_id, query_name, query_price``, ``base`` holds
    ``catalog_id, name, price``. Queries without candidates keep an empty list.
    """
    listed = (
        topk.join(base.select("catalog_id", "name", "price"), "catalog_id")
        .groupBy("query_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "name", "price", "score"))).alias(
                "candidates"
            )
        )
    )
    empty = F.array().cast("array<struct<rank:int,name:string,price:double,score:double>>")
    return queries.join(listed, "query_id", "left").select(
        *queries.columns, F.coalesce("candidates", empty).alias("candidates")
    ).withColumn("names", F.col("candidates.name"))


def decide_match(rows: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The verified candidate with its own price and score, else the best one unverified.
    The columns ``also`` go along.

    A failed judge means no match, so the best candidate stays as an unverified row; only a
    query without candidates gets the placeholder row.
    """
    failed = F.col("failed") if "failed" in rows.columns else F.lit(False)
    verified = F.col("verified_at").isNotNull() & ~F.coalesce(failed, F.lit(False))
    picked = F.when(
        verified, F.get("candidates", F.col("verified_at") - 1)
    ).otherwise(F.get("candidates", F.lit(0)))
    lost = F.size("candidates") == 0
    return rows.withColumn("_c", picked).select(
        F.col("query_name").alias(MATCH_QUERY_NAME),
        F.when(lost, MATCH_FAILED).otherwise(F.col("_c.name")).alias(MATCH_BASE_NAME),
        F.col("query_price").alias("price_from_line"),
        F.when(lost, F.lit(0.0)).otherwise(F.col("_c.price")).alias("price_from_watson"),
        F.when(lost, F.lit(0.0)).otherwise(F.col("_c.score")).alias("similarity"),
        (verified & ~lost).alias("verified_match"),
        *also,
    )


def top1_match(topk: DataFrame, queries: DataFrame, base: DataFrame) -> DataFrame:
    """The best candidate of each query; without one, the vector-error placeholder."""
    first = topk.filter(F.col("rank") == 1).join(
        base.select("catalog_id", "name", "price"), "catalog_id"
    ).select("query_id", "name", "price", "score")
    missing = F.col("score").isNull()
    return queries.join(first, "query_id", "left").select(
        F.col("query_name").alias(MATCH_QUERY_NAME),
        F.when(missing, QUERY_VECTOR_ERROR).otherwise(F.col("name")).alias(MATCH_BASE_NAME),
        F.col("query_price").alias("price_from_line"),
        F.when(missing, F.lit(float("nan"))).otherwise(F.col("price")).alias("price_from_watson"),
        F.coalesce("score", F.lit(0.0)).alias("similarity"),
    )


def with_ratio(matches: DataFrame) -> DataFrame:
    """Add the price ratio under the output name ``diff``."""
    return matches.withColumn(
        "diff", ieee_div(F.col("price_from_line"), F.col("price_from_watson"))
    )


def keep_verified(matches: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    kept = matches.filter((F.col("similarity") >= min_similarity) & F.col("verified_match"))
    return with_ratio(kept)


def keep_dearer(
    matches: DataFrame,
    min_similarity: float = STRICT_MIN_SIMILARITY,
    min_ratio: float = RATIO_MIN,
) -> DataFrame:
    """Similar rows whose price ratio is at least ``min_ratio`` (NaN counts as large)."""
    kept = with_ratio(matches.filter(F.col("similarity") >= min_similarity))
    return kept.filter(F.col("diff") >= min_ratio)


def keep_comparable(
    matches: DataFrame,
    min_similarity: float = MIN_SIMILARITY,
    band: tuple[float, float] = RATIO_BAND,
) -> DataFrame:
    """Similar rows whose price ratio lies strictly inside ``band``."""
    kept = with_ratio(matches.filter(F.col("similarity") >= min_similarity))
    return kept.filter((F.col("diff") > band[0]) & (F.col("diff") < band[1]))
