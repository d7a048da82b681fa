"""Which result pages exist, which are still to fetch, which arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.config import SourceSpec


def declared_pages(first_pages: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add ``total_pages`` and ``total_results`` as the first response declares them.

    A missing page count means one page.
    """
    doc = F.try_parse_json("value")
    return first_pages.select(
        "*",
        F.coalesce(F.try_variant_get(doc, spec.pages_path, "int"), F.lit(1)).alias("total_pages"),
        F.coalesce(F.try_variant_get(doc, spec.results_path, "bigint"), F.lit(0)).alias(
            "total_results"
        ),
    )


def page_plan(declared: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per page still to request after the first, in column ``page``."""
    start = spec.first_page + 1
    last = F.col("total_pages") - 1 + spec.first_page
    pages = F.when(F.col("total_pages") > 1, F.sequence(F.lit(start), last))
    return declared.select("*", F.explode(pages).alias("page")).drop("total_pages", "total_results")


def page_coverage(declared: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Declared pages and results against landed ones.

    ``landed_pages`` and ``landed_rows`` count what lies on declared pages; pages that landed
    without being declared, of declared searches, are ``undeclared_pages``.

    ``declared`` holds the keys with ``total_pages, total_results, first_page``;
    ``landed`` one row per landed product with the keys and ``page``.
    """
    # Rows per page first: a page is bounded, so what is left is small and even.
    per_page = landed.groupBy(*keys, "page").agg(F.count(F.lit(1)).alias("rows"))
    known = (F.col("page") >= F.col("first_page")) & (
        F.col("page") < F.col("first_page") + F.col("total_pages")
    )
    arrived = (
        per_page.join(declared.select(*keys, "first_page", "total_pages"), keys)
        .withColumn("known", F.coalesce(known, F.lit(False)))
        .groupBy(*keys)
        .agg(
            F.count_if("known").alias("landed_pages"),
            F.sum(F.when(F.col("known"), F.col("rows"))).alias("landed_rows"),
            F.count_if(~F.col("known")).alias("undeclared_pages"),
        )
    )
    # An empty search declares no pages; a sequence would count down.
    pages = F.when(
        F.col("total_pages") > 0,
        F.sequence(F.col("first_page"), F.col("first_page") + F.col("total_pages") - 1),
    )
    wanted = declared.select(*keys, F.explode(pages).alias("page"))
    missing = (
        wanted.join(per_page, [*keys, "page"], "left_anti")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("missing_pages"))
    )
    return (
        declared.join(arrived, keys, "left")
        .join(missing, keys, "left")
        .select(
            *keys,
            "total_pages",
            "total_results",
            *[
                F.coalesce(c, F.lit(0)).alias(c)
                for c in ("landed_pages", "landed_rows", "missing_pages", "undeclared_pages")
            ],
        )
    )
