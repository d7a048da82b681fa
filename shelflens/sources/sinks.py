"""Writers: product history, reports, manifests, match results, layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.sources.files import remove_matches
from shelflens.sources.tables import CSV_OPTIONS, HISTORY_COLUMNS, STAMP_OPTIONS

MANIFEST_SCHEMA = "path string, row_count bigint, written_at timestamp_ntz"
#: Rows of one file of a report, about.
REPORT_FILE_ROWS = 250_000


def append_history(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Plain append by year and month; a re-run adds the rows again."""
    rows.select(*HISTORY_COLUMNS).hint("rebalance").write.format(fmt).mode("append").partitionBy(
        "year", "month"
    ).save(path)


def load_history(rows: DataFrame, path: str, load_id: str, fmt: str = "parquet", add: bool = False) -> None:
    """Write one load, clustered by load time; the same ``load_id`` again replaces it.

    A retried or repeated load overwrites only its own folders; with ``add`` the rows join those
    that are there, as the next part of the load. Do not mix with
    ``append_history`` in one table: the folder depths differ.
    """
    (
        clustered(rows.select(*HISTORY_COLUMNS, F.lit(load_id).alias("load_id")))
        .write.format(fmt)
        .mode("append" if add else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "load_id")
        .save(path)
    )


def load_snapshot(partials: DataFrame, path: str, load_id: str, fmt: str = "parquet") -> None:
    """Write one load's latest rows below their days, in place of what the load left before."""
    remove_matches(partials.sparkSession, f"{path}/day=*/load_id={load_id}")
    (
        partials.select(*HISTORY_COLUMNS, "day", F.lit(load_id).alias("load_id"))
        .write.format(fmt)
        .mode("append")
        .partitionBy("day", "load_id")
        .save(path)
    )


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def clustered(rows: DataFrame, files: int | None = None) -> DataFrame:
    """History rows in ranges of load time, so that file min/max ranges prune.

    The further sort columns only split one load time over several files: many rows
    of a load carry the same time. Small ranges are merged when the job runs, so files
    have an even size, however many tasks read the landing area.
    """
    keys = ["ingest_timestamp_utc", "ecommerce_name", "product_name", "sale_price"]
    ranged = (
        rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys)


def write_clustered(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Copy history rows clustered by load time."""
    clustered(rows, files).write.mode("errorifexists").partitionBy("year", "month").parquet(path)


def write_report(
    report: DataFrame, path: str, sort_by: list[str], fmt: str = "csv"
) -> int:
    """Write a sorted report, replacing an earlier one; returns the row count.

    An empty report writes nothing. Files are range-partitioned, so that reading
    them by name gives the total order without one task holding everything.
    """
    # Kept, so that the count and the range bounds do not compute it anew. What is kept has as many
    # parts as a shuffle, however small: as many ranges again would be a file for each pair of them.
    report = report.persist()
    try:
        rows = report.count()
        if not rows:
            return 0
        ranges = -(-rows // REPORT_FILE_ROWS)
        writer = report.repartitionByRange(ranges, *sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True).options(**STAMP_OPTIONS)
        writer.format(fmt).save(path)
        return rows
    finally:
        report.unpersist()


def write_manifest(
    spark: SparkSession, target: str, path: str, row_count: int, written_at: dt.datetime
) -> None:
    """One JSON object that says what was written where."""
    spark.createDataFrame([(path, row_count, written_at)], MANIFEST_SCHEMA).write.mode(
        "overwrite"
    ).json(target)


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)
