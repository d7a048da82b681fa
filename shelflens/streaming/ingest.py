"""File stream: every landed file is loaded once, then the touched days are reported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelflens.config import SPECS, JobConfig
from shelflens.operators.flatten import decode_shops
from shelflens.plans.ingest import store_load
from shelflens.plans.report import run_report
from shelflens.sources.files import path_exists
from shelflens.sources.landing import stream_landing


def load_time(modified: Column, day: Column) -> Column:
    """``modified``, or the end of ``day`` that is nearest to it; ``day`` may be NULL."""
    start = day.cast("timestamp_ntz")
    end = start + F.expr("interval '0 23:59:59.999999' day to second")
    return F.when(day.isNull(), modified).otherwise(F.least(F.greatest(modified, start), end))


def load_batch(
    config: JobConfig, stream: str, report: bool, from_snapshots: bool = True
) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch.

    A document's load time is its file's time, moved into the day of its landing folder
    if it lies outside, so that a late file counts for the day it was landed for, as in
    batch. The load is named by the batch number: a batch that is retried after a failure
    writes the same rows to the same place. Every day with new rows is reported, from its
    loads' latest rows unless ``from_snapshots`` is off.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        # A micro-batch is read anew by each use, whole files each time, and its text is too
        # large to keep: one pass decodes both shops.
        dated = batch.withColumn("load_ts", load_time(F.col("modified"), F.col("day")))
        decoded = decode_shops(dated, SPECS, carry=("load_ts",)).withColumnRenamed("shop", "ecommerce_name")
        loads = store_load(decoded, config, F.col("load_ts"), f"{stream}-{batch_id}")
        if loads and report and path_exists(spark, config.name_map):
            for newest in loads:
                run_report(spark, config, newest.date(), newest, from_snapshots)

    return run


def start_ingest(
    spark: SparkSession,
    config: JobConfig,
    *,
    stream: str = "landing",
    report: bool = True,
    from_snapshots: bool = True,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load what has landed since the last run, then stop (``availableNow``).

    ``from_snapshots`` reports from the loads' latest rows; it must be off where other writers
    than loads add to the history. Progress is kept below the storage root, so each file counts once across runs.
    """
    source = stream_landing(spark, config, files_per_batch)
    return (
        source.writeStream.queryName(stream)
        .foreachBatch(load_batch(config, stream, report, from_snapshots))
        .option("checkpointLocation", f"{config.root}/checkpoints/{stream}")
        .trigger(availableNow=True)
        .start()
    )
