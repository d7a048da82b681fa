"""Landing documents to product history, in batch."""

from __future__ import annotations

import datetime as dt
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import SPECS, JobConfig
from shelflens.operators.flatten import decode_products
from shelflens.operators.history import history_rows, union_sources
from shelflens.operators.keep import shuffles_let_go
from shelflens.operators.snapshot import load_partials
from shelflens.sources.files import remove_matches
from shelflens.sources.landing import scan_landed, scan_landing
from shelflens.sources.sinks import load_history, load_snapshot
from shelflens.sources.tables import JSON_OPTIONS, load_folders, read_load


def decode_sources(by_spec: dict, carry: tuple[str, ...] = ()) -> DataFrame:
    """All shops' documents decoded, with ``ecommerce_name``; ``by_spec`` maps a source
    spec to its documents, whose columns ``carry`` go along."""
    return union_sources(
        [
            decode_products(docs, spec, carry).withColumn("ecommerce_name", F.lit(spec.name))
            for spec, docs in by_spec.items()
        ]
    )


def history_build(decoded: DataFrame, load_ts: dt.datetime | Column) -> DataFrame:
    """Decoded product rows of all shops as history rows of one load."""
    return history_rows(
        decoded.filter(F.col("reason").isNull()), F.col("ecommerce_name"), load_ts
    )


def reject_places(decoded: DataFrame) -> DataFrame:
    """Decoded rows in which only rejects say where they were found (``file``, ``pos``).

    A product is stored without its place; kept with each product, the places would be the larger part.
    """
    rejected = F.col("reason").isNotNull()
    return decoded.withColumns({place: F.when(rejected, F.col(place)) for place in ("file", "pos")})


#: Rows of the history that are put in order at once; a shop's rows of one day are never cut.
SLICE_ROWS = 20_000_000
STAGED_SCHEMA = (
    "file string, pos int, reason string, product_name string, sale_price double, "
    "ingest_timestamp_utc timestamp_ntz, rejected boolean, day date, ecommerce_name string"
)


def stage_load(decoded: DataFrame, load_ts: dt.datetime | Column, path: str, fmt: str) -> None:
    """Write decoded rows once, rejects, days and shops apart, for a load's passes over them.

    Files in the job's folder are a fraction of the same rows in the executors' caches, and a lost
    executor does not take them along.
    """
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts.isoformat())
    dated = reject_places(decoded).withColumn("ingest_timestamp_utc", ts.cast("timestamp_ntz"))
    (
        dated.withColumn("rejected", F.col("reason").isNotNull())
        .withColumn("day", F.to_date("ingest_timestamp_utc"))
        .select(*[field.split(" ", 1)[0] for field in STAGED_SCHEMA.split(", ")])
        .write.format(fmt)
        .mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("rejected", "day", "ecommerce_name")
        .save(path)
    )


def load_slices(counts: list[tuple], rows: int) -> list[tuple[list[dt.date | None], str | None]]:
    """Days in runs of at most ``rows`` rows, with the shop where a single day has more.

    ``counts`` are ``(day, shop, n)`` in order; a day's shop is never cut.
    """
    slices: list[tuple[list[dt.date | None], str | None]] = []
    room = 0
    for day, group in groupby(counts, key=itemgetter(0)):
        shops = [(shop, n) for _, shop, n in group]
        n = sum(n for _, n in shops)
        if n > rows and len(shops) > 1 and all(shop for shop, _ in shops):
            slices += [([day], shop) for shop, _ in shops]
            room = 0
        elif slices and n <= room:
            slices[-1][0].append(day)
            room -= n
        else:
            slices.append(([day], None))
            room = rows - n
    return slices


def store_load(
    decoded: DataFrame, config: JobConfig, load_ts: dt.datetime | Column, load_id: str
) -> list[dt.datetime]:
    """Write one load's history rows and rejects; the newest load time of each day stored.

    The documents are decoded once for both outputs. Writing the same load again
    replaces it, also with nothing: a load without products leaves no rows. A large load is put in
    order in runs of days, the largest days by shop; their staged rows go when they are stored.
    """
    spark, staged, fmt = decoded.sparkSession, f"{config.staged}/load_id={load_id}", config.table_format
    with shuffles_let_go(spark):
        try:
            stage_load(decoded, load_ts, staged, fmt)
            found = spark.read.format(fmt).schema(STAGED_SCHEMA).load(staged)
            rejects = found.filter("rejected").select("ecommerce_name", "file", "pos", "reason")
            rejects.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{config.quarantine}/load_id={load_id}")
            remove_matches(spark, f"{staged}/rejected=true")
            products = found.filter("not rejected")
            counts = (
                products.groupBy("day", "ecommerce_name")
                .agg(F.count(F.lit(1)).alias("n"), F.max("ingest_timestamp_utc").alias("ts"))
                .orderBy("day", "ecommerce_name")
                .collect()
            )
            slices = load_slices([(r["day"], r["ecommerce_name"], r["n"]) for r in counts], SLICE_ROWS)
            if len(slices) != 1:
                # What an earlier run of the load left; the second slice must not find it.
                remove_matches(spark, load_folders(config.history, load_id))
            for place, (days, shop) in enumerate(slices):
                part = products.filter(
                    F.col("day").isin([d for d in days if d]) | F.lit(None in days) & F.col("day").isNull()
                )
                if shop:
                    part = part.filter(F.col("ecommerce_name") == shop)
                rows = history_build(part, F.col("ingest_timestamp_utc"))
                load_history(rows, config.history, load_id, fmt, add=place > 0)
                for day in days:
                    remove_matches(spark, f"{staged}/rejected=false/day={day}/ecommerce_name={shop or '*'}")
        finally:
            remove_matches(spark, staged)
        if counts:
            # What is stored is in order, so that each task has few rows of a product left for the shuffle.
            stored = read_load(spark, config.history, load_id, fmt)
            load_snapshot(load_partials(stored), config.snapshots, load_id, fmt)
        else:
            remove_matches(spark, f"{config.snapshots}/day=*/load_id={load_id}")
        return [max(r["ts"] for r in of_day) for _, of_day in groupby(counts, key=itemgetter("day"))]


def run_ingest(
    spark: SparkSession, config: JobConfig, day: dt.date, run_ts: dt.datetime
) -> bool:
    """Load the landing folder of one day, both shops, in one append.

    A second run of the same day replaces the first; for that, ``run_ts`` must lie in
    ``day``, as it chooses the folder. Without products nothing is written, and what an
    earlier run of the day wrote goes.
    """
    if run_ts.date() != day:
        raise ValueError(f"load time {run_ts} is not in landing day {day}")
    documents = {
        spec: scan_landing(spark, config, day, spec).unionByName(
            scan_landed(spark, config, day, spec)
        )
        for spec in SPECS
    }
    return bool(store_load(decode_sources(documents), config, run_ts, f"day-{day:%Y-%m-%d}"))
