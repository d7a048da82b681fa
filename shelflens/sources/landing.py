"""Landed shop responses as a DataFrame ``(file string, value string)``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import SPECS, JobConfig, SourceSpec
from shelflens.functions import text as TX
from shelflens.operators.keep import shuffles_let_go
from shelflens.sources.files import glob_matches
from shelflens.sources.tables import JSON_OPTIONS

LANDING_SCHEMA = "file string, value string"
LANDED_SCHEMA = "object_name string, value string"
#: Documents of one landed file at most: a compressed file is read by a single task.
LANDED_FILE_DOCUMENTS = 50_000
NOT_AN_OBJECT = "body is no object"


def scan_landing(
    spark: SparkSession, config: JobConfig, day: dt.date, spec: SourceSpec
) -> DataFrame:
    """All documents of one shop and UTC day, one file per document; none is fine."""
    pattern = config.landing_glob(day, spec)
    if not glob_matches(spark, pattern):
        return spark.createDataFrame([], LANDING_SCHEMA)
    return spark.read.text(pattern, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )


def select_landing(documents: DataFrame, day: dt.date | str, spec: SourceSpec) -> DataFrame:
    """The same choice by day folder and source prefix, on object names in ``file``."""
    return documents.filter(F.col("file").contains(f"pre_landing/{day}/{spec.prefix}"))


def stamp_envelopes(
    responses: DataFrame, *, shop, query, page, fetched_at, body="body"
) -> DataFrame:
    """Stamp raw response bodies with their load time, shop label and object name.

    ``shop``, ``query``, ``page`` and ``fetched_at`` are columns; ``body`` is a JSON
    object text. The two stamps are added as the last top-level keys. A body that is no
    object (a list, an error page, NULL) is kept as it is, with a ``reason``, which is
    NULL otherwise.
    """
    shape = r"(?s)^\s*\{(.*)\}\s*$"
    inner = F.regexp_extract(F.col(body), shape, 1)
    whole = F.coalesce(F.col(body).rlike(shape), F.lit(False))
    stamps = F.concat(
        F.lit('"ingest_timestamp_utc":"'),
        TX.iso_utc(fetched_at),
        F.lit('","ecommerce_name":'),
        F.to_json(F.array(shop)).substr(F.lit(2), F.length(F.to_json(F.array(shop))) - 2),
    )
    return responses.select(
        "*",
        TX.day_text(fetched_at).alias("ingest_date"),
        shop.alias("ecommerce_name"),
        TX.iso_utc(fetched_at).alias("ingest_timestamp_utc"),
        TX.object_name(shop, query, fetched_at, page).alias("object_name"),
        F.when(
            whole,
            F.concat(
                F.lit("{"), inner, F.when(F.trim(inner) == "", "").otherwise(","), stamps, F.lit("}")
            ),
        )
        .otherwise(F.col(body))
        .alias("value"),
        F.when(~whole, F.lit(NOT_AN_OBJECT)).alias("reason"),
    )


def land_envelopes(envelopes: DataFrame, config: JobConfig) -> None:
    """Append stamped envelopes as JSON lines, partitioned by day and shop.

    Many documents per file: a day of single-document objects is a listing problem
    long before it is a volume problem. What has a ``reason`` is set aside under it. Both are
    compressed, as the landing area stays and would be the largest of all that a job leaves.
    """
    folders = ["ingest_date", "ecommerce_name"]
    good = F.col("reason").isNull()
    with shuffles_let_go(envelopes.sparkSession):
        for rows, extra, path in ((good, [], config.landed_root), (~good, ["reason"], config.set_aside)):
            (
                envelopes.filter(rows)
                .select("object_name", "value", *extra, *folders)
                .write.mode("append")
                .options(**JSON_OPTIONS)
                .option("maxRecordsPerFile", LANDED_FILE_DOCUMENTS)
                .partitionBy(*folders)
                .json(path)
            )


def scan_landed(
    spark: SparkSession, config: JobConfig, day: dt.date, spec: SourceSpec
) -> DataFrame:
    """Documents written by ``land_envelopes`` for one shop and day."""
    path = f"{config.landed_root}/ingest_date={day}/ecommerce_name={spec.envelope_name}"
    if not glob_matches(spark, path):
        return spark.createDataFrame([], LANDING_SCHEMA)
    return spark.read.schema(LANDED_SCHEMA).json(path).select(
        F.col("object_name").alias("file"), "value"
    )


def stream_landing(
    spark: SparkSession, config: JobConfig, files_per_batch: int | None = None
) -> DataFrame:
    """Both landing areas, all days, as a file stream, each file once.

    Columns ``file, shop, day, modified, value``: shop and day are read off the folder
    and the file's name; a folder that names no day leaves ``day`` NULL.
    """

    def reader():
        stream = spark.readStream
        return stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else stream

    path, leaf = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    modified = F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified")

    def day(folder: str):
        return F.try_to_date(F.regexp_extract(path, folder + r"(\d{4}-\d{2}-\d{2})/", 1)).alias("day")

    single = reader().text(f"{config.landing_root}/*/", wholetext=True).select(
        path.alias("file"),
        F.coalesce(*[F.when(leaf.startswith(s.prefix), s.name) for s in SPECS]).alias("shop"),
        day("/pre_landing/"),
        modified,
        "value",
    )
    folder = F.regexp_extract(path, r"/ecommerce_name=([^/]*)/", 1)
    many = reader().schema(LANDED_SCHEMA).json(f"{config.landed_root}/ingest_date=*/*/").select(
        F.col("object_name").alias("file"),
        F.coalesce(*[F.when(folder == s.envelope_name, s.name) for s in SPECS]).alias("shop"),
        day("/ingest_date="),
        modified,
        "value",
    )
    return single.unionByName(many)


def landing_inventory(documents: DataFrame, specs: list[SourceSpec]) -> DataFrame:
    """Landed documents per day and shop, read off their object names."""
    folder = F.regexp_extract("file", r"pre_landing/(\d{4}-\d{2}-\d{2})/([^/]*)$", 1)
    leaf = F.regexp_extract("file", r"([^/]*)$", 1)
    shop = F.coalesce(*[F.when(leaf.startswith(s.prefix), s.name) for s in specs])
    return (
        documents.select(folder.alias("ingest_date"), shop.alias("ecommerce_name"))
        .filter((F.col("ingest_date") != "") & F.col("ecommerce_name").isNotNull())
        .groupBy("ingest_date", "ecommerce_name")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
