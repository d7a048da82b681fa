"""Typed readers for history, name map, product and embedding tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import MAP_BASE_NAME, MAP_QUERY_NAME

HISTORY_COLUMNS = [
    "product_name", "sale_price", "ingest_timestamp_utc", "ecommerce_name", "year", "month",
]
#: Options that the CSV reader and writer share.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: JSON lines are written compressed; readers tell by the files' names.
JSON_OPTIONS = {"compression": "gzip"}
#: Load times keep their microseconds; CSV would cut them to milliseconds.
STAMP_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Stands for null inside the reader only, so that quoted empty texts stay texts.
NO_TEXT = "\u0000null\u0000"
READ_OPTIONS = {**CSV_OPTIONS, "multiLine": True, "nullValue": NO_TEXT}
HISTORY_SCHEMA = (
    "product_name string, sale_price double, ingest_timestamp_utc timestamp_ntz, "
    "ecommerce_name string, year int, month int"
)
NAME_MAP_SCHEMA = f"product_no bigint, {MAP_QUERY_NAME} string, {MAP_BASE_NAME} string"
PRODUCTS_SCHEMA = "product_name string, sale_price double, ecommerce string"
REPORT_SCHEMA = (
    "product_no bigint, product_name string, price_from_line double, price_from_watson double, "
    "diff double, ingest_timestamp_utc timestamp_ntz"
)
CACHE_SCHEMA = "text string, model string, embedding array<float>, status string"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Ordinary CSV: quotes are doubled, line breaks may stand in quotes, nothing is trimmed.

    An empty field is null, a quoted empty one an empty text.
    """
    return spark.read.schema(schema).options(**READ_OPTIONS).csv(path)


def csv_records(rows: DataFrame) -> DataFrame:
    """The CSV text of each row ``(record)``, as the writer would put it into a file."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(F.to_csv(whole, CSV_OPTIONS).alias("record"))


def parse_records(records: DataFrame, schema: str) -> DataFrame:
    """Rows of CSV texts ``record``, as the reader would take them from a file."""
    return records.select(F.from_csv("record", schema, READ_OPTIONS).alias("row")).select("row.*")


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCTS_SCHEMA)


def read_name_map(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, NAME_MAP_SCHEMA)


def history_columns(rows: DataFrame) -> DataFrame:
    """The history's columns, in their order and types; whatever else a row has goes."""
    types = [field.split(" ", 1) for field in HISTORY_SCHEMA.split(", ")]
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in types])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A CSV report as ``write_report`` leaves it."""
    reader = spark.read.schema(REPORT_SCHEMA).option("header", True)
    return reader.options(**STAMP_OPTIONS).csv(path)


def load_folders(path: str, load_id: str) -> str:
    """Where ``load_history`` keeps one load."""
    return f"{path}/year=*/month=*/load_id={load_id}"


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The product history, all days, without the technical ``load_id``."""
    reader = spark.read.format(fmt)
    # load_id is a partition folder; naming it here stops type inference on it.
    reader = reader.schema(HISTORY_SCHEMA + ", load_id string")
    return history_columns(reader.load(path))


def read_load(spark: SparkSession, path: str, load_id: str, fmt: str = "parquet") -> DataFrame:
    """One load's rows of the history, with ``load_id``; only its own folders are listed."""
    reader = spark.read.format(fmt).schema(HISTORY_SCHEMA + ", load_id string").option("basePath", path)
    return reader.load(load_folders(path, load_id))


def read_snapshots(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The loads' latest rows, with ``day`` and ``load_id``."""
    return spark.read.format(fmt).schema(HISTORY_SCHEMA + ", day date, load_id string").load(path)


def history_for_day(history: DataFrame, day: dt.date) -> DataFrame:
    """Rows loaded on one UTC day.

    The date test alone cannot prune folders, because they are named by year and
    month; both are therefore given too.
    """
    return history.filter(
        (F.col("year") == day.year)
        & (F.col("month") == day.month)
        & (F.to_date("ingest_timestamp_utc") == F.lit(day))
    )
