"""Latest rows per load, merged to latest rows per day.

Which of two rows of a product is the later one does not depend on any third, so the latest of a
day is the latest of its loads' latest rows. A load leaves one row for each of its products and
days; a day's report merges those and never reads the day's listings again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.operators.latest import latest_by_shop

KEYS = ["day", "ecommerce_name", "product_name"]


def load_partials(rows: DataFrame) -> DataFrame:
    """Of history rows with ``load_id`` the latest of each day, load, shop and product, with ``day``."""
    dated = rows.withColumn("day", F.to_date("ingest_timestamp_utc"))
    return latest_by_shop(dated, keys=(*KEYS, "load_id"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """The latest row of each day, shop and product."""
    return latest_by_shop(partials, keys=tuple(KEYS)).drop("load_id")
