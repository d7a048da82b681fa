"""Norms and validity of vectors, and the table that remembers them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.functions import vectors as VX
from shelflens.functions.text import is_blank

OK, FAILED = "ok", "failed"


def with_norm(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add ``norm``, computed once per row and carried along."""
    return rows.withColumn("norm", VX.norm(F.col(vector)))


def check_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add ``norm`` and ``reject`` (why the vector cannot be scored, NULL if it can)."""
    return with_norm(rows, vector).withColumn(
        "reject", VX.reject_reason(F.col(vector), F.col("norm"))
    )


def valid_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Only the rows that can be scored, with their ``norm``."""
    return with_norm(rows.filter(VX.is_valid(F.col(vector))), vector)


def rejected_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    return check_vectors(rows, vector).filter(F.col("reject").isNotNull())


def require_vectors(rows: DataFrame) -> DataFrame:
    """The same rows; raises when there is none to match against."""
    if rows.isEmpty():
        raise ValueError("no valid catalogue vector: nothing to match against")
    return rows


def texts_to_embed(texts: DataFrame, model: str) -> DataFrame:
    """Distinct non-blank texts of column ``text`` with the model that should embed them."""
    return texts.filter(~is_blank(F.col("text"))).select(
        "text", F.lit(model).alias("model")
    ).distinct()


def cache_misses(
    texts: DataFrame, cache: DataFrame, model: str, retry_failed: bool = False
) -> DataFrame:
    """Texts without a cache entry. Failed entries count as present unless retried."""
    known = cache.filter(F.col("model") == model)
    if retry_failed:
        known = known.filter(F.col("status") == OK)
    return texts_to_embed(texts, model).join(known, ["text", "model"], "left_anti")


def cache_lookup(texts: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """Every row of ``texts`` with its ``embedding`` and ``status``; ``missing`` if unknown."""
    known = cache.filter(F.col("model") == model).select("text", "embedding", "status")
    return texts.join(known, "text", "left").withColumn(
        "status", F.coalesce("status", F.lit("missing"))
    )
