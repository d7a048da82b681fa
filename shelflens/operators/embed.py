"""Text to vector: native character trigrams, or a user's batch function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.config import EMBED_BATCH
from shelflens.functions.text import trigram_counts
from shelflens.functions.retry import retrying
from shelflens.operators.keep import spread
from shelflens.operators.vectors import FAILED, OK, cache_misses
from shelflens.sources.tables import CACHE_SCHEMA

EmbedFunction = Callable[[list[str]], Sequence[Sequence[float]]]


def trigram_vectors(texts: DataFrame, text: str = "product_name") -> DataFrame:
    """Add ``grams``, ``tf`` (parallel arrays) and ``norm`` of the lower-cased text."""
    return (
        texts.withColumn("_v", trigram_counts(F.lower(F.col(text))))
        .select("*", "_v.grams", "_v.tf")
        .drop("_v")
        .withColumn(
            "norm", F.sqrt(F.aggregate("tf", F.lit(0).cast("double"), lambda a, x: a + x * x))
        )
    )


def valid_trigrams(texts: DataFrame, text: str = "product_name") -> DataFrame:
    """Vectors of all texts that have one: every text but the empty one."""
    return trigram_vectors(texts.filter(F.length(text) > 0), text)


def asked_in_halves(ask: EmbedFunction, texts: list[str]) -> list[list[float] | None]:
    """The vector of each text; None for a text that fails alone.

    A batch that fails is asked again in two halves, so one bad text costs some more calls and
    none of its neighbours.
    """
    try:
        vectors = [[float(x) for x in v] for v in ask(texts)]
        if len(vectors) != len(texts):
            raise ValueError("one vector per text expected")
        return vectors
    except Exception:
        if len(texts) == 1:
            return [None]
    half = len(texts) // 2
    return asked_in_halves(ask, texts[:half]) + asked_in_halves(ask, texts[half:])


def embed_texts(
    misses: DataFrame,
    embed: EmbedFunction,
    batch_size: int = EMBED_BATCH,
    *,
    pause: float = 0.0,
    attempts: int = 1,
    retry_pause: float = 5.0,
    partitions: int | None = None,
) -> DataFrame:
    """Run a user function over ``(text, model)`` rows in batches.

    A batch that raises in all ``attempts`` is halved until the texts that fail are alone;
    these become ``failed`` rows with empty vectors, so that the next run does not try them
    again unless asked to. The texts are spread
    over ``partitions`` tasks (see ``spread`` for the default): the function, not the
    amount of text, sets the time.
    """
    ask = retrying(embed, attempts, retry_pause)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                vectors = asked_in_halves(ask, part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "text": part["text"].values,
                        "model": part["model"].values,
                        "embedding": [v or [] for v in vectors],
                        "status": [OK if v else FAILED for v in vectors],
                    }
                )
                if pause:
                    time.sleep(pause)

    return spread(misses.select("text", "model"), partitions).mapInPandas(run, CACHE_SCHEMA)


def embed_misses(
    texts: DataFrame, cache: DataFrame, model: str, embed: EmbedFunction, *,
    batch_size: int = EMBED_BATCH, retry_failed: bool = False, attempts: int = 1,
) -> DataFrame:
    """Cache rows, with their states, of the texts that the cache lacks; nothing is stored."""
    misses = cache_misses(texts, cache, model, retry_failed)
    return embed_texts(misses, embed, batch_size, attempts=attempts)


def refreshed(
    texts: DataFrame, cache: DataFrame, model: str, embed: EmbedFunction, *,
    batch_size: int = EMBED_BATCH, attempts: int = 1,
) -> DataFrame:
    """The model's cache rows as they are after a refresh, with ``origin``: cached or new."""
    new = embed_misses(texts, cache, model, embed, batch_size=batch_size, attempts=attempts)
    known = cache.filter(F.col("model") == model).select("text", "model", "embedding", "status")
    return known.withColumn("origin", F.lit("cached")).unionByName(new.withColumn("origin", F.lit("new")))


def refresh_cache(
    texts: DataFrame,
    cache_path: str,
    model: str,
    embed: EmbedFunction,
    *,
    batch_size: int = EMBED_BATCH,
    retry_failed: bool = False,
    attempts: int = 1,
) -> DataFrame:
    """Embed what the cache lacks, append it once, return the cache.

    With ``retry_failed`` a later ``ok`` row stands beside the earlier failed one;
    readers see the ``ok`` row only.
    """
    from shelflens.sources.files import path_exists

    spark = texts.sparkSession
    if path_exists(spark, cache_path):
        cache = read_cache(texts, cache_path)
    else:
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    new = embed_misses(
        texts, cache, model, embed, batch_size=batch_size, retry_failed=retry_failed, attempts=attempts
    )
    new.write.mode("append").partitionBy("model", "status").parquet(cache_path)
    return read_cache(texts, cache_path)


def read_cache(like: DataFrame, cache_path: str) -> DataFrame:
    """The cache, one row per text and model; a failed row is left out once there is an ``ok`` row.

    Two runs at once may have stored a text twice; the smaller vector counts, so that every
    reader sees the same one. Models and states are folders.
    """
    stored = like.sparkSession.read.schema(CACHE_SCHEMA).parquet(cache_path)
    good = (
        stored.filter(F.col("status") == OK)
        .groupBy("text", "model", "status")
        .agg(F.min("embedding").alias("embedding"))
    )
    failed = stored.filter(F.col("status") == FAILED)
    columns = ["text", "model", "embedding", "status"]
    return good.select(*columns).unionByName(
        failed.join(good.select("text", "model"), ["text", "model"], "left_anti")
        .select(*columns)
        .dropDuplicates(["text", "model"])
    )
