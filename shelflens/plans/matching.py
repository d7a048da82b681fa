"""Match the product names of two catalogues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelflens.config import EMBED_BATCH, MIN_SIMILARITY, TOP_N, JobConfig
from shelflens.operators.decide import decide_match, keep_verified, pack_candidates, top1_match
from shelflens.operators.embed import EmbedFunction, refresh_cache, refreshed, valid_trigrams
from shelflens.operators.history import split_catalogs
from shelflens.operators.keep import keep, released, spread
from shelflens.operators.latest import latest_per_product
from shelflens.operators.namemap import NAMES, accepted_pairs, new_numbers
from shelflens.operators.sparse_topk import sparse_topk
from shelflens.operators.topk import dense_topk
from shelflens.operators.vectors import cache_lookup, require_vectors, valid_vectors
from shelflens.operators.verify import (
    Judge,
    judge_reply,
    resolve_reply,
    rule_reply,
    verify_payload,
)
from shelflens.sources.files import path_exists
from shelflens.sources.sinks import write_csv
from shelflens.sources.tables import NAME_MAP_SCHEMA, read_history

Search = Callable[[DataFrame, DataFrame, int, list[str]], DataFrame]


def trigram_search(min_similarity: float | None = None) -> Search:
    """Search on native character trigrams: the best names that share any.

    With ``min_similarity`` it finds only candidates at or above it and is cheaper; for
    use where a later filter drops the others anyway.
    """

    def search(queries: DataFrame, base: DataFrame, k: int, block_on: list[str]) -> DataFrame:
        # The names are kept; their vectors are cheaper to make again than to store.
        q = valid_trigrams(spread(queries), "query_name")
        c = valid_trigrams(spread(base), "name")
        return sparse_topk(q, c, k, min_similarity=min_similarity, block_on=block_on)

    return search


def _vector_search(cache_of: Callable[[DataFrame], DataFrame], model: str) -> Search:
    """Search on the vectors of a cache; ``cache_of`` gives it for the texts that are needed."""

    def search(queries: DataFrame, base: DataFrame, k: int, block_on: list[str]) -> DataFrame:
        names = queries.select(F.col("query_name").alias("text")).unionByName(
            base.select(F.col("name").alias("text"))
        )
        cache = cache_of(names)

        def vectors(side: DataFrame, row_id: str, name: str) -> DataFrame:
            texts = side.select(row_id, *block_on, F.col(name).alias("text"))
            found = cache_lookup(texts, cache, model).withColumnRenamed("embedding", "vector")
            return valid_vectors(found, "vector").select(row_id, *block_on, "vector", "norm")

        # Tested for rows, measured, then searched: looked up once.
        catalog = require_vectors(keep(vectors(base, "catalog_id", "name")))
        return dense_topk(vectors(queries, "query_id", "query_name"), catalog, k, block_on=block_on)

    return search


def embedding_search(
    cache_path: str,
    model: str,
    embed: EmbedFunction,
    *,
    batch_size: int = EMBED_BATCH,
    retry_failed: bool = False,
) -> Search:
    """Search on a user's embeddings through the embedding cache."""

    def cache_of(names: DataFrame) -> DataFrame:
        return refresh_cache(
            names, cache_path, model, embed, batch_size=batch_size, retry_failed=retry_failed
        )

    return _vector_search(cache_of, model)


def embedding_search_over(
    cache: DataFrame, model: str, embed: EmbedFunction, *, batch_size: int = EMBED_BATCH
) -> Search:
    """The same over a cache that is only read: what it lacks is embedded for this search alone."""

    def cache_of(names: DataFrame) -> DataFrame:
        # Both sides look texts up: each is embedded once.
        return keep(refreshed(names, cache, model, embed, batch_size=batch_size))

    return _vector_search(cache_of, model)


def _sides(
    query_df: DataFrame, base_df: DataFrame, dedup: bool, block_on: list[str], k: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is searched for, all query rows, and the catalogue.

    A query's id is its product name and block: equal names have equal candidates, so
    each is searched for once, and every row of that id gets the result. Without
    ``dedup`` the ``k`` cheapest listings of a catalogue name are its candidates.

    The searched sides are read several times, so they are kept: one short row per
    product, however long its history is. Both are one job.
    """
    keys = ["product_name", *block_on]

    def prepare(rows: DataFrame) -> DataFrame:
        rows = rows.filter(F.col("product_name").isNotNull() & (F.col("product_name") != ""))
        if dedup:
            rows = latest_per_product(rows, tuple(keys))
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in keys]
        return rows.select(
            F.concat_ws("\u0001", *texts).alias("id"),
            F.col("product_name").alias("name"),
            F.col("sale_price").alias("price"),
            *block_on,
        )

    queries, base = prepare(query_df), prepare(base_df)
    asked = queries
    if not dedup:
        asked = queries.dropDuplicates(["id"])
        cheapest = Window.partitionBy("id").orderBy(F.col("price").asc_nulls_last())
        base = base.withColumn("_copy", F.row_number().over(cheapest))
        base = base.filter(F.col("_copy") <= k).withColumn(
            "id", F.concat_ws("\u0001", "id", F.lpad(F.col("_copy").cast("string"), 10, "0"))
        ).drop("_copy")
    both = keep(
        asked.withColumn("is_query", F.lit(True)).unionByName(
            base.withColumn("is_query", F.lit(False))
        )
    )
    names = {"id": "query_id", "name": "query_name", "price": "query_price"}
    asked = both.filter(F.col("is_query")).drop("is_query").withColumnsRenamed(names)
    base = both.filter(~F.col("is_query")).drop("is_query").withColumnRenamed("id", "catalog_id")
    return asked, asked if dedup else queries.withColumnsRenamed(names), base


def ranked_candidates(
    query_df: DataFrame,
    base_df: DataFrame,
    search: Search | None = None,
    *,
    top_n: int = TOP_N,
    block_on: list[str] | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Each query product with its ranked candidates from the base catalogue.

    Without ``dedup`` it is one row per query listing instead, equal ones included.
    """
    blocks = list(block_on or [])
    asked, queries, base = _sides(query_df, base_df, dedup, blocks, top_n)
    topk = (search or trigram_search())(asked, base, top_n, blocks)
    return pack_candidates(topk, queries.drop(*blocks), base)


def match_catalogs(
    query_df: DataFrame,
    base_df: DataFrame,
    search: Search | None = None,
    judge: Judge | None = None,
    *,
    top_n: int = TOP_N,
    block_on: list[str] | None = None,
    dedup: bool = True,
    attempts: int = 3,
    pause: float = 5.0,
) -> DataFrame:
    """One match row per query product (per listing without ``dedup``), verified or not;
    see ``keep_verified``."""
    rows = ranked_candidates(
        query_df, base_df, search, top_n=top_n, block_on=block_on, dedup=dedup
    )
    if judge is None:
        replied = rule_reply(rows)
    else:
        replied = judge_reply(verify_payload(rows), judge, attempts, pause)
    return decide_match(resolve_reply(replied))


def match_top1(
    query_df: DataFrame,
    base_df: DataFrame,
    search: Search | None = None,
    *,
    block_on: list[str] | None = None,
    dedup: bool = True,
) -> DataFrame:
    """The best base product of each query product, without verification."""
    blocks = list(block_on or [])
    asked, queries, base = _sides(query_df, base_df, dedup, blocks, 1)
    topk = (search or trigram_search())(asked, base, 1, blocks)
    return top1_match(topk, queries.drop(*blocks), base)


def run_matching(
    spark: SparkSession,
    config: JobConfig,
    search: Search | None = None,
    judge: Judge | None = None,
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """Match the two shops of the whole history and write the result to the cache area.

    Returns the stored result; ``write_name_map`` turns it into the report's map. The
    native rule accepts the best name it can, so names below the filter need no search;
    a judge is shown all.
    """
    if search is None and judge is None:
        search = trigram_search(min_similarity)
    queries, base = split_catalogs(read_history(spark, config.history, config.table_format))
    with released():
        result = keep_verified(match_catalogs(queries, base, search, judge), min_similarity)
        result.write.mode("overwrite").parquet(config.match_result)
    return spark.read.parquet(config.match_result)


def write_name_map(
    spark: SparkSession, config: JobConfig, reviewed: DataFrame | None = None
) -> None:
    """Number the stored matches (and reviews) and save them as the map CSV.

    Numbers are given once: new pairs are added to the list of numbers, then the map is the
    part of it that is matched or accepted now. A run that is repeated adds nothing.
    """
    with released():
        pairs = keep(accepted_pairs(spark.read.parquet(config.match_result), reviewed))
        if path_exists(spark, config.name_numbers):
            numbered = spark.read.schema(NAME_MAP_SCHEMA).parquet(config.name_numbers)
        else:
            numbered = spark.createDataFrame([], NAME_MAP_SCHEMA)
        new_numbers(pairs, numbered).write.mode("append").parquet(config.name_numbers)
        numbered = spark.read.schema(NAME_MAP_SCHEMA).parquet(config.name_numbers)
        current = numbered.join(pairs, NAMES, "left_semi").select("product_no", *NAMES)
        write_csv(current, config.name_map, mode="overwrite")
