"""One query per operator, over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import (
    MAP_BASE_NAME,
    MAP_QUERY_NAME,
    MATCH_BASE_NAME,
    MATCH_QUERY_NAME,
    MIN_SIMILARITY,
    PAGE_SIZE,
    SHOP_L,
    SHOP_W,
    SPEC_L,
    SPEC_W,
    SPECS,
    STRICT_MIN_SIMILARITY,
    JobConfig,
)
from shelflens.functions import variants as V
from shelflens.functions.numbers import SCORE_DIGITS, clean_price
from shelflens.operators import decide, embed, flatten, history, latest, namemap, paging, snapshot, topk, verify
from shelflens.operators import sparse_topk as sparse
from shelflens.operators.keep import keep, spread
from shelflens.operators.embed import trigram_vectors, valid_trigrams
from shelflens.operators.vectors import cache_lookup, cache_misses, check_vectors, valid_vectors
from shelflens.operators.vectors import with_norm
from shelflens.plans import driver_tables as D
from shelflens.plans import matching, report
from shelflens.plans.ingest import decode_sources, history_build
from shelflens.sources.files import remove_matches, table_exists
from shelflens.sources.landing import land_envelopes, landing_inventory, select_landing, stamp_envelopes
from shelflens.sources.sinks import MANIFEST_SCHEMA, append_history, write_clustered, write_csv
from shelflens.sources.tables import HISTORY_COLUMNS, NAME_MAP_SCHEMA, PRODUCTS_SCHEMA
from shelflens.sources.tables import csv_records, history_columns, history_for_day, parse_records
from shelflens.sources.tables import read_history, read_report
from shelflens.streaming.ingest import start_ingest

DAY = dt.date.fromisoformat(D.LAST_DAY)
LOAD_TS = dt.datetime(2025, 1, 31, 1, 0, 5, 123456)
MODEL = "char3"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
Query = Callable[[SparkSession, str], DataFrame]


# ---- history and report


def price_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.price_report(D.listings(spark, sf_dir), D.name_map(spark, sf_dir), DAY)


def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_columns(D.listings(spark, sf_dir))


def report_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_for_day(D.listings(spark, sf_dir), DAY).select(*HISTORY_COLUMNS)


def catalog_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, base = history.split_catalogs(D.listings(spark, sf_dir))
    cols = ["product_name", "sale_price"]
    return queries.select(F.lit("query").alias("side"), *cols).unionByName(
        base.select(F.lit("base").alias("side"), *cols)
    )


def latest_cheapest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.of_shop(D.listings(spark, sf_dir), SHOP_L)
    return latest.latest_cheapest(rows.select("product_name", "sale_price", "ingest_timestamp_utc"))


def latest_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.of_shop(D.listings(spark, sf_dir), SHOP_W)
    return latest.latest_per_product(
        rows.select("product_name", "sale_price", "ingest_timestamp_utc")
    )


def map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.listings(spark, sf_dir).select(
        "product_name", "sale_price", "ingest_timestamp_utc", "ecommerce_name"
    )
    return report.map_join(latest.latest_by_shop(rows), D.name_map(spark, sf_dir))


def step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.step_counts(D.listings(spark, sf_dir), D.name_map(spark, sf_dir), DAY)


def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.distinct_names(*history.split_catalogs(D.disturbed(D.listings(spark, sf_dir))))


# ---- landing


def _documents(spark: SparkSession, sf_dir: str) -> dict:
    return {SPEC_L: D.landing_l(spark, sf_dir), SPEC_W: D.landing_w(spark, sf_dir)}


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    every = docs[SPEC_L].select("file").unionByName(docs[SPEC_W].select("file"))
    return landing_inventory(every, list(SPECS))


def landing_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of the last day takes: the day's documents of both shops."""
    chosen = [
        select_landing(docs, DAY, spec).select("file", F.lit(spec.name).alias("ecommerce_name"))
        for spec, docs in _documents(spark, sf_dir).items()
    ]
    return history.union_sources(chosen)


def _job(spark: SparkSession) -> JobConfig:
    """A job's folders below the shared checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="shelflens-")
    return JobConfig(f"{shared.rstrip('/')}/job-{uuid.uuid4().hex}")


def _held(rows: DataFrame, config: JobConfig) -> DataFrame:
    """``rows`` held by the session before the job's files go."""
    result = keep(rows)
    result.count()
    if rows.sparkSession.sparkContext.getCheckpointDir() is not None:
        remove_matches(rows.sparkSession, config.root)
    return result


def history_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings appended in two runs, the table copied in order of load time, and the copy read.

    The second run finds the table that the first one made, and adds to it.
    """
    config = _job(spark)
    rows = D.listings(spark, sf_dir)
    for there, part in ((False, rows.filter("l_orderkey % 3 = 0")), (True, rows.filter("l_orderkey % 3 <> 0"))):
        if table_exists(spark, config.history) != there:
            raise RuntimeError(f"{config.history} exists: {not there}")
        append_history(part, config.history)
    ordered = f"{config.root}/history_by_time"
    write_clustered(read_history(spark, config.history), ordered)
    return _held(read_history(spark, ordered), config)


def ingest_stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents landed, loaded by the file stream, and every touched day's report as written.

    Works below the shared checkpoint folder and leaves nothing there but the kept result.
    """
    config = _job(spark)
    for spec, docs in _documents(spark, sf_dir).items():
        day = F.regexp_extract("file", r"pre_landing/(\d{4}-\d{2}-\d{2})/", 1)
        landed = docs.select(
            F.col("file").alias("object_name"), "value", day.alias("ingest_date"),
            F.lit(spec.envelope_name).alias("ecommerce_name"), F.lit(None).cast("string").alias("reason"),
        )
        land_envelopes(landed, config)
    write_csv(D.name_map(spark, sf_dir), config.name_map)
    start_ingest(spark, config).awaitTermination()
    rows = read_report(spark, f"{config.root}/reports/*")
    said = spark.read.schema(MANIFEST_SCHEMA).json(f"{config.root}/metadata/*").select(
        F.to_date(F.regexp_extract("path", r"([^/]*)$", 1)).alias("day"), "row_count"
    )
    day = F.to_date("ingest_timestamp_utc")
    return _held(rows.withColumn("day", day).join(F.broadcast(said), "day"), config)


def flatten_shop_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(D.landing_l(spark, sf_dir), SPEC_L)


def flatten_shop_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(D.landing_w(spark, sf_dir), SPEC_W)


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = [
        flatten.quarantine(D.damaged(docs), spec)
        for spec, docs in _documents(spark, sf_dir).items()
    ]
    return bad[0].unionByName(bad[1]).select(
        "file", F.coalesce("pos", F.lit(-1)).alias("pos"), "reason"
    )


def history_build_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_build(decode_sources(_documents(spark, sf_dir)), LOAD_TS)


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        history.product_rows(flatten.flatten(docs, spec), spec.name)
        for spec, docs in _documents(spark, sf_dir).items()
    ]
    return history.union_sources(parts)


def _awkward(name: str, turn: str) -> Column:
    """Names with what a careless CSV loses: outer blanks, quotes, commas, line breaks, nothing."""
    n, kind = F.col(name), F.col(turn) % 8
    return (
        F.when(kind == 0, F.concat(F.lit("  "), n))
        .when(kind == 1, F.concat(n, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit('5" pack, '), n))
        .when(kind == 3, F.concat(F.lit('"'), n, F.lit('"')))
        .when(kind == 4, F.concat(n, F.lit("\nrefill \\")))
        .when(kind == 5, F.lit(""))
        .when(kind != 6, n)
    )


def products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.listings(spark, sf_dir).withColumn("product_name", _awkward("product_name", "l_orderkey"))
    labelled = [history.product_rows(history.of_shop(rows, s.name), s.name) for s in SPECS]
    back = parse_records(csv_records(history.union_sources(labelled)), PRODUCTS_SCHEMA)
    return back.withColumn("product_name", F.coalesce("product_name", F.lit("(none)")))


def name_map_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.name_map(spark, sf_dir).withColumn(MAP_QUERY_NAME, _awkward(MAP_QUERY_NAME, "product_no"))
    back = parse_records(csv_records(rows), NAME_MAP_SCHEMA)
    return back.select(
        "product_no",
        F.coalesce(MAP_QUERY_NAME, F.lit("(none)")).alias("query_name"),
        F.col(MAP_BASE_NAME).alias("base_name"),
    )


def price_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, kind = F.col("value").cast("string"), F.col("event_id") % 12
    thai = F.translate(text, "0123456789", "๐๑๒๓๔๕๖๗๘๙")
    dirty = (
        F.when(kind == 0, F.concat(F.lit("฿"), F.format_number("value", 2)))
        .when(kind == 1, F.concat(F.lit("$ "), text, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("THB "), text))
        .when(kind == 3, F.concat(text, F.lit("d")))
        .when(kind == 4, F.lit("1_000"))
        .when(kind == 5, F.lit("1e3"))
        .when(kind == 6, thai)
        .when(kind == 7, F.concat(F.lit(" "), text, F.lit(" €\n")))
        .when(kind == 8, F.lit("0x1p3"))
        .when(kind == 9, F.lit(""))
        .when(kind == 10, F.lit("-Infinity"))
        .otherwise(F.concat(F.lit("+"), text))
    )
    return D.table(spark, sf_dir, "events").select(
        "event_id", clean_price(dirty).alias("price")
    )


def falsy_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One spelling per JSON type, falsy ones first.
    spellings = ["0", "0.0", '""', "null", "false", "[]", "{}", '"0"', "3.5", '"4.5"']
    n = len(spellings) + 1
    kind = (F.col("event_id") % n).cast("int")
    first = F.get(F.array(*map(F.lit, spellings)), kind)
    doc = F.concat(
        F.lit("{"),
        F.coalesce(F.concat(F.lit('"salePrice":'), first, F.lit(",")), F.lit("")),
        F.lit('"price":'),
        F.to_json(F.struct(F.col("value"))).substr(F.lit(10), F.lit(1000)),
    )
    parsed = D.table(spark, sf_dir, "events").select(
        "event_id", F.try_parse_json(doc).alias("doc")
    )
    chosen = V.first_truthy([V.at(F.col("doc"), p) for p in SPEC_L.price_paths])
    return parsed.select("event_id", clean_price(V.as_text(chosen)).alias("price"))


def envelope_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh response is no object: a list, an error page, or nothing."""
    i, props = F.col("event_id"), F.col("props")
    body = (
        F.when(i % 21 == 7, F.concat(F.lit("["), props, F.lit("]")))
        .when(i % 21 == 14, F.concat(F.lit("<html>"), props, F.lit("</html>")))
        .when(i % 21 != 0, props)
    )
    responses = D.table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id", body.alias("body")
    )
    stamped = stamp_envelopes(
        responses,
        shop=F.lit(SPEC_L.envelope_name),
        query=F.concat("event_type", F.lit(" ครีม#"), "user_id"),
        page=F.col("event_id"),
        fetched_at=F.col("ts"),
    )
    return stamped.select(
        "event_id", "object_name", "ingest_date", "ecommerce_name", "ingest_timestamp_utc",
        F.coalesce("value", F.lit("-")).alias("value"), F.coalesce("reason", F.lit("-")).alias("reason"),
    )


# ---- paging


def _declared(spark: SparkSession, sf_dir: str) -> dict:
    """First-page envelopes of every shop and brand, and what they declare."""
    counts = (
        D.listings(spark, sf_dir)
        .groupBy("ecommerce_name", F.col("brand").alias("query"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("pages", F.ceil(F.col("rows") / PAGE_SIZE).cast("int"))
    )
    shapes = {
        SPEC_L: F.struct(
            F.struct(
                F.struct(
                    F.col("pages").alias("totalPage"), F.col("rows").alias("totalShop")
                ).alias("shops")
            ).alias("data")
        ),
        SPEC_W: F.struct(
            F.struct(
                F.lit(0).alias("currentPage"),
                F.col("pages").alias("totalPages"),
                F.col("rows").alias("totalResults"),
            ).alias("pagination")
        ),
    }
    return {
        spec: paging.declared_pages(
            counts.filter(F.col("ecommerce_name") == spec.name).select(
                "ecommerce_name", "query", F.to_json(shape).alias("value")
            ),
            spec,
        ).drop("value")
        for spec, shape in shapes.items()
    }


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.union_sources(
        [paging.page_plan(rows, spec) for spec, rows in _declared(spark, sf_dir).items()]
    )


def page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["ecommerce_name", "query"]
    declared = history.union_sources(
        [
            rows.withColumn("first_page", F.lit(spec.first_page))
            for spec, rows in _declared(spark, sf_dir).items()
        ]
    )
    # Brands that end in 5 declare no results at all, though their listings landed.
    empty = F.col("query").endswith("5")
    declared = declared.withColumn(
        "total_pages", F.when(empty, 0).otherwise(F.col("total_pages"))
    ).withColumn("total_results", F.when(empty, 0).otherwise(F.col("total_results")))
    # A product lands on a page given by its order; one page more than declared is used, the
    # second is never.
    landed = (
        D.listings(spark, sf_dir)
        .withColumnRenamed("brand", "query")
        .join(declared.select(*keys, "total_pages", "first_page"), keys)
        .withColumn("turn", F.col("l_orderkey") % (F.col("total_pages") + 1))
        .select(
            *keys,
            (F.when(F.col("turn") == 1, 0).otherwise(F.col("turn")) + F.col("first_page")).alias(
                "page"
            ),
        )
    )
    return paging.page_coverage(declared, landed, keys)


# ---- vectors


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "embeddings")


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of which some are empty, zero, or hold a NULL or NaN."""
    v, i = F.col("embedding"), F.col("vec_id")
    spoiled = (
        F.when(i % 11 == 0, F.array().cast("array<float>"))
        .when(i % 13 == 0, F.transform(v, lambda x: F.lit(0.0).cast("float")))
        .when(i % 17 == 0, F.transform(v, lambda x, n: F.when(n != 3, x)))
        .when(
            i % 19 == 0,
            F.transform(v, lambda x, n: F.when(n == 5, float("nan")).otherwise(x).cast("float")),
        )
        .otherwise(v)
    )
    return _embeddings(spark, sf_dir).withColumn("embedding", spoiled)


def _vector_sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Even ids ask, odd ids are the catalogue."""
    good = valid_vectors(rows).withColumnRenamed("embedding", "vector")
    even = F.col("vec_id") % 2 == 0
    return (
        good.filter(even).select(F.col("vec_id").alias("query_id"), "vector", "norm"),
        good.filter(~even).select(F.col("vec_id").alias("catalog_id"), "vector", "norm"),
    )


def vector_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_norm(_embeddings(spark, sf_dir)).select(
        "vec_id", F.round("norm", SCORE_DIGITS).alias("norm")
    )


def vector_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_vectors(_spoiled(spark, sf_dir)).select(
        "vec_id", F.coalesce("reject", F.lit("ok")).alias("state")
    )


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.dense_topk(*_vector_sides(_embeddings(spark, sf_dir)))


def cosine_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.dense_topk(*_vector_sides(_embeddings(spark, sf_dir)), 1).drop("rank")


def cosine_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.pivot_topk(*_vector_sides(_embeddings(spark, sf_dir)), pivots=64)


def cosine_topk_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within groups of vectors: a third of all rows is one group, the others are small."""
    rows = _embeddings(spark, sf_dir)
    shelf = F.when(F.col("vec_id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("shelf "), (F.floor(F.col("vec_id") / 2) % 40).cast("string"))
    )
    sides = []
    for side, row_id in zip(_vector_sides(rows), ("query_id", "catalog_id"), strict=True):
        labelled = rows.select(F.col("vec_id").alias(row_id), shelf.alias("shelf"))
        sides.append(side.join(labelled, row_id))
    return topk.dense_topk(*sides, block_on=["shelf"])


def lsh_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.lsh_topk(*_vector_sides(_embeddings(spark, sf_dir)), tables=24, bits=4)


# ---- trigrams and the cache


def _catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_names(spark, sf_dir)


def ngram_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = trigram_vectors(_catalog_names(spark, sf_dir))
    return vectors.select(
        "product_name", F.explode(F.arrays_zip("grams", "tf")).alias("e")
    ).select("product_name", F.col("e.grams").alias("gram"), F.col("e.tf").alias("tf"))


def ngram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unblocked: the whole catalogues against each other."""
    queries, base = history.split_catalogs(D.disturbed(D.listings(spark, sf_dir)))

    def side(rows: DataFrame, row_id: str) -> DataFrame:
        names = spread(keep(rows.select("product_name").distinct()))
        return valid_trigrams(names).withColumnRenamed("product_name", row_id)

    return sparse.sparse_topk(side(queries, "query_id"), side(base, "catalog_id"), min_similarity=0.8)


def _cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache that knows every third part's name; its vectors come from ``embeddings``."""
    v = _embeddings(spark, sf_dir).select("vec_id", "embedding")
    known = (
        D.parts(spark, sf_dir)
        .filter(F.col("p_partkey") % 3 == 0)
        .groupBy("product_name")
        .agg(F.min("p_partkey").alias("vec_id"))
    )
    return known.join(v, "vec_id", "left").select(
        F.col("product_name").alias("text"),
        F.lit(MODEL).alias("model"),
        F.coalesce("embedding", F.array().cast("array<float>")).alias("embedding"),
        F.when(F.col("embedding").isNull(), "failed").otherwise("ok").alias("status"),
    )


def letter_vectors(texts: list[str]) -> list[list[float]]:
    """A service that embeds by length and letters, and fails on any batch with a promotion in it."""
    if any("PROMO" in t for t in texts):
        raise RuntimeError("no vector for a promotion")
    return [[float(len(t)), float(t.count("e")), 1.0] for t in texts]


def embedding_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = D.parts(spark, sf_dir).select(F.col("product_name").alias("text"))
    rows = embed.refreshed(names, _cache(spark, sf_dir), MODEL, letter_vectors)
    return rows.select(
        "text", "model", "status", "origin", F.size("embedding").alias("dimension"),
        F.coalesce(F.round(F.get("embedding", F.lit(0)).cast("double"), SCORE_DIGITS), F.lit(-9.0)).alias("first"),
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listing names, and a blank for every product sold by the piece."""
    return D.listings(spark, sf_dir).select(
        F.when(F.col("l_quantity") == 1, "  ").otherwise(F.col("product_name")).alias("text")
    )


def embedding_cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache_misses(_texts(spark, sf_dir), _cache(spark, sf_dir), MODEL)


def embedding_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir).distinct()
    found = cache_lookup(texts, _cache(spark, sf_dir), MODEL)
    return found.select(
        "text", "status", F.coalesce(F.size("embedding"), F.lit(-1)).alias("dimension")
    )


# ---- matching, blocked by brand


def _match_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return history.split_catalogs(D.disturbed(D.listings(spark, sf_dir)))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.ranked_candidates(*_match_sides(spark, sf_dir), block_on=["brand"])


def _brief(matches: DataFrame) -> DataFrame:
    """The match columns under plain names."""
    return matches.withColumnsRenamed(
        {MATCH_QUERY_NAME: "query_name", MATCH_BASE_NAME: "base_name"}
    )


def verify_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verify_payload(_candidates(spark, sf_dir)).select("query_name", "payload")


def verify_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.rule_reply(_candidates(spark, sf_dir)).select("query_name", "reply")


def verify_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of all kinds: padded names, refusals, names that are not candidates."""
    kind = F.length("query_name") % 4
    reply = (
        F.when(kind == 0, F.concat(F.lit(" "), F.get("names", F.lit(1)), F.lit("\n")))
        .when(kind == 1, F.lit("None"))
        .when(kind == 2, F.lit("FALSE"))
        .otherwise(F.concat(F.get("names", F.lit(0)), F.lit("!")))
    )
    rows = _candidates(spark, sf_dir).withColumn("reply", reply)
    return verify.resolve_reply(rows).select(
        "query_name",
        F.coalesce("verified_name", F.lit("-")).alias("verified_name"),
        F.coalesce("verified_at", F.lit(0)).alias("verified_at"),
    )


def choosy_judge(payload: str) -> str:
    """A judge that takes the last candidate of names of even length and cannot stand promotions."""
    name, rest = payload.removeprefix("Base product: ").split("\nCandidates:\n", 1)
    if "PROMO" in name.upper():
        raise RuntimeError("no answer")
    listed = [line[2:] for line in rest.split("\n") if line.startswith("- ")]
    return f" {listed[-1]}\n" if len(name) % 2 == 0 and listed else "None"


def judge_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = verify.verify_payload(_candidates(spark, sf_dir))
    replied = verify.judge_reply(asked, choosy_judge, attempts=3, pause=0.0)
    return _brief(decide.decide_match(verify.resolve_reply(replied), also=("attempts", "failed")))


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A service that embeds by letters and digits, and fails on any batch with a promotion in it."""
    if any("PROMO" in t for t in texts):
        raise RuntimeError("no vector for a promotion")
    return [[float(t.lower().count(c)) for c in LETTERS] for t in texts]


def match_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match with a user's embeddings, through a cache that knows some texts to fail, and a judge."""
    lost = D.parts(spark, sf_dir).filter(F.col("p_partkey") % 7 == 0).select(
        F.col("product_name").alias("text"), F.lit("letters").alias("model"),
        F.array().cast("array<float>").alias("embedding"), F.lit("failed").alias("status"),
    )
    search = matching.embedding_search_over(lost.dropDuplicates(["text"]), "letters", letter_counts)
    sides = _match_sides(spark, sf_dir)
    return _brief(
        matching.match_catalogs(*sides, search, choosy_judge, block_on=["brand"], attempts=2, pause=0.0)
    )


def match_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(matching.match_catalogs(*_match_sides(spark, sf_dir), block_on=["brand"]))


def match_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing of shop L, not one per product, with the best name of shop W."""
    rows = matching.match_top1(*_match_sides(spark, sf_dir), block_on=["brand"], dedup=False)
    return _brief(rows).select("query_name", "price_from_line", "base_name", "similarity")


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``run_matching`` does: the filter's cut may go into the search under the native rule."""
    search = matching.trigram_search(MIN_SIMILARITY)
    matches = matching.match_catalogs(*_match_sides(spark, sf_dir), search, block_on=["brand"])
    return decide.keep_verified(matches)


def match_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(_verified(spark, sf_dir))


def _top1(spark: SparkSession, sf_dir: str, cut: float) -> DataFrame:
    return matching.match_top1(
        *_match_sides(spark, sf_dir), matching.trigram_search(cut), block_on=["brand"]
    )


def match_ratio_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(decide.keep_dearer(_top1(spark, sf_dir, STRICT_MIN_SIMILARITY)))


def match_ratio_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(decide.keep_comparable(_top1(spark, sf_dir, 0.8)))


def match_missing_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spoiled(spark, sf_dir)
    queries, catalog = _vector_sides(rows)
    label = F.concat(F.lit("item "), F.col("vec_id").cast("string"))
    price = F.col("vec_id").cast("double")
    asked = rows.filter(F.col("vec_id") % 2 == 0).select(
        F.col("vec_id").alias("query_id"), label.alias("query_name"), price.alias("query_price")
    )
    base = rows.filter(F.col("vec_id") % 2 == 1).select(
        F.col("vec_id").alias("catalog_id"), label.alias("name"), price.alias("price")
    )
    return _brief(decide.top1_match(topk.dense_topk(queries, catalog, 1), asked, base))


def name_map_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return namemap.build_name_map(_verified(spark, sf_dir))


def name_map_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of all matches, after one of the dearer products' matches alone."""
    matches = keep(_verified(spark, sf_dir))
    earlier = namemap.build_name_map(matches.filter("price_from_line > 30000"))
    return namemap.update_name_map(namemap.accepted_pairs(matches.filter("price_from_line < 50000")), earlier)


def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rows of each day and shop, by way of those of 16 loads a day."""
    load = F.concat(F.lit("load-"), (F.col("l_orderkey") % 16).cast("string"))
    rows = D.listings(spark, sf_dir).select(*HISTORY_COLUMNS, load.alias("load_id"))
    return snapshot.merge_partials(snapshot.load_partials(rows)).select(
        "day", "ecommerce_name", "product_name", F.coalesce("sale_price", F.lit(-1.0)).alias("sale_price"),
        "ingest_timestamp_utc",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        price_report, history_scan, report_day_filter, catalog_split, latest_cheapest,
        latest_per_product, map_join, step_counts, distinct_names, landing_scan, flatten_shop_l,
        flatten_shop_w, json_quarantine, product_rows, products_csv, name_map_csv, price_clean, falsy_coalesce,
        envelope_stamp, page_plan, page_coverage, vector_norm, vector_validity, cosine_topk,
        cosine_top1, cosine_topk_pivots, cosine_topk_blocked, lsh_topk, ngram_vectors, ngram_topk,
        embedding_cache_misses, embedding_lookup, verify_payload, verify_rule, verify_resolve,
        match_decide, match_all_rows, match_verified, match_ratio_min, match_ratio_band, match_missing_vector,
        name_map_build, embedding_refresh, judge_match, name_map_update, snapshot_merge,
        landing_select, ingest_stream_report, match_embedded, history_store,
    )
}
QUERIES["history_build"] = history_build_query
