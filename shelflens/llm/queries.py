"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.llm import (
    bpe_stream, exact_dedup, filter_audit, langid, mixing, periodic_runs, repeats, simhash, threshold_topk,
    token_count, token_shards, toxicity, url_filter,
)
from shelflens.llm.common import shared_folder, table


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "spans")


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "token_shards")
    token_shards.write_shards(docs, VOCABULARY, folder)
    # The ids end here: a join that shuffles would write them all once more.
    stored = token_shards.read_ids(docs, folder).select(
        "doc_id",
        "shard",
        "offset",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return stored.join(token_shards.shard_starts(spark, folder), "shard").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repeats that op13's contract puts into every tenth document."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int") + 1
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    whole = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), n - F.col("a")))
    numbered = chosen.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    return numbered.select("doc_id", F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(planted(table(spark, sf_dir, "documents")))
    # The greatest length, of equals the smallest start, then period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", "collapsed", best.alias("best"), F.size("runs").alias("n"), text.alias("lines")).select(
        "doc_id",
        F.col("n").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_exact_topk": op4_exact_topk,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_token_shards": op11_token_shards,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}
