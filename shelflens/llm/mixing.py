"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

A document's random key is the MD5 of its id. The keys are spread evenly, so fixed key ranges
("buckets") of a source hold about equal numbers of rows and can be sorted apart: the running
sum inside a bucket plus the sum of the source's earlier buckets is the prefix sum, and no
task sees a whole source. Nothing is sampled, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelflens.operators.keep import keep

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows that a bucket of the largest source holds at most, about.
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sums: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``_none, _source, source_size`` (one row per source) with the column ``target``.

    Sources in the order of their code points, null last, take the weights in turn and share
    ``share`` times all sizes; no target exceeds ``most`` times its source's size, and what is
    cut off goes to the others by weight. Sorted by size per weight, the sources that reach
    their limit come first, so one pass of prefix sums finds the level of the rest. The table
    of sources, one row each, is sorted in one task.
    """
    n = len(weights)
    place = F.row_number().over(W.orderBy("_none", "_source"))
    numbered = sums.withColumn("_place", place).withColumn(
        "_weight", F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_place") - 1) % n + 1).cast("long")
    )
    limit = F.col("source_size") * most
    everything = W.partitionBy()
    before = W.orderBy(limit / F.col("_weight"), "_place").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    levels = numbered.withColumn("_level", left / weight_left).withColumn(
        "_full", limit <= F.col("_weight") * F.col("_level")
    )
    # Sources that are not full follow those that are; the first of them has the level.
    at = F.when(~F.col("_full"), F.struct(limit / F.col("_weight"), F.col("_place"), F.col("_level").alias("level")))
    level = F.min(at).over(everything)["level"]
    return levels.withColumn(
        "target", F.when(F.col("_full"), limit.cast("double")).otherwise(F.col("_weight") * level)
    ).select("_none", "_source", "source_size", "target")


def bucket_bits(rows: int) -> int:
    """Bits of the key that name a bucket: 8 at least, more as the table grows."""
    return min(20, max(8, (rows // BUCKET_ROWS).bit_length()))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, *more: Column) -> DataFrame:
    """What the mix needs of each row. Rows without an id get their keys from their texts."""
    id_text, no_id = F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.col(text))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).isNull().alias("_none"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(id_text, no_id, F.lit(""))).alias("_key"),
        F.xxhash64(F.col(text)).alias("_tie"),
        *more,
    )


def _bucketed(rows: DataFrame, bits: int) -> DataFrame:
    top = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    return rows.withColumn("_bucket", F.shiftright(top, 32 - bits).cast("int"))


def _cuts(rows: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[int, DataFrame]:
    """Bits of a bucket's number, and per bucket what its source's target leaves for it."""
    bits = bucket_bits(rows.count())
    buckets = _bucketed(rows, bits).groupBy("_none", "_source", "_bucket").agg(F.sum("size").alias("_words"))
    sums = buckets.groupBy("_none", "_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sums, weights, share, most)
    budget = F.floor("target")
    earlier = W.partitionBy("_none", "_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return bits, (
        buckets.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .join(targets, ["_none", "_source"])
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
        .withColumn("_rest", budget - F.col("passes") * F.col("source_size"))
        .drop("_words")
    )


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``passes`` and ``part``: whole times that each is taken, and words beyond."""
    keys = ["_none", "_source", "_bucket"]
    order = W.partitionBy(*keys).orderBy("_key", "doc_id", "size", "_tie")
    running = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    room = F.col("_rest") - F.col("_before") - (F.col("_running") - F.col("size"))
    return (
        rows.withColumn("_running", running)
        .join(cuts, keys)
        .withColumn("part", F.greatest(F.lit(0), F.least("size", room)).cast("long"))
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, passes, part``.

    ``size`` counts the text's words (null and empty: 0). Every document of a source is taken
    ``passes`` whole times; what then is left of the source's target is taken from documents
    in random order, whole ones until the cut and ``part`` words of the one that the cut runs
    through. ``taken = passes * size + part`` adds up to the whole part of the target. A null
    source is a source of its own; rows that repeat an id are taken one by one; the order of
    rows without an id comes from their texts. A source without words has target 0. Other
    columns are ignored, an empty table gives no rows.
    """
    rows = keep(_sized(docs, doc_id, text, source))
    cuts = _cuts(rows, weights, share, most)
    return _taken(_bucketed(rows, cuts[0]), cuts[1]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        F.col("passes").cast("long").alias("passes"),
        "part",
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document as often as ``mix`` takes it, with all its columns.

    Documents are handed on whole: the one that the cut runs through comes once more if at
    least half of it is taken. Documents without words are no part of a mix. Rows that repeat
    an id, or have none, are taken one by one, as by ``mix``: whole rows go through the order
    and the cut, and meet nothing again by their ids.
    """
    bits, cuts = _cuts(keep(_sized(docs, doc_id, text, source)), WEIGHTS, SHARE, MOST)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    taken = _taken(_bucketed(_sized(docs, doc_id, text, source, whole), bits), cuts)
    times = (F.col("passes") + (F.col("part") * 2 >= F.col("size")).cast("long")).cast("int")
    return (
        taken.filter("size > 0")
        .withColumn("_times", times)
        .filter("_times > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
        .select("_row.*")
    )
