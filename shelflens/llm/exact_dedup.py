"""Exact duplicates by a tree of merges over sorted runs of digests.

Rows are dealt into ``runs`` runs by a hash of their id; a run is sorted by digest and id, and
one pass over it leaves an entry per digest with the winning id and the number of rows. Every
following round brings ``fan_in`` sorted runs together by ranges of hashed digests, merges them
into one in order of digest and id, and leaves the last entry of each digest with the sum of
sizes up to it; no hash table is built. ``log(runs) / log(fan_in)`` rounds leave one run.
The winners then go back down the same tree, so that a group of copies, however large, meets
its winner in ``runs`` places and never in one task. Only digests and ids travel.

An entry is the SHA-256 of the text with its byte length and its XXH64; all three must agree
for two texts to count as equal, at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelflens.operators.keep import keep

RUNS = 256
FAN_IN = 16
DIGEST = ["_sha", "_n_bytes", "_xx"]


def digest_columns(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    return {
        "_sha": F.unhex(F.sha2(whole, 256)),
        "_n_bytes": F.octet_length(whole),
        "_xx": F.xxhash64(whole),
    }


def run_of(doc_id: Column, runs: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(runs)).cast("int")


def dealt(docs: DataFrame, doc_id: str, text: str, runs: int) -> DataFrame:
    """One narrow row per document, with its run and its digest; texts are read once for it."""
    return keep(
        docs.select(
            F.col(doc_id).alias("_id"),
            run_of(F.col(doc_id), runs).alias("_run"),
            *[c.alias(n) for n, c in digest_columns(F.col(text)).items()],
        )
    )


def merged(entries: DataFrame) -> DataFrame:
    """Entries of sorted runs as one sorted run: of a digest the one with the largest id, and all sizes.

    A digest has as many entries here as runs are merged, or in a first run its rows there.
    """
    order = W.partitionBy("_run", *DIGEST).orderBy("_best")
    total = F.sum("_size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        entries.withColumns({"_total": total, "_next": F.lead("_size").over(order)})
        .filter("_next IS NULL")
        .select("_run", *DIGEST, "_best", F.col("_total").alias("_size"))
    )


def merge_tree(rows: DataFrame, runs: int, fan_in: int) -> DataFrame:
    """For every run and digest: the winning id of all runs and the group's size."""
    levels = [merged(rows.select("_run", *DIGEST, F.col("_id").alias("_best"), F.lit(1).cast("long").alias("_size")))]
    while runs > 1:
        runs = -(-runs // fan_in)
        above = F.floor(F.col("_run") / fan_in).cast("int")
        levels.append(merged(levels[-1].withColumn("_run", above)))
    found = levels.pop()
    while levels:
        below = levels.pop().select("_run", *DIGEST)
        found = (
            below.withColumn("_above", F.floor(F.col("_run") / fan_in).cast("int"))
            .join(found.withColumnRenamed("_run", "_above"), ["_above", *DIGEST])
            .select("_run", *DIGEST, "_best", "_size")
        )
    return found


def mark_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", runs: int = RUNS, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; a null text counts as empty. The largest id of a
    group stays (a null id is the smallest); of rows that repeat this id with the same text
    exactly one is kept, and they cannot be told apart. Other columns are ignored, an empty
    table gives no rows.
    """
    rows = dealt(docs, doc_id, text, runs)
    found = merge_tree(rows, runs, fan_in)
    first = F.row_number().over(W.partitionBy("_run", *DIGEST, "_id").orderBy("_id")) == 1
    return rows.join(found, ["_run", *DIGEST]).select(
        F.col("_id").alias("doc_id"),
        F.col("_best").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_best")) & first).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", runs: int = RUNS, fan_in: int = FAN_IN
) -> DataFrame:
    """The documents that ``mark_copies`` keeps, with all their columns.

    Winners are few columns wide; the texts move once, to meet them.
    """
    rows = dealt(docs, doc_id, text, runs)
    winners = (
        merge_tree(rows, runs, fan_in)
        .filter(F.col("_run") == run_of(F.col("_best"), runs))
        .select("_run", *DIGEST, F.col("_best").alias("_id"))
    )
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(doc_id).alias("_id"),
        run_of(F.col(doc_id), runs).alias("_run"),
        *[c.alias(n) for n, c in digest_columns(F.col(text)).items()],
    )
    w = winners.select(*[F.col(c).alias(f"{c}_w") for c in winners.columns])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_w")) for c in ("_run", *DIGEST, "_id")]
    first = F.row_number().over(W.partitionBy("_run", *DIGEST, "_id").orderBy("_id"))
    return marked.join(w, same).withColumn("_n", first).filter("_n = 1").select("_row.*")
