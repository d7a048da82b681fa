"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelflens.operators.keep import keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``, which a cluster's executors share.

    Where that is unset, as in tests, it lies in this machine's temporary folder.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept away from training: crc32 of its id as text, modulo 4, is 2.

    A row without an id counts as not held out, and is never learned from (see ``learnable``).
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def hash_order(doc_id: str = "doc_id", seed: str = "sample") -> Column:
    """A repeatable random key of a document."""
    return F.md5(F.concat(F.lit(seed), F.col(doc_id).cast("string")))


def smallest_hashes(rows: DataFrame, label: str, order: str, n: int, labels: int = 20_000) -> DataFrame:
    """Of each label the ``n`` rows with the smallest random keys ``order`` (see ``hash_order``).

    Keys are spread evenly, so a share of them worked out from the label's count leaves about
    ``3 * n`` rows of a label to be shuffled and sorted, however many it has. The counts are
    broadcast, because a join that shuffled would bring all rows of a label into one task.
    More than ``labels`` labels raise an error: no label is left out.
    """
    counts = keep(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_all")))
    if (found := counts.count()) > labels:
        raise ValueError(f"{found} different labels, {labels} are the most that a classifier is fitted on")
    share = F.conv(F.substring(order, 1, 8), 16, 10).cast("double") / float(1 << 32)
    near = rows.join(F.broadcast(counts), label).filter(share * F.col("_all") < 3 * n + 50)
    place = F.row_number().over(W.partitionBy(label).orderBy(order))
    return near.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n", "_all")
