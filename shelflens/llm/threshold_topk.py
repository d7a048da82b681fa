"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's components are dealt into a few lists; a pair's score is the sum of its partial
scores in the lists. (1) Every block of candidates gives, for each query and list, the
entries with the highest partial scores, and of these its best totals; the k-th best total of
all blocks is a score that k candidates reach, the cutoff. (2) It goes to all blocks. A
candidate that reaches the cutoff must reach cutoff / lists in some list: the entries that do
are collected, and those whose known parts, with the threshold for the unknown ones, stay
below the cutoff are struck out. (3) The scores of the rest are resolved exactly.

Queries meet candidates block by block; blocks of both have sizes bounded in bytes, and at most
k rows of a query leave a pair of blocks. Each candidate is sent once per block of queries and
each query once per block of candidates (see ``blocks``), in 32 bits where the numbers allow.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelflens.operators.keep import keep

LISTS = 4
#: Bytes of the vectors in a block of queries and of candidates, at most.
QUERY_BYTES = 8 << 20
CANDIDATE_BYTES = 16 << 20
#: Candidates below which a block is not made smaller to have more tasks.
CANDIDATE_BLOCK = 4096
#: Scores that are worked on in one step.
STEP = 1 << 20
SMALL = (1 << 31) - 1
LOWEST = -(1 << 63)
EXACT = float(1 << 53)


def partial_scores(queries: np.ndarray, candidates: np.ndarray, lists: int) -> list[np.ndarray]:
    """Inner products over each list of components, exact.

    Floats are exact while sums stay below 2**53; beyond that Python's integers are used, and
    scores that do not fit into 64 bits are cut to the nearest that does.
    """
    largest = [float(np.abs(x).max(initial=0)) for x in (queries.astype(float), candidates.astype(float))]
    kind = float if largest[0] * largest[1] * max(1, queries.shape[1]) < EXACT / 2 else object
    cuts = np.array_split(np.arange(queries.shape[1]), lists)
    q, c = queries.astype(kind), candidates.astype(kind)
    if kind is float:
        return [q[:, d] @ c[:, d].T for d in cuts]
    return [
        np.array([[sum(x * y for x, y in zip(a[d], b[d], strict=True)) for b in c] for a in q], object).reshape(
            len(q), len(c)
        )
        for d in cuts
    ]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if scores.dtype != object and len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def blocks(asked: int, held: int, dimension: int, width: int, tasks: int) -> tuple[int, int]:
    """How many blocks of queries and of candidates there are.

    As few as the byte bounds allow, since rows are copied once per block of the other side;
    more blocks of candidates only while that gives idle tasks work.
    """
    size = max(1, dimension * width)
    q_blocks = max(1, -(-asked * size // QUERY_BYTES))
    by_bytes = -(-held * size // CANDIDATE_BYTES)
    wanted = min(-(-held // CANDIDATE_BLOCK), -(-tasks // q_blocks))
    return q_blocks, max(1, by_bytes, wanted)


def long_of(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(s), LOWEST), -LOWEST - 1) for s in scores], np.int64)
    return scores.astype(np.int64)


def over_pairs(k: int, lists: int, second: bool) -> Callable[[pa.Table], pa.Table]:
    """Phase 1, or phases 2 and 3, of one pair of blocks."""

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(table.num_rows, -1) if table.num_rows else flat.reshape(0, 0)

    def run(table: pa.Table) -> pa.Table:
        asks = table.filter(table["asks"])
        holds = table.filter(pa.compute.invert(table["asks"]))
        out = [[], [], [], []]
        if asks.num_rows and holds.num_rows:
            q, c = matrix(asks), matrix(holds)
            rid, cid = asks["rid"].to_numpy(), holds["rid"].to_numpy()
            ids = holds["vec_id"].to_numpy()
            cutoff = asks["cutoff"].fill_null(LOWEST).to_numpy()
            step = max(1, STEP // len(c))
            for at in range(0, len(q), step):
                parts = partial_scores(q[at : at + step], c, lists)
                for i in range(len(parts[0])):
                    row = [p[i] for p in parts]
                    other = cid != rid[at + i]
                    found = collected(row, other, cutoff[at + i]) if second else highest(row, other, ids, k)
                    total = sum(p[found] for p in row)
                    if second:
                        reach = total >= cutoff[at + i]
                        found, total = found[reach], total[reach]
                    top = best(total, ids[found], k)
                    out[0].append(np.full(len(top), rid[at + i]))
                    out[1].append(ids[found[top]])
                    out[2].append(cid[found[top]])
                    out[3].append(long_of(total[top]))
        columns = [np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in out]
        return pa.table(columns, names=["rid", "vec_id", "found", "score"])

    def highest(row: list[np.ndarray], other: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        there = np.flatnonzero(other)
        return np.unique(np.concatenate([there[best(p[there], ids[there], k)] for p in row]))

    def collected(row: list[np.ndarray], other: np.ndarray, cutoff: int) -> np.ndarray:
        share = int(cutoff) / lists
        there = [p * lists >= int(cutoff) for p in row]
        seen = np.flatnonzero(np.logical_or.reduce(there) & other)
        # A little room for rounding: the bound only strikes out, the score decides.
        bound = sum(np.where(t[seen], p[seen], share).astype(float) for t, p in zip(there, row, strict=True))
        return seen[bound >= int(cutoff) - 1 - abs(float(cutoff)) * 1e-12]

    return run


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    lists: int = LISTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row whose id ``every`` divides.

    Components become ``floor(scale * x)``. Vectors that are null, or hold a null or a
    component that is not finite, and rows without an id take no part. Only vectors of equal
    length are compared; vectors of length 0 score 0. Rows that repeat an id are rows of their
    own: each is a query, and a candidate of the others. Ties go to the smaller id. Fewer than
    k candidates: all of them. Other columns are ignored; an empty table gives no rows.
    """
    x = F.col(embedding)
    usable = F.coalesce(
        ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))), F.lit(False)
    )
    rows = keep(
        vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & usable).select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(vec_id).cast("long").alias("vec_id"),
            F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"),
        )
    )
    question = F.col("vec_id") % every == 0
    seen = rows.agg(
        F.count(F.lit(1)).alias("held"),
        F.count_if(question).alias("asked"),
        F.max(F.size("v")).alias("dimension"),
        F.max(F.array_max("v")).alias("high"),
        F.min(F.array_min("v")).alias("low"),
    ).first()
    small = max(abs(seen["high"] or 0), abs(seen["low"] or 0)) <= SMALL
    if small:
        rows = rows.withColumn("v", F.col("v").cast("array<int>"))
    asked = rows.filter(question)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, 1) * 2
    q_blocks, c_blocks = blocks(seen["asked"], seen["held"], seen["dimension"] or 0, 4 if small else 8, tasks)
    spread = F.xxhash64("rid")
    schema = "rid long, vec_id long, found long, score long"

    def numbers(n: int):
        return F.sequence(F.lit(0), F.lit(n - 1))

    held = rows.select(
        F.size("v").alias("length"),
        F.explode(numbers(q_blocks)).alias("q"),
        F.pmod(spread, F.lit(c_blocks)).cast("int").alias("c"),
        F.lit(False).alias("asks"),
        "rid",
        "vec_id",
        "v",
        F.lit(None).cast("long").alias("cutoff"),
    )

    def meet(questions: DataFrame, second: bool) -> DataFrame:
        asks = questions.select(
            F.size("v").alias("length"),
            F.pmod(spread, F.lit(q_blocks)).cast("int").alias("q"),
            F.explode(numbers(c_blocks)).alias("c"),
            F.lit(True).alias("asks"),
            "rid",
            "vec_id",
            "v",
            "cutoff",
        )
        pairs = held.union(asks).groupBy("length", "q", "c")
        return pairs.applyInArrow(over_pairs(k, lists, second), schema)

    by_score = W.partitionBy("rid").orderBy(F.desc("score"), "vec_id", "found")
    place = F.row_number().over(by_score)
    first = meet(asked.withColumn("cutoff", F.lit(None).cast("long")), False)
    cutoffs = keep(
        first.withColumn("rank", place).filter(F.col("rank") == k).select("rid", F.col("score").alias("cutoff"))
    )
    found = meet(asked.join(cutoffs, "rid", "left"), True).withColumn("rank", place).filter(F.col("rank") <= k)
    names = asked.select("rid", F.col("vec_id").alias("query_id"))
    return found.join(names, "rid").select("query_id", "rank", "vec_id", "score")
