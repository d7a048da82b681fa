"""The best catalogue rows for every query row, by cosine.

All searches share one shape. Each side is given group keys such that every pair that
can be in the result meets in at least one group; groups are cut into blocks of
bounded size; a block pair is scored as one matrix product inside a task and hands on
at most ``k`` rows per query; a last ranking per query merges the blocks. Pairs are
never written out, a hot group becomes many block pairs, and no task holds more than
two blocks.

Scores are rounded to ``SCORE_DIGITS`` and ties go to the smaller catalogue id.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflens.functions.numbers import SCORE_DIGITS
from shelflens.operators.keep import keep

BLOCK_ROWS = 1024
#: Vectors of a block of the search through pivots, and blocks of its second round.
BLOCK_BYTES = 4 << 20
NEXT = 4
#: Catalogue rows of a bucket of the approximate search, about.
BUCKET_ROWS = 64
BROADCAST_BYTES = 64 << 20
#: Scores or copies that a task holds at a time, in one of the few arrays of that size.
SCRATCH_BYTES = 8 << 20
BROADCAST_GROUPS = 100_000
ROUNDING = 10.0**-SCORE_DIGITS


# ---------------------------------------------------------------- block pairs


def _copy_plan(queries: DataFrame, catalog: DataFrame, keys: list[str], block_rows: int):
    """How many blocks each side of each group has, joined to a side by the result.

    The counts come from the keys alone and are kept, to be counted once. A short list
    of groups is broadcast: no row moves for it, and groups with one side only drop out
    at once. Of a longer list just the groups over one block matter; only if even those
    are too many to broadcast, the rows are shuffled to the counts.
    """

    def sizes(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*keys).agg(
            F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name)
        )

    both = keep(sizes(queries, "_nqb").join(sizes(catalog, "_ncb"), keys))
    over_one = (F.col("_nqb") > 1) | (F.col("_ncb") > 1)
    every, hot = both.agg(F.count(F.lit(1)), F.count_if(over_one)).first()
    if every <= BROADCAST_GROUPS:
        return lambda side: side.join(F.broadcast(both), keys)
    if hot <= BROADCAST_GROUPS:
        known = F.broadcast(both.filter(over_one))
        return lambda side: side.join(known, keys, "left").fillna(1, ["_nqb", "_ncb"])
    return lambda side: side.join(both, keys)


def _cut(side: DataFrame, own: str, other: str, row_id: str) -> DataFrame:
    """Put each row into one of its side's blocks, and copy it to all of the other's."""
    return (
        side.withColumn(own, F.pmod(F.xxhash64(row_id), F.col(f"_n{own[1:]}")).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"_n{other[1:]}") - 1)))
        .drop("_nqb", "_ncb")
    )


def block_pairs(
    queries: DataFrame,
    catalog: DataFrame,
    keys: list[str],
    kernel,
    schema: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``kernel(query block, catalogue block)`` to all block pairs of equal keys.

    ``kernel`` takes and returns Arrow tables; a block may be empty. Rows with a NULL
    key meet nothing.
    """
    # By names alone: one side may come from an earlier search over the other.
    known = reduce(and_, (F.col(c).isNotNull() for c in keys))
    queries, catalog = queries.filter(known), catalog.filter(known)
    planned = _copy_plan(queries, catalog, keys, block_rows)
    group = [*keys, "_qb", "_cb"]
    left = _cut(planned(queries), "_qb", "_cb", "query_id")
    # Both sides may come from one table: its columns must not meet themselves.
    left = left.select(*[F.col(f"`{c}`").alias(c) for c in left.columns])
    right = _cut(planned(catalog), "_cb", "_qb", "catalog_id")
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(kernel, schema)


def best_per_query(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query with their ``rank``; repeats of a pair count once."""
    place = F.dense_rank().over(
        Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("catalog_id"))
    )
    return (
        scored.withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "catalog_id", "score")
        .distinct()
    )


def few_copies(catalog: DataFrame, k: int, same: list[str]) -> DataFrame:
    """Of each set of equal ``same`` columns the rows of the ``k`` lowest ids, each id once.

    Copies score alike and ties go to the lower id, so the others cannot be among the
    k best; a catalogue that is largely copies shrinks before any search.
    """
    place = F.dense_rank().over(Window.partitionBy(*same).orderBy("catalog_id"))
    return (
        catalog.withColumn("_copy", place)
        .filter(F.col("_copy") <= k)
        .drop("_copy")
        .dropDuplicates([*same, "catalog_id"])
    )


# ---------------------------------------------------------------- kernels


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal-length lists as a float64 matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _chunks(batches, width: int):
    """Pieces of the batches whose product with ``width`` columns stays near ``SCRATCH_BYTES``."""
    step = max(1, SCRATCH_BYTES // (8 * max(width, 1)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _unit(batch) -> np.ndarray:
    """The batch's vectors at length one."""
    return _matrix(batch["vector"]) / batch["norm"].to_numpy(zero_copy_only=False)[:, None]


def _round(scores: np.ndarray) -> np.ndarray:
    scale = 10.0**SCORE_DIGITS
    return np.floor(scores * scale + 0.5) / scale


def _pick(scores: np.ndarray, k: int, cut: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of each row's ``k`` best; ties go to the lower column."""
    n = scores.shape[1]
    if n > k:
        keep = scores >= np.partition(scores, n - k, axis=1)[:, n - k][:, None]
    else:
        keep = np.ones(scores.shape, dtype=bool)
    if cut is not None:
        keep &= scores >= cut
    rows, cols = np.nonzero(keep)
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    # Place of each entry in its row: distance to the row's first entry.
    first = np.searchsorted(rows, rows, side="left")
    best = np.arange(len(rows)) - first < k
    return rows[best], cols[best]


def _emit(query_ids, catalog_ids, scores, rows, cols) -> pa.Table:
    return pa.table(
        {
            "query_id": query_ids.take(pa.array(rows)),
            "catalog_id": catalog_ids.take(pa.array(cols)),
            "score": pa.array(scores[rows, cols], pa.float64()),
        }
    )


def _by_id(table: pa.Table) -> pa.Table:
    return table.sort_by("catalog_id")


def _dense_kernel(k: int, cut: float | None):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _no_rows(left, right)
        right = _by_id(right)
        scores = _round(_table_unit(left) @ _table_unit(right).T)
        return _emit(left["query_id"], right["catalog_id"], scores, *_pick(scores, k, cut))

    return run


def _table_unit(table: pa.Table) -> np.ndarray:
    return _matrix(table["vector"]) / table["norm"].to_numpy()[:, None]


def _no_rows(left: pa.Table, right: pa.Table) -> pa.Table:
    return pa.table(
        {
            "query_id": left["query_id"].slice(0, 0),
            "catalog_id": right["catalog_id"].slice(0, 0),
            "score": pa.array([], pa.float64()),
        }
    )


# ---------------------------------------------------------------- dense vectors


def _id_types(queries: DataFrame, catalog: DataFrame) -> tuple[str, str]:
    return (
        queries.schema["query_id"].dataType.simpleString(),
        catalog.schema["catalog_id"].dataType.simpleString(),
    )


def _score_schema(queries: DataFrame, catalog: DataFrame) -> str:
    q, c = _id_types(queries, catalog)
    return f"query_id {q}, catalog_id {c}, score double"


def dense_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 3,
    *,
    min_similarity: float | None = None,
    block_on: list[str] | None = None,
    pivots: int = 256,
    block_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact top ``k`` by cosine, with ``block_on`` among pairs of equal values there.

    ``queries`` holds ``query_id, vector, norm``, ``catalog`` holds
    ``catalog_id, vector, norm``; all vectors are valid and of one length. Returns
    ``query_id, rank, catalog_id, score``. Query ids are unique; catalogue rows that repeat
    an id and its vector count once, at any size.

    A catalogue whose measured size is within ``broadcast_bytes`` is broadcast and the
    queries are scored where they are, without a shuffle. A larger one is searched
    through pivots, see ``pivot_topk``.
    """
    if block_on:
        return blocked_topk(
            queries, catalog, list(block_on), k, min_similarity=min_similarity, block_rows=block_rows,
            broadcast_bytes=broadcast_bytes,
        )
    queries = queries.select("query_id", "vector", "norm")
    catalog = catalog.select("catalog_id", "vector", "norm")
    small = _within(catalog, broadcast_bytes)
    if small is not None:
        return _broadcast_topk(queries, catalog, small, k, min_similarity)
    return pivot_topk(queries, catalog, k, min_similarity=min_similarity, pivots=pivots)


def _within(catalog: DataFrame, max_bytes: int) -> pa.Table | None:
    """The whole catalogue when one aggregate measures at most ``max_bytes``, else None."""
    size = catalog.agg(F.sum(F.size("vector") * 8 + 64)).first()[0] or 0
    return catalog.toArrow() if size <= max_bytes else None


def _broadcast_topk(
    queries: DataFrame, catalog: DataFrame, table: pa.Table, k: int, cut: float | None
) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(_by_id(_unique(table)))

    def run(batches):
        catalog_ids = shared.value["catalog_id"].combine_chunks()
        if not len(catalog_ids):
            return
        c = _table_unit(shared.value)
        for part in _chunks(batches, len(c)):
            scores = _round(_unit(part) @ c.T)
            rows, cols = _pick(scores, k, cut)
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
            out = _emit(part["query_id"], catalog_ids, scores, rows, cols)
            out = out.add_column(1, "rank", pa.array(rank, pa.int32()))
            yield from out.combine_chunks().to_batches()

    q, c = _id_types(queries, catalog)
    return queries.mapInArrow(run, f"query_id {q}, rank int, catalog_id {c}, score double")


# ---------------------------------------------------------------- dense vectors in blocks


def _by_block(table: pa.Table | pa.RecordBatch, blocks: list[str]) -> dict[tuple, np.ndarray]:
    """Row numbers of each combination of block values, ascending."""
    names = list(zip(*(table[c].to_pylist() for c in blocks), strict=True))
    number: dict[tuple, int] = {}
    code = np.array([number.setdefault(n, len(number)) for n in names], np.int64)
    order = np.argsort(code, kind="stable")
    edges = np.searchsorted(code[order], np.arange(len(number) + 1))
    return {n: order[edges[i] : edges[i + 1]] for n, i in number.items()}


def _best_in_blocks(left: pa.Table, ids, vectors: np.ndarray, directory: dict, blocks: list[str], k: int, cut: float | None):
    """Hits of the rows of ``left`` among the rows that ``directory`` has for their block, in pieces."""
    unit = _table_unit(left)
    for name, rows in _by_block(left, blocks).items():
        others = directory.get(name)
        if others is None:
            continue
        step = max(1, SCRATCH_BYTES // (8 * len(others)))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            scores = _round(unit[own] @ vectors[others].T)
            r, c = _pick(scores, k, cut)
            rank = np.arange(len(r)) - np.searchsorted(r, r, side="left") + 1
            yield pa.table(
                {
                    "query_id": left["query_id"].take(pa.array(own[r])),
                    "rank": pa.array(rank, pa.int32()),
                    "catalog_id": ids.take(pa.array(others[c])),
                    "score": pa.array(scores[r, c], pa.float64()),
                }
            )


def blocked_topk(
    queries: DataFrame,
    catalog: DataFrame,
    blocks: list[str],
    k: int = 3,
    *,
    min_similarity: float | None = None,
    block_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact top ``k`` among the rows with equal values of the ``blocks`` columns; a null meets nothing.

    Values are dealt to as many buckets as the catalogue has blocks of ``block_rows`` (by default
    about ``BLOCK_BYTES`` of vectors), so small values share a group, and a bucket with a hot value
    is cut into block pairs like any other group. A catalogue within ``broadcast_bytes`` is broadcast with a directory of its values.
    """
    known = reduce(and_, (F.col(c).isNotNull() for c in blocks))
    queries = queries.filter(known).select(*blocks, "query_id", "vector", "norm")
    catalog = keep(
        few_copies(catalog.filter(known).select(*blocks, "catalog_id", "vector", "norm"), k, [*blocks, "vector"])
    )
    q, c = _id_types(queries, catalog)
    small = _within(catalog, broadcast_bytes)
    if small is not None:
        return _broadcast_blocked(queries, _by_id(small), blocks, k, min_similarity, f"query_id {q}, rank int, catalog_id {c}, score double")
    if block_rows is None:
        # The larger the blocks, the fewer copies of a hot value's rows.
        head = catalog.select(F.size("vector").alias("d")).first()
        block_rows = max(BLOCK_ROWS, BLOCK_BYTES // (8 * (head["d"] if head else 1) + 64))
    buckets = max(1, catalog.count() // block_rows)
    bucket = F.pmod(F.xxhash64(*blocks), F.lit(buckets)).alias("_bucket")

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _no_rows(left, right)
        right = _by_id(right)
        parts = _best_in_blocks(
            left, right["catalog_id"], _table_unit(right), _by_block(right, blocks), blocks, k, min_similarity
        )
        return pa.concat_tables([_no_rows(left, right), *(p.drop_columns("rank") for p in parts)])

    found = block_pairs(
        queries.select("*", bucket), catalog.select("*", bucket), ["_bucket"], kernel, _score_schema(queries, catalog), block_rows
    )
    return best_per_query(found, k)


def _broadcast_blocked(queries: DataFrame, table: pa.Table, blocks: list[str], k: int, cut: float | None, schema: str) -> DataFrame:
    directory = _by_block(table, blocks) if table.num_rows else {}
    shared = queries.sparkSession.sparkContext.broadcast(
        (table["catalog_id"].combine_chunks(), _table_unit(table) if table.num_rows else None, directory)
    )

    def run(batches):
        ids, vectors, directory = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in _best_in_blocks(pa.Table.from_batches([batch]), ids, vectors, directory, blocks, k, cut):
                yield from part.combine_chunks().to_batches()

    return queries.mapInArrow(run, schema)


def _unique(table: pa.Table) -> pa.Table:
    """Each id with each of its vectors once."""
    if not table.num_rows:
        return table
    ids = table["catalog_id"].combine_chunks().dictionary_encode().indices
    both = np.column_stack([ids.to_numpy(zero_copy_only=False), _matrix(table["vector"])])
    _, first = np.unique(both, axis=0, return_index=True)
    return table.take(pa.array(np.sort(first)))


def _spread_out(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the unit vectors, each the farthest from those before it."""
    chosen = [0]
    closest = vectors @ vectors[0]
    while len(chosen) < min(n, len(vectors)):
        farthest = int(closest.argmin())
        if closest[farthest] >= 1.0 - 1e-12:  # only copies are left
            break
        chosen.append(farthest)
        closest = np.maximum(closest, vectors @ vectors[farthest])
    return vectors[chosen]


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def pivot_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 3,
    *,
    min_similarity: float | None = None,
    pivots: int = 256,
    rings: int = 32,
    near_pivots: int = 8,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact top ``k`` without a size limit on the catalogue.

    Every catalogue vector belongs to its nearest pivot's cell and, by angle, to a ring of it.
    Angles obey the triangle inequality: from the smallest angle between a ring's vectors and
    any pivot follows how near the ring can come to a query. Whole cells are packed into blocks
    of about ``block_bytes``; a larger cell is dealt out to several.

    A query goes to a block at most once, with the list of its rings that can still hold a
    better hit. It goes in rounds: to the blocks of the rings nearest to it, to the ``NEXT``
    blocks that can come nearest, then to all others; after each round its k-th best angle is
    tighter, and what cannot come nearer is not visited. On vectors without any clusters nothing
    is pruned, and each query visits each block once.

    The driver sees a bounded sample to choose pivots from and one summary per ring, at
    most ``pivots * rings`` rows, whatever the catalogue's size.
    """
    spark = queries.sparkSession
    queries = queries.select("query_id", "vector", "norm")
    # Summarised, counted and searched: kept without the needless copies.
    catalog = keep(few_copies(catalog.select("catalog_id", "vector", "norm"), k, ["vector"]))
    schema = _score_schema(queries, catalog)
    head = catalog.select(F.size("vector").alias("d")).first()
    if head is None:
        return best_per_query(spark.createDataFrame([], schema), k)
    sample = (
        catalog.orderBy(F.xxhash64("catalog_id"), "catalog_id")
        .limit(max(pivots, min(16 * pivots, BROADCAST_BYTES // (8 * head["d"]))))
        .toArrow()
    )
    centres = spark.sparkContext.broadcast(_spread_out(_table_unit(sample), pivots))
    width = math.pi / rings

    def placed(batches):
        """Cell, ring and the angles to all pivots of each batch's vectors."""
        for batch in _chunks(batches, len(centres.value)):
            angle = _angles(_unit(batch) @ centres.value.T)
            cell = angle.argmin(axis=1)
            own = angle[np.arange(len(cell)), cell]
            yield batch, cell, np.minimum(own // width, rings - 1).astype(int), own, angle

    def summarise(batches):
        """Per ring of this partition: size, range of angles, least angle to each pivot."""
        known: dict[tuple[int, int], list] = {}
        for _, cell, ring, own, angle in placed(batches):
            label = cell * rings + ring
            order = np.argsort(label, kind="stable")
            starts = np.flatnonzero(np.diff(label[order], prepend=-1))
            least = np.minimum.reduceat(angle[order], starts)
            lo, hi = (f.reduceat(own[order], starts) for f in (np.minimum, np.maximum))
            sizes = np.diff(starts, append=len(order))
            for i, at in enumerate(label[order][starts]):
                key = divmod(int(at), rings)
                if key in known:
                    n, was_lo, was_hi, was = known[key]
                    known[key] = [
                        n + sizes[i], min(was_lo, lo[i]), max(was_hi, hi[i]),
                        np.minimum(was, least[i]),
                    ]
                else:
                    known[key] = [sizes[i], lo[i], hi[i], least[i]]
        if known:
            yield _summary_batch(known)

    def merge(table: pa.Table) -> pa.Table:
        least = _matrix(table["least"]).min(axis=0)
        key = (table["cell"][0].as_py(), table["ring"][0].as_py())
        row = [
            table["n"].to_numpy().sum(), table["lo"].to_numpy().min(),
            table["hi"].to_numpy().max(), least,
        ]
        return pa.Table.from_batches([_summary_batch({key: row})])

    summary = "cell int, ring int, n bigint, lo double, hi double, least array<double>"
    # One small row per ring and partition reaches the merge, not the vectors.
    limits = (
        catalog.mapInArrow(summarise, summary)
        .groupBy("cell", "ring")
        .applyInArrow(merge, summary)
        .orderBy("cell", "ring")
        .toArrow()
    )
    dimension = head["d"]
    layout = Layout(limits, rings, max(1, block_bytes // (8 * dimension + 64)))
    table = spark.sparkContext.broadcast(layout)

    def areas_of(batches):
        t = table.value
        for batch, cell, ring, _, _ in placed(batches):
            area = t.area[cell * rings + ring]
            turn = batch["_turn"].to_numpy(zero_copy_only=False).astype(np.int64)
            block = t.first[cell] + turn % t.parts[cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["catalog_id", "vector", "norm"]).columns, pa.array(area, pa.int32()), pa.array(block, pa.int64())],
                names=["catalog_id", "vector", "norm", "area", "block"],
            )

    def fields(rows: DataFrame) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    turned = catalog.withColumn("_turn", F.pmod(F.xxhash64("catalog_id"), F.lit(1 << 30)))
    keyed = keep(turned.mapInArrow(areas_of, f"{fields(catalog)}, area int, block bigint"))

    def visits(batches, nth: int):
        """Each query with the blocks of its ``nth`` round, and the areas that it looks for there."""
        t = table.value
        # Copies of a batch's queries stay near ``SCRATCH_BYTES``, however many blocks there are.
        step = max(1, SCRATCH_BYTES // (len(t.block) * (8 * dimension + 64) + 32 * len(t.cell)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                yield t.visit(batch.slice(at, step), centres.value, near_pivots, nth, k)

    kernel = _area_kernel(k, min_similarity)
    visited = f"{fields(queries)}, block bigint, areas array<int>"
    best = None
    for nth in range(3):
        bounded = queries.withColumn("bound", F.lit(None).cast("double"))
        if best is not None:
            kth = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
            bounded = queries.join(kth, "query_id", "left")
        if min_similarity is not None:
            bounded = bounded.withColumn("bound", F.greatest("bound", F.lit(float(min_similarity))))
        bounded = bounded.withColumn("bound", F.coalesce("bound", F.lit(float("nan"))))
        # Counted per block, then sent: kept, so that the angles are worked out once.
        asked = keep(bounded.mapInArrow(lambda b, nth=nth: visits(b, nth), visited))
        found = block_pairs(asked, keyed, ["block"], kernel, schema, layout.rows)
        both = found if best is None else best.drop("rank").unionByName(found)
        best = best_per_query(both, k)
        if nth < 2:
            best = keep(best)
    return best


class Layout:
    """Areas (rings of cells) of a catalogue, and the blocks of whole cells that they lie in."""

    def __init__(self, limits: pa.Table, rings: int, rows: int):
        self.rows = rows
        self.cell, ring = limits["cell"].to_numpy(), limits["ring"].to_numpy()
        self.n, self.lo, self.hi = (limits[c].to_numpy() for c in ("n", "lo", "hi"))
        self.least = _matrix(limits["least"]).T.copy()  # pivot by area
        self.area = np.zeros((int(self.cell.max()) + 1) * rings, np.int32)
        self.area[self.cell * rings + ring] = np.arange(len(self.cell))
        sizes = np.bincount(self.cell, weights=self.n).astype(np.int64)
        self.first, self.parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // rows))
        block, held = -1, rows
        for cell, size in enumerate(sizes.tolist()):
            if not size:
                continue
            if held + size > rows:
                block, held = block + 1, 0
            self.first[cell], held = block, held + size
            if self.parts[cell] > 1:
                block, held = block + int(self.parts[cell]) - 1, rows
        # Group of blocks with the same areas: a part of a large cell looks like all its parts.
        self.group = self.first[self.cell]
        self.block = np.unique(self.group)

    def bounds(self, angle: np.ndarray, near_pivots: int) -> tuple[np.ndarray, np.ndarray]:
        """How near each area can come to each query, and the query's angle to the area's pivot."""
        own = angle[:, self.cell]
        bound = np.maximum(0.0, np.maximum(own - self.hi, self.lo - own))
        # Pivots near the query say most about how far a ring is.
        m = min(near_pivots, angle.shape[1])
        near = np.argpartition(angle, m - 1, axis=1)[:, :m]
        for j in range(m):
            reach = np.take_along_axis(angle, near[:, j : j + 1], axis=1)
            bound = np.maximum(bound, self.least[near[:, j]] - reach)
        return bound, own

    def visit(self, batch: pa.RecordBatch, centres: np.ndarray, near_pivots: int, nth: int, k: int) -> pa.RecordBatch:
        """Rows of the batch, copied to the blocks that they visit in round ``nth``."""
        bound, own = self.bounds(_angles(_unit(batch) @ centres.T), near_pivots)
        # A little wider than the k-th best: scores are rounded, angles are not exact.
        score = batch["bound"].to_numpy(zero_copy_only=False)
        widest = np.where(np.isnan(score), math.pi, _angles(score - 2 * ROUNDING) + 1e-7)
        wanted = bound <= widest[:, None]
        # The areas nearest by their pivot that together hold k vectors.
        order = np.argsort(bound + own, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        seed = np.zeros(bound.shape, bool)
        np.put_along_axis(seed, order, before < k, axis=1)
        number = np.searchsorted(self.block, self.group)
        turn = np.argsort(number, kind="stable")
        starts = np.searchsorted(number[turn], np.arange(len(self.block)))
        nearest = np.minimum.reduceat(bound[:, turn], starts, axis=1)
        seeded = np.logical_or.reduceat(seed[:, turn], starts, axis=1)
        # Blocks without a seed in the order in which they can come near; the same in each round.
        place = np.argsort(np.argsort(np.where(seeded, -1.0, nearest), axis=1, kind="stable"), axis=1) - seeded.sum(1)[:, None]
        of_round = seeded if nth == 0 else ~seeded & ((place < NEXT) if nth == 1 else (place >= NEXT))
        looked = wanted & of_round[:, number]
        goes = np.logical_or.reduceat(looked[:, turn], starts, axis=1)
        rows, groups = np.nonzero(goes)
        # The areas of a visit: those of its row that lie in its group.
        r, areas = np.nonzero(looked[:, turn])
        lists = np.searchsorted(r * len(self.block) + number[turn][areas], rows * len(self.block) + groups)
        offsets = np.append(lists, len(areas)).astype(np.int32)
        parts = np.zeros(len(self.block), np.int64)
        np.maximum.at(parts, number, self.parts[self.cell])
        copies = parts[groups]
        chosen = np.repeat(np.arange(len(rows)), copies)
        block = np.repeat(self.block[groups] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(turn[areas], pa.int32()))
        base = batch.select(["query_id", "vector", "norm"]).take(pa.array(rows[chosen]))
        return pa.RecordBatch.from_arrays(
            [*base.columns, pa.array(block, pa.int64()), listed.take(pa.array(chosen))],
            names=["query_id", "vector", "norm", "block", "areas"],
        )


def _area_kernel(k: int, cut: float | None):
    """Scores of a block pair; rows in areas that no query of the block looks for are left out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _no_rows(left, right)
        asked = np.unique(left["areas"].combine_chunks().flatten().to_numpy())
        right = right.filter(pa.array(np.isin(right["area"].to_numpy(), asked)))
        if not right.num_rows:
            return _no_rows(left, right)
        right = _by_id(right)
        unit, other, out = _table_unit(left), _table_unit(right), []
        step = max(1, SCRATCH_BYTES // (8 * len(other)))
        for at in range(0, len(unit), step):
            scores = _round(unit[at : at + step] @ other.T)
            rows, cols = _pick(scores, k, cut)
            out.append(_emit(left["query_id"].slice(at, step), right["catalog_id"], scores, rows, cols))
        return pa.concat_tables(out)

    return run


def _summary_batch(known: dict[tuple[int, int], list]) -> pa.RecordBatch:
    cells, rings = zip(*known)
    n, lo, hi, least = zip(*known.values())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(cells, pa.int32()), pa.array(rings, pa.int32()), pa.array(n, pa.int64()),
            pa.array(lo, pa.float64()), pa.array(hi, pa.float64()),
            pa.array([list(x) for x in least], pa.list_(pa.float64())),
        ],
        names=["cell", "ring", "n", "lo", "hi", "least"],
    )


# ---------------------------------------------------------------- approximate search


def lsh_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 3,
    *,
    tables: int = 16,
    bits: int | None = None,
    probes: int = 0,
    seed: int = 7,
    min_similarity: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate top ``k``: only pairs that share a random-hyperplane bucket in one
    of ``tables`` tables are scored. More tables find more, more bits score less.

    Without ``bits`` they follow from the number of catalogue rows, so that a bucket holds
    about ``BUCKET_ROWS`` however large the catalogue is. A query also looks into ``probes``
    more buckets of each table: those beyond the hyperplanes that it lies nearest to.
    """
    catalog = few_copies(catalog.select("catalog_id", "vector", "norm"), k, ["vector"])
    d = catalog.select(F.size("vector").alias("d")).first()
    schema = _score_schema(queries, catalog)
    if d is None:
        return best_per_query(queries.sparkSession.createDataFrame([], schema), k)
    if bits is None:
        catalog = keep(catalog)
        bits = lsh_bits(catalog.count())
    planes = np.random.default_rng(seed).standard_normal((d["d"], tables * bits))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def buckets(batches, probes: int):
        ways = 1 + min(probes, bits)
        for batch in _chunks(batches, tables * max(bits, ways)):
            sides = (_unit(batch) @ planes).reshape(batch.num_rows, tables, bits)
            own = ((sides >= 0) * weights).sum(axis=2)
            # The nearest hyperplanes first; beyond each lies one more bucket.
            near = np.argsort(np.abs(sides), axis=2, kind="stable")[:, :, : ways - 1]
            marks = np.concatenate([own[:, :, None], own[:, :, None] ^ weights[near]], axis=2)
            rows = np.repeat(np.arange(batch.num_rows), tables * ways)
            base = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    *base.columns,
                    pa.array(np.tile(np.repeat(np.arange(tables), ways), batch.num_rows), pa.int32()),
                    pa.array(marks.ravel(), pa.int64()),
                ],
                names=[*base.schema.names, "table", "bucket"],
            )

    def keyed(side: DataFrame, row_id: str, probes: int) -> DataFrame:
        side = side.select(row_id, "vector", "norm")
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in side.schema)
        return side.mapInArrow(lambda b: buckets(b, probes), f"{fields}, table int, bucket bigint")

    found = block_pairs(
        keyed(queries, "query_id", probes),
        keyed(catalog, "catalog_id", 0),
        ["table", "bucket"],
        _dense_kernel(k, min_similarity),
        schema,
        block_rows,
    )
    return best_per_query(found, k)


def lsh_bits(rows: int) -> int:
    """Bits of a bucket's number for buckets of about ``BUCKET_ROWS``."""
    return max(1, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS)))
