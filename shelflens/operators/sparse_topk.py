"""The best catalogue rows for every query row, by cosine of counted grams.

A catalogue of a measured size within ``BROADCAST_BYTES`` is broadcast as an inverted index and
queries are scored where they are: work for the grams that two rows share, no shuffle.

A larger one is searched through *cells* of rows that are alike. Rows are sorted by their block
and by which of a few telling grams they hold, and cut into cells of some thousand rows. A cell is
summed up by the greatest share that each gram has of any row's length: no row of it scores more
than the sum of a query's shares times those. A query goes to the cell of the highest bound, and
with the k-th best score found there to the cells whose bound is not below it; within a cell runs
of ``RUN_ROWS`` rows are left out by the same bound. Cells and the queries sent to one are cut to
bounded sizes, each pair of them is scored as matrix products in a task, and at most ``k`` rows a
query leave it: no pair of rows is ever written out. Nothing is lost, as the bounds hold for
every pair; how much is left out depends on how alike the catalogue's rows are.

``candidate_pairs`` finds all pairs above a cut instead, not only the best. All grams have one
order, rarest first. Two rows whose cosine reaches a cut share a gram in both their *prefixes*:
the fewest first grams after which what remains is too short to make up the missing product. Rows
meet on these grams as an id, two weights, a length and a signature, and a pair goes on if neither
bound keeps it under the cut:

* by position: at the first gram that a pair shares, the product of what begins there;
* by signature: a gram sets one of 128 bits. A bit of one side that the other lacks is a gram
  that is not shared, so the lengths of what can be shared follow from two bit counts.

Scores are rounded to ``SCORE_DIGITS``; ties go to the smaller catalogue id.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.functions.numbers import SCORE_DIGITS
from shelflens.operators.keep import keep

BROADCAST_BYTES = 8 << 20
#: Scores that a task holds at a time when it scores against a broadcast catalogue.
SCORES = 1 << 19
#: Grams that more of the rows have are columns of a matrix, the most frequent of them.
HOT_SHARE, HOT_GRAMS = 0.01, 256
ROUNDING = 10.0**-SCORE_DIGITS
#: Rows of a cell at least, cells at most, queries that a cell meets at a time, rows of a run.
CELL_ROWS, MOST_CELLS, PIECE_ROWS, RUN_ROWS = 2048, 4096, 16384, 128
#: Numbers of the table of bounds, grams by cells; the grams that it has no room for are bounded as one.
BOUND_NUMBERS = 8 << 20
#: Grams that order the rows, chosen on so many of them; they set how much is left out, never what is found.
SPLITS, SPLIT_ROWS, SPLIT_GRAMS = 62, 4096, 512
#: What bounds and scores in single precision may be off by.
SLACK = 4 * ROUNDING


# ---------------------------------------------------------------- broadcast catalogue


def _entries(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, gram and count of all entries."""
    grams, counts = table["grams"], table["tf"]
    if isinstance(grams, pa.ChunkedArray):
        grams, counts = grams.combine_chunks(), counts.combine_chunks()
    lengths = grams.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    values = counts.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows, grams.flatten().to_numpy(zero_copy_only=False).astype(np.int64), values


class Index:
    """Postings of a catalogue by block and gram; of grams that many rows have, a dense matrix.

    Rows are sorted by block and id, so a row's place is also its turn among equal scores.
    """

    def __init__(self, table: pa.Table, blocks: list[str]):
        table = table.sort_by([(c, "ascending") for c in [*blocks, "catalog_id"]])
        names = _blocks_of(table, blocks)
        self.blocks: dict[tuple, int] = {}
        code = np.array([self.blocks.setdefault(n, len(self.blocks)) for n in names], np.int64)
        self.first = np.searchsorted(code, np.arange(len(self.blocks) + 1))
        self.ids, self.norms = table["catalog_id"].combine_chunks(), table["norm"].to_numpy()
        rows, grams, counts = _entries(table)
        self.grams, place = np.unique(grams, return_inverse=True)
        often = np.bincount(place, minlength=len(self.grams))
        hot = np.argsort(-often, kind="stable")[:HOT_GRAMS]
        hot = hot[often[hot] > HOT_SHARE * len(code)]
        self.column = np.full(len(self.grams), -1, np.int32)
        self.column[hot] = np.arange(len(hot))
        dense = self.column[place] >= 0
        self.hot = rows[dense], self.column[place[dense]], counts[dense].astype(np.float32)
        rows, place, counts = rows[~dense], place[~dense], counts[~dense]
        key = code[rows] * max(len(self.grams), 1) + place
        order = np.argsort(key, kind="stable")
        self.keys, start = np.unique(key[order], return_index=True)
        self.start = np.append(start, len(order))
        self.row, self.count = (rows - self.first[code[rows]])[order].astype(np.int32), counts[order]
        self._matrix = None

    def matrix(self) -> np.ndarray:
        """Counts of the frequent grams, row by column; made once per worker."""
        if self._matrix is None:
            self._matrix = np.zeros((len(self.norms), int((self.column >= 0).sum())), np.float32)
            self._matrix[self.hot[0], self.hot[1]] = self.hot[2]
        return self._matrix


def _blocks_of(table: pa.Table | pa.RecordBatch, blocks: list[str]) -> list[tuple]:
    return list(zip(*(table[c].to_pylist() for c in blocks), strict=True)) if blocks else [()] * table.num_rows


def _best_in_index(batch: pa.RecordBatch, index: Index, blocks: list[str], k: int, cut: float | None):
    """The batch's hits, block by block and in pieces whose scores stay bounded."""
    code = np.array([index.blocks.get(b, -1) for b in _blocks_of(batch, blocks)], np.int64)
    rows, grams, counts = _entries(batch)
    if not len(index.grams) or not len(grams):
        return
    place = np.minimum(np.searchsorted(index.grams, grams), len(index.grams) - 1)
    known = (code[rows] >= 0) & (index.grams[place] == grams)
    rows, place, counts = rows[known], place[known], counts[known]
    norm = batch["norm"].to_numpy(zero_copy_only=False)
    edges = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    matrix = index.matrix()
    # Whole numbers below 2**24 are exact in single precision.
    exact = norm.max() * index.norms.max() < 1 << 24
    by_block = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[by_block], prepend=-2))
    for members in np.split(by_block, cuts[1:]):
        block = int(code[members[0]])
        if block < 0:
            continue
        first, last = int(index.first[block]), int(index.first[block + 1])
        wide = last - first
        step = max(1, SCORES // wide)
        for at in range(0, len(members), step):
            chosen = members[at : at + step]
            n = edges[chosen + 1] - edges[chosen]
            local = np.repeat(np.arange(len(chosen)), n)
            entry = np.repeat(edges[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            column = index.column[place[entry]]
            hot = column >= 0
            asked = np.zeros((len(chosen), matrix.shape[1]), np.float32)
            asked[local[hot], column[hot]] = counts[entry[hot]]
            part = matrix[first:last] if exact else matrix[first:last].astype(np.float64)
            dots = asked.astype(part.dtype) @ part.T
            local, entry = local[~hot], entry[~hot]
            key = block * len(index.grams) + place[entry]
            slot = np.minimum(np.searchsorted(index.keys, key), max(len(index.keys) - 1, 0))
            hit = index.keys[slot] == key if len(index.keys) else np.zeros(len(key), bool)
            local, entry, slot = local[hit], entry[hit], slot[hit]
            if len(slot):
                long = index.start[slot + 1] - index.start[slot]
                post = np.repeat(index.start[slot] - (np.cumsum(long) - long), long) + np.arange(long.sum())
                cell = np.repeat(local * wide, long) + index.row[post]
                rare = np.bincount(cell, np.repeat(counts[entry], long) * index.count[post], dots.size)
                dots = dots + rare.reshape(dots.shape)
            yield from _best_scores(dots, norm[chosen], index.norms[first:last], chosen, first, k, cut)


def _best_scores(dots: np.ndarray, own: np.ndarray, other: np.ndarray, chosen: np.ndarray, first: int, k: int, cut):
    """The ``k`` best of each row of products. Only products that may be among them are rounded."""
    near = dots * (1.0 / other) * (1.0 / own)[:, None]
    # Without a cut any shared gram counts, however little it scores.
    least = 1e-12 if cut is None else cut - 2 * ROUNDING
    if near.shape[1] > k:
        kth = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        least = np.maximum(least, kth - 2 * ROUNDING)[:, None]
    rows, cols = np.nonzero(near >= least)
    scale = 10.0**SCORE_DIGITS
    scores = np.floor(dots[rows, cols].astype(np.float64) / (own[rows] * other[cols]) * scale + 0.5) / scale
    if cut is not None:
        good = scores >= cut
        rows, cols, scores = rows[good], cols[good], scores[good]
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
    best = rank <= k
    yield chosen[rows[best]], first + cols[best], rank[best], scores[best]


def _unlike(table: pa.Table, blocks: list[str]) -> pa.Table:
    """Equal rows once."""
    names = list(zip(_blocks_of(table, blocks), table["catalog_id"].to_pylist(), strict=True))
    if len(set(names)) == len(names):
        return table
    vectors = zip(table["grams"].to_pylist(), table["tf"].to_pylist(), strict=True)
    first = {(*name, tuple(g), tuple(t)): i for i, (name, (g, t)) in reversed([*enumerate(zip(names, vectors))])}
    return table.take(pa.array(sorted(first.values())))


def _measured(catalog: DataFrame) -> int:
    """Bytes, about, by one aggregate."""
    text = F.coalesce(F.octet_length(F.col("catalog_id").cast("string")), F.lit(0))
    return catalog.agg(F.sum(F.size("grams") * 12 + text + 16)).first()[0] or 0


def _broadcast_search(
    queries: DataFrame, catalog: DataFrame, k: int, cut: float | None, blocks: list[str]
) -> DataFrame:
    table = _unlike(catalog.select(*blocks, "catalog_id", "grams", "tf", "norm").toArrow(), blocks)
    shared = queries.sparkSession.sparkContext.broadcast(Index(table, blocks))

    def run(batches):
        index = shared.value
        for batch in batches:
            for rows, cols, rank, scores in _best_in_index(batch, index, blocks, k, cut):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["query_id"].take(pa.array(rows)), pa.array(rank, pa.int32()),
                        index.ids.take(pa.array(cols)), pa.array(scores, pa.float64()),
                    ],
                    ["query_id", "rank", "catalog_id", "score"],
                )

    q, c = (d.schema[n].dataType.simpleString() for d, n in ((queries, "query_id"), (catalog, "catalog_id")))
    known = queries.select(*blocks, "query_id", "grams", "tf", "norm")
    return known.mapInArrow(run, f"query_id {q}, rank int, catalog_id {c}, score double")


# ---------------------------------------------------------------- all pairs above a cut


def common_grams(queries: DataFrame, catalog: DataFrame, limit: int = 65536) -> np.ndarray:
    """The most frequent grams, rarest of them first; at most ``limit``."""
    both = queries.select(F.explode("grams").alias("g")).unionAll(
        catalog.select(F.explode("grams").alias("g"))
    )
    top = (
        both.groupBy("g")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "g")
        .limit(limit)
        .toArrow()
    )
    return top["g"].to_numpy()[::-1]


NARROW = {"gram": "bigint", "weight": "float", "after": "float", "square": "float", "low": "bigint", "high": "bigint"}


def prefix_rows(side: DataFrame, row_id: str, blocks: list[str], cut: float, shared) -> DataFrame:
    """One narrow row for each gram of each row's prefix: ``row_id, blocks`` and ``NARROW``.

    ``weight`` is the gram's share of the row's length, ``after`` the share of all later grams
    together, ``square`` the squared length, ``low`` and ``high`` the signature's bits.
    """

    def run(batches):
        known, place = shared.value
        for batch in batches:
            rows, grams, counts = _entries(batch)
            if not len(rows):
                continue
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            frequent = np.where(known[at] == grams, place[at], -1)
            bit = (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)
            n = batch.num_rows
            words = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
            for half in (0, 1):
                mine = (bit >> np.uint64(6)) == half
                np.bitwise_or.at(words[half], rows[mine], np.uint64(1) << (bit[mine] & np.uint64(63)))
            turn = np.lexsort((grams, frequent, rows))
            rows, grams, squares = rows[turn], grams[turn], counts[turn] ** 2
            total = np.cumsum(squares)
            last = np.searchsorted(rows, rows, side="right") - 1
            after = total[last] - total
            square = batch["norm"].to_numpy(zero_copy_only=False)[rows] ** 2
            keep_it = after + squares >= max(cut, 0.0) ** 2 * square * (1 - 1e-9)
            rows, grams, squares = rows[keep_it], grams[keep_it], squares[keep_it]
            after, square = after[keep_it], square[keep_it]
            base = batch.select([row_id, *blocks]).take(pa.array(rows))
            # Single precision, rounded up: the bounds must not fall below the truth.
            up = [
                np.nextafter(np.sqrt(x / square).astype(np.float32), np.float32(2)) for x in (squares, np.maximum(after, 0))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *base.columns, pa.array(grams), pa.array(up[0]), pa.array(up[1]),
                    pa.array(np.nextafter(square.astype(np.float32), np.float32(np.inf))),
                    *(pa.array(w[rows].view(np.int64)) for w in words),
                ],
                [*base.schema.names, *NARROW],
            )

    side = side.select(row_id, *blocks, "grams", "tf", "norm")
    fields = ", ".join(f"`{side.schema[c].name}` {side.schema[c].dataType.simpleString()}" for c in (row_id, *blocks))
    return side.mapInArrow(run, f"{fields}, " + ", ".join(f"{n} {t}" for n, t in NARROW.items()))


def _may_reach(cut: float) -> Column:
    """Whether neither bound keeps the pair ``q``, ``c`` of narrow rows under ``cut``."""
    least = F.lit(max(cut, 0.0) * (1 - 1e-6))
    by_place = F.col("q.weight") * F.col("c.weight") + F.col("q.after") * F.col("c.after") >= least

    def part(own: str, other: str) -> Column:
        lacking = sum(
            F.bit_count(F.col(f"{own}.{w}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{w}")))) for w in ("low", "high")
        )
        # A gram counts at least once, so what is lacking is as long as it has bits.
        return F.greatest(F.lit(0.0), 1 - lacking / F.col(f"{own}.square"))

    return by_place & (part("q", "c") * part("c", "q") >= least * least)


def candidate_pairs(queries: DataFrame, catalog: DataFrame, cut: float, blocks: list[str], order: np.ndarray) -> DataFrame:
    """Distinct ``blocks, query_id, catalog_id`` that hold every pair with a cosine of at least ``cut``."""
    by_gram = np.argsort(order, kind="stable")
    shared = queries.sparkSession.sparkContext.broadcast((order[by_gram], by_gram))
    left = prefix_rows(queries, "query_id", blocks, cut, shared).alias("q")
    right = prefix_rows(catalog, "catalog_id", blocks, cut, shared).alias("c")
    same = [F.col(f"q.`{c}`") == F.col(f"c.`{c}`") for c in (*blocks, "gram")]
    # Never broadcast: both sides hold several rows for each row of the tables.
    met = left.join(right.hint("merge"), reduce(and_, [*same, _may_reach(cut)]))
    return met.select(*[F.col(f"q.`{c}`").alias(c) for c in blocks], "query_id", "catalog_id").distinct()


# ---------------------------------------------------------------- cells


def _telling_grams(sample: pa.Table) -> np.ndarray:
    """Grams in the order in which they best halve what those before them have left together."""
    rows, grams, _ = _entries(sample)
    if not len(rows):
        return np.zeros(0, np.int64)
    known, place = np.unique(grams, return_inverse=True)
    often = np.argsort(-np.bincount(place), kind="stable")[:SPLIT_GRAMS]
    column = np.full(len(known), -1)
    column[often] = np.arange(len(often))
    holds = np.zeros((sample.num_rows, len(often)), np.int32)
    hit = column[place] >= 0
    holds[rows[hit], column[place[hit]]] = 1
    group, chosen = np.zeros(sample.num_rows, np.int64), []
    while len(chosen) < SPLITS:
        turn = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[turn], prepend=-1))
        size = np.diff(starts, append=len(turn))[:, None]
        held = np.add.reduceat(holds[turn], starts, axis=0)
        gain = np.minimum(held, size - held).sum(axis=0)
        best = int(gain.argmax())
        if not gain[best]:
            break
        chosen.append(best)
        group = np.unique(group * 2 + holds[:, best], return_inverse=True)[1]
    return known[often[chosen]]


def _shares(rows: np.ndarray, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (counts / norms[rows]).astype(np.float32)


def _norms(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    norms = table["norm"]
    return norms.to_numpy() if isinstance(norms, pa.ChunkedArray) else norms.to_numpy(zero_copy_only=False)


def _cells_of(catalog: DataFrame, rows: int, n: int) -> DataFrame:
    """The catalogue with ``cell``, of ``rows`` rows that are alike, and ``place`` in it."""
    sample = catalog.orderBy(F.xxhash64("catalog_id", "grams")).limit(SPLIT_ROWS).select("grams", "tf").toArrow()
    telling = _telling_grams(sample)
    turn = np.argsort(telling)
    shared = catalog.sparkSession.sparkContext.broadcast((telling[turn], np.int64(1) << (SPLITS - 1 - turn)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in catalog.schema)

    def coded(batches):
        known, bits = shared.value
        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            if len(known):
                rows, grams, _ = _entries(batch)
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = known[at] == grams
                np.bitwise_or.at(code, rows[hit], bits[at[hit]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "_code"])

    def numbered(batches):
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first + at // rows), pa.array((at % rows).astype(np.int32))],
                [*batch.schema.names, "cell", "place"],
            )

    order = ["_block", "_code", "catalog_id"]
    ordered = catalog.mapInArrow(coded, f"{fields}, _code bigint").repartitionByRange(n, *order)
    ordered = ordered.sortWithinPartitions(*order).drop("_code")
    return keep(ordered.mapInArrow(numbered, f"{fields}, cell bigint, place int"))


class Bounds:
    """What the rows of each cell can score at most; one column per cell, in the order of their blocks."""

    def __init__(self, table: pa.Table, grams: np.ndarray):
        first: dict[int, str] = {}
        last: dict[int, str] = {}
        ids = table["cell"].to_pylist()
        # A cell comes in several parts if its rows were read so.
        for cell, lo, hi in zip(ids, table["first"].to_pylist(), table["last"].to_pylist(), strict=True):
            lo, hi = lo.encode(), hi.encode()
            first[cell], last[cell] = min(first.get(cell, lo), lo), max(last.get(cell, hi), hi)
        self.cells = np.array(sorted(first, key=lambda c: (first[c], last[c], c)), np.int64)
        self.first, self.last = ([side[c] for c in self.cells.tolist()] for side in (first, last))
        self.grams = grams
        number = {c: i for i, c in enumerate(self.cells.tolist())}
        column = np.array([number[c] for c in ids], np.int64)
        self.most = np.zeros((len(grams), len(self.cells)), np.float32)
        places, most = table["places"].combine_chunks(), table["most"].combine_chunks()
        wide = places.value_lengths().to_numpy(zero_copy_only=False)
        where = places.flatten().to_numpy(), np.repeat(column, wide)
        np.maximum.at(self.most, where, most.flatten().to_numpy().astype(np.float32))
        self.rest = np.zeros(len(self.cells), np.float32)
        np.maximum.at(self.rest, column, table["rest"].to_numpy().astype(np.float32))

    def of(self, batch: pa.RecordBatch | pa.Table):
        """Row numbers, the cells of their block (from, to) and the rows' bounds there, piece by piece."""
        rows, grams, counts = _entries(batch)
        if not len(rows) or not len(self.cells):
            return
        share = _shares(rows, counts, _norms(batch))
        at = np.minimum(np.searchsorted(self.grams, grams), max(len(self.grams) - 1, 0))
        known = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), bool)
        other = np.sqrt(np.bincount(rows[~known], share[~known].astype(np.float64) ** 2, batch.num_rows))
        names, code = np.unique(np.array(batch["_block"].to_pylist(), object), return_inverse=True)
        edges = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        by_block = np.argsort(code, kind="stable")
        for members in np.split(by_block, np.flatnonzero(np.diff(code[by_block])) + 1):
            name = names[code[members[0]]].encode()
            lo, hi = bisect_left(self.last, name), bisect_right(self.first, name)
            if lo >= hi:
                continue
            step = max(1, (4 << 20) // (max(len(self.grams), hi - lo)))
            for start in range(0, len(members), step):
                chosen = members[start : start + step]
                n = edges[chosen + 1] - edges[chosen]
                local = np.repeat(np.arange(len(chosen)), n)
                entry = np.repeat(edges[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                local, entry = local[known[entry]], entry[known[entry]]
                asked = np.zeros((len(chosen), len(self.grams)), np.float32)
                asked[local, at[entry]] = share[entry]
                bound = asked @ self.most[:, lo:hi] + np.outer(other[chosen], self.rest[lo:hi])
                yield chosen, lo, hi, np.minimum(bound, 1.0)


def _bounds(cells: DataFrame, n: int) -> Bounds:
    """Summaries of the cells; the driver sees ``BOUND_NUMBERS`` of them at most."""
    frequent = common_grams(cells, cells.limit(0), max(1, BOUND_NUMBERS // max(n, 1)))
    grams = np.sort(frequent)
    shared = cells.sparkSession.sparkContext.broadcast(grams)

    def summed(batches):
        known, found = shared.value, {}
        for batch in batches:
            rows, grams, counts = _entries(batch)
            share = _shares(rows, counts, _norms(batch))
            cell, block = batch["cell"].to_numpy(zero_copy_only=False), batch["_block"].to_pylist()
            at = np.minimum(np.searchsorted(known, grams), max(len(known) - 1, 0))
            hit = known[at] == grams if len(known) else np.zeros(len(grams), bool)
            lost = np.sqrt(np.bincount(rows[~hit], share[~hit].astype(np.float64) ** 2, batch.num_rows))
            for one in np.unique(cell):
                mine = np.flatnonzero(cell == one)
                if one not in found:
                    found[one] = [np.zeros(len(known), np.float32), 0.0, block[mine[0]], block[mine[-1]]]
                whole = found[one]
                of_it = hit & (cell[rows] == one)
                np.maximum.at(whole[0], at[of_it], share[of_it])
                names = [block[i] for i in mine]
                whole[1] = max(whole[1], float(lost[mine].max()))
                whole[2:] = min(whole[2], *names[:1]), max(whole[3], *names[-1:])
            # Rows come in the order of their cells: all but the last one are whole.
            for one in sorted(found)[:-1]:
                yield _bound_batch(one, found.pop(one))
        for one, whole in found.items():
            yield _bound_batch(one, whole)

    schema = "cell bigint, places array<int>, most array<float>, rest double, first string, last string"
    return Bounds(cells.select("cell", "_block", "grams", "tf", "norm").mapInArrow(summed, schema).toArrow(), grams)


def _bound_batch(cell: int, whole: list) -> pa.RecordBatch:
    places = np.flatnonzero(whole[0])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(cell)], pa.int64()), pa.array([places], pa.list_(pa.int32())),
            pa.array([whole[0][places]], pa.list_(pa.float32())), pa.array([whole[1]], pa.float64()),
            pa.array([whole[2]], pa.string()), pa.array([whole[3]], pa.string()),
        ],
        ["cell", "places", "most", "rest", "first", "last"],
    )


class Cell:
    """A cell's rows, in runs of ``RUN_ROWS``."""

    def __init__(self, table: pa.Table):
        self.norm = _norms(table)
        self.rows, grams, self.counts = _entries(table)
        self.grams, self.place = np.unique(grams, return_inverse=True)
        self.edges = np.searchsorted(self.rows, np.arange(table.num_rows + 1))
        self.runs = -(-table.num_rows // RUN_ROWS)
        self.most = np.zeros((len(self.grams), self.runs), np.float32)
        np.maximum.at(self.most, (self.place, self.rows // RUN_ROWS), _shares(self.rows, self.counts, self.norm))
        # Rows are in the order of their blocks, so a run's blocks are a range.
        self.blocks: dict[str, int] = {}
        self.block = np.array([self.blocks.setdefault(b, len(self.blocks)) for b in table["_block"].to_pylist()])
        self.first = self.block[::RUN_ROWS]
        self.last = self.block[np.minimum(np.arange(1, self.runs + 1) * RUN_ROWS, table.num_rows) - 1]

    def run(self, r: int, dtype) -> tuple[np.ndarray, np.ndarray]:
        """Column of each gram in the run's matrix (-1: none), and the matrix."""
        lo, hi = self.edges[r * RUN_ROWS], self.edges[min((r + 1) * RUN_ROWS, len(self.norm))]
        own, column = np.unique(self.place[lo:hi], return_inverse=True)
        where = np.full(len(self.grams), -1)
        where[own] = np.arange(len(own))
        matrix = np.zeros((len(own), min(RUN_ROWS, len(self.norm) - r * RUN_ROWS)), dtype)
        matrix[column, self.rows[lo:hi] - r * RUN_ROWS] = self.counts[lo:hi]
        return where, matrix


def _best_in_cell(asked: pa.Table, known: pa.Table, least: np.ndarray, k: int):
    """Row numbers and scores of the ``k`` best of ``known`` for each row of ``asked``, from ``least`` on.

    Also the ``k``-th best score of each row, where it has so many, else its ``least``.
    """
    cell, norm, n = Cell(known), _norms(asked), asked.num_rows
    rows, grams, counts = _entries(asked)
    at = np.minimum(np.searchsorted(cell.grams, grams), len(cell.grams) - 1)
    hit = cell.grams[at] == grams
    rows, at, counts = rows[hit], at[hit], counts[hit]
    edges = np.searchsorted(rows, np.arange(n + 1))
    block = np.array([cell.blocks.get(b, -1) for b in asked["_block"].to_pylist()])
    share = _shares(rows, counts, norm)
    bound = np.zeros((n, cell.runs), np.float32)
    some = np.flatnonzero(np.diff(edges))
    step = max(1, (8 << 20) // (64 * cell.runs))
    for start in range(0, len(some), step):
        part = some[start : start + step]
        lo, hi = edges[part[0]], edges[part[-1] + 1]
        bound[part] = np.add.reduceat(cell.most[at[lo:hi]] * share[lo:hi, None], edges[part] - lo, axis=0)
    bound[(block[:, None] < cell.first) | (block[:, None] > cell.last) | (bound <= 0)] = -1.0
    best = np.full((n, k), -1.0)
    lowest = least.astype(np.float64).copy()
    # Whole numbers below 2**24 are exact in single precision.
    dtype = np.float32 if n and norm.max() * cell.norm.max() < 1 << 24 else np.float64
    scale, hits = 10.0**SCORE_DIGITS, []

    def visit(r: int, chosen: np.ndarray, where: np.ndarray, matrix: np.ndarray) -> None:
        m = edges[chosen + 1] - edges[chosen]
        local = np.repeat(np.arange(len(chosen)), m)
        entry = np.repeat(edges[chosen] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        column = where[at[entry]]
        there = column >= 0
        side = np.zeros((len(chosen), len(matrix)), dtype)
        side[local[there], column[there]] = counts[entry[there]]
        dots = side @ matrix
        other = slice(r * RUN_ROWS, r * RUN_ROWS + matrix.shape[1])
        if cell.first[r] != cell.last[r]:
            dots[block[chosen][:, None] != cell.block[other]] = 0
        near = dots * (1.0 / cell.norm[other]).astype(dtype) * (1.0 / norm[chosen]).astype(dtype)[:, None]
        top = np.partition(near, near.shape[1] - k, axis=1)[:, -k:] if near.shape[1] > k else near
        top = np.where(top > 0, top, -1.0)
        all_best = np.concatenate([best[chosen], top], axis=1)
        best[chosen] = np.partition(all_best, all_best.shape[1] - k, axis=1)[:, -k:]
        lowest[chosen] = np.maximum(lowest[chosen], best[chosen].min(axis=1))
        i, j = np.nonzero((near >= (lowest[chosen] - SLACK)[:, None]) & (dots > 0))
        exact = dots[i, j].astype(np.float64) / (norm[chosen[i]] * cell.norm[other][j])
        hits.append((chosen[i], j + r * RUN_ROWS, np.floor(exact * scale + 0.5) / scale))

    nearest = bound.argmax(axis=1) if cell.runs else np.zeros(n, np.int64)
    piece = 2048
    for first in (True, False):
        for r in range(cell.runs):
            wanted = (bound[:, r] > 0) & (bound[:, r] >= lowest - SLACK) & ((nearest == r) == first)
            wanted = np.flatnonzero(wanted)
            if len(wanted):
                where, matrix = cell.run(r, dtype)
                for start in range(0, len(wanted), piece):
                    visit(r, wanted[start : start + piece], where, matrix)
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), least
    q, c, score = (np.concatenate(x) for x in zip(*hits))
    good = (score >= least[q]) & (score >= lowest[q] - SLACK)
    q, c, score = q[good], c[good], score[good]
    place = np.empty(known.num_rows, np.int64)
    place[pc.sort_indices(known["catalog_id"]).to_numpy()] = np.arange(known.num_rows)
    turn = np.lexsort((place[c], -score, q))
    q, c, score = q[turn], c[turn], score[turn]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    kth = np.maximum(least, -1.0)
    full = rank == k - 1
    kth[q[full]] = np.maximum(kth[q[full]], score[full])
    return q[rank < k], c[rank < k], score[rank < k], kth


VISIT = ["query_id", "_block", "grams", "tf", "norm"]


def _meet(visits: DataFrame, cells: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel(queries, cell)`` for each cell and each piece of the queries that visit it.

    ``visits`` holds ``VISIT``, ``cell`` and ``least``. A cell that many queries visit is copied to
    as many pieces; the counts are one row per cell.
    """
    pieces = F.broadcast(
        visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int").alias("_pieces"))
    )
    q, c = (d.schema[n].dataType for d, n in ((visits, "query_id"), (cells, "catalog_id")))
    own = visits.join(pieces, "cell").select(
        "cell", F.pmod(F.xxhash64("query_id", "grams"), "_pieces").cast("int").alias("piece"), *VISIT, "least",
        F.lit(None).cast(c).alias("catalog_id"), F.lit(None).cast("int").alias("place"),
    )
    other = cells.join(pieces, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("piece"), F.lit(None).cast(q).alias("query_id"),
        *VISIT[1:], F.lit(None).cast("double").alias("least"), "catalog_id", "place",
    )

    def run(table: pa.Table) -> pa.Table:
        mine = pc.is_null(table["place"])
        return kernel(table.filter(mine), table.filter(pc.invert(mine)).sort_by("place"))

    return own.unionByName(other).groupBy("cell", "piece").applyInArrow(run, schema)


def cell_search(queries: DataFrame, catalog: DataFrame, k: int, cut: float | None, blocks: list[str]) -> DataFrame:
    """Exact top ``k`` without a size limit on the catalogue, see above."""
    from shelflens.operators.topk import best_per_query

    block = F.to_json(F.struct(*blocks)) if blocks else F.lit("")
    queries = queries.select("query_id", block.alias("_block"), "grams", "tf", "norm").filter(F.size("grams") > 0)
    catalog = catalog.select("catalog_id", block.alias("_block"), "grams", "tf", "norm").filter(F.size("grams") > 0)
    catalog = keep(catalog.distinct())
    n = catalog.count()
    rows = max(CELL_ROWS, -(-n // MOST_CELLS))
    cells = _cells_of(catalog, rows, max(1, n // (8 * rows)))
    table = _bounds(cells, -(-n // rows) + n // (8 * rows) + 1)
    shared = queries.sparkSession.sparkContext.broadcast(table)
    least = -1.0 if cut is None else float(cut)
    q, c = (d.schema[n].dataType.simpleString() for d, n in ((queries, "query_id"), (catalog, "catalog_id")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema)

    def nearest(batches):
        """Each query with the cell that can score highest."""
        for batch in batches:
            for chosen, lo, hi, bound in shared.value.of(batch):
                best = bound.argmax(axis=1)
                reach = bound[np.arange(len(chosen)), best]
                good = (reach > 0) & (reach >= least - SLACK)
                rows = batch.select(VISIT).take(pa.array(chosen[good]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(shared.value.cells[lo:hi][best[good]]), pa.array(np.full(len(rows), least))],
                    [*VISIT, "cell", "least"],
                )

    def hits(asked: pa.Table, known: pa.Table, found) -> list:
        own, other, score, _ = found
        return [asked["query_id"].take(pa.array(own)), known["catalog_id"].take(pa.array(other)), pa.array(score, pa.float64())]

    names = ["query_id", "catalog_id", "score"]

    def first(asked: pa.Table, known: pa.Table) -> pa.Table:
        """The hits in the first cell, and the visits to all others that may hold better ones."""
        if not asked.num_rows or not known.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        else:
            found = _best_in_cell(asked, known, asked["least"].to_numpy(), k)
        out = pa.table(hits(asked, known, found), names)
        parts = [out]
        for name in ("_block", "grams", "tf", "norm", "cell", "least"):
            parts[0] = parts[0].append_column(name, pa.nulls(out.num_rows, pa.int64() if name == "cell" else asked[name].type))
        been = asked["cell"].to_numpy() if asked.num_rows else np.zeros(0, np.int64)
        for chosen, lo, hi, bound in shared.value.of(asked):
            cells = shared.value.cells[lo:hi]
            goes = (bound > 0) & (bound >= (found[3][chosen] - SLACK)[:, None]) & (cells != been[chosen][:, None])
            row, cell = np.nonzero(goes)
            sent = asked.select(VISIT).take(pa.array(chosen[row]))
            sent = sent.append_column("cell", pa.array(cells[cell])).append_column("least", pa.array(found[3][chosen[row]]))
            sent = sent.append_column("catalog_id", pa.nulls(len(row), out["catalog_id"].type))
            sent = sent.append_column("score", pa.nulls(len(row), pa.float64()))
            parts.append(sent.select(parts[0].schema.names))
        return pa.concat_tables(parts)

    def later(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows or not known.num_rows:
            return pa.table([asked["query_id"].slice(0, 0), known["catalog_id"].slice(0, 0), pa.array([], pa.float64())], names)
        return pa.table(hits(asked, known, _best_in_cell(asked, known, asked["least"].to_numpy(), k)), names)

    # Counted per cell, then sent: the bounds are worked out once.
    seeds = keep(queries.mapInArrow(nearest, f"{fields}, cell bigint, least double"))
    both = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.drop("query_id").schema)
    begun = keep(_meet(seeds, cells, first, f"query_id {q}, catalog_id {c}, score double, {both}, cell bigint, least double"))
    rest = begun.filter(F.col("cell").isNotNull()).select(*VISIT, "cell", "least")
    found = begun.filter(F.col("cell").isNull()).select(*names)
    return best_per_query(found.unionByName(_meet(rest, cells, later, f"query_id {q}, catalog_id {c}, score double")), k)


def sparse_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 3,
    *,
    min_similarity: float | None = None,
    block_on: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact top ``k`` by cosine, of all pairs that share a gram or reach ``min_similarity``.

    Sides hold an id, ``grams`` (ascending, each once), ``tf``, ``norm`` and the ``block_on``
    columns, within whose equal values pairs are sought; a null there meets nothing. Returns
    ``query_id, rank, catalog_id, score``. Query ids are unique; equal catalogue rows count once.
    """
    if min_similarity is not None and not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must be in (0, 1]")
    blocks = list(block_on or [])
    for c in blocks:
        queries, catalog = queries.filter(F.col(c).isNotNull()), catalog.filter(F.col(c).isNotNull())
    queries = queries.select(*blocks, "query_id", "grams", "tf", "norm")
    catalog = catalog.select(*blocks, "catalog_id", "grams", "tf", "norm")
    # Measured, then fetched or searched: its vectors are made once.
    catalog = keep(catalog)
    if _measured(catalog) <= broadcast_bytes:
        return _broadcast_search(queries, catalog, k, min_similarity, blocks)
    return cell_search(queries, catalog, k, min_similarity, blocks)
