"""Near duplicates by SimHash fingerprints, compared exactly in tiles.

Equal fingerprints become one. A fingerprint's tile is the numbers of ones in some parts of
its 64 bits. Two fingerprints that differ in at most ``radius`` bits lie in tiles whose counts
differ by at most that much in all, so all other pairs of tiles are skipped: nothing is
approximate. The more fingerprints there are, the finer the parts (see ``parts_for``), so that
the share of pairs that is compared falls as the table grows. Tiles that remain are compared with numpy exclusive-or and bit counts; a large
tile is cut into cells of bounded size that run as tasks of their own. A cell returns a
spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import LongType, StructField, StructType

from shelflens.llm.components import stars
from shelflens.operators.keep import keep

SHINGLE = 3
RADIUS = 3
#: Fingerprints from which on the ones of so many parts are counted. Each part more lets fewer
#: pairs be compared (10, 4, 1.6 and 0.7 in a hundred) and sends a fingerprint to more tiles.
FINER = ((0, 3), (1_000_000, 4), (4_000_000, 5), (30_000_000, 6))
#: Rows of a cell on either side, and pairs that are compared in one step.
CELL = 16_384
STEP = 1 << 20
#: Pairs of fingerprints after which a bucket of cells is full.
BUCKET = 1 << 22


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Lower-cased A-Z, words between ASCII white space, XXH64 (seed 42) of word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    hashed = partial(xxhash.xxh64_intdigest, seed=42)
    if len(words) <= shingle:
        return hashed(line)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - shingle + 1
    pieces = zip(starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
    hashes = np.fromiter((hashed(line[a:b]) for a, b in pieces), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        some = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(some, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """One row per document: ``doc_id, mark`` (a hash of the text), ``fp`` (64 bits as a signed number)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            kept = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "mark", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("mark", LongType()), StructField("fp", LongType())])
    return rows.mapInArrow(run, schema)


def parts_of(n: int) -> tuple[tuple[int, int], ...]:
    """First bits and lengths of ``n`` about equal parts of 64 bits."""
    ends = [64 * i // n for i in range(n + 1)]
    return tuple((a, b - a) for a, b in zip(ends[:-1], ends[1:], strict=True))


def parts_for(fingerprints: int) -> tuple[tuple[int, int], ...]:
    """The parts whose ones tell tiles apart, for a table of so many different fingerprints."""
    return parts_of(max(n for least, n in FINER if fingerprints >= least))


def tile_of(fp: Column, parts: tuple[tuple[int, int], ...]) -> Column:
    """The number of a fingerprint's tile, from its ones by part."""
    code = F.lit(0)
    for start, length in parts:
        ones = F.bit_count(F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << length) - 1)))
        code = code * (length + 1) + ones
    return code.cast("int")


def tile_counts(fps: np.ndarray, parts: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Ones by part, one row per fingerprint."""
    return np.stack(
        [np.bitwise_count((fps >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int32) for s, n in parts], 1
    )


def code_of(counts: np.ndarray, parts: tuple[tuple[int, int], ...]) -> np.ndarray:
    code = np.zeros(len(counts), np.int64)
    for i, (_, length) in enumerate(parts):
        code = code * (length + 1) + counts[:, i]
    return code


def steps_within(radius: int, parts: int) -> np.ndarray:
    """All differences of tile counts that a pair within the radius can have."""
    span = range(-radius, radius + 1)
    return np.array([d for d in product(span, repeat=parts) if sum(map(abs, d)) <= radius], np.int32)


class Plan:
    """Which bucket compares what: for each tile a grid of cells, cells packed into buckets.

    Made on the driver from the sizes of the tiles (``sizes[code]``, noughts included), a few
    numbers per tile: the product of the parts' lengths plus one bounds them, at most 2.5
    million for six parts, whatever the table's size. Cells and buckets are worked out from
    those and never listed.
    """

    def __init__(self, sizes: np.ndarray, radius: int, parts: tuple[tuple[int, int], ...]):
        self.parts = parts
        self.lengths = np.array([n for _, n in parts], np.int32)
        self.steps = steps_within(radius, len(parts))
        shape = [n + 1 for _, n in parts]
        grid, visits = sizes.reshape(shape), np.zeros(shape, np.int64)
        for step in self.steps[[tuple(d) >= (0,) * len(parts) for d in self.steps.tolist()]]:
            # A tile is visited from itself and from those behind it in the order of codes.
            own = tuple(slice(max(0, -d), m - max(0, d)) for d, m in zip(step, shape, strict=True))
            other = tuple(slice(max(0, d), m - max(0, -d)) for d, m in zip(step, shape, strict=True))
            visits[own] += grid[other]
        visits = visits.reshape(-1)
        self.rows = -(-sizes // CELL)
        self.columns = np.where(sizes > 0, -(-visits // CELL), 0)
        cells = self.rows * self.columns
        self.first = np.cumsum(cells) - cells
        #: Work of one cell of a tile, and of all cells before the tile.
        self.work = np.where(cells > 0, sizes * visits // np.maximum(cells, 1) + sizes + visits, 0)
        self.before = np.cumsum(self.work * cells) - self.work * cells

    def bucket(self, cell: np.ndarray, tile: np.ndarray) -> np.ndarray:
        """The bucket of each cell: as many cells in a row as make up the work of one bucket."""
        return (self.before[tile] + (cell - self.first[tile] + 1) * self.work[tile]) // BUCKET

    def cells(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(cells, their tiles, rows of ``fps``, whether they live there) of every place to go to."""
        counts = tile_counts(fps, self.parts)
        own = code_of(counts, self.parts)
        mixed = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        everyone = np.arange(len(fps))
        yield from self._spread(own, everyone, mixed % np.maximum(self.rows[own], 1).astype(np.uint64), True)
        for step in self.steps:
            other = counts + step
            inside = ((other >= 0) & (other <= self.lengths)).all(1)
            codes = np.where(inside, code_of(np.where(inside[:, None], other, 0), self.parts), 0)
            go = np.flatnonzero(inside & (codes <= own) & (self.rows[codes] > 0))
            column = mixed[go] % np.maximum(self.columns[codes[go]], 1).astype(np.uint64)
            yield from self._spread(codes[go], go, column, False)

    def _spread(self, tiles: np.ndarray, rows: np.ndarray, place: np.ndarray, home: bool):
        """A resident goes to all cells of its row in the grid, a visitor to all of its column."""
        times = self.columns[tiles] if home else self.rows[tiles]
        again = np.repeat(np.arange(len(rows)), times)
        n = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
        t, p = tiles[again], place[again].astype(np.int64)
        across = self.columns[t]
        cell = self.first[t] + (p * across + n if home else n * across + p)
        yield cell, t, rows[again], np.full(len(again), home)


def forest(near: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The least reachable node of each of ``n`` nodes, from links given step by step."""
    root = np.arange(n)
    for a, b in near:
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (further := root[root]).tobytes() != root.tobytes():
                root = further
    return root


def links_of(residents: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two lists of fingerprints, as two arrays."""
    every, place = np.unique(np.concatenate([residents, visitors]), return_inverse=True)
    at, to = place[: len(residents)], place[len(residents) :]

    def near() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, STEP // max(1, len(visitors)))
        for i in range(0, len(residents), step):
            apart = np.bitwise_count(residents[i : i + step, None] ^ visitors[None, :])
            x, y = np.nonzero(apart <= radius)
            yield at[i + x], to[y]

    root = forest(near(), len(every))
    linked = np.flatnonzero(root != np.arange(len(every)))
    return every[linked], every[root[linked]]


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``nodes`` has one row per fingerprint (``fp``); links (a, b) that span their components."""
    parts = parts_for(nodes.count())
    found = nodes.groupBy(tile_of(F.col("fp"), parts).alias("tile")).count().toArrow()
    sizes = np.zeros(np.prod([n + 1 for _, n in parts]), np.int64)
    sizes[found["tile"].to_numpy()] = found["count"].to_numpy()
    # Bounded as Plan says: 40 bytes a tile, 0.4 MB for three parts and 100 MB for six.
    shared = nodes.sparkSession.sparkContext.broadcast(Plan(sizes, radius, parts))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for cell, tile, row, home in plan.cells(fps):
                if len(cell):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(plan.bucket(cell, tile)), pa.array(cell), pa.array(home), pa.array(fps[row].view(np.int64))],
                        ["bucket", "cell", "home", "fp"],
                    )

    def compare(table: pa.Table) -> pa.Table:
        cell, home = table["cell"].to_numpy(), table["home"].to_numpy()
        fps = table["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((~home, cell))
        cell, home, fps = cell[order], home[order], fps[order]
        edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            middle = start + int(home[start:end].sum())
            x, y = links_of(fps[start:middle], fps[middle:end], radius)
            a.append(x)
            b.append(y)
        return pa.table({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    sent = nodes.select("fp").mapInArrow(send, "bucket long, cell long, home boolean, fp long")
    return sent.groupBy("bucket").applyInArrow(compare, "a long, b long")


def classes(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """One row per document: ``doc_id, mark, fp, root, component_id``; ``root`` names its component."""
    rows = keep(fingerprints(docs, doc_id, text, shingle))
    nodes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = stars(near_links(nodes, radius)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints that differ in at most ``radius`` bits are linked, ``component_id`` is the
    smallest id that links reach, the document's own included (a null id only if there is no
    other). A text without words, null or empty, has the fingerprint zero and is linked like
    any other; fewer words than a shingle make one shingle. Rows that repeat stay rows; other
    columns are ignored; an empty table gives no rows.
    """
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    found = classes(docs, doc_id, text, shingle, radius)
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One document of each group, that of the smallest id, with all its columns.

    Of rows that repeat this id in the group, the one whose text has the smallest hash stays.
    """
    kept = (
        classes(docs, doc_id, text, shingle, radius)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct(F.col("mark"), F.col("doc_id"))).alias("best"))
        .select(F.col("best.doc_id").alias("_kept"), F.col("best.mark").alias("_kept_mark"))
    )
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_held"),
        F.col(doc_id).alias("_own"),
        F.xxhash64(text).alias("_own_mark"),
    )
    first = F.row_number().over(W.partitionBy("_own", "_own_mark").orderBy("_own"))
    same = F.col("_own").eqNullSafe(F.col("_kept")) & (F.col("_own_mark") == F.col("_kept_mark"))
    return held.join(kept, same).withColumn("_n", first).filter("_n = 1").select("_held.*")
