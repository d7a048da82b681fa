"""Runs of periodically repeated words, by difference-cover longest common extensions.

A run is a stretch of words with smallest period ``q`` that holds the period at least twice and
cannot be extended. On the grid of the multiples of ``q``, one point ``i`` of every run has its
word equal to the one at ``i + q``; how far the two places agree to the right and to the left
(their longest common extensions) tells the run. All grids together have ``n log n`` points.

Extensions: the residues of ``COVER`` modulo ``MODULUS`` hold every difference, so two places
reach two sampled ones after the same, short way. Those few words are compared as they are, and
most pairs end there. Between sampled places the extension is a range minimum over the common
prefixes of neighbours in the sorted order of the *sampled* suffixes, from a sparse table.

Documents are worked on in groups of bounded size, a longer document by itself; they are parted
by words that occur once, so no extension crosses from one to the next. A document never leaves
its task: no shuffle, and memory grows with the longest document only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# Fixed value: a perfect difference set. Every difference modulo 31 occurs between two members.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Words of the documents that are worked on together, and grid points that are looked at at once.
GROUP_WORDS = 1 << 17
POINTS = 1 << 20
MIN_LENGTH = 12


def common_shifts(cover: tuple[int, ...] = COVER, modulus: int = MODULUS) -> np.ndarray:
    """For two residues the smallest step that brings both into the cover."""
    member = np.zeros(modulus, bool)
    member[list(cover)] = True
    steps = np.arange(modulus)
    both = member[(steps[:, None] + steps) % modulus]  # residue by step
    meet = both[:, None, :] & both[None, :, :]
    if not meet.any(axis=2).all():
        raise ValueError("not a difference cover")
    return meet.argmax(axis=2).astype(np.int32)


SHIFTS = common_shifts()


class SampledSuffixes:
    """Common prefixes of suffixes that start at ``places`` (sampled ones, ascending).

    ``words`` must not hold two equal suffixes or a suffix that is the beginning of another
    before ``MODULUS`` words of padding at its end, which unique separators see to.
    """

    def __init__(self, words: np.ndarray, places: np.ndarray):
        self.words, self.number = words, np.full(len(words), -1, np.int32)
        self.number[places] = np.arange(len(places), dtype=np.int32)
        self._sort(places)

    def _refine(self, rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Order the ``tied`` by ``key`` inside their ranks; who is still tied."""
        order = np.lexsort((key, rank[tied]))
        members, key = tied[order], key[order]
        before = rank[members]
        first = np.ones(len(members), bool)
        first[1:] = (before[1:] != before[:-1]) | (key[1:] != key[:-1])
        group = np.ones(len(members), bool)
        group[1:] = before[1:] != before[:-1]
        at = np.arange(len(members))
        # A rank is the place of its first member, so parts of a group stay within its places.
        start = at[group][np.cumsum(group) - 1]
        own = at[first][np.cumsum(first) - 1]
        rank[members] = before + (own - start)
        size = np.diff(np.append(at[first], len(members)))
        return members[np.repeat(size > 1, size)]

    def _sort(self, places: np.ndarray) -> None:
        m, w = len(places), self.words
        rank = np.zeros(m, np.int32)
        tied = np.arange(m)
        for t in range(0, MODULUS, 2):  # two words a key
            high = w[places[tied] + t].astype(np.int64) << 32
            low = w[places[tied] + t + 1] if t + 1 < MODULUS else 0
            tied = self._refine(rank, tied, high | low)
            if not len(tied):
                break
        levels, step = [rank.copy()], MODULUS
        while len(tied):
            # Equal so far, so no separator has been passed and the next sampled place exists.
            tied = self._refine(rank, tied, levels[-1][self.number[places[tied] + step]].astype(np.int64))
            levels.append(rank.copy())
            step *= 2
        self.rank = rank
        order = np.empty(m, np.int32)
        order[rank] = np.arange(m, dtype=np.int32)
        self.table = self._minima(self._neighbours(places, order, levels))

    def _neighbours(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each suffix in the order and the next one."""
        a, b = places[order[:-1]], places[order[1:]]
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            # Ranks of a level are equal where MODULUS * 2**k words are.
            x, y = self.number[a + length], self.number[b + length]
            live = (x >= 0) & (y >= 0)
            same = np.zeros(len(a), bool)
            same[live] = levels[k][x[live]] == levels[k][y[live]]
            length[same] += MODULUS << k
        active = np.arange(len(a))
        while len(active):
            active = active[self.words[a[active] + length[active]] == self.words[b[active] + length[active]]]
            length[active] += 1
        return length

    @staticmethod
    def _minima(values: np.ndarray) -> np.ndarray:
        levels = max(1, int(len(values)).bit_length())
        table = np.zeros((levels, len(values)), np.int32)
        table[0] = values
        for k in range(1, levels):
            half = 1 << (k - 1)
            n = len(values) - 2 * half + 1
            table[k, :n] = np.minimum(table[k - 1, :n], table[k - 1, half : half + n])
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at the sampled places ``a`` and ``b``, pair by pair."""
        x, y = self.rank[self.number[a]], self.rank[self.number[b]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level)])


def extensions(words: np.ndarray, of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree from each place of ``a`` and of ``b`` on.

    ``of`` gives each place's document. Only documents in which a pair agrees up to sampled
    places have their sampled suffixes sorted.
    """
    shift = SHIFTS[a % MODULUS, b % MODULUS]
    length = np.zeros(len(a), np.int64)
    active, deep = np.arange(len(a)), []
    for t in range(MODULUS):
        there = shift[active] == t
        deep.append(active[there])
        active = active[~there]
        active = active[words[a[active] + t] == words[b[active] + t]]
        length[active] = t + 1
        if not len(active):
            break
    far = np.concatenate(deep)
    if len(far):
        wanted = np.zeros(int(of[-1]) + 1, bool)
        wanted[of[a[far]]] = True
        n = len(of)
        places = np.flatnonzero(wanted[of] & np.isin(np.arange(n) % MODULUS, COVER))
        suffixes = SampledSuffixes(words, places)
        length[far] = shift[far] + suffixes(a[far] + shift[far], b[far] + shift[far])
    return length


@dataclass
class Runs:
    """Runs, sorted by document, start and period; ``start`` counts from the document's first word."""

    document: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def grid_points(sizes: np.ndarray, points: int = POINTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All (document, place, period) of the harmonic grids, ``points`` at a time, about."""
    periods = sizes // 2
    document = np.repeat(np.arange(len(sizes), dtype=np.int32), periods)
    period = (np.arange(len(document)) - np.repeat(np.cumsum(periods) - periods, periods) + 1).astype(np.int32)
    count = (sizes[document] - 1) // period
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        done = ends[at - 1] if at else 0
        # A grid with more points than fit comes by itself; it is no longer than its document.
        to = max(at + 1, int(np.searchsorted(ends, done + points, side="right")))
        n = count[at:to]
        step = np.repeat(period[at:to], n)
        turn = np.arange(len(step)) - np.repeat(ends[at:to] - n - done, n)
        yield np.repeat(document[at:to], n), turn * step, step
        at = to


def runs_of(ids: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH) -> Runs:
    """All runs of at least ``min_length`` words in documents given one after the other.

    ``ids`` numbers the words from 0, ``sizes`` has each document's number of words.
    """
    n_docs = len(sizes)
    total = int(sizes.sum())
    offset = np.cumsum(sizes) - sizes + np.arange(n_docs) + 1  # of each document's first word
    size = total + n_docs + 1
    words = np.zeros(size + MODULUS, np.int32)
    top = int(ids.max()) + 1 if total else 0
    borders = np.append(offset - 1, size - 1)
    inner = np.ones(size, bool)
    inner[borders] = False
    words[:size][inner] = ids
    words[borders] = top + np.arange(n_docs + 1)
    # A document's places are those of its words and of the separator after them, in the mirror alike.
    of = np.append(0, np.repeat(np.arange(n_docs), sizes + 1)).astype(np.int32)
    mirror = np.append(words[:size][::-1], np.zeros(MODULUS, np.int32))
    of_mirror = np.append(0, np.repeat(np.arange(n_docs), sizes[::-1] + 1)).astype(np.int32)
    found = []
    long_enough = np.where(sizes >= min_length, sizes, 0)
    hits = [[], []]
    for document, place, period in grid_points(long_enough):
        at = offset[document] + place
        same = np.flatnonzero(words[at] == words[at + period])
        hits[0].append(at[same])
        hits[1].append(period[same])
        # Where most words are equal the points are worked on as they come.
        if sum(map(len, hits[0])) >= POINTS:
            found.append(_extended(words, mirror, of, of_mirror, size, *map(np.concatenate, hits), min_length))
            hits = [[], []]
    if hits[0]:
        found.append(_extended(words, mirror, of, of_mirror, size, *map(np.concatenate, hits), min_length))
    begin, length, period = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    # A stretch with a period has its multiples too: the smallest counts.
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    first = np.ones(len(begin), bool)
    first[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, period = begin[first], length[first], period[first]
    order = np.lexsort((period, begin))
    begin, length, period = begin[order], length[order], period[order]
    document = of[begin]
    return Runs(document, begin - offset[document] if len(begin) else begin, length, period)


def _extended(words, mirror, of, of_mirror, size, at, period, min_length):
    """Begin, length and period of the runs through the points ``at`` and ``at + period``."""
    ahead = extensions(words, of, at, at + period)
    # Fewer than one period lie behind the first of a run's grid points.
    able = ahead >= np.maximum(1, min_length + 1 - 2 * period)
    at, period, ahead = at[able], period[able].astype(np.int64), ahead[able]
    back = extensions(mirror, of_mirror, size - at, size - at - period)
    length = ahead + back + period
    good = (back < period) & (length >= np.maximum(min_length, 2 * period))
    return at[good] - back[good], length[good], period[good]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) == 0


def split_words(text: str | None) -> list[bytes]:
    # bytes.split() parts at exactly \x20 and \x09-\x0D.
    return (text or "").encode().split()


def document_runs(texts: list[list[bytes]], min_length: int) -> Iterator[tuple[Runs, list[bytes]]]:
    """Of each document its runs and its words without what the runs repeat."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = [w for t in texts for w in t]
    ids = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy()
    runs = runs_of(ids, sizes, min_length)
    edges = np.searchsorted(runs.document, np.arange(len(texts) + 1))
    for i, own in enumerate(texts):
        part = slice(edges[i], edges[i + 1])
        one = Runs(runs.document[part], runs.start[part], runs.length[part], runs.period[part])
        if len(one.start):
            own = [own[k] for k in np.flatnonzero(kept_words(len(own), one.start, one.length, one.period))]
        yield one, own


def find_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """One row per document: ``doc_id, runs, collapsed``.

    ``runs`` lists (start, length, period) of every run, by start, then period. Words are
    ``[^\\x20\\x09-\\x0D]+``, numbered from 0; a run is a stretch with smallest period
    ``period``, at least ``min_length`` and two periods long, that no neighbouring word
    extends. ``collapsed`` is the text's words, without those that lie in a run after its first
    period, joined by one space. A null text counts as empty: no runs, empty ``collapsed``.
    Rows that repeat are worked on each; other columns are ignored; an empty table gives no
    rows.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, first = 0, 0, 0
            texts: list[list[bytes]] = []
            for value in batch.column(1):
                words = split_words(value.as_py())
                if texts and held + len(words) > GROUP_WORDS:
                    yield result(batch, first, texts)
                    first, texts, held = at, [], 0
                texts.append(words)
                held += len(words)
                at += 1
            if texts:
                yield result(batch, first, texts)

    def result(batch: pa.RecordBatch, first: int, texts: list[list[bytes]]) -> pa.RecordBatch:
        found, collapsed = zip(*document_runs(texts, min_length), strict=True)
        count = np.cumsum([0, *(len(f.start) for f in found)])
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate([getattr(f, c) for f in found]), pa.int64()) for c in ("start", "length", "period")],
            fields=list(run_type),
        )
        lists = pa.ListArray.from_arrays(pa.array(count, pa.int32()), flat)
        joined = pa.array([b" ".join(c) for c in collapsed], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).slice(first, len(texts)), lists, joined], ["doc_id", "runs", "collapsed"]
        )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    one = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType(
        [rows.schema["doc_id"], StructField("runs", ArrayType(one)), StructField("collapsed", StringType())]
    )
    return rows.mapInArrow(run, schema)
