"""Long repeats between documents by a run-length index, built in shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id. One index over a whole corpus cannot be built in tasks, so it is built in shards
that each hold all occurrences of their strings:

1. Every such string contains exactly one anchor: of its 24-byte pieces the one with the least
   hash. Equal strings have equal anchors at equal places. Anchors are counted by hash; those
   that occur in one document only cannot lie in a repeat.
2. An anchor that is left goes, with the 26 bytes on either side, to the shard of its hash:
   once per block of documents and distinct surrounding, with the smallest id there. Anchors
   of very many documents are dealt out further, by each whole string around them.
3. A shard's index is a run-compressed, positional Burrows-Wheeler transform: surroundings are
   aligned at their anchors, and column by column kept in the order of their reversed
   prefixes. A column is cut into runs of equal symbols, which move as one; at a run's ends
   stands where its match with the run before begins, and its smallest document id. Streaming
   the columns gives each surrounding's matching statistics; where a match reaches LENGTH
   and its class has a smaller id, the string is marked.
4. The marks go back to the blocks, and each document's bytes are cut.

Texts are shuffled once, by block; all stages reuse that exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 50
PIECE = 24
SIDE = LENGTH - PIECE
WIDE = LENGTH + SIDE
#: Bytes that stand outside of a document; UTF-8 has no such byte.
OUTSIDE = 0xFE
#: Text bytes of a block of documents, about.
BLOCK_BYTES = 2 << 20
#: Documents with one anchor from which on it is dealt out by its whole strings.
MANY = 4096
#: Bits that a hash loses where anchors are only counted; an accidental equal does no harm there.
SHORT = np.uint64(16)
#: Bytes of a long document that are looked at in one step.
STEP = 1 << 20


def mixed(words: np.ndarray) -> np.ndarray:
    words = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return words ^ (words >> np.uint64(32))


def extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every stretch of ``width`` values."""
    n, span, now = len(values) - width + 1, 1, values
    while span * 2 <= width:
        now = pick(now[:-span], now[span:])
        span *= 2
    return pick(now[:n], now[width - span : width - span + n])


def anchors(text: bytes, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the least piece of every string of LENGTH bytes; ties all count.

    With ``known``, sorted short hashes, only anchors among these, and for each the strings
    that it is the anchor of: bit w stands for the string that starts ``SIDE - w`` bytes before.
    """
    places, hashes, strings = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]
    for at in range(0, len(text) - LENGTH + 1, STEP):
        part = text[at : at + STEP + LENGTH - 1]
        raw = np.frombuffer(part + bytes(8), np.uint8)
        eight = np.lib.stride_tricks.as_strided(raw, (len(part), 8), (1, 1)).copy().view("<u8").ravel()
        n = len(part) - PIECE + 1
        h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
        h ^= (eight[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(7)
        h = mixed(h ^ (eight[16 : 16 + n] * np.uint64(0x165667B19E3779F9)) << np.uint64(3))
        width = SIDE + 1
        least = extreme(h, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        # A piece is least somewhere if it equals the greatest of the minima around it.
        found = np.flatnonzero(extreme(np.concatenate([edge, least, edge]), width, np.maximum) == h)
        if known is not None:
            short = h[found] >> SHORT
            found = found[known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short]
            bits = np.zeros(len(found), np.uint32)
            for w in range(width):
                start = found - SIDE + w
                own = (start >= 0) & (start < len(least))
                own[own] = least[start[own]] == h[found[own]]
                bits |= own.astype(np.uint32) << np.uint32(w)
            strings.append(bits)
        places.append(found + at)
        hashes.append(h[found])
    place, first, row = np.unique(np.concatenate(places), return_index=True, return_inverse=True)
    bits = np.zeros(len(place), np.uint32)
    if known is not None:
        np.bitwise_or.at(bits, row, np.concatenate(strings))
    return place, np.concatenate(hashes)[first], bits


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def documents_of(table: pa.Table) -> list[tuple[int | None, bytes]]:
    """A block's documents in a fixed order, so that numbers can name them."""
    rows = zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)
    whole = [(i, (t or "").encode()) for i, t in rows]
    return sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def order_of(doc_id: int | None) -> int:
    return (1 << 63) - 1 if doc_id is None else doc_id


def block_anchors(docs: list[tuple[int | None, bytes]], known: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Document numbers, places, hashes and strings of the anchors of a block."""
    parts = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]]
    for i, (_, text) in enumerate(docs):
        found = anchors(text, known)
        for part, values in zip(parts, (np.full(len(found[0]), i), *found), strict=True):
            part.append(values)
    return tuple(np.concatenate(p) for p in parts)


def parts_by(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each shard number that occurs."""
    if not len(shard):
        return
    order = np.argsort(shard, kind="stable")
    sorted_ = shard[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    for start, end in zip(starts, [*starts[1:], len(shard)], strict=True):
        yield int(sorted_[start]), order[start:end]


def six_bytes(short: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def from_six(raw: bytes) -> np.ndarray:
    whole = np.zeros((len(raw) // 6, 8), np.uint8)
    whole[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return whole.view("<u8").ravel()


def count_in_block(shards: int):
    """Step 1 in a block: each distinct anchor hash and in how many documents it is, up to 255."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        number, _, hashed, _ = block_anchors(documents_of(table))
        short = hashed >> SHORT
        order = np.lexsort((number, short))
        short, number = short[order], number[order]
        fresh = np.concatenate([[True], (short[1:] != short[:-1]) | (number[1:] != number[:-1])])
        once, often = np.unique(short[fresh[: len(short)]], return_counts=True)
        rows = [
            (shard, block, len(at), packed(six_bytes(once[at]), np.minimum(often[at], 255).astype(np.uint8)))
            for shard, at in parts_by((once % np.uint64(shards)).astype(np.int64))
        ]
        return columns(rows, ["shard", "block", "n", "counts"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()])

    return run


def columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    lists = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(lists, types, strict=True)], names=names)


def repeated_in_shard(table: pa.Table) -> pa.Table:
    """Step 1 over all blocks: to each block its anchors that others have too, and which are in many."""
    blocks = table["block"].to_pylist()
    raw = [zstandard.decompress(c) for c in table["counts"].to_pylist()]
    sizes = table["n"].to_pylist()
    hashes = [from_six(r[: 6 * n]) for r, n in zip(raw, sizes, strict=True)]
    often = np.concatenate([np.frombuffer(r[6 * n :], np.uint8) for r, n in zip(raw, sizes, strict=True)])
    every, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(place, weights=often, minlength=len(every))
    rows = []
    for block, own in zip(blocks, np.split(place, np.cumsum(sizes)[:-1]), strict=True):
        known = own[total[own] >= 2]
        if len(known):
            many = (total[known] >= MANY).astype(np.uint8)
            rows.append((block, six_bytes(every[known]).tobytes(), many.tobytes()))
    return columns(rows, ["block", "hashes", "many"], [pa.int64(), pa.binary(), pa.binary()])


def surroundings(docs: list[tuple[int | None, bytes]], number: np.ndarray, place: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The bytes of each anchor's strings, aligned at the anchor; all others are left out."""
    edge = bytes([OUTSIDE]) * SIDE
    wide = np.empty((len(number), WIDE), np.uint8)
    for i, at in parts_by(number):
        padded = np.frombuffer(edge + docs[i][1] + edge, np.uint8)
        wide[at] = np.lib.stride_tricks.sliding_window_view(padded, WIDE)[place[at]]
    column = np.arange(WIDE)
    lowest = np.log2((strings & (~strings + np.uint32(1))).astype(float)).astype(np.int64)
    highest = np.log2(strings.astype(float)).astype(np.int64)
    wide[(column < lowest[:, None]) | (column >= highest[:, None] + LENGTH)] = OUTSIDE
    return wide


def hash_of_rows(wide: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(wide), -(-wide.shape[1] // 8) * 8), np.uint8)
    padded[:, : wide.shape[1]] = wide
    words = padded.view("<u8")
    found = np.zeros(len(wide), np.uint64)
    for i in range(words.shape[1]):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + words[:, i])
    return found


def send_surroundings(shards: int):
    """Step 2 in a block: distinct surroundings by shard, with where they occur."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, types = ["shard", "block", "n", "rows", "where"], [pa.int64()] * 3 + [pa.binary()] * 2
        if not left.num_rows or not right.num_rows:
            return columns([], names, types)
        block, docs = left["block"][0].as_py(), documents_of(left)
        known = from_six(b"".join(right["hashes"].to_pylist()))
        many = np.frombuffer(b"".join(right["many"].to_pylist()), np.uint8)
        order = np.argsort(known)
        known, many = known[order], many[order]
        number, place, hashed, valid = block_anchors(docs, known)
        many = many[np.searchsorted(known, hashed >> SHORT)].astype(bool)
        wide = surroundings(docs, number, place, valid)
        if many.any():
            # One row for each string around the anchor, all else left out; its own hash is its key.
            some, rest = np.flatnonzero(many), np.flatnonzero(~many)
            parts = [(wide[rest], valid[rest], hashed[rest], number[rest], place[rest])]
            for w in range(SIDE + 1):
                has = some[(valid[some] >> np.uint32(w)) & 1 == 1]
                only = np.full((len(has), WIDE), OUTSIDE, np.uint8)
                only[:, w : w + LENGTH] = wide[has, w : w + LENGTH]
                parts.append((only, np.full(len(has), 1 << w, np.uint32), hash_of_rows(only), number[has], place[has]))
            wide, valid, hashed, number, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        owners = np.array([order_of(i) for i, _ in docs], np.int64)[number]
        # Equal surroundings of one key become one row with the smallest id.
        exact = np.concatenate([hashed[:, None].view(np.uint8).reshape(-1, 8), wide], 1)
        joined = np.ascontiguousarray(exact).view(f"V{8 + WIDE}").ravel()
        _, first, row = np.unique(joined, return_index=True, return_inverse=True)
        least = np.full(len(first), (1 << 63) - 1, np.int64)
        np.minimum.at(least, row, owners)
        later = owners > least[row]
        order = np.argsort(row, kind="stable")
        starts = np.searchsorted(row[order], np.arange(len(first) + 1))
        rows = []
        for shard, some in parts_by((hashed[first] % np.uint64(shards)).astype(np.int64)):
            own = np.concatenate([order[starts[r] : starts[r + 1]] for r in some])
            times = (starts[some + 1] - starts[some]).astype("<u4")
            spots = np.stack([number[own] * 2 + later[own], place[own]], 1).astype("<u4")
            one = first[some]
            body = packed(wide[one], valid[one], least[some], times)
            rows.append((shard, block, len(some), body, packed(spots)))
        return columns(rows, names, types)

    return run


def marked(wide: np.ndarray, key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Step 3: for each surrounding a bit for every string in it that a smaller id has too."""
    marks = np.zeros(len(wide), np.uint32)
    order = np.lexsort((owner, key))
    group = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
    never = WIDE + 1
    # begins[i]: the column at which the match of row i with the row before it begins.
    begins = np.where(np.concatenate([[True], group[1:] != group[:-1]]), never, 0)
    turned = np.ascontiguousarray(wide.T)
    for column in range(WIDE):
        symbol = group * 256 + turned[column][order]
        heads = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        lengths = np.diff(np.append(heads, len(symbol)))
        # Runs of equal symbols move as one: stable by symbol within their group.
        moved = np.argsort(symbol[heads], kind="stable")
        before = np.concatenate([[-1], moved[:-1]])
        same = np.concatenate([[False], symbol[heads[moved][1:]] == symbol[heads[moved][:-1]]])
        # A moved run matches the run now before it back to the latest start between the two.
        latest = np.where(begins[heads[moved]] == never, never, column + 1)
        gaps = np.flatnonzero(same)
        if len(gaps):
            ends = heads[before[gaps]] + lengths[before[gaps]]
            pairs = np.stack([ends, heads[moved[gaps]] + 1], 1).ravel()
            latest[gaps] = np.maximum.reduceat(np.append(begins, 0), pairs)[::2]
        first_of_group = np.concatenate([[True], group[heads[moved][1:]] != group[heads[moved][:-1]]])
        latest = np.where(first_of_group, never, np.where(same, latest, column + 1))
        starts = np.concatenate([[0], np.cumsum(lengths[moved])[:-1]])
        take = np.arange(len(order)) + np.repeat(heads[moved] - starts, lengths[moved])
        order, begins, group = order[take], begins[take], group[take]
        begins[starts] = latest
        string = column + 1 - LENGTH
        if string >= 0:
            # Matching statistics of at least LENGTH: classes between the rows that break off later.
            breaks = np.flatnonzero(begins > string)
            least = np.minimum.reduceat(owner[order], breaks)
            sizes = np.diff(np.append(breaks, len(order)))
            hit = np.repeat(least, sizes) < owner[order]
            marks[order[hit]] |= np.uint32(1 << string)
    return marks


def mark_in_shard(table: pa.Table) -> pa.Table:
    """Steps 3 and back: to each block the places where something is marked."""

    parts = [[], [], [], []]
    kinds = [(np.uint8, WIDE), (np.uint32, 1), (np.int64, 1), ("<u4", 1)]
    for n, body in zip(table["n"].to_pylist(), table["rows"].to_pylist(), strict=True):
        raw, at = zstandard.decompress(body), 0
        for part, (kind, many) in zip(parts, kinds, strict=True):
            part.append(np.frombuffer(raw, kind, n * many, at))
            at += part[-1].nbytes
    times = parts.pop()
    wide, valid, least = (np.concatenate(p) for p in parts)
    wide = wide.reshape(-1, WIDE)
    # Whatever a row was dealt by, it is aligned at its anchor.
    marks = marked(wide, hash_of_rows(wide[:, SIDE:LENGTH]), least) & valid
    rows, at = [], 0
    for block, occurs, where in zip(table["block"].to_pylist(), times, table["where"].to_pylist(), strict=True):
        spots = np.frombuffer(zstandard.decompress(where), "<u4").reshape(-1, 2).astype(np.int64)
        own = slice(at, at + len(occurs))
        at += len(occurs)
        later = spots[:, 0] % 2 == 1
        bits = np.where(later, np.repeat(valid[own], occurs), np.repeat(marks[own], occurs))
        hit = bits > 0
        if hit.any():
            rows.append((block, np.stack([spots[hit, 0] // 2, spots[hit, 1], bits[hit].astype(np.int64)], 1).tobytes()))
    return columns(rows, ["block", "marks"], [pa.int64(), pa.binary()])


def cut(text: bytes, starts: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes and stretches removed, and what is left, when strings from ``starts`` on go."""
    edges = np.zeros(len(text) + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + LENGTH, len(text)), -1)
    gone = np.cumsum(edges[:-1]) > 0
    if not len(gone):
        return 0, 0, text
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def cut_block(left: pa.Table, right: pa.Table) -> pa.Table:
    """Step 4: one row per document of a block."""
    docs = documents_of(left)
    found = np.frombuffer(b"".join(right["marks"].to_pylist()), np.int64).reshape(-1, 3)
    by_doc = {i: found[at] for i, at in parts_by(found[:, 0])}
    ids, sizes, removed, spans, digests = [], [], [], [], []
    for i, (doc_id, text) in enumerate(docs):
        starts = np.empty(0, np.int64)
        if i in by_doc:
            place, bits = by_doc[i][:, 1], by_doc[i][:, 2]
            starts = np.unique(np.concatenate([place[(bits >> w) & 1 == 1] - SIDE + w for w in range(SIDE + 1)]))
        gone, runs, rest = cut(text, starts)
        ids.append(doc_id)
        sizes.append(len(text))
        removed.append(gone)
        spans.append(runs)
        digests.append(hashlib.sha256(rest).hexdigest())
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte goes that is covered by a string of 50 bytes that also starts in a document
    with a smaller id; strings are judged on the input. A null text counts as empty, texts
    under 50 bytes stay whole. A row without an id comes after all others. Rows that repeat an
    id are one document for this purpose: none of them is smaller than another. Other columns
    are ignored; an empty table gives no rows. Ids must be whole numbers.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(shards))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), block.alias("block"))
    counted = rows.groupBy("block").applyInArrow(
        count_in_block(shards), "shard long, block long, n long, counts binary"
    )
    known = counted.groupBy("shard").applyInArrow(repeated_in_shard, "block long, hashes binary, many binary")
    sent = (
        rows.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(
            send_surroundings(shards),
            "shard long, block long, n long, rows binary, where binary",
        )
    )
    marks = sent.groupBy("shard").applyInArrow(mark_in_shard, "block long, marks binary")
    return (
        rows.groupBy("block")
        .cogroup(marks.groupBy("block"))
        .applyInArrow(cut_block, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
