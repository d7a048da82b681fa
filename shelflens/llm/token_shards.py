"""Token ids as binary shards, read by key through a minimal perfect hash index.

File format, two Parquet tables below one folder (Parquet because every store that Spark writes
to takes it, with Spark's commit protocol; the ids in it are raw bytes):

``shards``  a row per shard: its number, numbers of rows and ids, ``ids`` (all its documents' ids
            one after the other, unsigned little-endian, ``width`` bytes each: 2 where the
            vocabulary allows, else 4), ``offsets`` (64-bit, one more than rows: where each
            document's ids begin) and ``entries`` (for each key its hashes, first row and number
            of rows in the shard, from which the index is made)
``index``   a row per bucket of keys: a minimal perfect hash function of the bucket's keys, and
            for each of its slots a 32-bit fingerprint and the places (shard, row, rows)

Shards are cut from the documents in order of their ids, so all shards in order of their numbers
hold the corpus in order. A key is hashed to its bucket and there to its slot; a slot whose
fingerprint differs belongs to no key that was stored. That takes the same few steps however many
keys there are.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from shelflens.llm import bpe, bpe_stream

#: Ids that close a shard (its last document may go beyond), and documents that do.
SHARD_IDS = 1 << 20
SHARD_ROWS = 1 << 20
#: A shard's number is its part's (a range of the documents' ids) and these bits for its place there.
PART_BITS = 24
#: Keys of an index bucket, about.
BUCKET_KEYS = 4096
#: Bits of a level of the hash function for each key that it is offered.
SPARE = 2
KEY = ["_h1", "_h2"]

# ---------------------------------------------------------------- minimal perfect hashing


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """An independent looking 64-bit hash for each level, from a key's two hashes."""
    x = h1 + h2 * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """A minimal perfect hash function by levels of bit arrays.

    Each level offers its keys twice as many bits; a bit is set where exactly one key falls, and
    keys that collide go on to the next level. A key's slot is the number of bits set before its
    own. About 3.7 bits a key.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.cumsum([0, *sizes])
        self.before = np.cumsum(bits) - bits

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(h1):
            if len(sizes) == 200:
                raise ValueError("two keys share both hashes")
            size = SPARE * len(h1) + 1
            at = (_mixed(h1, h2, len(sizes)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(bits)
            h1, h2 = h1[~bits[at]], h2[~bits[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has a bit for it (then it was not stored)."""
        found = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            at = (_mixed(h1[left], h2[left], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[at]
            found[left[hit]] = self.before[at[hit]]
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<i{len(self.sizes)}i", len(self.sizes), *self.sizes)
        return head + np.packbits(self.bits, bitorder="little").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<i", data)
        sizes = list(struct.unpack_from(f"<{n}i", data, 4))
        packed = np.frombuffer(data, np.uint8, offset=4 + 4 * n)
        return cls(sizes, np.unpackbits(packed, count=sum(sizes), bitorder="little").astype(bool))


def key_hashes(key: Column) -> list[Column]:
    """Two 64-bit hashes of a key; a null key is a key of its own."""
    text = key.cast("string")
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(text, F.lit("second")).alias("_h2")]


def _unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64) if column.null_count == 0 else np.zeros(0, np.uint64)


def _fingerprints(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(32)).astype(np.uint32)


# ---------------------------------------------------------------- encoding


class Encoder:
    """The ids of a text as the vocabulary file's own library gives them, as an array.

    Texts go through tiktoken, which merges by the same ranks; one with a very long word or
    stretch of space goes through the streaming coder, whose work is linear in such words.
    """

    LONG = re.compile(r"\S{2000}|\s{2000}")

    def __init__(self, content: bytes):
        self.coder = bpe_stream.coder_for(content)
        vocab = self.coder.vocab
        self.dtype = "<u2" if vocab.size <= 1 << 16 else "<u4"
        made = dict(zip(vocab.byte_ids, range(256), strict=True))
        ranks = {vocab.text_of[i]: i for i in [*made, *vocab.made]}
        if vocab.made != sorted(vocab.made) or min(vocab.made, default=256) <= max(vocab.byte_ids):
            raise ValueError("ids must rise with the place in the merge list")
        self.fast = tiktoken.Encoding(
            "file", pat_str=bpe.WORDS, mergeable_ranks=ranks, special_tokens=vocab.special
        )

    def __call__(self, text: str) -> np.ndarray:
        if not self.LONG.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype(self.dtype)
        parts = [w for s in bpe_stream.stretches(self.coder, text) for w, _ in s]
        if len(self.coder) > bpe_stream.REMEMBERED:
            self.coder.clear()
        return np.array([int(i) for w in parts for i in w.split(",")], self.dtype)


_encoders: dict[bytes, Encoder] = {}


def encoder_for(content: bytes) -> Encoder:
    if content not in _encoders:
        _encoders.clear()
        _encoders[content] = Encoder(content)
    return _encoders[content]


# ---------------------------------------------------------------- writing

ENTRY = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("row", pa.int32()), ("rows", pa.int32())])
SHARDS = (
    "shard long, n_rows int, n_ids long, width int, ids binary, offsets binary, "
    "entries array<struct<h1:long,h2:long,row:int,rows:int>>"
)


class _Open:
    """A shard while it is filled."""

    def __init__(self):
        self.ids, self.ends, self.h1, self.h2, self.size = [], [0], [], [], 0

    def add(self, ids: np.ndarray, h1: int, h2: int) -> None:
        self.ids.append(ids)
        self.size += len(ids)
        self.ends.append(self.size)
        self.h1.append(h1)
        self.h2.append(h2)

    def closed(self, number: int) -> pa.RecordBatch:
        h1, h2 = np.array(self.h1, np.int64), np.array(self.h2, np.int64)
        # Rows of one key follow each other: they are one entry.
        first = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        rows = np.diff(np.append(first, len(h1))).astype(np.int32)
        columns = [h1[first], h2[first], first.astype(np.int32), rows]
        entries = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(ENTRY))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([len(h1)], pa.int32()),
                pa.array([self.size], pa.int64()),
                pa.array([self.ids[0].itemsize], pa.int32()),
                pa.array([np.concatenate(self.ids).tobytes()], pa.binary()),
                pa.array([np.array(self.ends, "<i8").tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), entries),
            ],
            ["shard", "n_rows", "n_ids", "width", "ids", "offsets", "entries"],
        )


def write_shards(
    docs: DataFrame,
    vocabulary_path: str,
    folder: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every text, close it with ``end_id``, write shards and index below ``folder``.

    Documents come in ascending order of their ids, a null id first; rows that repeat an id
    come in the order of a hash of their texts and are all found under it. A null text counts
    as empty and has the end id only. Other columns are ignored; an empty table leaves an empty
    corpus. The folder must be one that all executors share; what it held is replaced.
    """
    spark = docs.sparkSession
    file = bpe.shared_file(spark, vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(file.value)
        number, shard = TaskContext.get().partitionId() << PART_BITS, _Open()
        end = np.array([end_id], encode.dtype)
        for batch in batches:
            h1, h2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, value in enumerate(batch.column(0)):
                shard.add(np.concatenate([encode(value.as_py()), end]), h1[i], h2[i])
                if shard.size >= shard_ids or len(shard.h1) >= SHARD_ROWS:
                    yield shard.closed(number)
                    number, shard = number + 1, _Open()
        if shard.h1:
            yield shard.closed(number)

    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *key_hashes(F.col(doc_id)),
        F.col(doc_id).alias("_id"),
        F.xxhash64(F.col(text)).alias("_turn"),
    )
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "_id", "_turn").sortWithinPartitions("_id", "_turn", "_text")
    ordered.select("_text", *KEY).mapInArrow(run, SHARDS).write.mode("overwrite").parquet(f"{folder}/shards")
    write_index(spark, folder)


def write_index(spark: SparkSession, folder: str) -> None:
    """Make the index from the shards' entries; the ids themselves are not read."""
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    stored = shards.agg(F.sum(F.size("entries").cast("long"))).first()[0] or 0
    buckets = max(1, -(-stored // BUCKET_KEYS))
    entries = shards.select("shard", F.explode("entries").alias("e")).select(
        F.pmod("e.h1", F.lit(buckets)).alias("bucket"),
        F.lit(buckets).cast("long").alias("buckets"),
        F.col("e.h1").alias("_h1"),
        F.col("e.h2").alias("_h2"),
        "shard",
        F.col("e.row").alias("row"),
        F.col("e.rows").alias("rows"),
    )
    entries.groupBy("bucket").applyInArrow(_bucket_index, INDEX).write.mode("overwrite").parquet(f"{folder}/index")


INDEX = "bucket long, buckets long, hash binary, fingerprints binary, firsts binary, shards binary, rows binary, counts binary"


def _bucket_index(entries: pa.Table) -> pa.Table:
    h1, h2 = _unsigned(entries["_h1"]), _unsigned(entries["_h2"])
    shard, row = entries["shard"].to_numpy(), entries["row"].to_numpy()
    order = np.lexsort((row, shard, h2, h1))
    h1, h2 = h1[order], h2[order]
    # A key whose rows go over several shards has several places.
    first = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    function = PerfectHash.build(h1[first], h2[first])
    slot = function.slots(h1[first], h2[first])
    fingerprints = np.zeros(len(first), "<u4")
    fingerprints[slot] = _fingerprints(h2[first])
    # Places in the order of the slots.
    number = np.empty(len(first), np.int64)
    number[slot] = np.diff(np.append(first, len(h1)))
    firsts = np.append(0, np.cumsum(number)).astype("<i8")
    by_slot = np.argsort(np.repeat(slot, np.diff(np.append(first, len(h1)))), kind="stable")
    places = order[by_slot]
    data = [
        function.to_bytes(),
        fingerprints.tobytes(),
        firsts.tobytes(),
        shard[places].astype("<i8").tobytes(),
        row[places].astype("<i4").tobytes(),
        entries["rows"].to_numpy()[places].astype("<i4").tobytes(),
    ]
    names = ["hash", "fingerprints", "firsts", "shards", "rows", "counts"]
    head = {c: entries[c].slice(0, 1) for c in ("bucket", "buckets")}
    return pa.table(head | {n: pa.array([d], pa.binary()) for n, d in zip(names, data, strict=True)})


# ---------------------------------------------------------------- reading


def locate(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Where the ids of each distinct key lie: ``doc_id, shard, row, rows``.

    Keys that were not stored give no row: their slots hold other fingerprints (but for one in
    four billion).
    """
    spark = keys.sparkSession
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    head = index.select("buckets").first()
    buckets = head["buckets"] if head else 1
    asked = keys.select(F.col(key).alias("doc_id")).distinct()
    asked = asked.select("doc_id", *key_hashes(F.col("doc_id"))).withColumn("bucket", F.pmod("_h1", F.lit(buckets).cast("long")))
    id_type = pa_type(asked.schema["doc_id"])

    def run(wanted: pa.Table, bucket: pa.Table) -> pa.Table:
        if not wanted.num_rows or not bucket.num_rows:
            empty = {"doc_id": pa.array([], id_type), "shard": pa.array([], pa.int64())}
            return pa.table(empty | {c: pa.array([], pa.int32()) for c in ("row", "rows")})
        h1, h2 = _unsigned(wanted["_h1"]), _unsigned(wanted["_h2"])
        stored = {c: bucket[c][0].as_py() for c in bucket.column_names if c not in ("bucket", "buckets")}
        slot = PerfectHash.from_bytes(stored["hash"]).slots(h1, h2)
        known = np.flatnonzero(slot >= 0)
        fingerprints = np.frombuffer(stored["fingerprints"], "<u4")
        known = known[fingerprints[slot[known]] == _fingerprints(h2[known])]
        firsts = np.frombuffer(stored["firsts"], "<i8")
        first, last = firsts[slot[known]], firsts[slot[known] + 1]
        n = last - first
        place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return pa.table(
            {
                "doc_id": wanted["doc_id"].take(pa.array(np.repeat(known, n))),
                "shard": np.frombuffer(stored["shards"], "<i8")[place],
                "row": np.frombuffer(stored["rows"], "<i4")[place],
                "rows": np.frombuffer(stored["counts"], "<i4")[place],
            }
        )

    kind = asked.schema["doc_id"].dataType.simpleString()
    return (
        asked.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInArrow(run, f"doc_id {kind}, shard long, row int, rows int")
    )


def pa_type(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def read_ids(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """The stored ids of each distinct key: ``doc_id, shard, offset, ids``, a row per document.

    ``ids`` are raw unsigned 32-bit little-endian, ``offset`` counts ids from the shard's begin.
    Each shard is read once and meets the places that lie in it; a shard is bounded, so is a task.
    """
    spark = keys.sparkSession
    places = locate(keys, folder, key)
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards").select("shard", "width", "ids", "offsets")
    id_type = pa_type(places.schema["doc_id"])

    def run(wanted: pa.Table, shard: pa.Table) -> pa.Table:
        if not wanted.num_rows or not shard.num_rows:
            empty = {"doc_id": pa.array([], id_type)} | {c: pa.array([], pa.int64()) for c in ("shard", "offset")}
            return pa.table(empty | {"ids": pa.array([], pa.binary())})
        payload = shard["ids"].combine_chunks().chunk(0) if shard["ids"].num_chunks > 1 else shard["ids"].chunk(0)
        data = memoryview(payload[0].as_buffer())
        ends = np.frombuffer(shard["offsets"][0].as_py(), "<i8")
        row, rows = wanted["row"].to_numpy(), wanted["rows"].to_numpy().astype(np.int64)
        each = np.repeat(row - (np.cumsum(rows) - rows), rows) + np.arange(rows.sum())
        stored = np.frombuffer(data, f"<u{shard['width'][0].as_py()}")
        ids = [stored[ends[i] : ends[i + 1]].astype("<u4").tobytes() for i in each.tolist()]
        return pa.table(
            {
                "doc_id": wanted["doc_id"].take(pa.array(np.repeat(np.arange(len(row)), rows))),
                "shard": pa.array(np.full(len(each), shard["shard"][0].as_py()), pa.int64()),
                "offset": pa.array(ends[each], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    kind = places.schema["doc_id"].dataType.simpleString()
    return (
        places.groupBy("shard")
        .cogroup(shards.groupBy("shard"))
        .applyInArrow(run, f"doc_id {kind}, shard long, offset long, ids binary")
    )


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, start``: ids before each shard.

    Sums run inside each part of the shards; what meets in one task is a row per part.
    """
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards").select("shard", "n_ids")
    shards = shards.withColumn("_part", F.shiftright("shard", PART_BITS))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("_part").orderBy("shard")), F.lit(0))
    parts = shards.groupBy("_part").agg(F.sum("n_ids").alias("_all"))
    earlier = F.coalesce(F.sum("_all").over(before.orderBy("_part")), F.lit(0))
    return (
        shards.withColumn("_inside", inside)
        .join(parts.select("_part", earlier.alias("_earlier")), "_part")
        .select("shard", (F.col("_earlier") + F.col("_inside")).alias("start"))
    )
