"""Token counts by heap-and-linked-list merging of byte pairs.

The symbols of a word form a linked list; a heap holds the adjacent pairs that the merge list
knows. The pair of lowest rank (leftmost of equals) is popped and merged, its new neighbours
are pushed, pairs that have changed meanwhile are skipped when they come up. A word's count
is its bytes less its merges; no ids are made into a result. O(n log n) for a word of n bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelflens.llm.bpe import Vocabulary, shared_file, vocabulary

#: Words whose counts a worker remembers; it starts anew beyond that.
REMEMBERED = 400_000
PLACES = 40


def tokens_left(ids: list[int], vocab: Vocabulary) -> int:
    """Symbols that are left of ``ids`` after all merges. Changes ``ids``."""
    rank, made, size = vocab.rank, vocab.made, vocab.size
    n = left = len(ids)
    find = rank.get
    heap = [r << PLACES | i for i in range(n - 1) if (r := find(ids[i] * size + ids[i + 1])) is not None]
    if not heap:
        return n
    heapify(heap)
    after, before, place = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << PLACES) - 1
    while heap:
        top = heappop(heap)
        i, r = top & place, top >> PLACES
        j = after[i]
        if ids[i] < 0 or j == n or find(ids[i] * size + ids[j]) != r:
            continue
        ids[i], ids[j] = made[r], -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := find(ids[i] * size + ids[k])) is not None:
                heappush(heap, r << PLACES | i)
        h = before[i]
        if h >= 0 and (r := find(ids[h] * size + ids[i])) is not None:
            heappush(heap, r << PLACES | h)
    return left


class Counts(dict):
    """Counts by word, computed when first asked for."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        count = tokens_left(self.vocab.ids(word), self.vocab)
        if len(word) < 100:
            self[word] = count
        return count

    def of(self, text: str) -> int:
        words = self.vocab.words.findall
        return sum(1 if special else sum(map(self.__getitem__, words(part))) for part, special in self.vocab.parts(text))


_counts: dict[bytes, Counts] = {}


def counts_for(content: bytes) -> Counts:
    """One memory of words per worker process and vocabulary, kept between tasks."""
    if content not in _counts:
        _counts.clear()
        _counts[content] = Counts(vocabulary(content))
    return _counts[content]


def counter(file: Broadcast):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_for(file.value)
        for batch in batches:
            found = []
            for text in batch.column(2):
                found.append(counts.of(text.as_py() or ""))
                if len(counts) > REMEMBERED:
                    counts.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return count


def count_tokens(
    docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the tokenizers library for the file, without added special tokens;
    special strings inside a text are one token each, as by its default. A null text counts
    as empty: 0 bytes, 0 tokens. Rows that repeat are counted each; other columns are
    ignored; an empty table gives no rows. No shuffle.
    """
    file = shared_file(docs.sparkSession, vocabulary_path)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    schema = StructType(
        [rows.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    )
    return rows.mapInArrow(counter(file), schema).withColumn("over_limit", F.col("n_tokens") > limit)
