"""What each filter of a chain removes, in every order of the filters, from one pass over the rows.

A document fails some of five filters. Its *survival word* has a bit for each of the 32 subsets
of the filters: set where the document passes all filters of the subset, so the word is a row of
a truth table. Summed over documents, bit ``S`` says how many survive the subset ``S``. The sums
are positional popcounts: carry-save adders work on all 32 bits at once and halve the words that
are left with each carry. The chain's counts in any order are differences of subset counts, so
120 orders cost no further pass.

Only narrow rows are shuffled: a digest, an id and four bits stand for a text. Of the rows with
one text, the copies are told by joining on digest *and* id with the digest's least id, so no
task sees a whole group of copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shelflens.operators.keep import keep

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
WORD = "[^\\x20\\x09-\\x0D]+"
#: Parts whose counts a task holds before it hands them on.
HELD_PARTS = 4096
#: ``SURVIVAL[m]`` has bit S set where no filter of S is among the failed ones ``m``.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & m) for m in range(SUBSETS)], np.uint32)
CLASSES = ("all", "good", "toxic")


def text_failures(text: Column) -> Column:
    """The bits of the filters A to D that ``text`` fails, as an int.

    A: under 200 words. B: fewer distinct words than half the words. C: more than 2 % capital
    letters A-Z. D: holds one of ``#$%&*|``.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [
        F.size(words) < 200,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 2,
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, part, mask`` of every document; ``mask`` has a bit for each filter it fails.

    Filter E, the fifth bit, fails where a smaller id has the identical text. Rows that repeat
    an id with its text do not make each other fail; a row without an id neither fails E nor
    makes others fail. Texts are identical when their SHA-256 and length are.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = keep(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.col(source), F.lit("")).alias("part"),
            text_failures(whole).alias("_fails"),
            F.unhex(F.sha2(whole, 256)).alias("_sha"),
            F.octet_length(whole).alias("_bytes"),
            # Rows without an id match nothing; a number spreads them over the join's tasks.
            F.when(F.col(doc_id).isNull(), F.monotonically_increasing_id()).otherwise(-1).alias("_spread"),
        )
    )
    first = (
        narrow.filter("doc_id IS NOT NULL")
        .groupBy("_sha", "_bytes")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumns({"_spread": F.lit(-1).cast("long"), "_first": F.lit(True)})
    )
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return narrow.join(first, ["doc_id", "_sha", "_bytes", "_spread"], "left").select(
        "doc_id", "part", "_spread", (F.col("_fails") + F.when(copy, 16).otherwise(0)).cast("int").alias("mask")
    )


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set.

    Three words of a weight become one of the same weight and one carry of the next, bit by
    bit, until few are left to be counted singly.
    """
    counts, weight = np.zeros(32, np.int64), 1
    bits = np.arange(32, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) > 8:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n :]])
        counts += weight * ((words[:, None] >> bits) & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries) if carries else words[:0], weight * 2
    return counts


def subset_survivors(marked: DataFrame) -> DataFrame:
    """Per part the arrays ``all, good, toxic``: at place S + 1, how many survive subset S.

    ``marked`` has ``part, mask, good, toxic``. Tasks hand on sums, one row for each of their
    parts, so a part with many documents costs no task more than one row from each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy()
            words = SURVIVAL[batch.column(1).to_numpy()]
            classes = [None, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))]
            order = np.argsort(code, kind="stable")
            edges = np.searchsorted(code[order], np.arange(len(parts.dictionary) + 1))
            for i, name in enumerate(parts.dictionary.to_pylist()):
                rows = order[edges[i] : edges[i + 1]]
                sums = held.setdefault(name, np.zeros((len(CLASSES), SUBSETS), np.int64))
                for k, there in enumerate(classes):
                    sums[k] += positional_popcount(words[rows if there is None else rows[there[rows]]])
            if len(held) > HELD_PARTS:
                yield handed_on(held)
                held = {}
        if held:
            yield handed_on(held)

    def handed_on(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array([s[k].tolist() for s in held.values()], pa.list_(pa.int64())) for k in range(len(CLASSES))]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *columns], ["part", *CLASSES])

    counts = [StructField(c, ArrayType(LongType())) for c in CLASSES]
    partial = marked.select("part", "mask", "good", "toxic").mapInArrow(
        run, StructType([StructField("part", StringType()), *counts])
    )
    sums = {f"_{c}{s}": F.sum(F.col(c)[s]) for c in CLASSES for s in range(SUBSETS)}
    whole = partial.groupBy("part").agg(*[c.alias(n) for n, c in sums.items()])
    return whole.select("part", *[F.array(*[F.col(f"_{c}{s}") for s in range(SUBSETS)]).alias(c) for c in CLASSES])


def audit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    label_id: str = "doc_id",
) -> DataFrame:
    """One row per part, filter order and step: ``part, filter_order, step`` and seven counts.

    ``kept`` documents after the step, ``removed`` by it, ``redundant`` (failing its filter but
    removed before), ``unique_fails`` (failing no other filter), ``good_lost`` and
    ``toxic_lost`` (removed by it, with a label quality = 1 or toxic = 1) and ``shapley`` (what
    its filter removes, summed over all orders). Parts are the source values; null and the empty
    string are one part. A null text counts as empty; several labels of an id count as one with
    any of their marks; a document without label is neither good nor toxic. Rows that repeat
    count each. Other columns are ignored; an empty table gives no rows.
    """
    # An id's labels are one row, so the join leaves each document one row.
    marks = (
        labels.filter(F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("doc_id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"),
        )
        .withColumn("_spread", F.lit(-1).cast("long"))
    )
    marked = failures(docs, doc_id, text, source).join(marks, ["doc_id", "_spread"], "left")
    survivors = subset_survivors(
        marked.select(
            "part",
            "mask",
            F.coalesce("_good", F.lit(False)).alias("good"),
            F.coalesce("_toxic", F.lit(False)).alias("toxic"),
        )
    )
    return chains(survivors)


def chains(survivors: DataFrame) -> DataFrame:
    """The counts of every order and step from the subset counts of ``subset_survivors``."""
    n = len(FILTERS)
    full = SUBSETS - 1
    orders, before, after, own = [], [], [], []
    for order in permutations(range(n)):
        orders.append("".join(FILTERS[f] for f in order))
        for step, f in enumerate(order):
            before.append(sum(1 << g for g in order[:step]))
            after.append(before[-1] | 1 << f)
            own.append(f)

    def at(name: str, subset: Column | int) -> Column:
        return F.get(F.col(name), subset if isinstance(subset, Column) else F.lit(subset))

    def lost_over_all(f: int) -> Column:
        subsets = [s for s in range(SUBSETS) if not s >> f & 1]
        ways = [factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) for s in subsets]
        return sum((F.lit(w) * (at("all", s) - at("all", s | 1 << f)) for s, w in zip(subsets, ways, strict=True)), F.lit(0))

    per_filter = {
        "_failing": F.array(*[at("all", 0) - at("all", 1 << f) for f in range(n)]),
        "_alone": F.array(*[at("all", full ^ 1 << f) - at("all", full) for f in range(n)]),
        "_shapley": F.array(*[lost_over_all(f) for f in range(n)]),
    }

    def fixed(values: list, place: Column) -> Column:
        return F.get(F.array(*map(F.lit, values)), place)

    steps = (
        survivors.withColumns(per_filter)
        .withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1))))
        .withColumns(
            {
                "_before": fixed(before, F.col("_at")),
                "_after": fixed(after, F.col("_at")),
                "_own": fixed(own, F.col("_at")),
                "filter_order": fixed(orders, F.floor(F.col("_at") / n).cast("int")),
                "step": (F.col("_at") % n + 1).cast("int"),
            }
        )
    )
    lost = {c: at(c, F.col("_before")) - at(c, F.col("_after")) for c in CLASSES}
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("all", F.col("_after")).alias("kept"),
        lost["all"].alias("removed"),
        (F.get("_failing", F.col("_own")) - lost["all"]).alias("redundant"),
        F.get("_alone", F.col("_own")).alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        F.get("_shapley", F.col("_own")).alias("shapley"),
    )
