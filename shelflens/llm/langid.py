"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies are counted over all training rows. The weights are fitted by
follow-the-regularised-leader with L1 and L2 penalties, on a bounded sample with equally many
rows of each language, and a temperature, fitted on a part of the sample kept away from the
weights, makes the probabilities honest. N-grams are hashed into a fixed number of buckets, so
that model and counts have a size that does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelflens.llm.common import hash_order, held_out, learnable, smallest_hashes

BUCKET_BITS = 15
LENGTHS = (1, 2, 3, 4)
#: Rows that the weights are fitted on: of each language, and in all.
ROWS_PER_LANGUAGE = 500
ROWS = 20_000
UNKNOWN = "und"
#: Code points that are hashed in one step.
STEP = 1 << 20
LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character n-grams, rising, and how often each occurs."""
    lower = text.lower()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    overlap = max(LENGTHS) - 1
    for at in range(0, len(lower), STEP):
        points = np.frombuffer(lower[at : at + STEP + overlap].encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.uint64)
        own = min(STEP, len(lower) - at)
        rolled = np.zeros(len(points), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            rolled = rolled[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :]
            if n in LENGTHS:
                mixed = (rolled[:own] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                counts += np.bincount((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(counts))
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighed(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length one."""
    values = (1.0 + np.log(counts)) * idf[found]
    return values / max(np.sqrt(values @ values), 1e-12)


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighed(found, counts, self.idf) @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.labels or not LETTER.search(text):
            return UNKNOWN, 0.0
        chances = softmax(self.logits(*gram_counts(text)) / self.temperature)
        best = int(chances.argmax())
        return self.labels[best], float(min(chances[best], 1.0))


def softmax(logits: np.ndarray) -> np.ndarray:
    top = np.exp(logits - logits.max(-1, keepdims=True))
    return top / top.sum(-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 4,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over rows (places, values, class); the bias is a last, unpenalised feature."""
    z, n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
    first, second = np.full(features + 1, l1), np.full(features + 1, l2)
    first[-1] = second[-1] = 0.0

    def weights(at) -> np.ndarray:
        a, b, own = z[at], n[at], first[at][:, None]
        shrunk = np.sign(a) * own - a
        return np.where(np.abs(a) <= own, 0.0, shrunk / ((beta + np.sqrt(b)) / alpha + second[at][:, None]))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            places, values, label = rows[i]
            at, x = np.append(places, features), np.append(values, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1.0
            gradient = x[:, None] * error
            squares = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / alpha * w
            n[at] += squares
    fitted = weights(np.arange(features + 1))
    return fitted[:-1], fitted[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden sections on its logarithm."""

    def loss(t: float) -> float:
        chances = softmax(logits / np.exp(t))
        return -np.log(np.maximum(chances[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, cut = -5.0, 3.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each bucket occurs, and how many texts there are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One place more than buckets: the number of texts.
        seen = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found, _ = gram_counts(text.as_py())
                seen[found] += 1
                seen[-1] += 1
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(seen[there])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << BUCKET_BITS) + 1)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = ROWS_PER_LANGUAGE, most: int = ROWS,
) -> Model:
    """Learn from all given rows with an id, a text and a language.

    The weights see at most ``per_language`` rows of a language and ``most`` in all, those
    with the smallest hashes of their ids; document frequencies see every row.
    """
    rows = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), hash_order(doc_id, "langid").alias("_order")
    )
    chosen = smallest_hashes(rows.select("lang", "_order"), "lang", "_order", per_language, most)
    ends = chosen.groupBy("lang").agg(F.max("_order").alias("_end")).orderBy("lang").limit(most).collect()
    labels = [r["lang"] for r in ends]
    if not labels:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0)
    df, total = document_frequencies(rows.select("text"))
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in enumerate(batch.column(2)):
                found, counts = gram_counts(value.as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, 1) for c in (0, 1)],
                        pa.array([found.astype("<i4").tobytes()]),
                        pa.array([counts.astype("<i4").tobytes()]),
                    ],
                    ["lang", "_order", "found", "counts"],
                )

    sample = (
        rows.join(F.broadcast(docs.sparkSession.createDataFrame(ends)), "lang")
        .filter("_order <= _end")
        .select("lang", "_order", "text")
        .mapInArrow(grams, "lang string, _order string, found binary, counts binary")
        .orderBy("_order", "lang", "found")
        .limit(most)
        .collect()
    )
    number = {name: i for i, name in enumerate(labels)}
    train, rest = [], []
    for i, r in enumerate(sample):
        found, counts = np.frombuffer(r["found"], "<i4"), np.frombuffer(r["counts"], "<i4")
        (rest if i % 5 == 4 else train).append((found, weighed(found, counts, idf), number[r["lang"]]))
    weights, bias = follow_the_leader(train, len(idf), len(labels))
    held = rest or train
    logits = np.array([v @ weights[f] + bias for f, v, _ in held])
    temperature = best_temperature(logits, np.array([y for *_, y in held]))
    return Model(labels, idf, weights, bias, temperature)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            found = [judge.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Learns from the rows that are not held out and judges all. A text that is null, empty or
    without a letter is ``und`` with score 0, and so is every text when there is nothing to
    learn from. Rows that repeat are judged alike; other columns are ignored; an empty table
    gives no rows. The judging has no shuffle; what is counted for it has a fixed size.
    """
    return predict(docs, fit(docs.filter(learnable(doc_id)), doc_id, text, lang), doc_id, text)
