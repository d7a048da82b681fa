"""Toxicity by a linear-chain conditional random field over words.

Labels mark documents, so words are labelled first: a word that occurs in many more toxic
than clean documents of the training sample counts as toxic inside toxic documents. The field
has two states, clean and toxic, a weight for each word that leans to toxic documents, a bias,
and weights for transitions. Forward-backward marginals say how likely each word is toxic;
stretches above one half are the offending offsets, and a logistic curve fitted on document
labels makes a score of the expected number of toxic words.

Words without a weight of their own all have the same potentials, so a stretch of them acts on
the chain as a power of one 2 x 2 matrix: the marginals are exact, and the work for a document
grows with its length only in the cutting of words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StructField, StructType,
)

from shelflens.llm.common import hash_order, held_out, learnable, smallest_hashes

#: Rows of each label that the field is fitted on at most, and bytes of a text among them: of a
#: longer one so many evenly spread stretches are learned from.
ROWS_PER_LABEL = 1500
TEXT_BYTES = 50_000
STRETCHES = 8
CUT = 0.3
#: Words of a training chain; long documents make several.
CHAIN = 64
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return list(map(str.lower, WORD.findall(text)))


@dataclass
class Field:
    """Weights of the state toxic against clean: by word, for any word, and for transitions.

    ``moves[a, b]`` is the weight of going from state a to b (0 clean, 1 toxic).
    """

    words: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    offset: float = -20.0

    def __post_init__(self) -> None:
        step = np.exp(self.moves) * np.array([1.0, np.exp(self.bias)])
        values, vectors = np.linalg.eig(step)
        top = int(np.argmax(values.real))
        inverse = np.linalg.inv(vectors)
        # The matrix's n-th power is proportional to one fixed part plus ratio**n of another.
        self.lasting = np.outer(vectors[:, top], inverse[top]).real
        self.fading = np.outer(vectors[:, 1 - top], inverse[1 - top]).real
        self.ratio = float((values[1 - top] / values[top]).real)

    def plain(self, n: int) -> np.ndarray:
        """Effect of ``n`` words without a weight of their own, up to a factor."""
        return self.lasting + self.ratio**n * self.fading

    def marginals(self, places: list[int], weights: list[float], n: int) -> list[float]:
        """How likely each of the words at ``places`` is toxic, in a text of ``n`` words."""
        go = np.exp(self.moves)
        forward, message, last = [], np.array([1.0, 1.0]), -1
        for place, weight in zip(places, weights, strict=True):
            if last < 0:
                # A chain starts in either state alike.
                message = np.array([1.0, np.exp(self.bias)]) @ self.plain(place - 1) if place else message
                message = message @ go if place else message
            else:
                message = message @ self.plain(place - last - 1) @ go
            message = message * np.array([1.0, np.exp(min(self.bias + weight, 500.0))])
            message = message / message.sum()
            forward.append(message)
            last = place
        back, found = self.plain(n - 1 - last) @ np.array([1.0, 1.0]) if places else None, []
        for i in range(len(places) - 1, -1, -1):
            both = forward[i] * back
            found.append(float(both[1] / both.sum()))
            if i:
                back = back * np.array([1.0, np.exp(min(self.bias + weights[i], 500.0))])
                back = self.plain(places[i] - places[i - 1] - 1) @ (go @ back)
                back = back / back.sum()
        return found[::-1]

    def tag(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and the stretches (start, end, likelihood) of toxic words in characters."""
        words = words_of(text)
        places = [i for i, w in enumerate(words) if w in self.words]
        if not places:
            return self.score(0.0), []
        chances = self.marginals(places, [self.words[words[i]] for i in places], len(words))
        spans = [m.span() for m in WORD.finditer(text)]
        stretches: list[tuple[int, int, float]] = []
        last = -2
        for place, chance in zip(places, chances, strict=True):
            if chance >= 0.5:
                start, end = spans[place]
                if place == last + 1:
                    start, _, before = stretches.pop()
                    chance = max(chance, before)
                stretches.append((start, end, chance))
                last = place
        return self.score(sum(chances)), stretches

    def score(self, expected: float) -> float:
        return float(1.0 / (1.0 + np.exp(-(self.slope * np.log1p(expected) + self.offset))))


def distinct_texts(rows: list[tuple[list[str], int]]) -> list[tuple[list[str], int]]:
    """Rows without near copies, which would make any of their words look telling.

    A row goes if at least 6 of 16 least hashes of its five-word shingles came before.
    """
    kept, seen = [], set()
    salts = np.random.default_rng(5).integers(1, 1 << 32, 16, np.uint64) | np.uint64(1)
    for words, label in rows:
        shingles = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        hashes = np.array([zlib.crc32(s.encode()) for s in shingles], np.uint64)
        marks = [(i, int(((hashes * salt) & np.uint64(0xFFFFFFFF)).min())) for i, salt in enumerate(salts)]
        if sum(m in seen for m in marks) < 6:
            kept.append((words, label))
        seen.update(marks)
    return kept


def telling_words(rows: list[tuple[list[str], int]]) -> tuple[set[str], set[str]]:
    """Words that lean to toxic documents, and those of them that count as toxic there."""
    seen, n = [Counter(), Counter()], [0, 0]
    for words, label in rows:
        seen[label].update(set(words))
        n[label] += 1
    leaning, toxic = set(), set()
    for word, often in seen[1].items():
        if often < 5 or not n[0]:
            continue
        p, q = often / n[1], seen[0][word] / n[0]
        whole = (often + seen[0][word]) / (n[0] + n[1])
        z = (p - q) / np.sqrt(max(whole * (1 - whole), 1e-9) * (1 / n[0] + 1 / n[1]))
        if z >= 3 and p >= 2 * q:
            leaning.add(word)
            if often >= 8 and p >= 8 * (q + 0.25 / n[0]):
                toxic.add(word)
    return leaning, toxic


def train_chains(rows: list[tuple[list[str], int]], steps: int = 80) -> Field:
    """Fit the field's weights by gradient ascent on the likelihood of the labelled words."""
    leaning, toxic = telling_words(rows)
    if not toxic:
        return Field()
    names = sorted(leaning)
    number = {w: i + 1 for i, w in enumerate(names)}
    # Equal chains, mostly those without any telling word, are worked on once.
    often = Counter()
    for words, label in rows:
        ids = [number.get(w, 0) for w in words]
        tags = [int(label and w in toxic) for w in words]
        for at in range(0, len(words), CHAIN):
            often[tuple(ids[at : at + CHAIN]), tuple(tags[at : at + CHAIN])] += 1
    chains = list(often)
    times = np.array([often[c] for c in chains], float)
    length = np.array([len(c) for c, _ in chains])
    ids = np.zeros((len(chains), CHAIN), np.int32)
    tags = np.zeros((len(chains), CHAIN), np.int8)
    for i, (c, t) in enumerate(chains):
        ids[i, : len(c)], tags[i, : len(t)] = c, t
    there = np.arange(CHAIN) < length[:, None]
    each = np.repeat(times[:, None], CHAIN, 1)
    goal_words = np.bincount(ids[there], weights=(tags * each)[there], minlength=len(names) + 1)
    ways, inner = tags[:, :-1] * 2 + tags[:, 1:], there[:, 1:]
    goal_moves = np.bincount(ways[inner], weights=each[:, 1:][inner], minlength=4).reshape(2, 2)
    weights, moves, bias = np.zeros(len(names) + 1), np.zeros((2, 2)), -4.0
    size = float(each[there].sum())
    speed = np.zeros(len(weights) + 5)
    columns, live = np.ascontiguousarray(ids.T), np.ascontiguousarray(there.T)
    for step in range(steps):
        # Messages are odds of toxic against clean, one number for each chain.
        (cc, ct), (tc, tt) = np.exp(moves)
        odds = np.exp(np.clip(weights + bias, -30, 30))[columns]
        forward = np.empty(odds.shape)
        message = np.ones(len(chains))
        for i in range(CHAIN):
            message = odds[i] * ((ct + message * tt) / (cc + message * tc) if i else message)
            forward[i] = message
        back = np.ones(len(chains))
        likely, got_moves = np.empty(odds.shape), np.zeros((2, 2))
        for i in range(CHAIN - 1, -1, -1):
            both = forward[i] * back
            likely[i] = both / (1 + both) * times * live[i]
            if i:
                after, before = odds[i] * back, forward[i - 1]
                ways = np.stack([np.full(len(chains), cc), ct * after, before * tc, before * tt * after])
                got_moves += (ways @ (times * live[i] / ways.sum(0))).reshape(2, 2)
                # Past the end of a chain the message stays flat.
                back = np.where(live[i], (tc + tt * after) / (cc + ct * after), 1.0)
        got_words = np.bincount(columns.ravel(), weights=likely.ravel(), minlength=len(weights))
        gradient = np.concatenate(
            [
                (goal_words - got_words) / size * 1000 - 0.01 * weights,
                [(goal_words.sum() - got_words.sum()) / size * 1000],
                ((goal_moves - got_moves) / size * 1000 - 0.01 * moves).ravel(),
            ]
        )
        gradient[0] = 0.0  # words without a weight have the bias alone
        speed = 0.9 * speed + 0.1 * gradient**2 if step else gradient**2
        change = 0.2 * gradient / (np.sqrt(speed) + 1e-6)
        weights = weights + change[: len(weights)]
        bias += change[len(weights)]
        moves = moves + change[len(weights) + 1 :].reshape(2, 2)
    return Field({w: float(weights[i]) for w, i in number.items()}, float(bias), moves)


def calibrated(found: Field, rows: list[tuple[list[str], int]]) -> Field:
    """Fit the logistic curve from expected toxic words to document labels, by Newton steps."""
    x, y, share = [], [], [0, 0]
    for words, label in rows:
        places = [i for i, w in enumerate(words) if w in found.words]
        chances = found.marginals(places, [found.words[words[i]] for i in places], len(words)) if places else []
        x.append(np.log1p(sum(chances)))
        y.append(label)
        share[label] += 1
    a = np.stack([np.array(x), np.ones(len(x))], 1)
    target = np.array(y, float)
    theta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ theta))
        hessian = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + 0.05 * np.eye(2)
        theta = theta + np.linalg.solve(hessian, a.T @ (target - p) - 0.05 * theta)
    return Field(found.words, found.bias, found.moves, float(theta[0]), float(theta[1]))


def learned_text(text: str, most_bytes: int) -> Column:
    """The text, or of one longer than ``most_bytes`` evenly spread stretches that are no longer together."""
    # A character has at most four bytes.
    long = most_bytes // 4 // STRETCHES
    starts = [F.floor(F.length(text) * i / STRETCHES).cast("int") + 1 for i in range(STRETCHES)]
    pieces = F.concat_ws("\n", *[F.substring(text, start, F.lit(long)) for start in starts])
    return F.when(F.octet_length(text) <= most_bytes, F.col(text)).otherwise(pieces)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label_id: str = "doc_id", toxic: str = "toxic", per_label: int = ROWS_PER_LABEL, most_bytes: int = TEXT_BYTES,
) -> Field:
    """Learn from the rows of ``docs`` that have a label 0 or 1.

    The sample: of each label the ``per_label`` rows with the smallest hashes of their ids; of
    texts over ``most_bytes`` evenly spread stretches. Ids with contradicting labels count as
    toxic. The share of toxic rows among all labelled ones corrects the scores for the sample's
    balance.
    """
    marks = (
        labels.filter(F.col(toxic).isin(0, 1))
        .groupBy(F.col(label_id).alias("_id"))
        .agg(F.max(toxic).cast("int").alias("_label"))
    )
    known = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("_id"), hash_order(doc_id, "toxicity").alias("_order")
    )
    known = known.join(marks, "_id")
    chosen = smallest_hashes(known, "_label", "_order", per_label).select("_id", "_label")
    rows = (
        docs.filter(F.col(text).isNotNull())
        .select(F.col(doc_id).alias("_id"), learned_text(text, most_bytes).alias("_text"))
        .join(F.broadcast(chosen.distinct()), "_id")
        .select("_label", "_text", hash_order("_id", "toxicity").alias("_order"))
        .orderBy("_order", "_text")
        .limit(2 * per_label)
        .collect()
    )
    sample = distinct_texts([(words_of(r["_text"]), r["_label"]) for r in rows])
    there = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({label for _, label in sample}) < 2:
        always = sample[0][1] if sample else 0
        return Field(offset=20.0 if always else -20.0)
    found = calibrated(train_chains(sample), sample)
    in_sample = Counter(label for _, label in sample)
    found.offset += np.log(there[1] / there[0]) - np.log(in_sample[1] / in_sample[0])
    return found


def score(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(1):
                s, found = judge.tag(value.as_py() or "")
                scores.append(s)
                spans.append([{"start": a, "end": b, "chance": c} for a, b, c in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                ["doc_id", "score", "spans"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stretch = StructType(
        [StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("chance", DoubleType())]
    )
    schema = StructType(
        [rows.schema["doc_id"], StructField("score", DoubleType()), StructField("spans", ArrayType(stretch))]
    )
    return rows.mapInArrow(run, schema).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "spans"
    )


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, spans``.

    Learns from labelled rows that are not held out, judges all. A null or empty text has no
    toxic words and gets the score of such texts. Without labels, or with clean ones only, all
    scores are near 0; with toxic labels only, near 1. Rows that repeat are judged alike;
    other columns are ignored; an empty table gives no rows. The judging has no shuffle.
    """
    return score(docs, fit(docs.filter(learnable(doc_id)), labels, doc_id, text), doc_id, text)


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """The documents whose score stays below ``cut``, with all their columns, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.filter(learnable(doc_id)), labels, doc_id, text))
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            yield batch.filter(pa.array([judge.tag(t.as_py() or "")[0] < cut for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
