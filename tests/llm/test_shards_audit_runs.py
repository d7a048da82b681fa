"""Token shards, the filter audit and periodic runs, against the library, SQL and brute force."""

import hashlib
import itertools
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import connect, rows_of
from shelflens.llm import filter_audit, periodic_runs, token_shards
from shelflens.llm.oracles import ORACLES
from shelflens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"
LONG = "one two three four five six seven " * 60_000  # over 2 MB
TEXTS = [
    (4, LONG, "a"), (1, "plain text", "a"), (2, None, None), (3, "", "b"), (5, LONG, "b"), (6, " \n\t ", "a"),
    (7, "x" * 5000 + " 'll <|endoftext|> é中" + " " * 3000 + "end", ""), (7, "again", "c"), (7, "again", "c"),
    (None, "no id", "a"), (None, "no id", None), (10, "no id", "a"), (11, "no id", "a"), (12, "A B C d $", "a"),
    (13, "a b " * 120, "a"),
]
LABELS = [(1, 1, 0), (7, 0, 1), (7, 1, None), (11, 1, 1), (13, None, None), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    """Columns named like those that operators use inside are there as well."""
    plain = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    names = "_id _turn _text _h1 part mask _sha _fails _spread shard ids good toxic runs collapsed w a p g"
    return plain.withColumns({c: F.lit("clash") for c in names.split()}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("clash"))


# ---------------------------------------------------------------- shards


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=600), st.integers(0, 2**32))
def test_perfect_hash(keys, salt):
    h1 = np.array(sorted(keys), np.uint64)
    h2 = h1 * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    function = token_shards.PerfectHash.build(h1, h2)
    again = token_shards.PerfectHash.from_bytes(function.to_bytes())
    for f in (function, again):
        assert sorted(f.slots(h1, h2).tolist()) == list(range(len(keys)))


def test_keys_that_share_both_hashes_are_refused():
    same = np.array([5, 5], np.uint64)
    with pytest.raises(ValueError, match="share"):
        token_shards.PerfectHash.build(same, same)


PIECES = st.sampled_from(["a", "'", "s", " ", "\n", "1", "é", "中", "!", "<|endoftext|>", " the", "=" * 900, "b" * 2500, " " * 2100])


@settings(max_examples=40, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_encoder_equals_the_library(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert token_shards.encoder_for(open(PATH, "rb").read())(text).tolist() == want


@pytest.mark.parametrize("shard_ids", [3, token_shards.SHARD_IDS])
def test_shards_are_read_by_key(spark, docs, tmp_path, shard_ids):
    tok = Tokenizer.from_file(PATH)
    folder = str(tmp_path)
    token_shards.write_shards(docs, PATH, folder, shard_ids=shard_ids)
    keys = spark.createDataFrame([(i,) for i in (4, 7, None, 2, 12345, -1, 7)], "doc_id long")
    got = token_shards.read_ids(keys, folder).collect()
    want = defaultdict(list)
    for i, t, _ in TEXTS:
        want[i].append([*tok.encode(t or "", add_special_tokens=False).ids, 0])
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append(np.frombuffer(r.ids, "<u4").tolist())
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(want[k]) for k in (4, 7, None, 2)}
    # Shard after shard and row after row the ids make up the corpus in order.
    starts = {r.shard: r.start for r in token_shards.shard_starts(spark, folder).collect()}
    every = token_shards.read_ids(docs, folder).collect()
    assert len(every) == len(TEXTS)
    at = 0
    for r in sorted(every, key=lambda r: (starts[r.shard], r.offset)):
        assert starts[r.shard] + r.offset == at
        at += len(r.ids) // 4
    ids = [r.doc_id for r in sorted(every, key=lambda r: (starts[r.shard], r.offset))]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    if shard_ids == 3:
        assert len(starts) > 10  # the rows of id 7 and of null lie in several shards


def test_other_kinds_of_keys_and_nothing(spark, tmp_path):
    names = spark.createDataFrame([("b", "two"), ("", "none"), (None, "null"), ("a", "one")], "name string, text string")
    token_shards.write_shards(names, PATH, str(tmp_path / "names"), doc_id="name")
    got = token_shards.read_ids(names, str(tmp_path / "names"), "name").collect()
    assert sorted((r.doc_id or "-", r.doc_id is None) for r in got) == [("-", False), ("-", True), ("a", False), ("b", False)]
    token_shards.write_shards(names.limit(0), PATH, str(tmp_path / "none"), doc_id="name")
    assert token_shards.read_ids(names, str(tmp_path / "none"), "name").count() == 0
    assert token_shards.shard_starts(spark, str(tmp_path / "none")).count() == 0


def test_the_index_reads_no_ids(spark, docs, tmp_path):
    token_shards.write_shards(docs, PATH, str(tmp_path))
    plan = token_shards.locate(docs, str(tmp_path))._jdf.queryExecution().toString()
    assert "shards" in plan and "ids:binary" not in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_no_ids_pass_through_the_join_of_op11(spark):
    plan = QUERIES["op11_token_shards"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    # The checksum, for which ids are needed, is taken on a side of the join, so below it.
    assert plan.index("Join") < plan.index("crc32(")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_op11(spark):
    tok = Tokenizer.from_file(PATH)
    want, start = [], 0
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY 1").fetchall():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op11_token_shards"](spark, SF_DIR).collect())) == want


# ---------------------------------------------------------------- audit


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_positional_popcount(words):
    got = filter_audit.positional_popcount(np.array(words, np.uint32))
    assert got.tolist() == [sum(w >> b & 1 for w in words) for b in range(32)]


def failed(i, text):
    """The filters that a text fails, by the plain reading of the contract."""
    text = text or ""
    words = text.encode().split()
    copies = any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in TEXTS)
    fails = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": copies,
    }
    return {f for f, bad in fails.items() if bad}


def test_audit_equals_brute_force(docs, labels):
    parts = defaultdict(list)
    for i, text, source in TEXTS:
        marks = [(q, t) for j, q, t in LABELS if j is not None and j == i]
        parts[source or ""].append((failed(i, text), any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    want, shapley = {}, Counter()
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                here = [r for r in rows if not r[0] & set(order[:k])]
                gone = [r for r in here if f in r[0]]
                shapley[part, f] += len(gone)
                want[part, "".join(order), k + 1] = [
                    len(here) - len(gone), len(gone), sum(f in r[0] for r in rows) - len(gone),
                    sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == 120 * 5 * len(parts) == len(want)
    for r in got:
        key = (r.part, r.filter_order, r.step)
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost] == want[key], key
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


def test_audit_of_nothing(docs, labels):
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_with_many_parts(spark, labels):
    many = spark.range(9000, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.lit("few words").alias("text"), (F.col("id") % 5000).cast("string").alias("source")
    )
    got = filter_audit.audit(many, labels).filter("filter_order = 'ABCDE' AND step = 1")
    assert got.count() == 5000 and got.agg(F.sum("removed")).first()[0] == 9000


def test_no_text_is_shuffled_for_the_audit(docs):
    plan = filter_audit.failures(docs)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("Scan")[0] and "hashpartitioning(_sha" in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_op12(spark):
    got = QUERIES["op12_filter_audit"](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES["op12_filter_audit"])
    assert rows_of(got.columns, got.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


# ---------------------------------------------------------------- runs


def all_runs(words, least=12):
    """(start, length, period) of all runs, from the stretches of words equal to those a period on."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        t = 0
        while t + p < n:
            s = t
            while t + p < n and words[t] == words[t + p]:
                t += 1
            if t > s and t - s + p >= max(least, 2 * p):
                found.setdefault((s, t - s + p), p)
            t += t == s
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def tiled(part, times, tail):
    return part * times + tail


WORDS = st.lists(st.integers(0, 2), max_size=40)
DOCUMENT = st.builds(tiled, WORDS, st.integers(0, 6), WORDS)


@settings(max_examples=150, deadline=None)
@given(st.lists(DOCUMENT, min_size=1, max_size=5), st.sampled_from([1, 12]), st.sampled_from([10, 1 << 20]))
def test_runs_equal_brute_force(documents, least, points):
    sizes = np.array([len(d) for d in documents], np.int64)
    ids = np.array([w for d in documents for w in d], np.int32)
    usual, periodic_runs.POINTS = periodic_runs.POINTS, points
    try:
        runs = periodic_runs.runs_of(ids, sizes, least)
    finally:
        periodic_runs.POINTS = usual
    for i, words in enumerate(documents):
        own = runs.document == i
        got = list(zip(runs.start[own].tolist(), runs.length[own].tolist(), runs.period[own].tolist()))
        assert got == all_runs(words, least)


def test_the_cover_meets_every_difference():
    for a, b in itertools.product(range(periodic_runs.MODULUS), repeat=2):
        steps = [t for t in range(31) if (a + t) % 31 in periodic_runs.COVER and (b + t) % 31 in periodic_runs.COVER]
        assert periodic_runs.SHIFTS[a, b] == min(steps)


def test_long_extensions():
    """Two copies of a long passage: the common extension goes over many levels of the sampled order."""
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 50, 40_000)
    words = np.concatenate([passage, passage, rng.integers(0, 50, 100)]).astype(np.int32)
    runs = periodic_runs.runs_of(words, np.array([len(words)]))
    longest = int(np.argmax(runs.length))
    assert runs.period[longest] == 40_000 and runs.length[longest] >= 80_000


def test_find_runs(docs):
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in periodic_runs.find_runs(docs).collect()}
    for i, text, _ in TEXTS:
        if text == LONG:
            assert got[i, "one two three four five six seven"] == [(0, 420_000, 7)]
        elif i == 13:
            assert got[i, "a b"] == [(0, 240, 2)]
        else:
            assert got[i, " ".join(w.decode() for w in (text or "").encode().split())] == []
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_op13(spark):
    def sha(parts):
        return hashlib.sha256(b"".join(parts)).hexdigest()

    want = []
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY 1").fetchall():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        if n > 4000:
            continue
        runs = all_runs(words)
        inside = {k for s, length, p in runs for k in range(s + p, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append(
            (
                i, len(runs), *([*best, best[1] * 1000 // best[2]] if best else [None] * 4),
                sha(b"%d,%d,%d\n" % r for r in runs),
                sha([b" ".join(w for k, w in enumerate(words) if k not in inside)]),
            )
        )
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    assert len(want) > 150 and [got[w[0]] for w in want] == want
