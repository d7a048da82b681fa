import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.operators import sparse_topk as S
from shelflens.operators import topk as T
from shelflens.operators.embed import trigram_vectors, valid_trigrams
from shelflens.operators.vectors import check_vectors, rejected_vectors, require_vectors, valid_vectors


def frame(spark, vectors, row_id):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, f"{row_id} bigint, vector array<double>")
    return valid_vectors(df, "vector")


def brute(q, c, k, cut=None):
    q = q / np.linalg.norm(q, axis=1)[:, None]
    c = c / np.linalg.norm(c, axis=1)[:, None]
    s = np.floor(q @ c.T * 1e6 + 0.5) / 1e6
    out = []
    for i in range(len(q)):
        best = sorted(range(len(c)), key=lambda j: (-s[i, j], j))[:k]
        out += [(i, r + 1, j, s[i, j]) for r, j in enumerate(best) if cut is None or s[i, j] >= cut]
    return out


def got(df):
    return sorted((r["query_id"], r["rank"], r["catalog_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    # A third of the catalogue is copies of one vector.
    hot = np.repeat(centres[:1], 200, axis=0)
    rest = centres[rng.integers(0, 12, 400)] + 0.25 * rng.standard_normal((400, 16))
    queries = centres[rng.integers(0, 12, 60)] + 0.25 * rng.standard_normal((60, 16))
    return np.vstack([queries, centres[:1]]), np.vstack([hot, rest])


@pytest.mark.parametrize("k,cut", [(1, None), (3, None), (3, 0.8), (5, 0.95)])
def test_all_exact_searches_agree_with_brute_force(spark, clustered, k, cut):
    q, c = clustered
    want = brute(q, c, k, cut)
    qs, cs = frame(spark, q, "query_id"), frame(spark, c, "catalog_id")
    assert got(T.dense_topk(qs, cs, k, min_similarity=cut)) == want
    assert got(T.pivot_topk(qs, cs, k, min_similarity=cut, pivots=9, block_bytes=9000)) == want


def test_a_catalogue_over_the_size_limit_takes_the_pivots(spark, clustered):
    q, c = clustered
    qs, cs = frame(spark, q, "query_id"), frame(spark, c, "catalog_id")
    df = T.dense_topk(qs, cs, 3, broadcast_bytes=20000)
    assert "FlatMapCoGroups" in df._jdf.queryExecution().toString()
    assert got(df) == brute(q, c, 3)


def visits_of(spark, monkeypatch, q, c, **settings):
    """(query, block, areas) of all rounds of a search, and its result."""
    seen, real = [], T.block_pairs

    def spy(queries, *rest):
        seen.append(queries)
        return real(queries, *rest)

    monkeypatch.setattr(T, "block_pairs", spy)
    df = T.pivot_topk(frame(spark, q, "query_id"), frame(spark, c, "catalog_id"), 3, **settings)
    result = got(df)
    return [[(r.query_id, r.block, tuple(r.areas)) for r in s.collect()] for s in seen], result


def test_pivots_prune(spark, clustered, monkeypatch):
    q, c = clustered
    rounds, result = visits_of(spark, monkeypatch, q, c, pivots=24, block_bytes=3000)
    assert result == brute(q, c, 3) and len(rounds) == 3
    areas = sum(len(v[2]) for r in rounds for v in r)
    assert 0 < areas < len(q) * 24 * 32 / 20
    # A later round visits fewer blocks than there are: the k-th best has been tightened.
    blocks = {v[1] for r in rounds for v in r}
    assert sum(map(len, rounds)) < len(q) * len(blocks) / 2


def test_without_clusters_a_query_visits_a_block_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    q, c = rng.standard_normal((40, 24)), rng.standard_normal((900, 24))
    rounds, result = visits_of(spark, monkeypatch, q, c, pivots=16, block_bytes=12_000)
    assert result == brute(q, c, 3)
    every = [v[:2] for r in rounds for v in r]
    assert len(every) == len(set(every))
    assert 15 < len({b for _, b in every}) < 40
    assert len({v for v in rounds[1]}) <= 40 * T.NEXT * 2


def test_a_cell_larger_than_a_block_is_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(7)
    c = np.concatenate([np.ones((1, 8)) + 0.01 * rng.standard_normal((600, 8)), rng.standard_normal((30, 8))])
    q = np.ones((5, 8)) + 0.02 * rng.standard_normal((5, 8))
    rounds, result = visits_of(spark, monkeypatch, q, c, pivots=4, block_bytes=4000)
    assert result == brute(q, c, 3)
    assert len({v[1] for r in rounds for v in r}) > 10


def test_fewer_candidates_than_k(spark):
    q, c = np.eye(3)[:1], np.array([[1.0, 1.0, 0.0], [0.0, 0.0, 1.0]])
    for search in (T.dense_topk, T.pivot_topk):
        assert got(search(frame(spark, q, "query_id"), frame(spark, c, "catalog_id"), 3)) == [
            (0, 1, 0, 0.707107), (0, 2, 1, 0.0),
        ]


def test_empty_catalogue_and_empty_queries(spark):
    qs, cs = frame(spark, np.eye(2), "query_id"), frame(spark, np.eye(2), "catalog_id")
    for search in (T.dense_topk, T.pivot_topk, T.lsh_topk):
        assert search(qs, cs.limit(0), 3).count() == 0
        assert search(qs.limit(0), cs, 3).count() == 0
    with pytest.raises(ValueError):
        require_vectors(cs.limit(0))


def test_equal_scores_take_the_lower_id(spark):
    q, c = np.eye(2)[:1], np.ones((50, 2))
    for df in (
        T.dense_topk(frame(spark, q, "query_id"), frame(spark, c, "catalog_id"), 3),
        T.pivot_topk(frame(spark, q, "query_id"), frame(spark, c, "catalog_id"), 3, block_bytes=400),
    ):
        assert [r[2] for r in got(df)] == [0, 1, 2]


def test_lsh_recall(spark, clustered):
    q, c = clustered
    c = np.unique(c, axis=0)
    qs, cs = frame(spark, q, "query_id"), frame(spark, c, "catalog_id")
    exact = {(a, b) for a, _, b, _ in brute(q, c, 3)}
    found = {(a, b) for a, _, b, _ in got(T.lsh_topk(qs, cs, 3, tables=16, bits=6))}
    assert len(exact & found) / len(exact) >= 0.9


def test_lsh_scores_a_falling_share_of_all_pairs(spark, monkeypatch):
    """Buckets stay as they are while the catalogue grows; probes make up for the bits."""
    rng = np.random.default_rng(9)
    scored, real = [], T.block_pairs

    def spy(queries, catalog, keys, *rest):
        pairs = queries.groupBy(*keys).count().join(catalog.groupBy(*keys).agg(F.count("*").alias("n")), keys)
        scored.append(pairs.agg(F.sum(F.col("count") * F.col("n"))).first()[0])
        return real(queries, catalog, keys, *rest)

    monkeypatch.setattr(T, "block_pairs", spy)
    shares = []
    for n in (1000, 8000):
        centres = rng.standard_normal((n // 20, 24))
        c = np.repeat(centres, 20, axis=0) + 0.15 * rng.standard_normal((n, 24))
        q = centres[:50] + 0.15 * rng.standard_normal((50, 24))
        df = T.lsh_topk(frame(spark, q, "query_id"), frame(spark, c, "catalog_id"), 3, tables=4, probes=2)
        exact = {(a, b) for a, _, b, _ in brute(q, c, 3)}
        found = {(r.query_id, r.catalog_id) for r in df.collect()}
        assert len(exact & found) / len(exact) >= 0.9
        shares.append(scored[-1] / (50 * n))
    assert T.lsh_bits(1000) == 4 and T.lsh_bits(8000) == 7 and T.lsh_bits(0) == 1
    assert shares[0] < 1 and shares[1] < shares[0] / 3


def test_vector_validity(spark):
    nan = float("nan")
    rows = spark.createDataFrame(
        [(0, [3.0, 4.0]), (1, []), (2, None), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [None, 1.0]),
         (6, [1e-10, 0.0]), (7, [float("inf"), 1.0])],
        "id int, embedding array<double>",
    )
    state = {r.id: r.reject for r in check_vectors(rows).collect()}
    assert state == {
        0: None, 1: "empty", 2: "empty", 3: "zero norm", 4: "not a number", 5: "not a number",
        6: "zero norm", 7: "not a number",
    }
    assert [(r.id, r.norm) for r in valid_vectors(rows).collect()] == [(0, 5.0)]
    assert rejected_vectors(rows).count() == 7


def brute_grams(names_q, names_c, k, cut, block=lambda n: 0):
    def vec(n):
        t = n.lower()
        out = {}
        for g in [t[i : i + 3] for i in range(max(len(t) - 2, 1))]:
            out[g] = out.get(g, 0) + 1
        return out, np.sqrt(sum(x * x for x in out.values()))

    res = []
    vc = {n: vec(n) for n in names_c}
    for a in names_q:
        va, na = vec(a)
        scored = []
        for b, (vb, nb) in vc.items():
            if block(a) == block(b):
                s = np.floor(sum(x * vb.get(g, 0) for g, x in va.items()) / (na * nb) * 1e6 + 0.5) / 1e6
                if s >= cut:
                    scored.append((-s, b))
        res += [(a, r + 1, b, -s) for r, (s, b) in enumerate(sorted(scored)[:k])]
    return sorted(res)


def names(rng, n, hot=""):
    words = ["cream", "serum", "ครีม", "gel", "50ml", "100ml", "night", "day", "soap", "x", "spf"]
    return sorted({hot + " ".join(rng.choice(words, rng.integers(1, 5))) + str(rng.integers(0, 60)) for _ in range(n)})


def gram_side(spark, values, row_id, parts=3):
    rows = [(v, None if len(v) == 9 else len(v) % 3) for v in values]
    df = spark.createDataFrame(rows, f"{row_id} string, block int").repartition(parts)
    return valid_trigrams(df, row_id)


SIZES = pytest.mark.parametrize("limit", [0, S.BROADCAST_BYTES], ids=["narrow", "broadcast"])


@SIZES
@pytest.mark.parametrize("cut,blocked", [(0.8, False), (0.5, False), (0.8, True), (0.2, False), (1.0, False), (0.4, True)])
def test_sparse_search_agrees_with_brute_force(spark, cut, blocked, limit):
    rng = np.random.default_rng(11)
    # The hot prefix puts the same grams into every name.
    nq = names(rng, 120, "brand one ") + ["a", "ab", "repeat " * 30, "nine char"]
    nc = names(rng, 150, "BRAND ONE ") + ["ab", "A", "Repeat " * 29, "repeat", "nine chaR"]
    df = S.sparse_topk(
        gram_side(spark, nq, "query_id"), gram_side(spark, nc + nc[:40], "catalog_id"), 3, min_similarity=cut,
        block_on=["block"] if blocked else None, broadcast_bytes=limit,
    )
    # A null block meets nothing.
    asked, known = ([n for n in side if not blocked or len(n) != 9] for side in (nq, nc))
    want = brute_grams(asked, known, 3, cut, (lambda n: len(n) % 3) if blocked else (lambda n: 0))
    assert got(df) == want


@SIZES
@pytest.mark.parametrize("blocked", [False, True])
def test_sparse_search_without_a_cut_agrees_with_brute_force(spark, limit, blocked):
    rng = np.random.default_rng(12)
    nq, nc = names(rng, 60) + ["brand one gel", "qqq www"], names(rng, 90) + ["BRAND one gel", "qqq", "zzz"]
    nq, nc = ([n for n in side if len(n) != 9] for side in (nq, nc))
    df = S.sparse_topk(
        gram_side(spark, nq, "query_id"), gram_side(spark, nc, "catalog_id"), 3,
        block_on=["block"] if blocked else None, broadcast_bytes=limit,
    )
    want = brute_grams(nq, nc, 3, 1e-9, (lambda n: len(n) % 3) if blocked else (lambda n: 0))
    assert got(df) == want


def test_prefix_rows_are_narrow_and_bounds_prune(spark):
    """What is shuffled to find pairs holds no gram arrays, and few pairs meet their arrays."""
    rng = np.random.default_rng(13)
    nq, nc = names(rng, 400, "brand "), names(rng, 400, "BRAND ")
    q, c = gram_side(spark, nq, "query_id"), gram_side(spark, nc, "catalog_id")
    pairs = S.candidate_pairs(q, c, 0.8, [], S.common_grams(q, c))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line or "SortMergeJoin" in line:
            assert "grams" not in line and "tf#" not in line
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    near = len(brute_grams(nq, nc, 400, 0.8))
    assert near <= pairs.count() < len(nq) * len(nc) / 10


def test_a_hot_gram_is_no_single_task(spark):
    """Every name shares its rarest grams: the pairs come from a join, which is split by size."""
    q = gram_side(spark, [f"same start {i:04d}" for i in range(300)], "query_id")
    c = gram_side(spark, [f"SAME start {i:04d}" for i in range(300)], "catalog_id")
    df = S.sparse_topk(q, c, 1, min_similarity=0.9, broadcast_bytes=0)
    best = {r.query_id: r.catalog_id for r in df.collect()}
    assert best == {f"same start {i:04d}": f"SAME start {i:04d}" for i in range(300)}
    assert "CoGroups" not in df._jdf.queryExecution().toString()


def test_the_broadcast_search_moves_no_query(spark):
    q, c = gram_side(spark, ["abcd", "bcde"], "query_id", 1), gram_side(spark, ["abcde"], "catalog_id", 1)
    plan = S.sparse_topk(q, c, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == q._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_empty_sides_of_the_sparse_search(spark):
    q, c = gram_side(spark, ["abcd"], "query_id"), gram_side(spark, ["abcd"], "catalog_id")
    for limit in (0, S.BROADCAST_BYTES):
        for cut in (None, 0.8):
            assert S.sparse_topk(q.limit(0), c, 3, min_similarity=cut, broadcast_bytes=limit).count() == 0
            assert S.sparse_topk(q, c.limit(0), 3, min_similarity=cut, broadcast_bytes=limit).count() == 0


def test_sparse_search_refuses_an_empty_cut(spark):
    with pytest.raises(ValueError):
        S.sparse_topk(None, None, 3, min_similarity=0.0)


def test_sparse_search_without_a_cut_finds_all_that_share_a_gram(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcd"), 12)) for _ in range(60)]
    asked, known = [*words[:25], "abcdxyz", "zzzz"], [*words[20:], "xyz", "abcd"]

    def side(names, row_id):
        rows = spark.createDataFrame([(n,) for n in names], "product_name string")
        return trigram_vectors(rows).withColumnRenamed("product_name", row_id)

    got = S.sparse_topk(side(asked, "query_id"), side(known, "catalog_id"), 3, broadcast_bytes=0)

    def grams(text):
        return Counter(text[i : i + 3] for i in range(len(text) - 2))

    want = set()
    for q in asked:
        scored = []
        for c in known:
            a, b = grams(q), grams(c)
            dot = sum(a[g] * b[g] for g in a)
            if dot:
                norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
                scored.append((-round(dot / norm, 6), c))
        want |= {(q, i, c) for i, (_, c) in enumerate(sorted(scored)[:3], 1)}
    assert {(r.query_id, r["rank"], r.catalog_id) for r in got.collect()} == want


def test_repeated_catalogue_rows_count_once_at_any_size(spark):
    v = [[1.0, 0.0], [1.0, 0.0], [0.9, 0.1], [0.5, 0.5]]
    catalog = spark.createDataFrame(
        [(i, x, math.hypot(*x)) for i, x in zip([1, 1, 2, 3], v)] * 2, "catalog_id long, vector array<double>, norm double"
    )
    queries = spark.createDataFrame([(7, [1.0, 0.0], 1.0)], "query_id long, vector array<double>, norm double")
    for limit in (T.BROADCAST_BYTES, 0):
        rows = T.dense_topk(queries, catalog, 3, broadcast_bytes=limit).orderBy("rank").collect()
        assert [(r["rank"], r.catalog_id) for r in rows] == [(1, 1), (2, 2), (3, 3)]


def test_no_search_plans_a_cross_join(spark, clustered):
    q, c = clustered
    qs, cs = frame(spark, q, "query_id"), frame(spark, c, "catalog_id")
    texts = trigram_vectors(spark.createDataFrame([("abc",)], "product_name string"))
    for df in (
        T.pivot_topk(qs, cs, 3),
        T.lsh_topk(qs, cs, 3),
        S.sparse_topk(
            texts.withColumnRenamed("product_name", "query_id"),
            texts.withColumnRenamed("product_name", "catalog_id"), min_similarity=0.8, broadcast_bytes=0,
        ),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_hot_group_is_cut_into_bounded_blocks(spark):
    q = spark.range(300).selectExpr("id query_id", "0 key")
    c = spark.range(500).selectExpr("id catalog_id", "0 key")

    def kernel(left, right):
        import pyarrow as pa

        return pa.table({"q": [left.num_rows], "c": [right.num_rows]})

    rows = T.block_pairs(q, c, ["key"], kernel, "q bigint, c bigint", 32).collect()
    assert sum(r.q * r.c for r in rows) == 300 * 500
    assert max(r.q for r in rows) < 64 and max(r.c for r in rows) < 64


@pytest.mark.parametrize("limit", [0, 3, 100])
def test_every_copy_plan_gives_the_same_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(T, "BROADCAST_GROUPS", limit)
    q = spark.range(300).selectExpr("id query_id", "if(id % 3 = 0, 0, if(id % 50 = 7, null, id % 40)) key")
    c = spark.range(400).selectExpr("id catalog_id", "if(id % 3 = 0, 0, if(id % 50 = 9, null, id % 60)) key")

    def kernel(left, right):
        import pyarrow as pa

        n = left.num_rows * right.num_rows
        return pa.table({"n": [n], "biggest": [max(left.num_rows, right.num_rows)]})

    rows = T.block_pairs(q, c, ["key"], kernel, "n bigint, biggest bigint", 24).collect()
    want = q.join(c, "key").count()
    assert sum(r.n for r in rows) == want
    assert max(r.biggest for r in rows if r.n) < 60


def test_copies_beyond_k_are_dropped_before_the_search(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i % 3 == 0)]) for i in range(90)], "catalog_id bigint, vector array<double>")
    kept = T.few_copies(rows, 2, ["vector"])
    assert sorted(r.catalog_id for r in kept.collect()) == [0, 1, 2, 3]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning") :]


@pytest.mark.parametrize("limit", [0, T.BROADCAST_BYTES], ids=["block pairs", "broadcast"])
@pytest.mark.parametrize("k,cut", [(3, None), (2, 0.7)])
def test_search_in_blocks_agrees_with_brute_force(spark, clustered, limit, k, cut):
    """One value holds half of all rows, many have a few, one has none on the other side, some are null."""
    q, c = clustered

    def label(i):
        return "hot" if i % 2 else None if i % 14 == 4 else f"s{i % 30}" if i % 30 != 8 else f"own {i}"

    def side(vectors, row_id):
        rows = [(label(i), i % 3 == 0, i, [float(x) for x in v]) for i, v in enumerate(vectors)]
        df = spark.createDataFrame(rows, f"shelf string, odd boolean, {row_id} bigint, vector array<double>")
        return valid_vectors(df, "vector")

    want = []
    for name in {(label(i), i % 3 == 0) for i in range(len(q)) if label(i)}:
        own, other = ([i for i in range(len(v)) if (label(i), i % 3 == 0) == name] for v in (q, c))
        if other:
            want += [(own[a], r, other[b], s) for a, r, b, s in brute(q[own], c[other], k, cut)]
    catalog = side(c, "catalog_id")
    df = T.dense_topk(
        side(q, "query_id"), catalog.unionByName(catalog.limit(50)), k, min_similarity=cut,
        block_on=["shelf", "odd"], block_rows=20, broadcast_bytes=limit,
    )
    assert got(df) == sorted(want)
    assert ("CoGroups" in df._jdf.queryExecution().toString()) == (limit == 0)
    nothing = T.dense_topk(side(q, "query_id"), catalog.limit(0), k, block_on=["shelf", "odd"], broadcast_bytes=limit)
    assert nothing.count() == 0


def test_the_sparse_search_hands_on_few_rows_a_query(spark, monkeypatch):
    """Names that all share grams: what is ranked last are a few hits a query, never pairs of rows."""
    rng = np.random.default_rng(21)
    nq, nc = names(rng, 500, "one brand "), names(rng, 500, "ONE brand ")
    seen, ranked = [], T.best_per_query

    def counted(scored, k):
        seen.append(scored.count())
        return ranked(scored, k)

    monkeypatch.setattr(T, "best_per_query", counted)
    monkeypatch.setattr(S, "CELL_ROWS", 32, raising=False)
    monkeypatch.setattr(S, "PIECE_ROWS", 64, raising=False)
    df = S.sparse_topk(gram_side(spark, nq, "query_id"), gram_side(spark, nc, "catalog_id"), 3, broadcast_bytes=0)
    assert got(df) == brute_grams(nq, nc, 3, 1e-9)
    assert sum(seen) <= 20 * len(nq) < len(nq) * len(nc) / 20


@pytest.mark.parametrize("run_rows", [3, 128])
def test_best_in_a_cell_agrees_with_brute_force(spark, monkeypatch, run_rows):
    monkeypatch.setattr(S, "RUN_ROWS", run_rows)
    rng = np.random.default_rng(22)
    block = F.when(F.col("block") == 0, "a").otherwise("b").alias("_block")
    asked, known = (
        gram_side(spark, names(rng, 80), row_id).select(row_id, block, "grams", "tf", "norm").orderBy("_block", row_id).toArrow()
        for row_id in ("query_id", "catalog_id")
    )
    rows, cols, scores, kth = S._best_in_cell(asked, known, np.full(asked.num_rows, -1.0), 2)
    label = dict(zip(asked["query_id"].to_pylist() + known["catalog_id"].to_pylist(), asked["_block"].to_pylist() + known["_block"].to_pylist()))
    want = brute_grams(asked["query_id"].to_pylist(), known["catalog_id"].to_pylist(), 2, 1e-9, label.get)
    found = {(asked["query_id"][int(q)].as_py(), known["catalog_id"][int(c)].as_py()) for q, c in zip(rows, cols)}
    assert found == {(q, c) for q, _, c, *_ in want}
    assert all(kth[q] == min(scores[rows == q]) for q in set(rows.tolist()) if (rows == q).sum() == 2)


@pytest.mark.parametrize("block_rows", [20, None])
def test_the_blocked_search_takes_both_sides_from_one_table(spark, block_rows):
    rng = np.random.default_rng(23)
    v = rng.standard_normal((120, 4))
    rows = spark.createDataFrame([(i, x.tolist(), f"s{i % 3}", i % 2 == 0) for i, x in enumerate(v)], "id long, vector array<double>, shelf string, asks boolean")
    rows = valid_vectors(rows, "vector").cache()
    asked = rows.filter("asks").select(F.col("id").alias("query_id"), "shelf", "vector", "norm")
    known = rows.filter("NOT asks").select(F.col("id").alias("catalog_id"), "shelf", "vector", "norm")
    settings = {"block_rows": block_rows} if block_rows else {}
    df = T.dense_topk(asked, known, 2, block_on=["shelf"], broadcast_bytes=0, **settings)
    want = []
    for shelf in range(3):
        mine = [i for i in range(120) if i % 3 == shelf]
        q, c = ([i for i in mine if i % 2 == side] for side in (0, 1))
        want += [(q[i], rank, c[j], score) for i, rank, j, score in brute(v[q], v[c], 2)]
    assert got(df) == sorted(want)


def test_a_task_scores_a_few_megabytes_at_a_time(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000))], ["query_id"])
    pieces = [p.num_rows for p in T._chunks([batch], 60_000)]
    assert sum(pieces) == 5000 and max(pieces) * 60_000 * 8 <= 8 << 20
