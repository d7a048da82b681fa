import datetime as dt
import math
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelflens.config import MATCH_BASE_NAME, MATCH_QUERY_NAME, SHOP_L, SHOP_W, JobConfig
from shelflens.operators import decide, embed, namemap, verify
from shelflens.operators.vectors import cache_lookup, cache_misses
from shelflens.plans import matching
from shelflens.sources import sinks, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])
T1, T2 = dt.datetime(2025, 1, 31, 1), dt.datetime(2025, 2, 1, 1)


def catalog(spark, shop, *rows):
    full = [(n, p, t, shop, t.year, t.month) for n, p, t in rows]
    return spark.createDataFrame(full, tables.HISTORY_SCHEMA)


def letters(texts):
    """A toy embedder: letter counts."""
    return [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz0123456789"] for t in texts]


def test_failed_batches_are_remembered(spark, tmp_path):
    calls = str(tmp_path / "calls")
    path = str(tmp_path / "cache")

    def flaky(texts):
        with open(calls, "a") as f:
            f.write(f"{len(texts)}\n")
        if "bad" in texts:
            raise RuntimeError("no answer")
        return letters(texts)

    texts = spark.createDataFrame([("a1",), ("a1",), ("  ",), ("b2",)], "text string")
    cache = embed.refresh_cache(texts, path, "m", flaky)
    assert {(r.text, r.status) for r in cache.collect()} == {("a1", "ok"), ("b2", "ok")}
    more = spark.createDataFrame([("a1",), ("bad",)], "text string")
    embed.refresh_cache(more, path, "m", flaky)
    assert {(r.text, r.status, len(r.embedding)) for r in embed.read_cache(texts, path).collect()} == {
        ("a1", "ok", 36), ("b2", "ok", 36), ("bad", "failed", 0),
    }
    before = open(calls).read()
    embed.refresh_cache(more, path, "m", flaky)
    assert open(calls).read() == before
    cache = embed.refresh_cache(more, path, "m", letters, retry_failed=True)
    assert cache.filter("text = 'bad'").first().status == "ok"
    # Another model has its own entries.
    assert cache_misses(texts, cache, "other").count() == 2
    look = cache_lookup(spark.createDataFrame([("zz",), ("a1",)], "text string"), cache, "m")
    assert {(r.text, r.status) for r in look.collect()} == {("zz", "missing"), ("a1", "ok")}


def test_batches_hold_at_most_batch_size(spark):
    rows = spark.range(250).selectExpr("concat('t', id) text", "'m' model")

    def count(texts):
        return [[float(len(texts))] for _ in texts]

    sizes = {r.embedding[0] for r in embed.embed_texts(rows, count, partitions=1).collect()}
    assert sizes == {100.0, 50.0}


@pytest.mark.parametrize(
    "reply,place",
    [
        ("A", 1), (" B \n", 2), ("None", None), ("none", None), ("False", None), ("FALSE", None),
        ("C", None), ("a", None), (None, None), ("", None),
    ],
)
def test_reply_must_be_a_candidate(spark, reply, place):
    rows = spark.createDataFrame([(["A", "B", "A"], reply)], "names array<string>, reply string")
    r = verify.resolve_reply(rows).first()
    assert r.verified_at == place
    assert r.verified_name == (None if place is None else ["A", "B"][place - 1])


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("Cream A 50ml", "cream a 50ML", True), ("Cream A 50ml", "Cream A 50ml 2", False),
        ("Cream A 50ml", "A Cream 50ml", True), ("Cream A 50ml", "Soap A 50ml", False),
        ("a b c d e", "a b c d f", False), ("x 1.5 a b c", "a b c x 1.5", True), ("", "", False),
    ],
)
def test_rule(spark, a, b, same):
    rows = spark.createDataFrame([(a, [b])], "query_name string, names array<string>")
    assert verify.rule_reply(rows).first().reply == (b if same else "None")


def test_payload_lists_candidates(spark):
    rows = spark.createDataFrame([("Q", ["A", "B"]), ("Z", [])], "query_name string, names array<string>")
    got = [r.payload for r in verify.verify_payload(rows).collect()]
    assert "Base product: Q" in got[0] and "- A\n- B\n" in got[0]


def test_decision(spark):
    cands = "array<struct<rank:int,name:string,price:double,score:double>>"
    rows = spark.createDataFrame(
        [
            ("q1", 1.0, [(1, "A", 2.0, 0.9), (2, "B", 3.0, 0.8)], ["A", "B"], 2, False),
            ("q2", 1.0, [(1, "A", 2.0, 0.9), (2, "B", 3.0, 0.8)], ["A", "B"], None, False),
            ("q3", 1.0, [], [], None, False),
            ("q4", 1.0, [(1, "A", 2.0, 0.9)], ["A"], None, True),
        ],
        f"query_name string, query_price double, candidates {cands}, names array<string>, "
        "verified_at int, failed boolean",
    )
    assert [tuple(r) for r in decide.decide_match(rows).orderBy(F.col(f"`{MATCH_QUERY_NAME}`")).collect()] == [
        ("q1", "B", 1.0, 3.0, 0.8, True), ("q2", "A", 1.0, 2.0, 0.9, False),
        ("q3", "Matching Failed", 1.0, 0.0, 0.0, False), ("q4", "A", 1.0, 2.0, 0.9, False),
    ]


def test_cuts_and_ratio_bands(spark):
    rows = spark.createDataFrame(
        [
            ("at cut", 1.0, 1.0, 0.8, True), ("below", 1.0, 1.0, 0.799999, True),
            ("half", 1.0, 2.0, 0.9, True), ("more", 3.0, 2.0, 0.9, True), ("zero", 1.0, 0.0, 0.9, True),
            ("none", 0.0, 0.0, 0.9, True), ("neg", -1.0, 0.0, 0.9, True), ("null", None, 0.0, 0.9, True),
            ("unverified", 1.0, 1.0, 0.9, False),
        ],
        "n string, price_from_line double, price_from_watson double, similarity double, verified_match boolean",
    )
    kept = {r.n: r["diff"] for r in decide.keep_verified(rows).collect()}
    assert set(kept) == {"at cut", "half", "more", "zero", "none", "neg", "null"}
    assert kept["zero"] == math.inf and kept["neg"] == -math.inf and math.isnan(kept["none"])
    assert kept["null"] is None
    assert {r.n for r in decide.keep_dearer(rows).collect()} == {"more", "zero", "none"}
    assert {r.n for r in decide.keep_comparable(rows).collect()} == {"at cut", "unverified"}


def test_judge_is_retried_then_fails(spark, tmp_path):
    log = str(tmp_path / "log")

    def judge(payload):
        with open(log, "a") as f:
            f.write("x")
        raise RuntimeError("down")

    rows = spark.createDataFrame([("p",)], "payload string").coalesce(1)
    r = verify.judge_reply(rows, judge, attempts=3, pause=0.0).first()
    assert (r.reply, r.failed) == (None, True)
    assert open(log).read() == "xxx"


def test_full_match_with_trigrams(spark):
    line = catalog(
        spark, SHOP_L, ("CREAM A 50ml", 12.0, T1), ("CREAM A 50ml", 11.0, T2), ("Night Serum Z 30ml", 5.0, T1),
        ("something else entirely", 1.0, T1), (None, 1.0, T1), ("", 1.0, T1),
    )
    watson = catalog(
        spark, SHOP_W, ("Cream A 50ml", 10.0, T1), ("Cream A 50ml", 9.0, T2), ("Cream A 500ml", 90.0, T1),
        ("Night Serum Z 35ml", 6.0, T1),
    )
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_catalogs(line, watson).collect()}
    assert set(rows) == {"CREAM A 50ml", "Night Serum Z 30ml", "something else entirely"}
    hit = rows["CREAM A 50ml"]
    assert (hit[MATCH_BASE_NAME], hit.price_from_line, hit.price_from_watson) == ("Cream A 50ml", 11.0, 9.0)
    assert hit.verified_match and hit.similarity == 1.0
    assert not rows["Night Serum Z 30ml"].verified_match
    assert rows["something else entirely"][MATCH_BASE_NAME] == "Matching Failed"
    # Without dedup every listing is matched, and copies may fill the candidate list.
    many = matching.match_catalogs(line, watson, dedup=False)
    assert many.filter(F.col(f"`{MATCH_QUERY_NAME}`") == "CREAM A 50ml").count() == 2
    names = [r.names for r in matching.ranked_candidates(line, watson, dedup=False).collect() if r.query_name == "CREAM A 50ml"]
    assert all(n[:2] == ["Cream A 50ml"] * 2 for n in names)
    # Listings equal in everything are still one row each.
    twice = matching.match_top1(line.unionByName(line), watson, dedup=False)
    assert twice.filter(F.col(f"`{MATCH_QUERY_NAME}`") == "CREAM A 50ml").count() == 4


def test_full_match_with_embeddings_and_a_judge(spark, tmp_path):
    line = catalog(spark, SHOP_L, ("abc", 2.0, T1), ("xyz", 3.0, T1))
    watson = catalog(spark, SHOP_W, ("cab", 1.0, T1), ("zyxw", 4.0, T1), ("---", 1.0, T1))

    def judge(payload):
        return "cab" if "Base product: abc" in payload else "nothing of the kind"

    search = matching.embedding_search(str(tmp_path / "cache"), "letters", letters)
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_catalogs(line, watson, search, judge, pause=0.0).collect()}
    assert (rows["abc"][MATCH_BASE_NAME], rows["abc"].verified_match) == ("cab", True)
    assert (rows["xyz"][MATCH_BASE_NAME], rows["xyz"].verified_match) == ("zyxw", False)


def test_embeddings_are_matched_within_blocks(spark, tmp_path):
    line = catalog(spark, SHOP_L, ("abc", 2.0, T1), ("xyz", 3.0, T1), ("lone", 1.0, T1))
    watson = catalog(spark, SHOP_W, ("cab", 1.0, T1), ("abcd", 5.0, T1), ("zyxw", 4.0, T1))
    brand = F.when(F.col("product_name").isin("abc", "abcd"), "b1").when(F.col("product_name") == "lone", "b3").otherwise("b2")
    line, watson = line.withColumn("brand", brand), watson.withColumn("brand", brand)
    search = matching.embedding_search(str(tmp_path / "cache"), "letters", letters)
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_top1(line, watson, search, block_on=["brand"]).collect()}
    assert rows["abc"][MATCH_BASE_NAME] == "abcd" and rows["xyz"][MATCH_BASE_NAME] == "zyxw"
    assert rows["lone"][MATCH_BASE_NAME] == "N/A (Query Embedding Error)"
    # Over the whole catalogue the nearer name of another brand wins.
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_top1(line, watson, search).collect()}
    assert rows["abc"][MATCH_BASE_NAME] == "cab"


def test_query_without_a_vector_gets_the_placeholder(spark, tmp_path):
    line = catalog(spark, SHOP_L, ("abc", 2.0, T1), ("---", 3.0, T1))
    watson = catalog(spark, SHOP_W, ("cab", 1.0, T1))
    search = matching.embedding_search(str(tmp_path / "cache"), "letters", letters)
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_top1(line, watson, search).collect()}
    lost = rows["---"]
    assert lost[MATCH_BASE_NAME] == "N/A (Query Embedding Error)"
    assert math.isnan(lost.price_from_watson) and lost.similarity == 0.0
    assert rows["abc"].price_from_watson == 1.0


def test_no_catalogue_vector_is_an_error(spark, tmp_path):
    line, watson = catalog(spark, SHOP_L, ("abc", 2.0, T1)), catalog(spark, SHOP_W, ("---", 1.0, T1))
    search = matching.embedding_search(str(tmp_path / "cache"), "letters", letters)
    with pytest.raises(ValueError):
        matching.match_catalogs(line, watson, search)


def test_name_map_numbers_are_dense_and_reviewed(spark):
    rows = spark.range(500).selectExpr(
        f"concat('L', id % 300) `{MATCH_QUERY_NAME}`", f"concat('W', id % 300) `{MATCH_BASE_NAME}`"
    )
    got = namemap.build_name_map(rows)
    want = spark.createDataFrame([], tables.NAME_MAP_SCHEMA)
    assert got.dtypes == want.dtypes
    assert sorted(r.product_no for r in got.collect()) == list(range(1, 301))
    reviewed = spark.createDataFrame(
        [("L1", "W1", False), ("L2", "W9", True)],
        "query_product_name_from_line string, base_product_name_from_watson string, accepted boolean",
    )
    pairs = {tuple(r)[1:] for r in namemap.build_name_map(rows, reviewed).collect()}
    assert ("L1", "W1") not in pairs and ("L2", "W9") in pairs and len(pairs) == 300


def test_matching_job_feeds_the_report_map(spark, tmp_path):
    config = JobConfig(str(tmp_path / "root"))
    rows = catalog(spark, SHOP_L, ("CREAM A 50ml", 12.0, T1)).union(
        catalog(spark, SHOP_W, ("Cream A 50ml", 10.0, T1))
    )
    sinks.load_history(rows, config.history, "x")
    stored = matching.run_matching(spark, config)
    assert [r["diff"] for r in stored.collect()] == [1.2]
    matching.write_name_map(spark, config)
    assert [tuple(r) for r in tables.read_name_map(spark, config.name_map).collect()] == [
        (1, "CREAM A 50ml", "Cream A 50ml")
    ]


def test_a_cache_that_is_only_read_is_filled_up_for_the_search(spark):
    line = catalog(spark, SHOP_L, ("abc", 2.0, T1), ("xyz", 3.0, T1), ("dead", 1.0, T1))
    watson = catalog(spark, SHOP_W, ("cab", 1.0, T1), ("zyxw", 4.0, T1))
    cache = spark.createDataFrame([("dead", "letters", [], "failed")], tables.CACHE_SCHEMA)
    search = matching.embedding_search_over(cache, "letters", letters)
    rows = {r[MATCH_QUERY_NAME]: r for r in matching.match_top1(line, watson, search).collect()}
    assert rows["abc"][MATCH_BASE_NAME] == "cab" and rows["xyz"][MATCH_BASE_NAME] == "zyxw"
    # Known to fail: not asked again, hence without a vector.
    assert rows["dead"][MATCH_BASE_NAME] == "N/A (Query Embedding Error)"
