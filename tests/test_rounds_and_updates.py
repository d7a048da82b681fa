"""Work in rounds, halved batches, numbers that stay, and days merged from their loads."""

import datetime as dt
import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelflens.config import (
    MATCH_BASE_NAME, MATCH_QUERY_NAME, SHOP_L, SHOP_W, SPEC_W, JobConfig,
)
from shelflens.operators import embed, namemap, snapshot, verify
from shelflens.operators.attempts import in_rounds, or_placeholder
from shelflens.operators.latest import latest_by_shop
from shelflens.plans import matching, report
from shelflens.plans.ingest import run_ingest
from shelflens.sources import sinks, tables
from shelflens.sources.files import path_exists
from shelflens.streaming.ingest import load_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DAY = dt.date(2025, 1, 31)


# ---------------------------------------------------------------- rounds


def test_only_failed_rows_go_on(spark, tmp_path):
    """Row i fails in its first i rounds; a log tells who was asked."""
    log = str(tmp_path)

    def judge(payload):
        with open(f"{log}/{payload}", "a") as f:
            f.write("x")
        if len(open(f"{log}/{payload}").read()) <= int(payload):
            raise RuntimeError("not yet")
        return "yes"

    rows = spark.createDataFrame([(str(i),) for i in range(5)], "payload string")
    got = {r.payload: r for r in verify.judge_reply(rows, judge, attempts=3, pause=0.0).collect()}
    assert [got[str(i)].attempts for i in range(5)] == [1, 2, 3, 3, 3]
    assert [got[str(i)].failed for i in range(5)] == [False, False, False, True, True]
    assert [got[str(i)].reply for i in range(5)] == ["yes"] * 3 + [None] * 2
    assert [len(open(f"{log}/{i}").read()) for i in range(5)] == [1, 2, 3, 3, 3]


def test_rounds_of_native_work_and_placeholders(spark):
    seen = []

    def work(rows):
        seen.append(rows.count())
        # Each round does the multiples of another number.
        good = F.col("id") % (2, 3, 5)[len(seen) - 1] == 0
        return rows.withColumn("failed", ~good).withColumn("value", F.when(good, F.col("id") * 10))

    done = in_rounds(spark.range(30), work, attempts=3)
    assert seen == [30, 15, 10]
    filled = or_placeholder(done, {"value": F.lit(-1)})
    got = {r.id: (r.attempts, r.failed, r.value) for r in filled.collect()}
    assert len(got) == 30 and got[4] == (1, False, 40) and got[9] == (2, False, 90) and got[25] == (3, False, 250)
    assert got[7] == (3, True, -1)
    seen.clear()
    assert in_rounds(spark.range(0), work, attempts=3).count() == 0 and seen == [0]
    with pytest.raises(ValueError):
        in_rounds(spark.range(1), work, attempts=0)


# ---------------------------------------------------------------- embeddings


def test_a_failing_batch_is_halved_to_its_bad_texts():
    calls = []

    def ask(texts):
        calls.append(len(texts))
        if {"bad1", "bad2"} & set(texts):
            raise RuntimeError("no")
        return [[float(len(t))] for t in texts]

    texts = [f"t{i}" for i in range(50)] + ["bad1"] + [f"u{i}" for i in range(40)] + ["bad2"]
    got = embed.asked_in_halves(ask, texts)
    assert [t for t, v in zip(texts, got) if v is None] == ["bad1", "bad2"]
    assert all(v == [float(len(t))] for t, v in zip(texts, got) if v is not None)
    assert len(calls) < 40
    assert embed.asked_in_halves(lambda t: [[1.0]], ["a", "b"]) == [[1.0], [1.0]]  # a wrong count is a failure


def test_a_bad_text_costs_its_neighbours_nothing(spark):
    def ask(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return [[1.0] for _ in texts]

    names = spark.range(120).select(
        F.when(F.col("id") % 50 == 7, F.concat(F.lit("bad"), "id")).otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    empty = spark.createDataFrame([("t1", "m", [2.0], "ok"), ("t2", "other", [2.0], "ok")], tables.CACHE_SCHEMA)
    got = embed.refreshed(names.unionByName(names), empty, "m", ask, batch_size=100).collect()
    assert len(got) == 120 and {r.text for r in got if r.status == "failed"} == {"bad7", "bad57", "bad107"}
    assert [(r.origin, r.embedding) for r in got if r.text == "t1"] == [("cached", [2.0])]
    assert sum(r.origin == "new" for r in got) == 119


# ---------------------------------------------------------------- numbers


def pairs_of(spark, *names):
    return spark.createDataFrame([(n, n.upper()) for n in names], f"{namemap.NAMES[0]} string, {namemap.NAMES[1]} string")


def test_numbers_are_given_once(spark):
    first = namemap.new_numbers(pairs_of(spark, *(f"a{i}" for i in range(200))), spark.createDataFrame([], tables.NAME_MAP_SCHEMA))
    old = {r[1]: r[0] for r in first.collect()}
    assert sorted(old.values()) == list(range(1, 201))
    now = pairs_of(spark, *(f"a{i}" for i in range(100, 200)), *(f"b{i}" for i in range(30)))
    got = {r[1]: r[0] for r in namemap.update_name_map(now, first).collect()}
    assert all(got[n] == old[n] for n in old if n in got) and len(got) == 130
    assert sorted(v for n, v in got.items() if n[0] == "b") == list(range(201, 231))


def test_a_map_that_is_written_again_changes_no_number(spark, tmp_path):
    config = JobConfig(str(tmp_path / "root"))

    def write(*names, reviewed=None):
        rows = [(n, n.upper()) for n in names]
        frame = spark.createDataFrame(rows, f"`{MATCH_QUERY_NAME}` string, `{MATCH_BASE_NAME}` string")
        frame.write.mode("overwrite").parquet(config.match_result)
        matching.write_name_map(spark, config, reviewed)
        return {r[1]: r[0] for r in tables.read_name_map(spark, config.name_map).collect()}

    one = write("c", "a", "b")
    assert write("c", "a", "b") == one and set(one.values()) == {1, 2, 3}
    two = write("aa", "a", "b", "c")
    assert {n: two[n] for n in one} == one and two["aa"] == 4
    # A pair that is gone keeps its number for when it comes back; nobody else gets it.
    three = write("aa", "zz", "b")
    assert three == {"aa": 4, "b": one["b"], "zz": 5}
    no = spark.createDataFrame([("zz", "ZZ", False)], f"{namemap.NAMES[0]} string, {namemap.NAMES[1]} string, accepted boolean")
    assert write("a", "zz", "new", reviewed=no) == {"a": one["a"], "new": 6}
    assert write("a", "zz", "new") == {"a": one["a"], "new": 6, "zz": 5}


# ---------------------------------------------------------------- snapshots


def test_partials_merge_to_the_same_latest_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        ts = dt.datetime(2025, 1, rng.randint(29, 31), rng.choice([1, 5]), 0)
        price = rng.choice([None, float("nan"), 0.0, *map(float, range(5))])
        rows.append((f"P{rng.randint(0, 40)}", price, ts, rng.choice([SHOP_L, SHOP_W]), 2025, 1, f"load{rng.randint(0, 6)}"))
    frame = spark.createDataFrame(rows, tables.HISTORY_SCHEMA + ", load_id string")
    partials = snapshot.load_partials(frame)
    assert partials.count() < 1800
    got = snapshot.merge_partials(partials).select(*tables.HISTORY_COLUMNS, "day")
    dated = frame.withColumn("day", F.to_date("ingest_timestamp_utc"))
    want = latest_by_shop(dated, keys=("day", "ecommerce_name", "product_name")).select(*tables.HISTORY_COLUMNS, "day")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def response(name, price):
    return json.dumps({"products": [{"name": name, "price": {"value": price}}]})


def test_reports_from_snapshots_equal_reports_from_the_days(spark, tmp_path):
    """Late, repeated and emptied loads, in batch and by micro-batches."""
    config = JobConfig(str(tmp_path / "root"))
    line = '{"data":{"products":{"products":[{"name":"a","price":%s}]}}}'
    sinks.write_csv(spark.createDataFrame([(1, "a", "A")], tables.NAME_MAP_SCHEMA), config.name_map)
    step = load_batch(config, "s", report=False)

    def batch(n, *rows):
        full = [(f"x/{s}_{n}_{i}.json", s, day, ts, text) for i, (s, day, ts, text) in enumerate(rows)]
        step(spark.createDataFrame(full, "file string, shop string, day date, modified timestamp_ntz, value string"), n)

    def same(rows):
        """Equal reports of both days; the rows (price_from_line, price_from_watson) of ``DAY``."""
        found = []
        for day in (DAY, dt.date(2025, 2, 1)):
            run_ts = dt.datetime.combine(day, dt.time(23))
            counts = [report.run_report(spark, config, day, run_ts, way) for way in (False, True)]
            assert counts[0] == counts[1]
            whole = report.price_report(tables.read_history(spark, config.history), tables.read_name_map(spark, config.name_map), day)
            stored = tables.read_snapshots(spark, config.snapshots).filter(F.col("day") == F.lit(day))
            merged = report.price_report(stored, tables.read_name_map(spark, config.name_map), day)
            assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
            found.append([(r.price_from_line, r.price_from_watson) for r in merged.collect()])
        assert found[0] == rows
        return found

    at = lambda h: dt.datetime(2025, 1, 31, h)
    batch(1, (SHOP_L, DAY, at(1), line % 5), (SHOP_W, DAY, at(2), response("A", 3)))
    same([(5.0, 3.0)])
    batch(2, (SHOP_W, DAY, at(4), response("A", 2)), (SHOP_L, dt.date(2025, 2, 1), dt.datetime(2025, 2, 1, 3), line % 9))
    same([(5.0, 2.0)])
    batch(3, (SHOP_W, DAY, at(3), response("A", 1)))  # late: an older price
    same([(5.0, 2.0)])
    batch(2, (SHOP_W, DAY, at(4), response("A", 2)), (SHOP_L, dt.date(2025, 2, 1), dt.datetime(2025, 2, 1, 3), line % 9))
    same([(5.0, 2.0)])
    folder = f"{config.landing_root}/{DAY}"
    os.makedirs(folder)
    with open(f"{folder}/watson_x.json", "w") as f:
        f.write(response("A", 7))
    assert run_ingest(spark, config, DAY, at(20))
    same([(5.0, 7.0)])
    with open(f"{folder}/watson_x.json", "w") as f:
        f.write('{"products":[]}')
    assert not run_ingest(spark, config, DAY, at(20))  # emptied: its rows go
    same([(5.0, 2.0)])
    assert not path_exists(spark, f"{config.snapshots}/day={DAY}/load_id=day-{DAY}")
    assert SPEC_W.name == SHOP_W


def test_a_day_of_snapshots_reads_that_day_only(spark, tmp_path):
    rows = [(f"p{i}", 1.0, dt.datetime(2025, 1, 1 + i % 9, 5), SHOP_W, 2025, 1, f"l{i % 3}") for i in range(90)]
    frame = spark.createDataFrame(rows, tables.HISTORY_SCHEMA + ", load_id string")
    for n in range(3):
        sinks.load_snapshot(snapshot.load_partials(frame.filter(f"load_id = 'l{n}'")), str(tmp_path), f"l{n}")
    day = tables.read_snapshots(spark, str(tmp_path)).filter(F.col("day") == dt.date(2025, 1, 3))
    assert len(day.inputFiles()) and {r.day for r in day.collect()} == {dt.date(2025, 1, 3)}
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- counts


def test_step_counts_read_the_history_once(spark, tmp_path):
    path, names = str(tmp_path / "history"), str(tmp_path / "names")
    rows = [(f"p{i % 20}", 1.0, dt.datetime(2025, 1, 31, 5), (SHOP_L, SHOP_W)[i % 2], 2025, 1) for i in range(400)]
    sinks.append_history(spark.createDataFrame(rows, tables.HISTORY_SCHEMA), path)
    spark.createDataFrame([(i, f"p{i}", f"p{i + 1}") for i in range(0, 20, 2)], tables.NAME_MAP_SCHEMA).write.parquet(names)
    counts = report.step_counts(tables.read_history(spark, path), spark.read.parquet(names), DAY)
    got = {(r.step, r.ecommerce_name): r.n for r in counts.collect()}
    assert got == {
        ("loaded", SHOP_L): 200, ("loaded", SHOP_W): 200, ("latest", SHOP_L): 10, ("latest", SHOP_W): 10,
        ("mapped", SHOP_L): 10, ("mapped", SHOP_W): 10, ("compared", "both"): 10,
    }
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2  # the history and the map, once each
    assert "Union" not in plan and "Window" not in plan
