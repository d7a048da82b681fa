import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from shelflens.config import SHOP_L, SHOP_W, JobConfig
from shelflens.operators.history import product_rows
from shelflens.operators.latest import latest_by_shop, latest_cheapest, latest_per_product
from shelflens.plans import report
from shelflens.plans.ingest import run_ingest
from shelflens.sources import sinks, tables
from shelflens.sources.files import path_exists

DAY = dt.date(2025, 1, 31)
T1, T2 = dt.datetime(2025, 1, 31, 1), dt.datetime(2025, 1, 31, 5)


def history(spark, *rows):
    full = [(n, p, t, s, t.year, t.month) for n, p, t, s in rows]
    return spark.createDataFrame(full, tables.HISTORY_SCHEMA)


def name_map(spark, *rows):
    return spark.createDataFrame(list(rows), tables.NAME_MAP_SCHEMA)


def only(df):
    return [(r.product_name, r.sale_price) for r in df.orderBy("product_name").collect()]


def test_latest_load_wins(spark):
    rows = history(spark, ("A", 5.0, T1, SHOP_L), ("A", 9.0, T2, SHOP_L))
    assert only(latest_cheapest(rows)) == only(latest_per_product(rows)) == [("A", 9.0)]


def test_missing_price_in_the_latest_load(spark):
    rows = history(spark, ("A", None, T2, SHOP_L), ("A", 10.0, T2, SHOP_L), ("A", 1.0, T1, SHOP_L))
    assert only(latest_cheapest(rows)) == [("A", None)]
    assert only(latest_cheapest(rows, prefer_priced=True)) == [("A", 10.0)]
    assert only(latest_per_product(rows)) == [("A", 10.0)]


def test_ties_take_the_lower_price_and_nan_last(spark):
    rows = history(
        spark, ("A", 9.0, T1, SHOP_W), ("A", 8.0, T1, SHOP_W), ("B", float("nan"), T1, SHOP_W),
        ("B", 3.0, T1, SHOP_W),
    )
    assert only(latest_per_product(rows)) == [("A", 8.0), ("B", 3.0)]


def test_one_pass_equals_two(spark):
    rows = history(
        spark,
        *[
            (f"P{i % 7}", None if i % 5 == 0 else float(i % 11), (T1, T2)[i % 2], (SHOP_L, SHOP_W)[i % 3 % 2])
            for i in range(200)
        ],
    )
    for flag in (False, True):
        got = latest_by_shop(rows, flag)
        line = latest_cheapest(rows.filter(F.col("ecommerce_name") == SHOP_L), prefer_priced=flag)
        watson = latest_per_product(rows.filter(F.col("ecommerce_name") == SHOP_W))
        assert sorted(map(str, got.collect())) == sorted(map(str, line.union(watson).collect()))


def test_hot_product_is_reduced_before_the_shuffle(spark):
    plan = latest_by_shop(history(spark, ("A", 1.0, T1, SHOP_L)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    before = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_report_rows(spark):
    rows = history(
        spark,
        ("a", 12.0, T1, SHOP_L), ("a", 11.0, T1, SHOP_L), ("a2", 30.0, T1, SHOP_L),
        ("A", 10.0, T1, SHOP_W), ("B", None, T1, SHOP_W), ("b", 7.0, T1, SHOP_L),
        ("late", 1.0, dt.datetime(2025, 2, 1), SHOP_L), ("unmapped", 1.0, T1, SHOP_L),
        ("A", 1.0, T1, "other"),
    )
    mapping = name_map(
        spark, (1, "a", "A"), (2, "a", "A"), (3, "b", "B"), (4, "late", "A"), (5, None, "A"),
        (6, "a", None),
    )
    got = sorted(
        tuple(r)[:5] for r in report.price_report(rows, mapping, DAY).collect()
    )
    assert got == [
        (1, "A", 11.0, 10.0, 1.0), (2, "A", 11.0, 10.0, 1.0), (3, "B", 7.0, None, None),
    ]
    # A repeated number pairs every row of one shop with every row of the other.
    mapping = name_map(spark, (1, "a", "A"), (1, "a2", "B"))
    got = sorted((r.product_name, r.price_from_line) for r in report.price_report(rows, mapping, DAY).collect())
    assert got == [("A", 11.0), ("A", 30.0), ("B", 11.0), ("B", 30.0)]


def test_report_reads_the_day_once(spark, tmp_path):
    path = str(tmp_path / "h")
    sinks.load_history(history(spark, ("a", 1.0, T1, SHOP_L), ("A", 2.0, T1, SHOP_W)), path, "x")
    df = report.price_report(tables.read_history(spark, path), name_map(spark, (1, "a", "A")), DAY)
    assert df.count() == 1
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_step_counts(spark):
    rows = history(spark, ("a", 1.0, T1, SHOP_L), ("a", 2.0, T1, SHOP_L), ("A", 2.0, T1, SHOP_W))
    got = {tuple(r) for r in report.step_counts(rows, name_map(spark, (1, "a", "A"), (2, "a", "A")), DAY).collect()}
    assert got == {
        ("loaded", SHOP_L, 2), ("loaded", SHOP_W, 1), ("latest", SHOP_L, 1), ("latest", SHOP_W, 1),
        ("mapped", SHOP_L, 2), ("mapped", SHOP_W, 2), ("compared", "both", 2),
    }


def test_landing_to_report(spark, tmp_path):
    config = JobConfig(str(tmp_path / "root"))
    folder = f"{config.landing_root}/{DAY}"
    os.makedirs(folder)
    line = [{"name": f"Line {i}", "salePrice": f"฿{1000 + i:,.2f}"} for i in range(30)]
    watson = [{"name": f"Watson {i}", "price": {"value": 1000}} for i in range(30)]
    for page in range(3):  # every page repeats the product list
        with open(f"{folder}/line_shopping_q_{page}.json", "w", encoding="utf-8") as f:
            json.dump({"data": {"products": {"products": line}}}, f, ensure_ascii=False)
    with open(f"{folder}/watson_q_0.json", "w", encoding="utf-8") as f:
        json.dump({"products": watson}, f)
    run_ingest(spark, config, DAY, T1)
    sinks.write_csv(name_map(spark, *[(i, f"Line {i}", f"Watson {i}") for i in range(20)]), config.name_map)
    assert report.run_report(spark, config, DAY, T2) == 20
    files = sorted(p for p in os.listdir(config.report(DAY)) if p.startswith("part-"))
    lines = [
        row for p in files for row in open(f"{config.report(DAY)}/{p}", encoding="utf-8").read().split("\n")[1:] if row
    ]
    assert [row.split(",")[0] for row in lines] == [str(i) for i in range(20)]
    assert lines[7].split(",")[1:5] == ["Watson 7", "1007.0", "1000.0", "7.0"]
    manifest = spark.read.json(config.manifest(T2)).first()
    assert (manifest.path, manifest.row_count) == (config.report(DAY), 20)
    # Nothing to report: nothing is written.
    other = dt.date(2025, 3, 1)
    assert report.run_report(spark, config, other, T1) == 0
    assert not path_exists(spark, config.report(other)) and not path_exists(spark, config.manifest(T1))


def test_product_csv_round_trip(spark, tmp_path):
    rows = product_rows(spark.createDataFrame([("ครีม, A", 1.5), ("B", None)], "product_name string, sale_price double"), SHOP_L)
    path = str(tmp_path / "p")
    sinks.write_csv(rows, path)
    back = tables.read_products_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == [("B", None, "line"), ("ครีม, A", 1.5, "line")]
    assert sinks.preview(back, 1).count() == 1
    empty = tables.read_products_csv(spark, path).limit(0)
    assert empty.columns == ["product_name", "sale_price", "ecommerce"]


def brute_report(rows, mapping):
    """The report in plain Python: latest row per shop and name, then every map pair."""

    def first(shop):
        best = {}
        for n, p, t, s in rows:
            if s != shop or t.date() != DAY:
                continue
            if shop == SHOP_L:  # a missing price counts as the lowest
                key = (-t.timestamp(), p is not None, p or 0.0)
            else:
                key = (-t.timestamp(), p is None, p or 0.0)
            if n not in best or key < best[n][0]:
                best[n] = (key, p, t)
        return best

    line, watson = first(SHOP_L), first(SHOP_W)
    out = []
    for no_w, _, name_w in mapping:
        for no_l, name_l, _ in mapping:
            if no_w == no_l and name_w in watson and name_l in line:
                pl, pw = line[name_l][1], watson[name_w][1]
                diff = None if pl is None or pw is None else pl - pw
                out.append((no_w, name_w, pl, pw, diff))
    return sorted(out, key=str)


def test_report_agrees_with_brute_force(spark):
    import random

    for seed in range(3):
        rng = random.Random(seed)
        times = [T1, T2, dt.datetime(2025, 1, 31, 23, 59, 59, 999999), dt.datetime(2025, 2, 1)]
        rows = [
            (
                rng.choice(["hot"] * 5 + [f"p{i}" for i in range(12)]),
                rng.choice([None, 0.0, 1.5, 2.0, 9.0, 10.0]),
                rng.choice(times),
                rng.choice([SHOP_L, SHOP_W]),
            )
            for _ in range(300)
        ]
        names = ["hot"] + [f"p{i}" for i in range(14)]
        mapping = [(rng.randrange(9), rng.choice(names), rng.choice(names)) for _ in range(15)]
        got = report.price_report(history(spark, *rows), name_map(spark, *mapping), DAY)
        assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute_report(rows, mapping)


def test_landing_to_matching_to_report(spark, tmp_path):
    from shelflens.plans.matching import run_matching, write_name_map

    config = JobConfig(str(tmp_path / "root"))
    folder = f"{config.landing_root}/{DAY}"
    os.makedirs(folder)
    goods = [f"Brand {b} {kind} {size}ml" for b in "ABC" for kind in ("Night Cream", "Soap") for size in (50, 120)]
    line = [{"name": g.upper(), "price": 100 + i} for i, g in enumerate(goods)]
    watson = [{"name": g, "price": {"value": f"฿{100}"}} for g in reversed(goods)]
    with open(f"{folder}/line_shopping_q_1.json", "w", encoding="utf-8") as f:
        json.dump({"data": {"products": {"products": line}}}, f, ensure_ascii=False)
    with open(f"{folder}/watson_q_0.json", "w", encoding="utf-8") as f:
        json.dump({"products": watson}, f, ensure_ascii=False)
    run_ingest(spark, config, DAY, T1)
    assert run_matching(spark, config).count() == len(goods)
    write_name_map(spark, config)
    assert report.run_report(spark, config, DAY, T2) == len(goods)
    rows = spark.read.option("header", True).csv(config.report(DAY)).collect()
    assert {(r.product_name, float(r["diff"])) for r in rows} == {(g, float(i)) for i, g in enumerate(goods)}
    assert sorted(int(r.product_no) for r in rows) == list(range(1, len(goods) + 1))


def test_report_keeps_microseconds(spark, tmp_path):
    stamp = dt.datetime(2025, 1, 31, 23, 59, 59, 999999)
    rows = [(1, "a", 1.0, 2.0, -1.0, stamp), (2, "b", None, 2.0, None, stamp.replace(microsecond=0))]
    sinks.write_report(spark.createDataFrame(rows, tables.REPORT_SCHEMA), str(tmp_path / "r"), ["product_no"])
    back = tables.read_report(spark, str(tmp_path / "r")).orderBy("product_no").collect()
    assert [tuple(r) for r in back] == rows


def test_a_small_report_is_not_cut_into_as_many_ranges_as_a_shuffle(spark, tmp_path, monkeypatch):
    rows = spark.range(3000, numPartitions=40).select(
        F.col("id").alias("product_no"), F.concat(F.lit("p"), "id").alias("product_name"),
        *[F.lit(1.0).alias(c) for c in ("price_from_line", "price_from_watson", "diff")],
        F.lit("2025-01-31T01:00:00").cast("timestamp_ntz").alias("ingest_timestamp_utc"),
    )
    # Runtime re-planning hides the ranges: without it each range with rows is a file.
    monkeypatch.setattr(sinks, "REPORT_FILE_ROWS", 1000, raising=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = str(tmp_path / "r")
        assert sinks.write_report(rows, path, ["product_no", "product_name"]) == 3000
        assert sinks.write_report(rows.limit(0), path, ["product_no"]) == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) == 3
    read = [[r.product_no for r in tables.read_report(spark, f).collect()] for f in files]
    assert sum(read, []) == list(range(3000))
