import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelflens.config import SHOP_L, SHOP_W, SPEC_L, SPEC_W, JobConfig
from shelflens.operators import flatten as FL
from shelflens.operators import paging
from shelflens.plans.ingest import run_ingest
from shelflens.sources import files, landing, sinks, tables
from shelflens.streaming.ingest import start_ingest

DAY = dt.date(2025, 1, 31)
RUN = dt.datetime(2025, 1, 31, 1, 5)


def doc_l(*products):
    return json.dumps({"data": {"products": {"products": list(products)}}}, ensure_ascii=False)


def doc_w(*products):
    return json.dumps({"products": list(products)}, ensure_ascii=False)


def docs(spark, *values):
    return spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(values)], "file string, value string")


def flat(spark, spec, *values):
    return [tuple(r) for r in FL.flatten(docs(spark, *values), spec).collect()]


def test_shop_l_rules(spark):
    got = flat(
        spark, SPEC_L,
        doc_l(
            {"name": "A", "salePrice": 0, "price": 5},
            {"name": "B", "salePrice": "0", "price": 7},
            {"name": "C", "salePrice": 0, "price": 0},
            {"name": "", "product_name": "D", "price": "฿1,299.50"},
            {},
            {"name": None, "product_name": None, "price": 1},
            {"name": "E"},
            {"name": "F", "salePrice": "THB 5"},
            {"name": "G", "salePrice": True, "price": 3},
            {"name": "H", "salePrice": [], "price": "1_000"},
        ),
    )
    assert got == [
        ("A", 5.0), ("B", 0.0), ("C", 0.0), ("D", 1299.5), ("E", None), ("F", None), ("G", None),
        ("H", 1000.0),
    ]


def test_shop_w_rules(spark):
    got = flat(
        spark, SPEC_W,
        doc_w(
            {"name": "A", "price": {"value": 1250}},
            {"name": "B", "price": None},
            {"name": "C", "price": {"value": 0}},
            {"name": "", "price": {"value": 1}},
            {"name": "D"},
            {"name": "E", "price": 7},
            {"name": "F", "price": {"value": "$ 2"}},
        ),
    )
    assert got == [("A", 1250.0), ("B", None), ("C", 0.0), ("D", None), ("E", None), ("F", 2.0)]


def test_unreadable_documents_are_set_aside(spark):
    rows = FL.quarantine(
        docs(
            spark, '{"data":{"pro', '{"data":{"products":{"products":{"x":1}}}}', '{"data":null}',
            "[1]", '{"other":1}', '{"data":{"products":{"products":[]}}}',
            '{"data":{"products":{"products":null}}}',
            doc_l({"name": "A", "price": 1}, None, "x", {"name": "B", "price": 2}),
        ),
        SPEC_L,
    )
    assert sorted((r.file, -1 if r.pos is None else r.pos, r.reason) for r in rows.collect()) == [
        ("f0", -1, "not json"), ("f1", -1, "not a list"), ("f2", -1, "$.data is no object"),
        ("f3", -1, "not an object"), ("f6", -1, "not a list"), ("f7", 1, "product is no object"),
        ("f7", 2, "product is no object"),
    ]


def test_rows_after_a_bad_element_stay(spark):
    assert flat(spark, SPEC_L, doc_l({"name": "A", "price": 1}, None, {"name": "B", "price": 2})) == [
        ("A", 1.0), ("B", 2.0),
    ]


def test_bare_nan_is_read(spark):
    text = '{"products":[{"name":"A: NaN, b","price":{"value":NaN}},{"name":"B","price":{"value": -Infinity}}]}'
    got = flat(spark, SPEC_W, text)
    assert [r[0] for r in got] == ["A: NaN, b", "B"] and got[0][1] != got[0][1] and got[1][1] == float("-inf")


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"a":NaN}', '{"a":"NaN"}'), ("[NaN, 1,-Infinity ,Infinity]", '["NaN",1,"-Infinity","Infinity"]'),
        (r'{"q\"uo: NaN,te\\":[NaN],"NaN":"NaN]"}', r'{"NaN":"NaN]","q\"uo: NaN,te\\":["NaN"]}'),
        ('{"a":NaNs}', None), ('{"a":NaN', None), ('{"a":"NaN}', None), ("NaN", '"NaN"'),
        ('{"a":"x\u0001","b":NaN}', None), ('{"a":"plain"}', '{"a":"plain"}'), (None, None),
    ],
)
def test_bare_numbers_are_quoted_outside_of_strings(spark, text, want):
    from shelflens.functions import variants

    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(F.to_json(variants.parse(F.col("t"))).alias("j")).first().j == want


def test_the_last_of_equal_keys_counts(spark):
    assert flat(spark, SPEC_W, '{"products":[],"products":[{"name":"A","name":"B"}]}') == [("B", None)]


def test_flatten_stays_in_the_jvm(spark):
    plan = FL.flatten(docs(spark, doc_l()), SPEC_L)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_an_element_is_looked_into_once_for_each_path(spark):
    for spec in (SPEC_L, SPEC_W):
        plan = FL.flatten(docs(spark, doc_l()), spec)._jdf.queryExecution().optimizedPlan().toString()
        for path in (*spec.name_paths, *spec.price_paths):
            assert plan.count(f"{path}, StringType") == 1


def test_values_of_all_types_at_a_path(spark):
    values = ["x", "", "0", 0, 0.0, -0.0, False, True, [], [0], {}, {"a": 1}, None, "false", "[]", "-0", -1, 0.5, "null", " "]
    got = flat(spark, SPEC_L, doc_l(*[{"name": v, "product_name": f"n{i}"} for i, v in enumerate(values)]))
    names = [name for name, _ in got]
    falsy = {f"n{i}" for i, v in enumerate(values) if not v}
    assert len(names) == len(values) and falsy == {n for n in names if n[:1] == "n" and n != "null"}


@pytest.fixture
def config(tmp_path):
    return JobConfig(str(tmp_path / "root"))


def put(config, day, name, text):
    folder = f"{config.landing_root}/{day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def fill(config, day="2025-01-31"):
    pretty = json.dumps(json.loads(doc_l({"name": "ครีม A", "salePrice": "฿10"})), indent=4)
    put(config, day, "line_shopping_a_1.json", pretty)
    put(config, day, "line_shopping_a_2.json", '{"data":{"pro')
    put(config, day, "watson_a_0.json", doc_w({"name": "Cream A", "price": {"value": 9}}))


def test_batch_ingest(spark, config):
    fill(config)
    assert run_ingest(spark, config, DAY, RUN)
    rows = tables.read_history(spark, config.history)
    assert rows.columns == tables.HISTORY_COLUMNS
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [("Cream A", 9.0, RUN, SHOP_W, 2025, 1), ("ครีม A", 10.0, RUN, SHOP_L, 2025, 1)]
    # A second run replaces the first; another day is added.
    assert run_ingest(spark, config, DAY, RUN)
    assert tables.read_history(spark, config.history).count() == 2
    fill(config, "2025-02-01")
    run_ingest(spark, config, dt.date(2025, 2, 1), dt.datetime(2025, 2, 1, 1, 0))
    rows = tables.read_history(spark, config.history)
    assert {(r.year, r.month) for r in rows.collect()} == {(2025, 1), (2025, 2)}
    bad = spark.read.json(config.quarantine)
    assert {(r.reason, r.ecommerce_name) for r in bad.collect()} == {("not json", SHOP_L)}


def test_empty_day_writes_nothing(spark, config):
    assert not run_ingest(spark, config, DAY, RUN)
    assert not files.path_exists(spark, config.history)


def test_day_filter_prunes_folders(spark, config):
    fill(config)
    run_ingest(spark, config, DAY, RUN)
    day = tables.history_for_day(tables.read_history(spark, config.history), DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    parts = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in parts and "month" in parts
    assert "ingest_timestamp_utc" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert day.count() == 2


def test_days_split_at_midnight(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'2025-01-31 23:59:59.999999' ingest_timestamp_utc, 2025 year, 1 month "
        "UNION ALL SELECT timestamp_ntz'2025-02-01 00:00:00', 2025, 2"
    )
    assert tables.history_for_day(rows, DAY).count() == 1
    assert tables.history_for_day(rows, dt.date(2025, 2, 1)).count() == 1


def test_plain_append_adds_again(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1.0, RUN, SHOP_L, 2025, 1)], tables.HISTORY_SCHEMA)
    path = str(tmp_path / "h")
    assert not files.table_exists(spark, path)
    sinks.append_history(rows, path)
    assert files.table_exists(spark, path)
    sinks.append_history(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_landing_round_trip(spark, config):
    responses = spark.createDataFrame(
        [("a b", 1, RUN, doc_l({"name": "A", "price": 1})), ("a b", 2, RUN, doc_l({"name": "B", "price": 2})),
         ("a b", 3, RUN, "{}")],
        "q string, page int, ts timestamp_ntz, body string",
    )
    stamped = landing.stamp_envelopes(
        responses, shop=F.lit(SPEC_L.envelope_name), query=F.col("q"), page=F.col("page"),
        fetched_at=F.col("ts"),
    )
    landing.land_envelopes(stamped, config)
    back = landing.scan_landed(spark, config, DAY, SPEC_L)
    assert back.count() == 3 and back.select("file").distinct().count() == 3
    body = json.loads(back.filter("file like '%_1.json'").first().value)
    assert body["ecommerce_name"] == "line_shopping"
    assert body["ingest_timestamp_utc"] == "2025-01-31T01:05:00+00:00"
    assert sorted(tuple(r) for r in FL.flatten(back, SPEC_L).collect()) == [("A", 1.0), ("B", 2.0)]
    assert landing.scan_landed(spark, config, DAY, SPEC_W).count() == 0
    assert run_ingest(spark, config, DAY, RUN)


@pytest.mark.parametrize("total,l_pages,w_pages", [(0, [], []), (1, [], []), (3, [2, 3], [1, 2]), (None, [], [])])
def test_page_plan(spark, total, l_pages, w_pages):
    for spec, body, want in (
        (SPEC_L, {"data": {"shops": {"totalPage": total}}}, l_pages),
        (SPEC_W, {"pagination": {"totalPages": total}}, w_pages),
    ):
        first = spark.createDataFrame([("q", json.dumps(body))], "query string, value string")
        plan = paging.page_plan(paging.declared_pages(first, spec), spec)
        assert [r.page for r in plan.orderBy("page").collect()] == want


def test_page_coverage(spark):
    declared = spark.createDataFrame(
        [("a", 3, 520, 0), ("b", 1, 5, 0)],
        "query string, total_pages int, total_results bigint, first_page int",
    )
    landed = spark.createDataFrame([("a", 0), ("a", 0), ("a", 2)], "query string, page int")
    got = {tuple(r) for r in paging.page_coverage(declared, landed, ["query"]).collect()}
    assert got == {("a", 3, 520, 2, 3, 1, 0), ("b", 1, 5, 0, 0, 1, 0)}


def test_clustered_copy_has_disjoint_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "concat('p', id % 50) product_name", "cast(id as double) sale_price",
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, cast(id % 20 as int)) ingest_timestamp_utc",
        "'watson' ecommerce_name", "2025 year", "1 month",
    )
    path = str(tmp_path / "c")
    sinks.write_clustered(rows, path, files=4)
    spans = sorted(
        (r.lo, r.hi)
        for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(
            F.min("ingest_timestamp_utc").alias("lo"), F.max("ingest_timestamp_utc").alias("hi")
        ).collect()
    )
    assert len(spans) == 4
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_stream_loads_each_file_once(spark, config):
    fill(config)

    def run():
        query = start_ingest(spark, config, stream="s")
        query.awaitTermination()
        assert query.exception() is None
        return tables.read_history(spark, config.history).count()

    assert run() == 2
    assert run() == 2
    fill(config, "2025-02-01")
    assert run() == 4


def test_stream_writes_the_report(spark, config):
    put(config, "2025-01-31", "line_shopping_a.json", doc_l({"name": "A x", "salePrice": 12}))
    put(config, "2025-01-31", "watson_a.json", doc_w({"name": "A", "price": {"value": 10}}))
    sinks.write_csv(spark.createDataFrame([(1, "A x", "A")], tables.NAME_MAP_SCHEMA), config.name_map)
    start_ingest(spark, config, stream="r").awaitTermination()
    day = tables.read_history(spark, config.history).first().ingest_timestamp_utc.date()
    row = spark.read.option("header", True).csv(config.report(day)).first()
    assert (row.product_no, row.product_name, row["diff"]) == ("1", "A", "2.0")


def test_replayed_batch_adds_nothing(spark, config):
    from shelflens.streaming.ingest import load_batch

    batch = spark.createDataFrame(
        [("x/watson_1.json", SHOP_W, DAY, RUN, doc_w({"name": "A", "price": {"value": 1}}))],
        "file string, shop string, day date, modified timestamp_ntz, value string",
    )
    step = load_batch(config, "s", report=False)
    step(batch, 7)
    step(batch, 7)
    assert tables.read_history(spark, config.history).count() == 1


def test_stream_before_anything_has_landed(spark, config):
    query = start_ingest(spark, config, stream="empty")
    query.awaitTermination()
    assert query.exception() is None
    assert not files.path_exists(spark, config.history)
    fill(config)
    start_ingest(spark, config, stream="empty").awaitTermination()
    assert tables.read_history(spark, config.history).count() == 2


def test_stream_in_small_batches(spark, config):
    for day in ("2025-01-30", "2025-01-31", "2025-02-01"):
        fill(config, day)
    start_ingest(spark, config, stream="b", files_per_batch=2, report=False).awaitTermination()
    rows = spark.read.parquet(config.history)
    assert rows.count() == 6 and rows.select("load_id").distinct().count() >= 3


def test_load_time_must_lie_in_the_day(spark, config):
    with pytest.raises(ValueError):
        run_ingest(spark, config, DAY, dt.datetime(2025, 2, 1))


def land(spark, config, spec, day, *bodies):
    ts = dt.datetime.fromisoformat(f"{day}T02:00:00")
    rows = spark.createDataFrame(
        [(n, ts, b) for n, b in enumerate(bodies)], "page int, ts timestamp_ntz, body string"
    )
    stamped = landing.stamp_envelopes(
        rows, shop=F.lit(spec.envelope_name), query=F.lit("q"), page=F.col("page"), fetched_at=F.col("ts")
    )
    landing.land_envelopes(stamped, config)


def test_batch_and_stream_agree(spark, tmp_path):
    """Two days in both landing layouts, loaded long after."""
    days = [dt.date(2025, 1, 31), dt.date(2025, 2, 1)]
    batch, stream = JobConfig(str(tmp_path / "batch"), "orc"), JobConfig(str(tmp_path / "stream"), "orc")
    for config in (batch, stream):
        for day in days:
            fill(config, day.isoformat())
            land(spark, config, SPEC_L, day, doc_l({"name": f"L {day}", "price": 3}), "[1, 2]")
            land(spark, config, SPEC_W, day, doc_w({"name": "ครีม A", "price": {"value": 4}}))
        names = [(1, "ครีม A", "ครีม A")]
        sinks.write_csv(spark.createDataFrame(names, tables.NAME_MAP_SCHEMA), config.name_map)
    for day in days:
        end = dt.datetime.combine(day, dt.time(23, 59, 59, 999999))
        assert run_ingest(spark, batch, day, end)
    start_ingest(spark, stream, stream="s").awaitTermination()
    got = [sorted(map(tuple, tables.read_history(spark, c.history, "orc").collect())) for c in (batch, stream)]
    assert len(got[0]) == 8 and got[0] == got[1]
    for day in days:
        assert spark.read.option("header", True).csv(stream.report(day)).count() == 1


def test_bodies_that_are_no_objects_are_set_aside(spark, config):
    land(spark, config, SPEC_W, DAY, doc_w({"name": "A", "price": {"value": 1}}), "[1,2]", "<html>", None, "")
    assert landing.scan_landed(spark, config, DAY, SPEC_W).count() == 1
    aside = spark.read.json(config.set_aside)
    assert {r.reason for r in aside.collect()} == {landing.NOT_AN_OBJECT}
    assert sorted(map(str, (r.value for r in aside.collect()))) == ["", "<html>", "None", "[1,2]"]


def test_an_emptied_load_leaves_no_rows(spark, config):
    fill(config, "2025-02-01")
    run_ingest(spark, config, dt.date(2025, 2, 1), dt.datetime(2025, 2, 1, 1, 0))
    put(config, DAY, "watson_a_0.json", doc_w({"name": "A", "price": {"value": 9}}))
    assert run_ingest(spark, config, DAY, RUN)
    assert tables.read_history(spark, config.history).count() == 3
    put(config, DAY, "watson_a_0.json", doc_w())
    assert not run_ingest(spark, config, DAY, RUN)
    assert tables.read_history(spark, config.history).count() == 2


def test_days_outside_the_file_time(spark):
    from shelflens.streaming.ingest import load_time

    rows = spark.createDataFrame(
        [(RUN, None), (RUN, DAY), (RUN, dt.date(2025, 1, 30)), (RUN, dt.date(2025, 2, 1))],
        "modified timestamp_ntz, day date",
    )
    got = [r[0] for r in rows.select(load_time(F.col("modified"), F.col("day"))).collect()]
    last = dt.datetime(2025, 1, 30, 23, 59, 59, 999999)
    assert got == [RUN, RUN, last, dt.datetime(2025, 2, 1)]


def test_only_rejects_are_kept_with_their_place(spark):
    from shelflens.plans import ingest

    text = doc_l({"name": "A", "price": 1}, None, {"name": "B", "price": 2})
    decoded = ingest.decode_sources({SPEC_L: docs(spark, text, "{"), SPEC_W: docs(spark, "[]")})
    rows = ingest.reject_places(decoded).collect()
    assert sorted((str(r.file), str(r.pos), str(r.product_name), str(r.reason)) for r in rows) == [
        ("None", "None", "A", "None"), ("None", "None", "B", "None"), ("f0", "1", "None", "product is no object"),
        ("f0", "None", "None", "not an object"), ("f1", "None", "None", "not json"),
    ]


def test_an_empty_text_is_falsy_without_a_second_look(spark):
    from shelflens.functions import variants as V

    rows = spark.createDataFrame([("", '{"a":"x"}'), ("0", '{"a":"0"}'), ("0", '{"a":0}')], "t string, j string")
    got = rows.select(V.is_truthy_text(F.col("t"), F.parse_json("j"), "$.a").alias("x")).collect()
    assert [r.x for r in got] == [False, True, False]


def files_below(path):
    return [f for _, _, names in os.walk(path) for f in names if not f.startswith((".", "_"))]


def test_landed_and_rejected_text_is_compressed(spark, config, monkeypatch):
    monkeypatch.setattr(landing, "LANDED_FILE_DOCUMENTS", 2)
    bodies = [doc_w({"name": f"P{i}", "price": {"value": i}}, None) for i in range(5)]
    rows = spark.createDataFrame([(n, RUN, b) for n, b in enumerate([*bodies, "[1]"])], "page int, ts timestamp_ntz, body string")
    shop = F.lit(SPEC_W.envelope_name)
    stamped = landing.stamp_envelopes(rows.coalesce(1), shop=shop, query=F.lit("q"), page=F.col("page"), fetched_at=F.col("ts"))
    landing.land_envelopes(stamped, config)
    # Three of two documents at most, as a compressed file is one task's.
    assert len(files_below(config.landed_root)) == 3
    assert run_ingest(spark, config, DAY, RUN)
    for path in (config.landed_root, config.set_aside, config.quarantine):
        assert all(f.endswith(".json.gz") for f in files_below(path)) and files_below(path)
    assert sorted(r.product_name for r in tables.read_history(spark, config.history).collect()) == [f"P{i}" for i in range(5)]
    assert spark.read.json(config.quarantine).count() == 5 and spark.read.json(config.set_aside).count() == 1


def test_one_pass_reads_each_shop_by_its_spec(spark):
    texts = [
        doc_l({"name": "A", "salePrice": "0", "price": 1}, {"product_name": "B", "salePrice": 0, "price": 2}, None, 3),
        doc_w({"name": "C", "price": {"value": 0}}, {"name": "", "price": {"value": 1}}, "x"), "{", "[]", '{"products":{"a":1}}',
        '{"data":{"products":[1]}}', "{}", '{"data":{"products":{"products":5}}}', None,
    ]
    shops = [SHOP_L, SHOP_W, "other", None]
    rows = [(f"{s}{i}", t, s, i) for i, t in enumerate(texts) for s in shops]
    every = spark.createDataFrame(rows, "file string, value string, shop string, n int")
    got = FL.decode_shops(every, (SPEC_L, SPEC_W), carry=("n",))
    want = [
        FL.decode_products(every.filter(F.col("shop") == s.name), s, ("n",)).withColumn("shop", F.lit(s.name))
        for s in (SPEC_L, SPEC_W)
    ]
    want = want[0].unionByName(want[1])
    key = lambda frame: sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))
    assert key(got) == key(want) and got.filter("reason is null").count() == 3
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_a_load_caches_nothing(spark, config, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from shelflens.streaming.ingest import load_batch

    def refuse(*_):
        raise AssertionError("the text or the rows of a load are larger than the executors")

    rows = [("x/watson_1.json", SHOP_W, DAY, RUN, doc_w({"name": "A", "price": {"value": 1}}, None))]
    batch = spark.createDataFrame(rows, "file string, shop string, day date, modified timestamp_ntz, value string")
    monkeypatch.setattr(DataFrame, "persist", refuse)
    load_batch(config, "s", report=False)(batch, 1)
    assert tables.read_history(spark, config.history).count() == 1 and spark.read.json(config.quarantine).count() == 1
    assert not files_below(config.staged)


def test_days_are_cut_into_slices():
    from shelflens.plans.ingest import load_slices

    days = [dt.date(2025, 1, d) for d in range(1, 8)]
    counts = [(d, SHOP_W, n) for d, n in zip(days, [3, 4, 5, 20, 1, 1])] + [(days[6], SHOP_L, 6), (days[6], SHOP_W, 3)]
    assert load_slices(counts, 8) == [
        (days[:2], None), (days[2:3], None), (days[3:4], None), (days[4:6], None), (days[6:], SHOP_L), (days[6:], SHOP_W),
    ]
    assert load_slices(counts, 100) == [(days, None)] and load_slices([], 8) == []


@pytest.mark.parametrize("most", [1, 2, 1000])
def test_a_load_in_slices_is_the_same_load(spark, config, monkeypatch, most):
    from shelflens.plans import ingest

    monkeypatch.setattr(ingest, "SLICE_ROWS", most)
    days = [dt.datetime(2025, 1, 30, 5), dt.datetime(2025, 1, 31, 6), dt.datetime(2025, 2, 1, 7)]

    def load(*names):
        shop = lambda name: SHOP_L if name in "CG" else SHOP_W
        rows = [(n, float(i), ts, shop(n), None, "f", 0) for i, (n, ts) in enumerate(names)]
        kind = "product_name string, sale_price double, ts timestamp_ntz, ecommerce_name string, reason string, file string, pos int"
        loads = ingest.store_load(spark.createDataFrame(rows, kind), config, F.col("ts"), "x")
        stored = spark.read.parquet(config.history).collect() if loads else []
        latest = tables.read_snapshots(spark, config.snapshots).collect() if loads else []
        assert {r.load_id for r in [*stored, *latest]} <= {"x"} and not files_below(config.staged)
        return loads, sorted((r.product_name, r.ingest_timestamp_utc) for r in stored), sorted((r.product_name, r.day) for r in latest)

    first = [("A", days[0]), ("A", days[0]), ("B", days[1]), ("C", days[2]), ("D", days[2])]
    latest = [("A", days[0].date()), ("B", days[1].date()), ("C", days[2].date()), ("D", days[2].date())]
    assert load(*first) == (days, first, latest)
    # Again, and then with less: nothing comes twice, nothing of a day that is gone from a sliced load stays.
    assert load(*first) == (days, first, latest)
    again = [("E", days[1]), ("F", days[1]), ("G", days[1]), ("H", days[2])]
    assert load(*again) == (days[1:], again, [("E", days[1].date()), ("F", days[1].date()), ("G", days[1].date()), ("H", days[2].date())])
    if most < 1000:
        assert load(*first[:2], ("B", days[1])) == (days[:2], first[:3], latest[:2])
    assert load() == ([], [], [])


def test_shuffle_files_go_when_a_write_has_run(spark):
    from shelflens.operators.keep import shuffles_let_go

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_let_go(spark):
        mode = spark.range(9).repartition(3)._jdf.queryExecution().shuffleCleanupMode().toString()
    assert mode.startswith("RemoveShuffleFiles") and spark.conf.get(name) == before
