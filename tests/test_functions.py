import json
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelflens.functions import text as TX
from shelflens.functions import variants as V
from shelflens.functions.numbers import clean_price, ieee_div


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (math.isnan(a) and math.isnan(b))


def python_price(text):
    try:
        return float(re.sub("[฿$,€]", "", text).strip())
    except ValueError:
        return None


PRICES = [
    "฿1,299.50", "THB 5", "1_000", "1e3", "nan", "-nan", "+NaN", "inf", "-inf", "+Infinity",
    "๑๒", "１２.５", "٣", "1.5d", "1.5f", "0x1p3", "true", "True", "1__0", "_1", "1_", "1e",
    "1.", ".", ".5", "-.5e-3", "", " ", " 5\x1f", " 5 ", "5\n", "1e999", "5 5", "+5",
    "--5", "1_0.0_1e1_0", "1.0E22", "£5", "1,2,3", "$", "infinit", "nanx", "1e5.0", "[5]", "{}",
]


def test_price_text_reads_like_python(spark):
    rng = random.Random(5)
    alphabet = "0123456789._eE+-, ฿$€dxn๑"
    texts = PRICES + ["".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", clean_price(F.col("t")).alias("p")).collect():
        assert same(python_price(r.t), r.p), (r.t, python_price(r.t), r.p)


def test_price_of_null_is_null(spark):
    row = spark.sql("SELECT CAST(NULL AS string) AS t").select(clean_price(F.col("t")).alias("p"))
    assert row.first().p is None


def test_truthiness_reads_like_python(spark):
    texts = [
        "null", '""', '"0"', "0", "0.0", "-0", "-0.0", "0e5", "0.00", "false", "true", "[]", "{}",
        "[null]", '{"a":null}', '"x"', "5", "-0.5", '" "', "1e-400", '"null"', '"[]"', "10",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", V.is_truthy(F.try_parse_json("t")).alias("x")).collect():
        assert r.x == bool(json.loads(r.t)), r.t


def test_missing_value_is_falsy(spark):
    v = F.try_parse_json(F.lit('{"a":1}'))
    row = spark.range(1).select(V.is_truthy(V.at(v, "$.b")).alias("x")).first()
    assert row.x is False


@pytest.mark.parametrize(
    "a,b,want",
    [
        (10.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, math.nan), (3.0, 2.0, 1.5),
        (None, 0.0, None), (1.0, None, None), (math.nan, 0.0, math.nan), (0.0, 5.0, 0.0),
    ],
)
def test_division_follows_ieee(spark, a, b, want):
    row = spark.createDataFrame([(a, b)], "a double, b double")
    assert same(row.select(ieee_div(F.col("a"), F.col("b")).alias("x")).first().x, want)


def test_safe_name_keeps_letters_and_numbers(spark):
    text = "ครีม Été 50ml/½-Ⅷ#🙂"
    want = "".join(c if unicodedata.category(c)[0] in "LN" else "_" for c in text)
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(TX.safe_name(F.col("t")).alias("x")).first().x == want


def test_time_texts(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'2025-01-31 01:00:05.123456' a, timestamp_ntz'2025-01-31 01:00:05' b"
    )
    r = rows.select(
        TX.iso_utc(F.col("a")), TX.iso_utc(F.col("b")), TX.day_text(F.col("a")),
        TX.object_stamp(F.col("a")), TX.report_stamp(F.col("a")),
        TX.object_name(F.lit("w"), F.lit("a b"), F.col("a"), F.lit(3)),
    ).first()
    assert list(r) == [
        "2025-01-31T01:00:05.123456+00:00", "2025-01-31T01:00:05+00:00", "2025-01-31",
        "20250131_010005", "2025-01-31_01-00-05", "pre_landing/2025-01-31/w_a_b_20250131_010005_3.json",
    ]


def grams(text):
    cps = [ord(c) for c in text.lower()]
    if not cps:
        return {}
    parts = [cps] if len(cps) < 3 else [cps[i : i + 3] for i in range(len(cps) - 2)]
    out = {}
    for p in parts:
        g = 0
        for c in p:
            g = (g << 21) + c
        out[g] = out.get(g, 0) + 1
    return out


def test_trigram_counts(spark):
    texts = ["", "a", "ab", "abc", "aaaaaa", "ครีมบำรุงผิว 50 มล.", "🙂🙂🙂🙂x", "Brand#1 BRAND#1", "a\nb\nc"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", TX.trigram_counts(F.lower("t")).alias("v")).collect():
        assert dict(zip(r.v.grams, r.v.tf)) == grams(r.t), r.t


def test_trigrams_of_a_whole_long_text(spark):
    text = " ".join(f"word{i % 977}" for i in range(20000))
    row = spark.createDataFrame([(text,)], "t string")
    v = row.select(TX.trigram_counts(F.lower("t")).alias("v")).first().v
    assert dict(zip(v.grams, v.tf)) == grams(text)


def test_words_and_numbers(spark):
    row = spark.createDataFrame([(" Cream  A cream 50ml 2.5 x50 ",)], "t string")
    r = row.select(TX.tokens(F.col("t")).alias("w"), TX.number_tokens(F.col("t")).alias("n")).first()
    assert sorted(r.w) == ["2.5", "50ml", "a", "cream", "x50"]
    assert r.n == ["2.5", "50", "50"]
