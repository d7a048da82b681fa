"""Run registered queries and their SQL side by side.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(x):
    if isinstance(x, float):
        return "NaN" if math.isnan(x) else round(x, 9)
    return x


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    """Whether both sides agree, with a short account."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    spark_s = time.time() - start
    if name not in ORACLES:
        return sum(ours.values()) > 0, f"{sum(ours.values())} rows, no SQL, {spark_s:.1f}s"
    start = time.time()
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    theirs = rows_of(columns, result.fetchall())
    sql_s = time.time() - start
    text = f"{sum(ours.values())} rows, {spark_s:.1f}s, sql {sql_s:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"{text}; columns {sorted(df.columns)} != {sorted(columns)}"
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        return False, (
            f"{text}; {sum(more.values())} extra e.g. {list(more)[:2]}, "
            f"{sum(less.values())} missing e.g. {list(less)[:2]}"
        )
    return True, text


def main() -> int:
    from shelflens.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            good, text = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            good, text = False, f"{type(error).__name__}: {str(error)[:400]}"
        bad += not good
        print("ok  " if good else "BAD ", name, text, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
