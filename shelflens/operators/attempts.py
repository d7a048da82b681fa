"""Work that may fail for some rows, tried again for those rows only."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.operators.keep import keep


def in_rounds(
    rows: DataFrame, work: Callable[[DataFrame], DataFrame], attempts: int = 3, pause: float = 0.0
) -> DataFrame:
    """``work(rows)`` with ``attempts``, the number of rounds that each row took.

    ``work`` adds columns to its rows, among them ``failed`` (not null). What a round has done
    is kept; only rows that failed go on to the next, after ``pause`` seconds, in which no task
    waits. A row that fails in every round stays, ``failed``. A lost executor or a task that is
    run again repeats no earlier round. Rounds run when this is called.
    """
    if attempts < 1:
        raise ValueError("at least one attempt")
    done, pending = [], rows
    for n in range(1, attempts + 1):
        tried = keep(work(pending).withColumn("attempts", F.lit(n)))
        failed = tried.filter("failed")
        done.append(tried.filter("NOT failed"))
        if n == attempts or failed.isEmpty():
            done.append(failed)
            break
        pending = failed.select(*[F.col(f"`{c}`") for c in rows.columns])
        if pause:
            time.sleep(pause)
    return reduce(DataFrame.unionByName, done)


def or_placeholder(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Rows that ``failed`` get ``values`` in place of what the work did not give."""
    return rows.withColumns(
        {name: F.when(F.col("failed"), value).otherwise(F.col(name)) for name, value in values.items()}
    )
