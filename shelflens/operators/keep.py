"""Keep results that are read several times; spread work that is heavy per row."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_cached: ContextVar[list[DataFrame] | None] = ContextVar("cached", default=None)


@contextmanager
def released() -> Iterator[None]:
    """A job's scope: results that ``keep`` cached in it are let go at its end, also after an error.

    What the job returns must be written by then. Results in the shared folder need no scope:
    Spark removes their files once nothing refers to them (``get_session`` asks it to).
    """
    mine: list[DataFrame] = []
    token = _cached.set(mine)
    try:
        yield
    finally:
        _cached.reset(token)
        for rows in mine:
            rows.unpersist()


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """What is planned in it removes its shuffle files when it has run.

    Otherwise they stay until the driver happens to collect its garbage, which on a cluster can
    take half an hour. For writes: a result that is run twice would be shuffled twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def keep(rows: DataFrame) -> DataFrame:
    """``rows`` computed once, for results that are small beside what they come from.

    With ``spark.checkpoint.dir`` set they are written there: the plan behind them is
    cut off, and a lost executor does not bring it back. Without that shared folder
    they are cached, and lost parts are computed again; on a cluster that draws a warning.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and folder:
        context.setCheckpointDir(folder)
    if context.getCheckpointDir() is None:
        if not (context.master or "").startswith("local"):
            warnings.warn("spark.checkpoint.dir is not set: results are cached on executors", stacklevel=2)
        cached = rows.persist()
        if (open_scope := _cached.get()) is not None:
            open_scope.append(cached)
        return cached
    return rows.checkpoint()


def spread(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly before work that is heavy per row.

    The default number is the larger of the session's cores and its shuffle partitions, which
    are set by the size of the data, so that a cluster that has just started does not
    shrink the work. Nothing is run to find out.
    """
    spark = rows.sparkSession
    if partitions is None:
        shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(spark.sparkContext.defaultParallelism, shuffled)
    return rows.repartition(partitions)
