"""Session settings that every job expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "shelflens", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with runtime re-planning; ``conf`` adds or replaces settings.

    One BLAS thread per Python worker: Spark already runs one worker per core.
    """
    for var in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(var, "1")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Kept results go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # As in most JSON readers, the last of two equal keys counts.
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
