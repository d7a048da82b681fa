"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from shelflens.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "price_report", "latest_cheapest", "latest_per_product", "map_join", "step_counts",
    "flatten_shop_l", "flatten_shop_w", "history_build", "json_quarantine", "price_clean",
    "envelope_stamp", "page_coverage", "distinct_names", "vector_norm", "cosine_topk",
    "cosine_topk_pivots", "lsh_topk", "ngram_vectors", "ngram_topk", "embedding_cache_misses",
    "embedding_lookup", "match_verified", "match_ratio_band", "name_map_build",
    "match_decide", "match_all_rows", "cosine_topk_blocked", "embedding_refresh", "judge_match",
    "name_map_update", "snapshot_merge",
]


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and Python's workers before the clock runs.
    QUERIES["price_report"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    QUERIES["cosine_topk"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
