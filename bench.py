"""Benchmark the headline queries.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set),
``BENCH_RUNS`` (default 2: one cold run, then warm runs; the warm median is
reported), ``BENCH_EVENTLOG_DIR`` (optional: write Spark's event log there for
stage and task times).  Each query is executed completely with the ``noop`` sink (no
driver collect).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenlens.plans import all_queries  # noqa: E402
from listenlens.session import get_spark  # noqa: E402

HEADLINE = [
    "top_tracks", "top_by_genre", "top_by_each_genre", "interaction_core", "holdout_test",
    "negative_samples", "item_cosine", "recommend_all", "precision_at_10", "recommend_titles",
    "lyrics_postings", "theme_chart", "similar_words", "theme_chart_expanded", "cosine_top_k",
    "user_profile", "taste_vector", "content_recommend", "training_set", "stratified_split",
    "classified_theme_chart", "svd_recommend", "als_recommend", "bow_features", "theme_classifier",
    "classifier_accuracy",
]


def run_once(spark, q, sf_dir: str) -> float:
    t0 = time.perf_counter()
    q.build(spark, sf_dir).write.mode("overwrite").format("noop").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {"spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
             "spark.ui.showConsoleProgress": "false"}
    if os.environ.get("BENCH_EVENTLOG_DIR"):  # stage/task times without the web UI
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG_DIR"]})
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                      app_name="listenlens-bench", extra=extra)
    registry = all_queries()
    # JVM and Python-worker start-up are not query time: one trivial job first
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm, failed = {}, {}, {}
    for name in names:
        q = registry[name]
        try:
            times = [run_once(spark, q, sf_dir) for _ in range(runs)]
        except Exception as e:  # keep benchmarking the rest; report the failure
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        cold[name] = round(times[0], 3)
        warm[name] = round(statistics.median(times[1:]) if len(times) > 1 else times[0], 3)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum of warm per-query seconds (headline queries)",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        **({"failed": failed} if failed else {}),
    }))


if __name__ == "__main__":
    main()
