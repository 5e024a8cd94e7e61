"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the cores.
Each query is warmed up once, then timed; the value is the sum of the medians. Results go
to the no-op sink, so every output column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "feat_rt_scored", "feat_ml_table", "feat_rt_full", "agg_user_stats", "user_profiles", "profile_preferences",
    "win_velocity", "win_amount_stats", "win_frequency", "join_anti_processed", "join_raw_processed", "insert_if_absent",
    "decode_json_tx", "detect_new_device", "detect_geo_outlier", "detect_merchant_burst", "balanced_sample",
    "stratified_split", "train_matrix", "ab_compare", "smote_oversample", "stream_features", "stream_user_profiles",
    "win_heavy_users", "knn_minority", "knn_matrix", "stream_behavioural",
)
LONG = ("knn_minority", "knn_matrix", "stream_behavioural", "smote_oversample", "stream_features", "stream_user_profiles")


def main() -> None:
    from riskloom.plans import registry
    from riskloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        runs = []
        for _ in range(2 if name in LONG else 4):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events,
        "events_per_second": {n: round(events / times[n]) for n in ("feat_rt_scored", "feat_ml_table", "stream_features") if n in times},
    }))


if __name__ == "__main__":
    main()
