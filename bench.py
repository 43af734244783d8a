"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3),
BENCH_QUERIES (comma-separated names, default the list below; ``all`` for every registered query).
Each time is the best of the repeats after one warm-up run; results go to Spark's noop sink, so whole
rows are computed and nothing is collected.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow.parquet as pq  # noqa: E402

from tablestream.plans.registry import load_all  # noqa: E402
from tablestream.session import get_spark  # noqa: E402

# query -> table whose rows it is rated by
HEADLINE = {
    "p01_select_rename": "events", "p09_classify": "orders", "f25_json_value": "events", "a02_sum_min_max_avg": "events",
    "a16_word_count": "documents", "a19_hot_keys": "events", "w01_tumble": "events", "w02_hop": "events", "w04_session": "events",
    "w07_rolling_features": "events", "o01_over_range": "events", "o04_lag": "events", "o06_locf": "events", "t01_dedup_last": "events",
    "t07_top_n": "lineitem", "j01_inner": "orders", "j10_interval": "events", "j11_asof": "events", "j21_multi_way": "lineitem",
    "j23_salted": "events", "c09_to_retract": "events", "x02_sequence_relaxed": "events", "m01_anomalies": "events", "d01_scalar_function": "events"}
RULE_OF_THUMB = {"simple": 10_000, "substantial": 5_000}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = get_spark("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    registry = load_all()
    names = list(registry) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    rows = {os.path.basename(f)[:-8]: pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{folder}/*.parquet")}
    times: dict[str, float] = {}
    for n in names:
        best = None
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            registry[n](spark, folder).write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            if i and (best is None or sec < best):
                best = sec
        times[n] = round(best if best is not None else sec, 4)
    rate = {n: round(rows[HEADLINE[n]] / s / cpus) for n, s in times.items() if n in HEADLINE}
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "rows_per_second_per_core": rate,
                      "baseline_rows_per_second_per_core": RULE_OF_THUMB}))
    spark.stop()


if __name__ == "__main__":
    main()
