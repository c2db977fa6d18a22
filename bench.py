"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion without collecting rows.  Its time is the
median of BENCH_RUNS runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urbanflow.session import build_session  # noqa: E402
from urbanflow.workloads import QUERIES  # noqa: E402

HEADLINE = (
    "q01_daily_zone_rollup",
    "q03_zone_day_facts",
    "q04_zone_hour_facts",
    "q06_borough_hour_facts",
    "q08_complaint_facts",
    "q12_decoded_weather",
    "q13_master",
    "q16_flatten_object",
    "q18_monthly_funnel",
    "q24_mixed_resample",
    "q26_decomposition",
    "q27_unit_root",
    "q28_ols",
    "q32_seasonal_model",
    "q33_backtest",
    "q35_dedup",
)


def main(argv: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in argv or HEADLINE:
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
        print(name, times[name], [round(x, 2) for x in laps], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf.split("sf")[-1]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
