"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3). Each query runs once to warm up, then BENCH_RUNS times; the median
counts. Results are computed in full and thrown away. The scorecard, which is
about a hundred stages long, is timed once after its warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

import querybook
from gradewell.session import session

HEADLINE = [
    "encounter_profile",
    "encounter_rollup",
    "pct_rank_avg",
    "pct_rank_many",
    "attach_median",
    "category_counts",
    "star_left_join",
    "step_estimate",
    "letter_mean",
    "rows_of_latest_date",
    "lag_gap",
    "last_per_group",
    "threshold_flags",
    "extract_links",
    "deficiency_table",
    "scorecard_table",
]
ONCE = {"scorecard_table"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    book = querybook.queries()

    def timed(name: str) -> float:
        start = time.perf_counter()
        book[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        timed(name)
        times = [timed(name) for _ in range(1 if name in ONCE else runs)]
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
