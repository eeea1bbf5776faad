"""Times the headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line.

The inputs (visits, app events, lifetime values) are derived once and timed on their own.
Each query then starts from the inputs again: no stage table is shared between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from journeylens.plans.queries import _BUILD, finish  # noqa: E402
from journeylens.plans.stages import Stages  # noqa: E402
from journeylens.runtime import session  # noqa: E402

INPUTS = ["visits", "app_events", "user_ltv"]
HEADLINE = [
    "distinct_classified", "conversion_windows_all", "attr_time_decay", "markov_transitions", "markov_removal_effect",
    "channel_totals", "avg_ltv_per_channel", "mart_removal_ltv", "median_days_to_convert", "median_days_by_conv_date",
    "rolling_cohort_90", "daily_purchases", "daily_engagement",
]
# Touch most code paths once before the clock runs.
WARM_UP = ["channel_totals", "mart_removal_ltv", "daily_purchases"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    inputs = Stages(spark, folder)
    for name in INPUTS:
        start = time.perf_counter()
        getattr(inputs, name)
        times[f"input_{name}"] = time.perf_counter() - start

    def run(name: str) -> float:
        fresh = Stages(spark, folder)
        for given in INPUTS:
            fresh.__dict__[given] = getattr(inputs, given)
        start = time.perf_counter()
        finish(_BUILD[name](fresh)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in WARM_UP:
        run(name)
    for name in HEADLINE:
        taken = sorted(run(name) for _ in range(runs))
        times[name] = taken[len(taken) // 2]
    print(
        json.dumps(
            {
                "metric": "headline attribution queries, warm, total",
                "value": round(sum(times[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": {name: round(taken, 3) for name, taken in times.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
