"""Benchmark: time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and run to completion into the ``noop`` sink (all rows
computed, nothing collected).  The pitch input is recomputed from the driver
tables every time (5 joins), as in the baseline.  One untimed warm-up run
first, so the JVM is warm; then each query runs ``BENCH_REPEAT`` times
(default 3) and the best time is kept.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchlake import catalog  # noqa: E402
from pitchlake.session import get_session  # noqa: E402

HEADLINE = (
    "silver_base",          # filter + 72-column projection + row_number per game
    "team_game_stats",      # aggregate by (game, fielding team)
    "pitcher_yearly",       # names + aggregate by (season, pitcher, team, pitch) + rates
    "game_summary",         # flagship: header + home/away statistics per game
    "resolve_names",        # two dimension lookups
    "dominance_top20",      # top-k report
    "pitch_mix",            # side stack + aggregate by team
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    # Local mode runs every task in the driver JVM, so its heap is the executor memory
    # (the 1 GB default makes the wide silver sort spend its time in GC).
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="pitchlake-bench",
                        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("game_summary")  # warm-up
    times = {name: round(min(run(name) for _ in range(repeat)), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
