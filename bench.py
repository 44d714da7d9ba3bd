"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, and
``BENCH_RUNS`` how often each query runs; the fastest run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import queries  # noqa: E402
from tallymart.session import local_session  # noqa: E402

HEADLINE = (
    "seller_scorecard",
    "seller_scorecard_1997",
    "seller_scorecard_state",
    "abc_classification",
    "abc_classification_1997",
    "delivery_by_state",
    "delivery_by_state_1997",
    "cohort_retention",
    "cohort_retention_1997",
    "orders_over_time",
    "orders_over_time_1997",
    "row_counts",
    "null_profile",
    "orphan_keys",
    "date_gaps",
    "duplicate_keys",
    "run_validation",
)


def _scale(folder: str) -> float | str:
    name = Path(folder).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "8g"))
    spark.conf.set("spark.sql.shuffle.partitions", str(cpus))
    available = queries()
    seconds: dict[str, float] = {}
    # Round by round, so that no query is timed only while the JVM is cold.
    for _ in range(runs):
        for name in HEADLINE:
            started = time.perf_counter()
            # Building counts too: some queries store an intermediate result.
            available[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = round(time.perf_counter() - started, 3)
            seconds[name] = min(taken, seconds.get(name, taken))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": _scale(folder),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
