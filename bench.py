"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR``  folder of the test tables   (default /root/testdata/sf0.1)
``BENCH_CPUS``    local cores                 (default 8)
``BENCH_RUNS``    runs of each query, best counts (default 2)
``BENCH_QUERIES`` comma-separated names, or ``all``

A run builds the plan and executes it completely; results go to Spark's no-op
sink, so all columns are computed and nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import time

from paylake.queries import registered
from paylake.session import build_session

HEADLINE = [
    "silver_merchants", "dim_merchants", "silver_link_tx", "silver_payments",
    "payment_reference", "payment_final", "fact_transactions",
    "never_reached_psp_overall", "payment_failure_rates", "payment_failure_rates_limited",
    "abandoned_by_merchant", "abandoned_by_merchant_limited",
    "failure_rate_by_payment_method", "failure_rate_by_payment_method_limited",
    "failure_rate_by_provider", "failure_rate_by_provider_limited",
    "match_rate_kpi", "method_switches", "extract_link_tx", "extract_payments",
    "sink_partition_replace", "fact_increment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    entries = registered()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(entries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    spark = build_session(
        app="paylake-bench",
        master=f"local[{cpus}]",
        extra={
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken: list[float] = []
        for _ in range(runs):
            start = time.perf_counter()
            entries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "paylake headline queries, best run, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
