"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores.
Each query is run once to warm up (but for the jobs in SINGLE) and then timed; every result row is
produced and discarded.
"""

from __future__ import annotations

import json
import os
import time

from riskflow import build_session
from riskflow.catalogue import QUERIES

HEADLINE = (
    "txn_first_wins",
    "customers_first_wins",
    "txn_insert_if_absent",
    "txn_key_resolved",
    "txn_alerts",
    "score_band_matrix",
    "int_transaction_stats",
    "fact_transactions",
    "mart_fraud_summary",
    "mart_customer_360",
    "panel_daily_rate",
    "panel_top_customers",
    "health_status",
    "dq_report",
    "event_rate_15s",
    "event_rate_lag",
    "stream_alerts",
    "load_counters",
)
SINGLE = ("dq_report", "stream_alerts", "load_counters")


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        if name not in SINGLE:
            timed(lambda: QUERIES[name](spark, sf_dir))
        seconds[name] = round(timed(lambda: QUERIES[name](spark, sf_dir)), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**result, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
