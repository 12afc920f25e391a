"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores. Every query runs in full: results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgertide.plans import queries
from ledgertide.session import build_session

HEADLINES = [
    "stg_bet_slip_events", "fct_lifecycle", "dim_fixture", "stg_rounds", "fct_activity", "game_sessions",
    "fct_ledger", "breach_wallet_overspend", "breach_deposit_limits", "breach_stake_limits",
    "rolling_deposit_audit", "activity_sessions", "readiness", "retry_state", "gaming_tax", "one_pass_rules",
    "provider_breaks", "legacy_field_breaks", "daily_recon", "envelope_batches", "pending_bets",
    "document_fr_bets", "betting_tax",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    run = queries.registered()
    run["market_players"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's workers
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
