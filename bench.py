"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Each query is
run once, from building its plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from finledger.registry import QUERIES
from finledger.session import build_session

HEADLINE = (
    "payments_per_day", "payment_parent_roundtrip", "charges_explode", "payments_search",
    "redact_payment", "merge_upsert", "skip_unchanged", "replace_children", "surrogate_ids",
    "insert_missing", "keep_last", "overlapping_windows", "latest_payments", "payments_by_status",
    "extract_records", "stitch_pages", "page_completeness", "balances_flatten",
    "statements_flatten", "transfer_accounts_flatten", "voucher_flatten", "normalize_movements",
    "natural_key_hash", "provisional_key", "provenance_split", "availability_matrix",
    "constraint_violations", "reconcile_snapshot", "width_audit", "run_ledger_fold",
    "last_run_per_process", "control_advance", "cap_cycle", "plan_slices", "latency_percentiles",
    "status_codes", "rejects_by_reason", "alert_5xx", "alert_gauge", "alert_absence",
    "signature_parse_and_age", "triage_events", "stream_metrics", "stream_dedup", "stream_upsert",
)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "finledger-bench",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{path}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
