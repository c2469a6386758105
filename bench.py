"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full with the ``noop`` sink (no rows travel to the driver).  An
untimed warm-up pass runs every headline query once on the smallest scale factor first, so
JVM JIT and whole-stage-codegen compilation (a constant per plan shape, irrelevant at
cluster scale) is not charged to whichever query happens to use a plan shape first; the
output says so in ``warmup``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rate_asof_cost", "rate_asof_many_keys", "daily_cost", "monthly_rollup", "rate_interval_cost",
    "rate_prorated", "rate_unmatched", "consumption_dedup", "consumption_range", "earliest_latest",
    "missing_intervals", "gap_slots", "rates_overlapping", "tariff_parse", "active_tariffs", "list_meters",
    "tariff_resolution", "day_report_demand", "day_report_temperature", "heating_unified",
    "heating_newer_than_state", "device_day_grid", "resume_window", "paged_results", "profile",
    "load_audit", "bill", "ingest_latency", "lake_roundtrip", "rate_asof_merge", "rate_prorated_remainder", "gap_runs", "gap_trend",
    "bill_reconciliation",
]
#: Loads, merges and streams: each builds lakes of its own.
LOADS = [
    "lake_merge_idempotent", "compaction", "backfill_range", "backfill_chunked", "stream_dedup_state", "stream_late", "late_reprocess",
    "heating_lake_roundtrip", "rates_lake_roundtrip", "costed_lake_roundtrip", "consumption_lake_general", "consumption_range_meter",
    "scheduled_load", "heating_load", "cross_domain_daily", "recost_changed_rates", "incremental_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from intervalflow.session import build_session
    from intervalflow.plans.queries import QUERIES

    spark = build_session(master=f"local[{cpus}]", app="intervalflow-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm_names = only or HEADLINE      # the loads warm up on what the headline queries compiled
    if os.path.isdir(warm_dir):
        for name in warm_names:  # untimed: JIT + codegen warm-up on tiny inputs
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in (only or HEADLINE + LOADS):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not only:
        # The as-of join alone on materialised inputs (BASELINE's probe figures time the join, not the inputs).
        from intervalflow.operators.rates import rate_join
        from intervalflow.plans import fixtures as fx
        cons = fx.consumption(spark, sf_dir).checkpoint(eager=True)
        rates = fx.rates(spark, sf_dir).checkpoint(eager=True)
        t0 = time.perf_counter()
        rate_join(cons, rates, by=["tariff_code"]).write.format("noop").mode("overwrite").save()
        times["asof_join_prepared_inputs"] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "warmup": f"one untimed pass over the same queries on {warm_dir}"}))
    spark.stop()


if __name__ == "__main__":
    main()
