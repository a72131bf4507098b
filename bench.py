"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is run to completion with a no-op sink, so all of its columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridloom.catalog import all_queries
from gridloom.core.session import build_session, use_folder

HEADLINES = (
    "offline_events",
    "quarter_hour_resample",
    "ffill_hourly",
    "interp_hourly",
    "time_weighted_step",
    "time_weighted_continuous",
    "dedupe_first",
    "spike_ratio",
    "iqr_outliers",
    "rolling_z_outliers",
    "null_outliers",
    "flatline_runs",
    "autoqc_summary",
    "changed_ranges",
    "r2_by_sensor",
    "profile_backfill",
    "asof_target",
    "excursion_events",
    "overlap_clip",
    "event_category_summary",
    "report_rows",
    "inverter_totals",
    "site_totals",
    "unit_hours",
    "setpoint_curtailment_daily",
    "market_curtailment_daily",
    "combiner_daily_flags",
    "kpi_reconcile",
    "insurance_claim",
    "wide_hours_melt",
    "interval_ending_shift",
    "settlement_pivot",
    "dst_repair",
    "daylight_flag",
    "pipeline_status",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_folder(spark, tempfile.mkdtemp(prefix="gridloom-"))
    queries = all_queries()
    spark.read.parquet(f"{sf}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
