"""Catalog queries against their SQL, and the shape of their plans."""

import glob
import os
import re

import pytest

import __spark_entry__ as entry
from gridloom.catalog import all_queries, all_sql
from tools.audit_plans import findings
from tools.check_sql import rows_of

duckdb = pytest.importorskip("duckdb")

# one or two queries per operator family; tools/check_sql.py compares all of them
COMPARED = [
    "offline_events", "ffill_hourly", "interval_check", "time_weighted_continuous", "boundary_values", "iqr_outliers",
    "rolling_z_outliers", "null_outliers", "flatline_runs", "changed_ranges", "r2_by_sensor", "asof_target",
    "event_category_summary", "claim_days", "inverter_totals", "unit_hours", "market_curtailment_daily",
    "combiner_daily_flags", "kpi_reconcile", "wide_hours_melt", "dst_repair", "file_routing", "station_pick",
]
SCALAR_ONLY = {"rate_lookup_clamped", "outage_log_dates"}  # a global maximum or count of a summary
CONSTANT_KEY = {"natural_order"}  # one list by nature; only its chunk totals meet in one task


def explained(df):
    execution = df._jdf.queryExecution()
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(execution, "formatted")


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_contract():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(all_queries()) == set(all_sql()) and set(all_queries()) <= set(queries)
    assert len(all_queries()) > 140


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["site", "event_start", "event_end", "n_offline", "lost_mwh", "event_hours"]
    assert df.count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in rel.description], rel.fetchall())


@pytest.mark.parametrize("name", ["offline_events", "site_totals", "profile_backfill", "rate_lookup_clamped", "natural_order", "table_by_longest_word", "valid_attributes", "eligible_sites"])
def test_plans_have_no_cross_joins_or_single_tasks(spark, sf, name):
    found = set(findings(entry.queries()[name](spark, sf)))
    if name in SCALAR_ONLY | CONSTANT_KEY:
        found -= {"single partition", "window without keys"}
    assert not found


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = explained(entry.queries()["scada_curtailment"](spark, sf))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"}
    plan = explained(entry.queries()["invoice_curtailment"](spark, sf))
    assert "IsNotNull(o_custkey)" in plan and "c_acctbal" not in plan


def test_interval_filter_is_pushed_to_a_stored_column(spark, tmp_path):
    from pyspark.sql import functions as F

    from gridloom.plans.curtailment import scada_rows

    path = str(tmp_path / "rows")
    spark.range(10).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts_utc"),
        *[F.col("id").cast("double").alias(c) for c in ("expected_kw", "meter_kw", "limit_kw", "capacity_kw")],
    ).write.parquet(path)
    plan = explained(scada_rows(spark.read.parquet(path), "2024-01-01", "2024-02-01"))
    assert "GreaterThanOrEqual(ts_utc" in plan and "LessThanOrEqual(ts_utc" in plan
