"""Curtailment by set-point, by market dispatch and from invoices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import clip, floor_time, sum0
from gridloom.operators.timeaxis import resample

RATE_PER_KWH = 0.0625  # fixed value: revenue rate of the set-point report


def curtailed_power(setpoint: Column, possible: Column, meter: Column, capacity: Column) -> Column:
    """Power held back: possible minus metered while the set-point binds, else zero."""
    binds = (setpoint < capacity) & (setpoint < possible) & (possible > meter)
    return F.when(binds, possible - meter).otherwise(0.0)


def effective_setpoint(command: Column, setpoint: Column, capacity: Column) -> Column:
    """Set-point in force: without a command the plant runs at capacity."""
    return F.when(command == 0, capacity).otherwise(setpoint)


def setpoint_intervals(df: DataFrame, capacity: Column, scaling: float = 1.0) -> DataFrame:
    """Minute rows with curtailed energy (kWh), lost revenue and a curtailment count.

    Possible power (MW) is bounded by the capacity before scaling.
    """
    possible = clip("possible_mw", upper=capacity) * scaling
    df = df.withColumn("possible_mw", possible)
    kw = curtailed_power(F.col("setpoint_mw"), F.col("possible_mw"), F.col("meter_mw"), capacity) * 1e3
    return (
        df.withColumn("curtailed_kwh", kw / 60)
        .withColumn("lost_revenue", F.col("curtailed_kwh") * RATE_PER_KWH)
        .withColumn("n_curtailments", F.when(F.col("curtailed_kwh") > 0, 1).otherwise(0))
    )


def interval_totals(intervals: DataFrame, keys: Sequence[str], seconds: int = 300, ts="ts") -> DataFrame:
    """Sums of energy, revenue and counts and means of the rest per bucket."""
    sums = [sum0(c).alias(c) for c in ("curtailed_kwh", "lost_revenue")]
    means = [F.avg(c).alias(c) for c in ("possible_mw", "meter_mw", "setpoint_mw")]
    counts = [F.sum("n_curtailments").alias("n_curtailments")]
    return resample(intervals, keys, seconds, [*sums, *counts, *means], ts)


def daily_summary(intervals: DataFrame, keys: Sequence[str], ts="ts", per_hour: int = 60) -> DataFrame:
    """Energy, hours and revenue per day plus a total row with a null day."""
    return (
        intervals.rollup(*keys, F.to_date(ts).alias("day"))
        .agg(
            sum0("curtailed_kwh").alias("curtailed_kwh"),
            (F.sum("n_curtailments") / per_hour).alias("curtailed_hours"),
            sum0("lost_revenue").alias("lost_revenue"),
            F.grouping_id().alias("_g"),
        )
        .filter(F.col("_g") <= 1)
        .drop("_g")
    )


def compare_sources(sources: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Total curtailed MWh of each source side by side."""
    tagged = [
        df.groupBy(*keys).agg((sum0("curtailed_kwh") / 1e3).alias("mwh")).withColumn("source", F.lit(n))
        for n, df in sources.items()
    ]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other)
    return union.groupBy(*keys).pivot("source", list(sources)).agg(F.first("mwh"))


def market_intervals(df: DataFrame, capacity: Column) -> DataFrame:
    """Five-minute dispatch rows with set-point, lost energy (MWh), revenue and events.

    A missing instruction means none.  Without instruction the set-point is the capacity,
    otherwise the dispatch target.  ``possible_mw`` is bounded by the capacity.
    """
    df = df.withColumn("supp", F.coalesce("supp", F.lit(0.0)))
    df = df.withColumn("possible_mw", clip("possible_mw", upper=capacity))
    setpoint = F.when(F.col("supp") == 0, capacity).otherwise(F.col("dot"))
    lost = curtailed_power(F.col("setpoint_mw"), F.col("possible_mw"), F.col("meter_mw"), capacity)
    return (
        df.withColumn("setpoint_mw", setpoint)
        .withColumn("lost_mwh", lost / 12)
        .withColumn("lost_revenue", F.col("lost_mwh") * F.col("rate_per_kwh") * 1000)
        .withColumn("n_events", F.when(F.col("lost_mwh") > 0, 1).otherwise(0))
    )


def market_hourly(df: DataFrame, keys: Sequence[str], capacity: Column, ts="ts") -> DataFrame:
    """Hourly dispatch target, instruction sum and resulting set-point."""
    hourly = df.groupBy(*keys, floor_time("hour", ts).alias("hour_start")).agg(
        (sum0("dot") / 12).alias("dot"),
        (sum0("supp") / 12).alias("supp"),
        F.count_if(F.col("supp") < 0).alias("n_negative"),
    )
    return hourly.withColumn("setpoint_mw", F.when(F.col("supp") >= 0, capacity).otherwise(F.col("dot")))


def market_daily(df: DataFrame, keys: Sequence[str], ts="ts") -> DataFrame:
    """Lost energy, events and revenue per day."""
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        sum0("lost_mwh").alias("lost_mwh"),
        F.sum("n_events").alias("n_events"),
        sum0("lost_revenue").alias("lost_revenue"),
    )


def scada_rows(df: DataFrame, start: str, end: str, ts="ts_utc", offset_hours: int = 6) -> DataFrame:
    """Database interval rows in plant time with the computed curtailment (kW).

    The range test runs on the shifted clock and includes the end.
    """
    local = F.col(ts) - F.expr(f"interval {offset_hours} hours")
    binds = (
        (F.col("expected_kw") > F.col("meter_kw"))
        & (F.col("limit_kw") < F.col("capacity_kw"))
        & (F.col("expected_kw") > F.col("limit_kw"))
    )
    shifted = F.expr(f"interval {offset_hours} hours")
    # compare the stored column with shifted bounds so the filter reaches the source
    in_range = (F.col(ts) >= F.lit(start).cast("timestamp_ntz") + shifted) & (
        F.col(ts) <= F.lit(end).cast("timestamp_ntz") + shifted
    )
    return (
        df.filter(in_range)
        .withColumn("ts", local)
        .withColumn("curtailed_kw", F.when(binds, F.col("expected_kw") - F.col("meter_kw")).otherwise(0.0))
    )


def invoice_totals(invoices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Curtailed MWh per site and month from the invoice in force.

    A final invoice goes before a preliminary one, then the later file counts.
    """
    per_file = invoices.groupBy(*keys, "file").agg(
        sum0("mwh").alias("mwh"), F.max("file_ts").alias("file_ts")
    )
    rank = F.struct(F.lower("file").contains("final"), F.col("file_ts"), F.col("file"))
    return per_file.groupBy(*keys).agg(
        F.max_by("mwh", rank).alias("total_mwh"), F.max_by("file", rank).alias("source")
    )
