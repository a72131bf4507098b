"""Interval summaries, scores and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, scan
from gridloom.core.quantiles import exact_quantiles
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import (
    add_time,
    bucket_start,
    floor_time,
    micros_between,
    sum0,
)
from gridloom.operators.lists import PART_ITEMS, join_null_safe, list_parts
from gridloom.operators.timeaxis import expand_steps

BASES = ("event_weighted", "time_weighted", "time_weighted_discrete", "time_weighted_continuous")


def with_group(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Attach group aggregates to every row by aggregate and join.

    Unlike a window over the group this pre-aggregates before the shuffle, and the
    aggregates are broadcast to the rows when their stored size allows it.
    """
    return df.join(sized(df.groupBy(*keys).agg(*aggs)), list(keys))


def segments(df: DataFrame, by: Series, bucket_seconds: int, value="value", ts="ts") -> DataFrame:
    """Cut the stretch from each recorded value to the next at the bucket edges."""
    rows = scan(df, by, lead={"_t1": ts, "_v1": value}).filter(F.col("_t1") > F.col(ts))
    width = bucket_seconds * 1_000_000
    rows = rows.withColumn("_b0", bucket_start(ts, bucket_seconds))
    touched = F.ceil(micros_between("_b0", "_t1") / F.lit(width))
    cut = expand_steps(rows, "_b0", touched, bucket_seconds, "bucket")
    return cut.withColumn("seg_start", F.greatest(ts, "bucket")).withColumn(
        "seg_end", F.least(F.col("_t1"), add_time("bucket", bucket_seconds))
    )


def interval_summary(
    df: DataFrame,
    by: Series,
    bucket_seconds: int,
    basis: str = "time_weighted",
    continuous: bool | None = None,
    value: str = "value",
    ts: str = "ts",
    good: str | None = None,
) -> DataFrame:
    """Total, average, minimum, maximum, range, count and percent good per bucket.

    ``event_weighted`` uses the recorded values alone.  The time-weighted bases weigh a
    value by the time it lasts: ``discrete`` holds it until the next one, ``continuous``
    draws a line to it.  ``total`` is in value hours.
    """
    if basis not in BASES:
        raise ValueError(f"unknown basis {basis}")
    keys = list(by.keys)
    if basis == "event_weighted":
        ok = F.count(value) if good is None else F.count(F.when(F.col(good), 1))
        return df.groupBy(*keys, bucket_start(ts, bucket_seconds).alias("bucket")).agg(
            sum0(value).alias("total"),
            F.avg(value).alias("average"),
            F.min(value).alias("minimum"),
            F.max(value).alias("maximum"),
            (F.max(value) - F.min(value)).alias("range"),
            F.count(value).alias("count"),
            (100.0 * ok / F.count("*")).alias("percent_good"),
        )
    if continuous is None:
        continuous = basis != "time_weighted_discrete"
    seg = segments(df, by, bucket_seconds, value, ts)
    dt = micros_between("seg_start", "seg_end").cast("double")
    if continuous:
        span = micros_between(ts, "_t1").cast("double")

        def at(point: str) -> Column:
            part = micros_between(ts, point).cast("double") / span
            return F.col(value) + (F.col("_v1") - F.col(value)) * part

        first, last = at("seg_start"), at("seg_end")
    else:
        first = last = F.col(value)
    usable = F.lit(True) if good is None else F.col(good)
    seg = (
        seg.withColumn("_dt", dt)
        .withColumn("_a", F.when(usable, first))
        .withColumn("_z", F.when(usable, last))
        .withColumn("_area", (F.col("_a") + F.col("_z")) / 2 * F.col("_dt"))
    )
    weight = F.sum(F.when(F.col("_area").isNotNull(), F.col("_dt")))
    low, high = F.min(F.least("_a", "_z")), F.max(F.greatest("_a", "_z"))
    return seg.groupBy(*keys, "bucket").agg(
        (sum0("_area") / 3.6e9).alias("total"),
        F.try_divide(F.sum("_area"), weight).alias("average"),
        low.alias("minimum"),
        high.alias("maximum"),
        (high - low).alias("range"),
        F.count(F.when(F.col("seg_start") == F.col(ts), F.col(value))).alias("count"),
        (100.0 * F.coalesce(weight, F.lit(0.0)) / (bucket_seconds * 1e6)).alias("percent_good"),
    )


def boundary_values(
    df: DataFrame, keys: Sequence[str], start: Column, end: Column, value="value", ts="ts"
) -> DataFrame:
    """Values at the two ends of a range, interpolated from the recorded neighbours.

    Where only one neighbour exists its value is used.
    """
    point = F.struct(ts, value)

    def side(pick, when) -> Column:
        return pick(point, F.when(when, F.col(ts)))

    near = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        side(F.max_by, F.col(ts) <= start).alias("_s0"),
        side(F.min_by, F.col(ts) >= start).alias("_s1"),
        side(F.max_by, F.col(ts) <= end).alias("_e0"),
        side(F.min_by, F.col(ts) >= end).alias("_e1"),
    )

    def interpolated(lo: str, hi: str, at: Column) -> Column:
        a, b = F.col(lo), F.col(hi)
        part = F.try_divide(
            micros_between(a[ts], at).cast("double"), micros_between(a[ts], b[ts]).cast("double")
        )
        line = a[value] + (b[value] - a[value]) * F.coalesce(part, F.lit(0.0))
        return F.coalesce(line, a[value], b[value])

    return near.select(
        *keys,
        interpolated("_s0", "_s1", start).alias("start_value"),
        interpolated("_e0", "_e1", end).alias("end_value"),
    )


def usable_items(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mark items without a single numeric value as omitted."""
    numeric = F.col(value).try_cast("double")
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), (F.count(numeric) == 0).alias("omitted")
    )


def across_assets(df: DataFrame, on: Sequence[str], value="value", flag: Column | None = None):
    """Row-wise mean, sum and maximum over assets, plus the all-bad flag."""
    flag = F.when(F.col(value).isNull(), 1).otherwise(0) if flag is None else flag
    return df.groupBy(*on).agg(
        F.avg(value).alias("mean"),
        sum0(value).alias("sum"),
        F.max(value).alias("max"),
        F.min(flag).alias("all_bad"),
    )


def month_hour_profile(df: DataFrame, keys: Sequence[str], value="value", ts="ts") -> DataFrame:
    return df.groupBy(*keys, F.month(ts).alias("month"), F.hour(ts).alias("hour")).agg(
        F.avg(value).alias("profile")
    )


def share_outside(
    df: DataFrame, keys: Sequence[str], low: float, high: float, value="value"
) -> DataFrame:
    """Share of rows below ``low`` or above ``high``; missing rows count as inside."""
    out = F.when((F.col(value) < low) | (F.col(value) > high), 1.0).otherwise(0.0)
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.avg(out).alias("share_outside"))


def spike_ratio(df: DataFrame, keys: Sequence[str], value="value") -> DataFrame:
    """How far the maximum stands above the 95th percentile; 0 where that is not positive."""
    p95 = exact_quantiles(df, keys, value, {"p95": 0.95}).drop("n_values")
    ratio = F.when(F.col("p95") > 0, (F.col("highest") - F.col("p95")) / F.col("p95")).otherwise(0.0)
    return p95.withColumn("ratio", ratio)


def iqr_bounds(df: DataFrame, keys: Sequence[str], multiplier=1.5, value="value") -> DataFrame:
    q = exact_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75}).select(*keys, "q1", "q3")
    reach = F.lit(multiplier) * (F.col("q3") - F.col("q1"))
    return q.withColumn("lower", F.col("q1") - reach).withColumn("upper", F.col("q3") + reach)


def iqr_outliers(df: DataFrame, keys: Sequence[str], multiplier=1.5, value="value") -> DataFrame:
    """Rows outside the interquartile bounds of their group, with the bounds."""
    bounds = sized(iqr_bounds(df, keys, multiplier, value).select(*keys, "lower", "upper"))
    return df.join(bounds, list(keys)).filter(
        (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))
    )


def r2_score(truth: str, predicted: str) -> Column:
    """Coefficient of determination of ``predicted`` against ``truth`` as an aggregate.

    Pairs with a missing side are left out.  A flat truth gives 1 for an exact match and
    0 otherwise; no pair gives null.
    """
    both = F.col(truth).isNotNull() & F.col(predicted).isNotNull()
    t = F.when(both, F.col(truth))
    rss = F.sum(F.when(both, F.pow(F.col(truth) - F.col(predicted), 2)))
    tss = F.var_pop(t) * F.count(t)
    flat = F.when(rss == 0, 1.0).otherwise(0.0)
    return F.when(F.count(t) > 0, F.when(tss == 0, flat).otherwise(1 - F.try_divide(rss, tss)))


def insolation(value: Column, step_hours: float) -> Column:
    """Irradiation in kWh per square metre from W per square metre, negatives left out."""
    return sum0(F.when(value >= 0, value)) * F.lit(step_hours / 1000.0)


def availability_minutes(
    df: DataFrame, keys: Sequence[str], threshold_kw: float = 0.1, value="value", ts="ts"
) -> DataFrame:
    """Minutes per hour with power above the threshold, for one-minute data."""
    on = F.when(F.col(value) > threshold_kw, 1).otherwise(0)
    return df.groupBy(*keys, floor_time("hour", ts).alias("hour_start")).agg(
        F.sum(on).alias("minutes_available")
    )


def missing_hours(df: DataFrame, keys: Sequence[str], value="value") -> DataFrame:
    """Missing count, share present and peak of each series."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col(value).isNull()).alias("n_missing"),
        (1 - F.count_if(F.col(value).isNull()) / F.count("*")).alias("share_present"),
        F.max(value).alias("peak"),
    )


def value_counts(df: DataFrame, parameter="parameter", value="value", holder="inverter", part_items=PART_ITEMS):
    """Per parameter and value: count, share within the parameter, list of holders.

    The list names each holder once, however many rows it has.  A long list has several rows,
    told apart by ``part``; the figures stand in each.
    """
    pairs = cut_lineage(df.groupBy(parameter, value, holder).agg(F.count("*").alias("_n")))
    counted = pairs.groupBy(parameter, value).agg(F.sum("_n").alias("count"))
    counted = join_null_safe(counted, list_parts(pairs, [parameter, value], holder, "holders", part_items), [parameter, value])
    totals = pairs.groupBy(parameter).agg(F.sum("_n").alias("_all"))
    return counted.join(totals, parameter).withColumn("share", F.col("count") / F.col("_all")).drop("_all")


def value_counts_wide(counts: DataFrame, parameter="parameter", value="value"):
    """One row per parameter holding its ranked counts and shares.

    As in the long table, rank 1 is the most frequent value.  There are as many ranks as the
    parameter with most values needs, so nothing is left out; ``counts`` is stored, since it
    is read twice.
    """
    counts = cut_lineage(counts.filter("part = 1").drop("holders", "part"))
    width = counts.groupBy(parameter).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
    order = F.array_sort(
        F.collect_list(F.struct((-F.col("count")).alias("neg"), F.col(value), "count", "share"))
    )
    ranked = counts.groupBy(parameter).agg(order.alias("_r"))
    cols = []
    for i in range(width):
        item = F.get("_r", F.lit(i))
        cols += [item["count"].alias(f"value_{i + 1}"), item["share"].alias(f"share_{i + 1}")]
    return ranked.select(parameter, *cols)
