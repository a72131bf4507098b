"""Interval summaries from stored partial states, so that new rows need no second look at old ones.

A state sums up the rows of a series in one cell of time: the areas under its values, what
they weigh, bounds, counts, and its first and last point.  States of a series that follow each
other are put together by the stretches between them.  Days that arrive later add states;
rows that fall between stored ones change only the cells they fall into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, scan
from gridloom.core.session import sized
from gridloom.functions.scalars import add_time, bucket_start, micros_between, sum0
from gridloom.operators.timeaxis import expand_steps

CELL = "cell"
#: Ways to weigh values by time: held until the next value, or on a line to it.
STEP, LINE = "step", "line"


def _measures(kind: str, a: Column, z: Column, dt: Column) -> list[Column]:
    """Area, weight and bounds of stretches from value ``a`` to ``z``."""
    area = (a + z) / 2 * dt
    return [
        F.sum(area).alias(f"area_{kind}"), F.sum(F.when(area.isNotNull(), dt)).alias(f"weight_{kind}"),
        F.min(F.least(a, z)).alias(f"low_{kind}"), F.max(F.greatest(a, z)).alias(f"high_{kind}"),
    ]


def cell_states(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cell_seconds: int = 3600, value: str = "value"
) -> DataFrame:
    """One state for each series and cell.  ``order`` is the time stamp and what orders equal ones.

    A cell of one series is sorted in one task; cells are short enough for that.
    """
    ts = order[0]
    rows = df.withColumn(CELL, bucket_start(ts, cell_seconds))
    w = Window.partitionBy(*keys, CELL).orderBy(*order)
    rows = rows.withColumns({"_t1": F.lead(ts).over(w), "_v1": F.lead(value).over(w)})
    real = F.col("_t1") > F.col(ts)
    v, v1 = F.when(real, F.col(value)), F.when(real, F.col("_v1"))
    line, line1 = F.when(v1.isNotNull(), v), F.when(v.isNotNull(), v1)
    dt = F.when(real, micros_between(ts, "_t1").cast("double"))
    point, place = F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")), F.struct(*order)
    ends = [F.min_by(point, place).alias("first"), F.max_by(point, place).alias("last")]
    count = F.count(v).alias("count")
    return rows.groupBy(*keys, CELL).agg(count, *_measures(STEP, v, v, dt), *_measures(LINE, line, line1, dt), *ends)


def merge_rows(
    states: DataFrame, late: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str], cell_seconds: int = 3600, value: str = "value"
) -> DataFrame:
    """States with ``late`` rows taken in.

    ``rows`` holds the rows behind ``states``.  It is read only where late rows fall into a
    cell that has a state; other late rows make states of their own.
    """
    place = [*keys, CELL]
    touched = sized(late.withColumn(CELL, bucket_start(order[0], cell_seconds)).select(*place).distinct())
    old = rows.withColumn(CELL, bucket_start(order[0], cell_seconds)).join(touched, place, "left_semi").drop(CELL)
    fresh = cell_states(old.unionByName(late.select(*old.columns)), keys, order, cell_seconds, value)
    return states.join(touched, place, "left_anti").unionByName(fresh)


def summarize_states(states: DataFrame, keys: Sequence[str], bucket_seconds: int, kind: str = STEP) -> DataFrame:
    """The time-weighted summary of :func:`interval_summary` by bucket, from states alone.

    Buckets are whole cells.  A stretch between two states is cut at the bucket edges.
    """
    keys = list(keys)
    names = [f"{x}_{kind}" for x in ("area", "weight", "low", "high")]
    inner = states.select(*keys, bucket_start(CELL, bucket_seconds).alias("bucket"), "count", *names)
    flat = states.select(*keys, F.col("last.ts").alias("ts"), F.col("last.value").alias("value"), F.col("first.ts").alias("_t"), F.col("first.value").alias("_v"))
    gaps = scan(flat, Series(tuple(keys), ("ts",), "month"), lead={"_t1": "_t", "_v1": "_v"}).filter(F.col("_t1") > F.col("ts"))
    gaps = gaps.withColumn("_b0", bucket_start("ts", bucket_seconds))
    touched = F.ceil(micros_between("_b0", "_t1") / F.lit(bucket_seconds * 1_000_000))
    cut = expand_steps(gaps, "_b0", touched, bucket_seconds, "bucket")
    cut = cut.withColumns({"_s": F.greatest("ts", "bucket"), "_e": F.least("_t1", add_time("bucket", bucket_seconds))})
    dt = micros_between("_s", "_e").cast("double")
    if kind == STEP:
        a = z = F.col("value")
    else:
        span = micros_between("ts", "_t1").cast("double")
        a, z = (F.col("value") + (F.col("_v1") - F.col("value")) * (micros_between("ts", p).cast("double") / span) for p in ("_s", "_e"))
    starts = F.count(F.when(F.col("_s") == F.col("ts"), F.col("value"))).alias("count")
    outer = cut.groupBy(*keys, "bucket").agg(starts, *_measures(kind, a, z, dt))
    area, weight, low, high = names
    # a bucket without any stretch has no row, as in one pass
    out = inner.unionByName(outer).groupBy(*keys, "bucket").agg(
        F.sum("count").alias("count"), sum0(area).alias("_area"), F.sum(weight).alias("_weight"), F.min(low).alias("minimum"), F.max(high).alias("maximum"),
        F.max(F.col(weight).isNotNull() | (F.col("count") > 0)).alias("_any"),
    )
    return out.filter("_any").select(
        *keys, "bucket", (F.col("_area") / 3.6e9).alias("total"), F.try_divide(F.col("_area"), F.col("_weight")).alias("average"),
        "minimum", "maximum", (F.col("maximum") - F.col("minimum")).alias("range"), "count",
        (100.0 * F.coalesce("_weight", F.lit(0.0)) / (bucket_seconds * 1e6)).alias("percent_good"),
    )
