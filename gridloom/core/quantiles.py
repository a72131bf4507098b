"""Exact quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.session import sized

GRID = 1024
SKETCH_SIZE = 4096
# cells of the grid on both sides of a rank: thrice the rank error of a sketch of that size
MARGIN = 4
ROWS_TO_ORDER = 1_000_000


def value_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mergeable state of each group's values: ``lowest, highest, n_values, sketch``.

    Stored per series and day, states of new days join the old ones, and quantiles over any
    set of days come from ``merge_sketches`` without a scan for bounds.
    """
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min(value).alias("lowest"), F.max(value).alias("highest"), F.count("*").alias("n_values"),
        _sketch(value).alias("sketch"),
    )


def merge_sketches(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each group of ``keys`` from states of parts of it."""
    return states.groupBy(*keys).agg(
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"), F.sum("n_values").alias("n_values"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def _sketch(value: str) -> Column:
    return F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_SIZE))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    rows_to_order: int = ROWS_TO_ORDER, sketches: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles (``percentile`` semantics) with the extremes.

    One row per group with the quantiles, ``lowest``, ``highest`` and ``n_values``.  For
    every group and quantile a value range known to hold the wanted ranks is narrowed, by
    a quantile sketch of the range and exact counts below it, until it has at most
    ``rows_to_order`` rows or a round doesn't make it smaller, which happens when only few
    values are left in it.  Each range is settled by itself.  Only the rows of settled ranges
    are merged by value and ordered, so a group is never sorted or hashed as a whole, however
    large it is.

    ``sketches`` are stored states (``value_sketches``) that cover exactly the rows of ``df``,
    by finer keys perhaps.  They spare the scans for extremes and for the first bounds; what
    they propose is accepted only after an exact count, so the result is the same.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    if sketches is None:
        known = None
        extremes = sized(
            rows.groupBy(*keys).agg(
                F.min("_v").alias("lowest"), F.max("_v").alias("highest"), F.count("*").alias("n_values")
            )
        )
    else:
        merged = sized(merge_sketches(sketches, keys))
        known, extremes = merged.select(*keys, "sketch"), merged.drop("sketch")
    wanted = F.array(
        *[F.struct(F.lit(n).alias("_q"), F.lit(float(q)).alias("_p")) for n, q in quantiles.items()]
    )
    # zero-based rank of the quantile; the range starts as the whole group
    ranges = extremes.select("*", F.inline(wanted)).select(
        *keys, "_q",
        (F.col("_p") * (F.col("n_values") - 1)).alias("_rank"),
        F.col("lowest").alias("_lo"), F.col("highest").alias("_hi"),
        F.lit(0).cast("bigint").alias("_below"), F.col("n_values").alias("_inside"),
    )
    wide = (F.col("_inside") > rows_to_order) & (F.col("_lo") < F.col("_hi"))
    ranges = sized(ranges.withColumn("_open", wide))
    while not ranges.filter("_open").isEmpty():
        narrowed = _narrow(rows, ranges.filter("_open"), keys, known)
        known = None  # it describes whole groups, not the ranges of the next round
        shrunk = narrowed.withColumn("_open", wide & (F.col("_inside") < F.col("_was"))).drop("_was")
        ranges = sized(shrunk.unionByName(ranges.filter("NOT _open").select(shrunk.columns)))
    merged = _within(rows, ranges, keys).groupBy(*keys, "_q", "_v").agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy(*keys, "_q").orderBy("_v")
    placed = (
        merged.withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .join(ranges.select(*keys, "_q", "_rank", "_below"), [*keys, "_q"])
        .withColumn("_end", F.col("_below") + F.col("_upto"))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    rank = F.col("_rank")
    low, high = at(F.floor(rank)), at(F.ceil(rank))
    found = placed.groupBy(*keys, "_q").agg(
        (low + (high - low) * F.max(rank - F.floor(rank))).alias("_value")
    )
    wide = found.groupBy(*keys).pivot("_q", list(quantiles)).agg(F.first("_value"))
    return wide.join(extremes, keys)


def _within(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    hits = rows.join(ranges, list(keys))
    return hits.filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _narrow(rows: DataFrame, ranges: DataFrame, keys: Sequence[str], known: DataFrame | None) -> DataFrame:
    """One round: new bounds from a sketch of the range, accepted after an exact count."""
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    ids = [*keys, "_q"]
    if known is None:
        sketch = _within(rows, ranges, keys).groupBy(*ids).agg(_sketch("_v").alias("sketch"))
    else:
        sketch = ranges.select(*ids).join(known, keys)
    sketch = sketch.select(*ids, F.kll_sketch_get_quantile_double("sketch", steps).alias("_grid"))
    cell = F.floor((F.col("_rank") - F.col("_below")) / F.col("_inside") * GRID).cast("int")
    proposed = sized(
        ranges.join(sketch, ids)
        .withColumn("_new_lo", F.coalesce(F.get("_grid", F.greatest(cell - MARGIN, F.lit(0))), "_lo"))
        .withColumn("_new_hi", F.coalesce(F.get("_grid", F.least(cell + MARGIN + 1, F.lit(GRID))), "_hi"))
        .drop("_grid")
    )
    inside = (F.col("_v") >= F.col("_new_lo")) & (F.col("_v") <= F.col("_new_hi"))
    counts = _within(rows, proposed, keys).groupBy(*ids).agg(
        F.count_if(F.col("_v") < F.col("_new_lo")).alias("_less"), F.count_if(inside).alias("_kept")
    )
    start = F.col("_below") + F.col("_less")
    holds = (F.floor("_rank") >= start) & (F.ceil("_rank") < start + F.col("_kept"))

    def pick(new: Column, old: str) -> Column:
        return F.when(holds, new).otherwise(F.col(old)).alias(old)

    return sized(
        proposed.join(counts, ids).select(
            *ids, "_rank", pick(F.col("_new_lo"), "_lo"), pick(F.col("_new_hi"), "_hi"),
            pick(start, "_below"), pick(F.col("_kept"), "_inside"), F.col("_inside").alias("_was"),
        )
    )
