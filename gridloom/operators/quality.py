"""Automatic quality control of interval data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.ordered import BLOCK, EDGE_BLOCK, Series, rolling, runs, scan
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import clip, round_half_even, seconds_between
from gridloom.operators.naming import with_qc_type
from gridloom.operators.summaries import r2_score, share_outside, spike_ratio

# Plausible temperature range, wind limit and jump limit of the outlier rules.
TEMP_RANGE = (-30.0, 90.0)
WIND_LIMIT = 24.0
JUMP_LIMIT = 1000.0
SPIKE_RATIO = 5.0
BAD_SENSOR_SHARE = 0.70
NIGHT_LIMIT = 15.0
NEGATIVE_LIMIT = -5.0
# Shortest flat-line run in rows per class.
RUN_ROWS = {"default": 120, "TEMP": 240, "METER": 240, "PAD": 300, "WIND": 1440}
# Weather sensor limits.
SENSOR_LIMITS = {
    "poa": (0.0, 1500.0),
    "ghi": (0.0, 1500.0),
    "amb_temp": (-35.0, 150.0),
    "mod_temp": (-35.0, 150.0),
    "wind": (0.0, 75.0),
}


def drop_empty(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Leave out series without any value."""
    full = sized(df.groupBy(*keys).agg(F.count(value).alias("_n")).filter("_n > 0"))
    return df.join(full, list(keys), "left_semi")


def bad_temperature_sensors(
    df: DataFrame, site_keys: Sequence[str], sensor: str, value="value"
) -> DataFrame:
    """Temperature sensors mostly out of range; the least bad stays if all of a site are.

    ``df`` holds the temperature readings only.  A site's single sensor is never dropped.
    """
    low, high = TEMP_RANGE
    shares = sized(share_outside(df, [*site_keys, sensor], low, high, value)).withColumn(
        "_bad", F.col("share_outside") > BAD_SENSOR_SHARE
    )
    site = shares.groupBy(*site_keys).agg(
        F.count("*").alias("n_sensors"),
        F.count_if("_bad").alias("n_bad"),
        F.min(F.when(F.col("_bad"), F.struct("share_outside", sensor))).alias("_least"),
    )
    spared = (F.col("n_bad") == F.col("n_sensors")) & (F.col(sensor) == F.col("_least")[sensor])
    removed = F.col("_bad") & (F.col("n_sensors") > 1) & ~spared
    return shares.join(site, list(site_keys)).withColumn("removed", removed).drop("_bad", "_least")


def centred(expr: Column, w, before: int, after: int) -> Column:
    """Mean over a row window that is null unless every row in it has a value."""
    frame = w.rowsBetween(-before, after)
    return F.when(F.count(expr).over(frame) == before + after + 1, F.avg(expr).over(frame))


def jump_score(df: DataFrame, by: Series, value="value", block_rows=8192) -> DataFrame:
    """Centred mean over four rows of the absolute forward difference."""

    return rolling(df, by, *JUMP_HALO, lambda rows, w: _jumps(rows, w, value), block_rows).drop("_ordinal", "_block")


#: Rows before and after one that its jump, and its curvature, depend on.
JUMP_HALO, CURVE_HALO = (2, 2), (7, 9)


def _jumps(rows: DataFrame, w, value: str) -> DataFrame:
    rows = rows.withColumn("_d1", F.abs(F.lead(value).over(w) - F.col(value)))
    return rows.withColumn("jump", centred(F.col("_d1"), w, 2, 1)).drop("_d1")


def rolling_zscore(df: DataFrame, by: Series, rows_back: int, value="value", block_rows=8192):
    """Trailing z-score over ``rows_back`` rows; null until the window is full."""

    def build(rows, w):
        frame = w.rowsBetween(-(rows_back - 1), 0)
        full = F.count(value).over(frame) == rows_back
        mean, std = F.avg(value).over(frame), F.stddev_samp(value).over(frame)
        return rows.withColumn("zscore", F.when(full, F.try_divide(F.col(value) - mean, std)))

    return rolling(df, by, rows_back - 1, 0, build, block_rows).drop("_ordinal", "_block")


# Z-score window in rows by data interval in minutes.
ZSCORE_ROWS = {1: 30, 5: 6, 15: 4, 60: 2}


def null_outliers(df: DataFrame, by: Series, value="value", block_rows=8192) -> DataFrame:
    """Null out outliers by class and mark them in ``outlier``.

    Wind: beyond the wind limit.  Temperature: outside the plausible range.  Others: the
    mean jump over four rows is too high.  Inverter and wind series without a spike are
    left alone.
    """
    scored = with_qc_type(jump_score(df, by, value, block_rows))
    ratios = sized(spike_ratio(df, by.keys, value).select(*by.keys, "ratio"))
    out = scored.join(ratios, list(by.keys), "left").withColumn("outlier", outlier_rule(value))
    return out.withColumn(value, F.when(~F.col("outlier"), F.col(value))).select(
        *df.columns, "outlier"
    )


def outlier_rule(value="value") -> Column:
    """Whether a row is an outlier, from its class, its ``jump`` and the ``ratio`` of its series."""
    low, high = TEMP_RANGE
    rule = (
        F.when(F.col("is_wind"), F.abs(value) > WIND_LIMIT)
        .when(F.col("is_temp"), (F.col(value) < low) | (F.col(value) > high))
        .otherwise(F.col("jump") > JUMP_LIMIT)
    )
    quiet = (F.col("is_inv") | F.col("is_wind")) & (F.col("ratio") < SPIKE_RATIO)
    return F.coalesce(rule & ~F.coalesce(quiet, F.lit(False)), F.lit(False))


def mark_flat(
    df: DataFrame, by: Series, value="value", block_rows=8192, materialize=cut_lineage
) -> DataFrame:
    """Number the islands between rows whose curvature is not flat.

    Adds ``d1``, ``flat`` (row meets the flat-line condition) and ``island``.  Breaks are
    counted inside the rolling blocks; after storing that result only the block totals
    have to be carried on, so the rows are not shuffled again.
    """

    build = lambda rows, w: _curves(rows, w, value)
    return _with_islands(materialize(rolling(with_qc_type(df), by, *CURVE_HALO, build, block_rows)), by)


def mark_outliers_and_flat(
    df: DataFrame, by: Series, value="value", block_rows=8192, materialize=cut_lineage
) -> DataFrame:
    """:func:`null_outliers` and then :func:`mark_flat`, in one pass over the blocks.

    The halo of a block is wide enough for both, so rows get their place in the series once,
    go to their blocks once and are stored once.
    """
    ratios = sized(spike_ratio(df, by.keys, value).select(*by.keys, "ratio"))
    rated = with_qc_type(df).join(ratios, list(by.keys), "left")

    def build(rows, w):
        rows = _jumps(rows, w, value).withColumn("outlier", outlier_rule(value)).drop("jump", "ratio")
        return _curves(rows.withColumn(value, F.when(~F.col("outlier"), F.col(value))), w, value)

    halo = [a + b for a, b in zip(JUMP_HALO, CURVE_HALO, strict=True)]
    return _with_islands(materialize(rolling(rated, by, *halo, build, block_rows)), by)


def _curves(rows: DataFrame, w, value: str) -> DataFrame:
    """``d1``, ``flat`` and the breaks up to a row inside its block."""
    rows = rows.withColumn("d1", F.lead(value).over(w) - F.col(value))
    rows = rows.withColumn("_d2", F.lead("d1").over(w) - F.col("d1"))
    curve = round_half_even(centred(F.col("_d2"), w, 7, 7), 4)
    rows = rows.withColumn("_curve", curve).drop("_d2")
    own_break = (F.col("_home") == F.col(BLOCK)) & (F.abs("_curve") > 0)
    flat = (F.col("_curve") == 0) & (~F.col("is_inv") | (F.col(value) > 1))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_break", F.when(own_break, 1).otherwise(0))
        .withColumn("_passed", F.sum("_break").over(upto))
        .withColumn("flat", F.coalesce(flat, F.lit(False)))
        .drop("_curve", "_ordinal")
    )


def _with_islands(rows: DataFrame, by: Series) -> DataFrame:
    """Breaks up to a row in its whole series: those of earlier blocks are carried on."""
    keys = list(by.keys)
    totals = rows.groupBy(*keys, BLOCK).agg(F.sum("_break").alias("_sum"))
    # one row per block is a series of its own: its running total is chunked too
    upto = scan(totals, Series(tuple(keys), (BLOCK,), EDGE_BLOCK), total={"_upto": F.col("_sum")})
    carried = sized(upto.select(*keys, BLOCK, (F.col("_upto") - F.col("_sum")).alias("_carry")))
    return (
        rows.join(carried, [*keys, BLOCK], "left")
        .withColumn("island", F.col("_passed") + F.col("_carry"))
        .drop("_break", "_passed", "_carry", BLOCK)
    )


# What lets a flat run stand.  Shares are of night rows, lengths in hours.
MOSTLY_NIGHT, HALF_NIGHT, SOME_NIGHT, NO_NIGHT = 0.70, 0.5, 0.2, 0.05
LINEAR_HOURS, SHORT_HOURS, NIGHT_HOURS = 2.5, 2, 8
METER_LEVEL, POWER_LEVEL, DARK_LEVEL, LINEAR_STEP = 0.02, 25.0, 5, 1


def flat_runs(
    marked: DataFrame, keys: Sequence[str], value="value", ts="ts", attribute="attribute",
    run_rows: dict[str, int] = RUN_ROWS,
) -> DataFrame:
    """Statistics and verdict of every flat run: ``keep`` names the exemption that holds.

    ``marked`` comes from :func:`mark_flat` and carries ``is_day``.
    """
    night = ~F.col("is_day")
    stats = (
        marked.filter("flat")
        .groupBy(*keys, "island", "is_inv", "is_meter", "is_temp", "is_wind", "needs_sun")
        .agg(
            F.count("*").alias("n_rows"),
            F.min(ts).alias("run_start"),
            F.max(ts).alias("run_end"),
            F.avg(night.cast("double")).alias("night_share"),
            F.avg(value).alias("mean"),
            F.max(value).alias("highest"),
            F.avg(F.abs("d1")).alias("mean_step"),
            F.avg(F.when(night, F.col(value))).alias("night_mean"),
            F.max(F.when(night, F.col(value))).alias("night_highest"),
        )
    )
    limit = (
        F.when(F.col("is_temp") | F.col("is_meter"), run_rows["TEMP"])
        .when(F.col("is_inv") & F.col(attribute).contains("_Pad_"), run_rows["PAD"])
        .when(F.col("is_wind"), run_rows["WIND"])
        .otherwise(run_rows["default"])
    )
    hours = seconds_between("run_start", "run_end") / F.lit(3600.0)
    pn, mean = F.col("night_share"), F.col("mean")
    level = F.when(F.col("is_meter"), METER_LEVEL).otherwise(POWER_LEVEL)
    dark = F.col("night_mean") < DARK_LEVEL
    exemption = (
        F.when(F.col("is_temp") & (pn > MOSTLY_NIGHT), "night_temperature")
        .when((F.col("is_inv") | F.col("is_meter")) & (pn < NO_NIGHT) & (mean > level), "daylight_power")
        .when(
            (pn < NO_NIGHT) & (hours < LINEAR_HOURS) & (mean > POWER_LEVEL) & (F.col("mean_step") > LINEAR_STEP), "daylight_linear"
        )
        .when((pn > MOSTLY_NIGHT) & dark & (F.col("night_highest") < DARK_LEVEL), "night_zero")
        .when((pn > HALF_NIGHT) & (hours < NIGHT_HOURS) & dark & (F.col("highest") < level), "mostly_night_zero")
        .when((pn > SOME_NIGHT) & (hours < SHORT_HOURS), "short_partial_night")
        .when(F.col("is_meter") & (round_half_even(mean, 1) == 0), "meter_outage")
    )
    sheltered = F.col("needs_sun") | F.col("is_temp")
    return (
        stats.filter(F.col("n_rows") >= limit)
        .withColumn("keep", F.when(sheltered, exemption))
        .withColumn("removed", F.col("keep").isNull())
    )


def null_flat_runs(marked: DataFrame, verdicts: DataFrame, keys, value="value", ts="ts"):
    """Null every row between the first and last row of the removed runs."""
    spans = sized(verdicts.filter("removed").select(*keys, "island", "run_start", "run_end"))
    out = marked.join(spans, [*keys, "island"], "left")
    hit = F.coalesce(F.col(ts).between(F.col("run_start"), F.col("run_end")), F.lit(False))
    return (
        out.withColumn("flatline", hit)
        .withColumn(value, F.when(~F.col("flatline"), F.col(value)))
        .drop("run_start", "run_end", "island", "d1", "flat")
    )


def zero_night(df: DataFrame, value="value") -> DataFrame:
    """Sun-dependent values above the limit at night become zero (``night_zeroed``)."""
    hit = F.coalesce(
        F.col("needs_sun") & ~F.col("is_day") & (F.col(value) > NIGHT_LIMIT), F.lit(False)
    )
    return df.withColumn("night_zeroed", hit).withColumn(
        value, F.when(F.col("night_zeroed"), 0.0).otherwise(F.col(value))
    )


def zero_negative(df: DataFrame, value="value") -> DataFrame:
    """Irradiance below the negative limit becomes zero; not counted as processed."""
    hit = F.coalesce((F.col("is_poa") | F.col("is_ghi")) & (F.col(value) < NEGATIVE_LIMIT), F.lit(False))
    return df.withColumn("negative_zeroed", hit).withColumn(
        value, F.when(F.col("negative_zeroed"), 0.0).otherwise(F.col(value))
    )


def auto_qc(
    df: DataFrame, by: Series, site_keys: Sequence[str], value="value", ts="ts",
    attribute="attribute", run_rows=RUN_ROWS, block_rows=8192, materialize=cut_lineage,
) -> DataFrame:
    """The full automatic cleaning of readings that carry ``is_day``.

    Empty series go (sites without power attributes only), then bad temperature sensors,
    outliers, flat runs, night values and negative irradiance.  ``processed`` marks a
    changed row, except for negatives.  The readings are stored once, without outliers and
    with their flat runs marked, as later steps read them more than once.
    """
    ids = [*by.keys, *[c for c in (*site_keys, attribute) if c not in by.keys]]
    found = sized(df.groupBy(*ids).agg((F.count(value) == 0).alias("_empty")))
    inv_sites = with_qc_type(found, attribute).filter("is_inv").select(*site_keys).distinct()
    gone = found.filter("_empty").join(inv_sites, list(site_keys), "left_anti").select(*by.keys)
    temps = with_qc_type(df, attribute).filter("is_temp")
    bad = bad_temperature_sensors(temps, site_keys, attribute, value).filter("removed")
    bad = sized(bad)
    kept = df.join(gone, list(by.keys), "left_anti").join(
        bad.select(*site_keys, attribute), [*site_keys, attribute], "left_anti"
    )
    marked = mark_outliers_and_flat(kept, by, value, block_rows, materialize)
    verdicts = flat_runs(marked, by.keys, value, ts, attribute, run_rows)
    out = zero_negative(zero_night(null_flat_runs(marked, verdicts, by.keys, value, ts), value), value)
    return out.withColumn(
        "processed", F.col("outlier") | F.col("flatline") | F.col("night_zeroed")
    )


def qc_summary(cleaned: DataFrame, keys: Sequence[str]) -> DataFrame:
    flags = ["outlier", "flatline", "night_zeroed", "negative_zeroed", "processed"]
    return cleaned.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), *[F.count_if(f).alias(f"n_{f}") for f in flags]
    )


def limit_check(df: DataFrame, limits: DataFrame, sensor_type="sensor_type", value="value"):
    """Older limit rule: irradiance and wind floored at zero, then bad if outside or missing."""
    floored = F.when(
        F.col(sensor_type).isin("poa", "ghi", "wind") & (F.col(value) < 0), 0.0
    ).otherwise(F.col(value))
    out = df.join(limits, sensor_type, "left").withColumn(value, floored)
    inside = F.coalesce(F.col(value).between(F.col("lower"), F.col("upper")), F.lit(False))
    return out.withColumn("bad", (~inside).cast("int")).drop("lower", "upper")


def negative_check(df: DataFrame, sensor_type="sensor_type", value="value") -> DataFrame:
    """Current limit rule as it takes effect.

    Irradiance is bounded first (not counted as bad), negative wind becomes zero and bad,
    missing rows are bad; values above a limit only count in ``above``/``below``.
    """
    low = F.when(F.col(sensor_type).isin("poa", "ghi", "wind"), 0.0).otherwise(-35.0)
    high = (
        F.when(F.col(sensor_type).isin("poa", "ghi"), 1500.0)
        .when(F.col(sensor_type) == "wind", 75.0)
        .otherwise(150.0)
    )
    bounded = F.when(
        F.col(sensor_type).isin("poa", "ghi"), clip(value, 0.0, 1500.0)
    ).otherwise(F.col(value))
    out = df.withColumn(value, bounded)
    negative = F.coalesce((F.col(sensor_type) == "wind") & (F.col(value) < 0), F.lit(False))
    out = out.withColumn("negative", negative).withColumn(
        "cleaned", F.when(F.col("negative"), 0.0).otherwise(F.col(value))
    )
    return (
        out.withColumn("below", F.coalesce(F.col("cleaned") < low, F.lit(False)))
        .withColumn("above", F.coalesce(F.col("cleaned") > high, F.lit(False)))
        .withColumn("bad", (F.col("negative") | F.col("cleaned").isNull()).cast("int"))
    )


def clear_days(
    hourly: DataFrame, keys: Sequence[str], reference: str, measured: str, top: int, ts="ts"
) -> DataFrame:
    """Best ``top`` clear days of each site by the score against the clear-sky curve.

    Only days within 0.1 of a perfect score qualify; if a site has none, all its days do.
    """
    days = (
        hourly.groupBy(*keys, F.to_date(ts).alias("date"))
        .agg(r2_score(reference, measured).alias("r2"))
        .filter(F.col("r2").isNotNull())
        .withColumn("clear", F.abs(F.col("r2") - 1) < 0.1)
    )
    site = Window.partitionBy(*keys)  # one row per site and day
    pool = days.withColumn("_any", F.max("clear").over(site)).filter("clear OR NOT _any")
    rank = F.row_number().over(site.orderBy(F.desc("r2"), "date"))
    return pool.withColumn("rank", rank).filter(F.col("rank") <= top).drop("_any")


def sensor_scores(
    sensors: DataFrame, reference: DataFrame, days: DataFrame, site_keys: Sequence[str],
    sensor="attribute", value="value", ref="ref", ts="ts", max_gap=0.1,
) -> DataFrame:
    """Score of each sensor against the reference on the clear days.

    A sensor without data on those days scores -1000.  ``bad`` marks scores below
    ``1 - max_gap``; ``delta_pct`` is the distance from the mean score of the site.
    """
    keys = list(site_keys)
    chosen = sized(days.select(*keys, "date"))
    on_days = sensors.withColumn("date", F.to_date(ts)).join(chosen, [*keys, "date"], "left_semi")
    paired = on_days.join(reference.select(*keys, ts, ref), [*keys, ts], "left")
    scored = paired.groupBy(*keys, sensor).agg(r2_score(ref, value).alias("_r2"))
    out = sensors.select(*keys, sensor).distinct().join(scored, [*keys, sensor], "left")
    out = out.select(*keys, sensor, F.coalesce("_r2", F.lit(-1000.0)).alias("r2"))
    mean = out.groupBy(*keys).agg(F.avg("r2").alias("_mean"))
    return (
        out.join(mean, keys)
        .withColumn("delta_pct", F.try_divide(F.col("r2") - F.col("_mean"), F.col("_mean")) * 100)
        .withColumn("bad", F.col("r2") < 1 - max_gap)
        .drop("_mean")
    )


def changed_ranges(
    raw: DataFrame, clean: DataFrame, by: Series, value="value", ts="ts",
    step_seconds: int | None = None, min_modified: int = 0, materialize=cut_lineage,
) -> DataFrame:
    """Ranges in which two versions of a series differ after rounding to four digits.

    ``change`` is REMOVED when all values vanished, MODIFIED when none did and
    REMOVED-MODIFIED otherwise; MODIFIED ranges below ``min_modified`` rows are left out.
    Without ``step_seconds`` a range is an unbroken stretch of differing rows.  With it, a
    range goes on while the differing rows follow each other by exactly that step, and the
    row after a pause only opens the next range without being counted.  The joined
    versions are stored, as finding the ranges reads them twice.
    """
    keys = list(by.keys)
    a = raw.select(*keys, *by.order, F.round(value, 4).alias("_a"))
    b = clean.select(*keys, *by.order, F.round(value, 4).alias("_b"))
    both = a.join(b, [*keys, *by.order], "full")
    both = materialize(
        both.select(
            *keys, *by.order, (~F.col("_a").eqNullSafe(F.col("_b"))).alias("_diff"),
            F.col("_b").isNull().alias("_gone"),
        )
    )
    if step_seconds is None:
        condition, is_break = F.col("_diff"), ~F.col("_diff")
    else:
        near = scan(both.filter("_diff"), by, lag={"_prev": ts}, lead={"_next": ts})
        both = near.withColumn(
            "_gap",
            F.coalesce(seconds_between("_prev", ts), seconds_between(ts, "_next")),
        )
        condition, is_break = F.col("_gap") == step_seconds, F.col("_gap") > step_seconds
    gone = F.col("_gone")
    change = (
        F.when(F.every(gone), "REMOVED").when(F.some(gone), "REMOVED-MODIFIED").otherwise("MODIFIED")
    )
    found = runs(
        both, by, condition,
        [
            F.count("*").alias("n_rows"),
            F.min(ts).alias("range_start"),
            F.max(ts).alias("range_end"),
            change.alias("change"),
        ],
        is_break,
    ).drop("island")
    return found.filter((F.col("change") != "MODIFIED") | (F.col("n_rows") >= min_modified))
