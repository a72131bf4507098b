"""Regular time axes: spines, reindexing, resampling, filling and clock changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, scan
from gridloom.core.session import sized
from gridloom.functions.scalars import add_time, bucket_start, floor_time, seconds_between

STEP_BLOCK = 4096


def expand_steps(
    df: DataFrame, start: str, steps: Column, step_seconds: int, name: str, spread: Sequence[str] = ()
) -> DataFrame:
    """Emit ``start + i * step`` for ``i`` in ``[0, steps)``.

    The expansion runs in two levels so that one long range is shared by many tasks
    (``spread`` names the columns to shuffle by) and no huge array is ever built.
    """
    last = F.col("_steps") - 1
    blocks = (
        df.withColumn("_steps", steps.cast("bigint"))
        .filter(F.col("_steps") > 0)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(STEP_BLOCK).cast("bigint"))))
    )
    if spread:
        blocks = blocks.repartition(*spread, "_from")
    inner = F.sequence(F.col("_from"), F.least(F.col("_from") + (STEP_BLOCK - 1), last))
    out = blocks.withColumn("_i", F.explode(inner))
    return out.withColumn(name, add_time(start, F.col("_i") * step_seconds)).drop(
        "_steps", "_from", "_i"
    )


def spine(
    bounds: DataFrame, keys: Sequence[str], step_seconds: int, start="start", end="end", name="ts"
) -> DataFrame:
    """Regular half-open time axis ``[start, end)`` for every row of ``bounds``."""
    steps = F.ceil(seconds_between(start, end) / F.lit(step_seconds))
    rows = expand_steps(bounds.select(*keys, start, end), start, steps, step_seconds, name, keys)
    return rows.select(*keys, name)


def observed_bounds(df: DataFrame, keys: Sequence[str], unit: str, ts: str = "ts") -> DataFrame:
    """First and one-past-last ``unit`` of each series, as spine bounds."""
    first, last = floor_time(unit, F.min(ts)), floor_time(unit, F.max(ts))
    return df.groupBy(*keys).agg(first.alias("start"), add_time(last, 1, unit).alias("end"))


def reindex(axis: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Put ``df`` on ``axis``: absent rows appear with nulls, foreign rows vanish."""
    return axis.join(df, list(on), "left")


def dedupe_first(df: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row by ``order`` of every group of rows equal in ``on``.

    An aggregate rather than a window, so copies are merged before the shuffle.
    """
    rest = [c for c in df.columns if c not in on]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*on).agg(best).select(*on, *[F.col(f"_row.{c}").alias(c) for c in rest])


def interval_check(df: DataFrame, by: Series, ts: str = "ts") -> DataFrame:
    """Shortest and longest step of each series and whether it is uniform."""
    steps = scan(df, by, lag={"_prev": ts}).withColumn("step", seconds_between("_prev", ts))
    return steps.groupBy(*by.keys).agg(
        F.count("*").alias("n_rows"),
        F.min("step").alias("min_step_s"),
        F.max("step").alias("max_step_s"),
        F.coalesce(F.min("step") == F.max("step"), F.lit(True)).alias("uniform"),
    )


def split_range(df: DataFrame, days: int, start="start", end="end") -> DataFrame:
    """Cut date ranges into consecutive ranges of at most ``days`` days."""
    width = days * 86400
    pieces = F.ceil(seconds_between(start, end) / F.lit(width))
    out = expand_steps(df, start, pieces, width, "range_start")
    return out.withColumn("range_end", F.least(add_time("range_start", days, "day"), F.col(end)))


def months_in_range(df: DataFrame, start="start", end="end") -> DataFrame:
    """One row per calendar month touched by ``[start, end)``."""
    last = F.trunc(add_time(end, -1), "MM")
    months = F.sequence(F.trunc(start, "MM"), last, F.expr("interval 1 month"))
    return (
        df.withColumn("month_start", F.explode(months))
        .withColumn("year", F.year("month_start"))
        .withColumn("month", F.month("month_start"))
    )


def coverage_split(wanted: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """Label each wanted period as ``stored`` or ``fetch``."""
    have = stored.select(*on).distinct().withColumn("_have", F.lit(True))
    label = F.when(F.col("_have"), F.lit("stored")).otherwise(F.lit("fetch"))
    return wanted.join(have, list(on), "left").withColumn("source", label).drop("_have")


def resample(
    df: DataFrame, keys: Sequence[str], seconds: int, aggs: Sequence[Column], ts: str = "ts"
) -> DataFrame:
    """Aggregate into fixed buckets labelled by their start."""
    bucket = bucket_start(ts, seconds).alias("bucket")
    return df.groupBy(*keys, bucket).agg(*aggs)


def two_stage_energy(
    df: DataFrame, keys: Sequence[str], period: str, value: str = "value", ts: str = "ts"
) -> DataFrame:
    """Hourly mean power first, then its sum per day or month."""
    hourly = resample(df, keys, 3600, [F.avg(value).alias("_mean")], ts)
    return hourly.groupBy(*keys, floor_time(period, "bucket").alias("period")).agg(
        F.coalesce(F.sum("_mean"), F.lit(0.0)).alias("energy")
    )


def _validity(df: DataFrame, by: Series, columns: Sequence[str], step_seconds: int, ts: str):
    """Rows with their grid labels: the ones from a row up to the next row."""
    nexts = {f"_next_{c}": c for c in (ts, *columns)}
    rows = scan(df, by, lead=nexts)
    floor = bucket_start(ts, step_seconds)
    first = F.when(floor == F.col(ts), floor).otherwise(add_time(floor, step_seconds))
    rows = rows.withColumn("_first", first)
    # labels in [first, next); the last row only covers a label it sits on
    until = F.col(f"_next_{ts}")
    open_steps = F.ceil(
        F.timestamp_diff("MICROSECOND", F.col("_first"), until) / F.lit(step_seconds * 1_000_000)
    )
    closing = F.when(F.col("_first") == F.col(ts), F.lit(1)).otherwise(F.lit(0))
    steps = F.when(until.isNull(), closing).otherwise(open_steps)
    return expand_steps(rows, "_first", steps, step_seconds, "label", [*by.keys, ts])


def upsample_ffill(
    df: DataFrame, by: Series, columns: Sequence[str], step_seconds: int, ts: str = "ts"
) -> DataFrame:
    """Forward fill onto a finer grid by spelling out each row's validity interval."""
    return _validity(df, by, [], step_seconds, ts).select(*by.keys, "label", *columns)


def upsample_linear(
    df: DataFrame, by: Series, columns: Sequence[str], step_seconds: int, ts: str = "ts"
) -> DataFrame:
    """Linear interpolation onto a finer grid."""
    rows = _validity(df, by, columns, step_seconds, ts)
    span = F.timestamp_diff("MICROSECOND", F.col(ts), F.col(f"_next_{ts}"))
    part = F.timestamp_diff("MICROSECOND", F.col(ts), F.col("label"))
    weight = F.coalesce(F.try_divide(part.cast("double"), span.cast("double")), F.lit(0.0))

    def mix(c: str) -> Column:
        later = F.coalesce(F.col(f"_next_{c}"), F.when(weight == 0, F.col(c)))
        return (F.col(c) + (later - F.col(c)) * weight).alias(c)

    return rows.select(*by.keys, "label", *[mix(c) for c in columns])


def forward_fill(df: DataFrame, by: Series, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the last known value of the series."""
    return scan(df, by, fill={c: c for c in columns})


def recentre_hourly(df: DataFrame, keys: Sequence[str], value: str, ts: str = "ts") -> DataFrame:
    """Shift hourly means by half an hour: mean of an hour and the following one.

    Each row feeds its own hour and the one before; an hour fed once has no successor
    (or is absent) and gets null.  No ordering is needed.
    """
    own = F.struct(F.col(ts).alias("ts"), F.lit(True).alias("own"))
    earlier = F.struct(add_time(ts, -1, "hour").alias("ts"), F.lit(False).alias("own"))
    fed = df.select(*keys, value, F.explode(F.array(own, earlier)).alias("_t"))
    return (
        fed.groupBy(*keys, F.col("_t.ts").alias(ts))
        .agg(
            F.max("_t.own").alias("_own"),
            F.when(F.count(value) == 2, F.sum(value) / 2).alias(value),
        )
        .filter("_own")
        .drop("_own")
    )


def shift_from(
    df: DataFrame, keys: Sequence[str], value: str, cut: Column, step_seconds: int, ts: str = "ts"
) -> DataFrame:
    """Delay a regular series by one step from ``cut`` on; the first shifted row is empty."""
    late = F.col(ts) >= cut
    delayed = df.filter(late).select(*keys, add_time(ts, step_seconds).alias(ts), F.col(value).alias("_delayed"))
    out = df.join(delayed, [*keys, ts], "left")
    return out.withColumn(value, F.when(late, F.col("_delayed")).otherwise(F.col(value))).drop("_delayed")


def shift_rows(df: DataFrame, by: Series, value: str, fill: float = 0.0) -> DataFrame:
    """Move a column down by one row, filling the first row."""
    moved = scan(df.withColumn("_here", F.lit(True)), by, lag={"_moved": value, "_has": "_here"})
    shifted = F.when(F.col("_has"), F.col("_moved")).otherwise(F.lit(fill))
    return moved.withColumn(value, shifted).drop("_moved", "_has", "_here")


def beginning_labels(df: DataFrame, by: Series, label: str) -> DataFrame:
    """Interval-ending labels to interval-beginning ones by taking the previous label."""
    ending = F.when(F.col(label) == "24:00", "00:00").otherwise(F.col(label))
    moved = scan(df.withColumn("_end", ending), by, lag={"_begin": "_end"})
    out = moved.withColumn(label, F.coalesce("_begin", F.lit("00:00"))).drop("_begin", "_end")
    return out.filter(F.length(label) == 5)


def hour_ending_to_ts(day: Column | str, hour: Column | str) -> Column:
    """Start of the hour that ends at ``hour`` (1 to 24) of ``day``."""
    day = F.col(day) if isinstance(day, str) else day
    hour = F.col(hour) if isinstance(hour, str) else hour
    return add_time(day.cast("timestamp_ntz"), hour.cast("bigint") - 1, "hour")


def ts_to_hour_ending(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("day", F.to_date(ts)).withColumn("hour", F.hour(ts) + 1)


# --- clock changes -----------------------------------------------------------------


def local_to_instant(ts_local: Column | str, tz: Column | str) -> Column:
    """Instant of a wall clock; of a repeated hour the first, of a skipped hour one later."""
    ts_local = F.col(ts_local) if isinstance(ts_local, str) else ts_local
    return F.to_utc_timestamp(ts_local, tz if isinstance(tz, Column) else F.col(tz))


def instant_to_local(instant: Column | str, tz: Column | str) -> Column:
    instant = F.col(instant) if isinstance(instant, str) else instant
    local = F.from_utc_timestamp(instant, tz if isinstance(tz, Column) else F.col(tz))
    return local.cast("timestamp_ntz")


def repair_meter_hours(
    df: DataFrame, keys: Sequence[str], tz: str, row: str, value: str = "mwh", ts: str = "ts_local",
    instant: str | None = None,
) -> DataFrame:
    """Put hourly wall-clock meter rows on the true local hours.

    A repeated autumn hour keeps both its rows in file order, a single one fills the
    first pass.  A row at a skipped spring hour replaces the hour before it.  Hours
    without a row get zero.  ``df`` must carry one time zone per key.  Rows whose
    ``instant`` is known already (not null) keep it.
    """
    keys = list(keys)
    known = None
    if instant is not None:
        known = df.filter(F.col(instant).isNotNull()).select(
            *keys, tz, F.col(instant).alias("instant"), F.col(value).alias("v"), F.lit(False).alias("moved")
        )
        df = df.filter(F.col(instant).isNull())
    merged = (
        df.groupBy(*keys, tz, ts)
        .agg(
            F.min_by(value, row).alias("_v1"),
            F.max_by(value, row).alias("_v2"),
            F.count("*").alias("_n"),
        )
        .withColumn("_instant", local_to_instant(ts, tz))
        .withColumn("_skipped", instant_to_local("_instant", tz) != F.col(ts))
        .withColumn("_repeated", instant_to_local(add_time("_instant", 1, "hour"), tz) == F.col(ts))
    )
    instant = F.col("_instant")
    passes = F.array_compact(
        F.array(
            F.struct(
                F.when(F.col("_skipped"), add_time(instant, -1, "hour")).otherwise(instant).alias("instant"),
                F.col("_v1").alias("v"),
                F.col("_skipped").alias("moved"),
            ),
            F.when(
                F.col("_repeated") & (F.col("_n") > 1),
                F.struct(
                    add_time(instant, 1, "hour").alias("instant"),
                    F.col("_v2").alias("v"),
                    F.lit(False).alias("moved"),
                ),
            ),
        )
    )
    by_label = merged.select(*keys, tz, F.explode(passes).alias("_p")).select(*keys, tz, "_p.*")
    if known is not None:
        by_label = by_label.unionByName(known)
    placed = by_label.groupBy(*keys, tz, "instant").agg(F.max_by("v", F.col("moved").cast("int")).alias(value))
    bounds = placed.groupBy(*keys, tz).agg(
        F.min("instant").alias("start"), add_time(F.max("instant"), 1, "hour").alias("end")
    )
    axis = spine(bounds, [*keys, tz], 3600, name="instant")
    return (
        axis.join(placed, [*keys, tz, "instant"], "left")
        .withColumn(value, F.coalesce(value, F.lit(0.0)))
        .withColumn(ts, instant_to_local("instant", tz))
    )


def localize_fixed_offset(df: DataFrame, keys: Sequence[str], tz: str, ts: str = "ts_local") -> DataFrame:
    """Wall clocks recorded without clock changes: the offset of the first row holds for all."""
    first = df.groupBy(*keys).agg(F.min(ts).alias("_t0"))
    offset = seconds_between(local_to_instant("_t0", tz).cast("timestamp_ntz"), F.col("_t0"))
    return (
        df.join(first, list(keys))
        .withColumn("instant", add_time(F.col(ts).cast("timestamp"), -offset))
        .drop("_t0")
    )


def standardize_local(
    df: DataFrame, keys: Sequence[str], tz: str, step_seconds: int, instant: str = "instant"
) -> DataFrame:
    """Instants to a gap-free wall-clock axis.

    Of a repeated hour the first pass is kept; the skipped hour appears with nulls.
    """
    local = df.withColumn("ts_local", instant_to_local(instant, tz))
    kept = dedupe_first(local, [*keys, "ts_local"], [instant])
    bounds = kept.groupBy(*keys).agg(
        F.min("ts_local").alias("start"), add_time(F.max("ts_local"), step_seconds).alias("end")
    )
    return reindex(spine(bounds, keys, step_seconds, name="ts_local"), kept, [*keys, "ts_local"])


# --- daylight ----------------------------------------------------------------------


def complete_daylight(dates: DataFrame, daylight: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dawn and dusk, to the nearest minute, for every key and date of ``dates``.

    ``daylight`` is an input table (keys, date, dawn, dusk) by local date and local clock.  A
    date that it lacks, or whose times are null, borrows those of the day before, else of the
    day after.
    """
    keys = list(keys)
    nearest = {c: floor_time("minute", add_time(c, 30)) for c in ("dawn", "dusk")}
    known = sized(daylight.filter("dawn IS NOT NULL AND dusk IS NOT NULL").select(*keys, "date", *[e.alias(c) for c, e in nearest.items()]))
    out = dates.select(*keys, "date").join(known, [*keys, "date"], "left")
    for step, tag in ((1, "prev"), (-1, "next")):
        moved = known.select(
            *keys, F.date_add("date", step).alias("date"),
            *[add_time(c, step, "day").alias(f"{c}_{tag}") for c in ("dawn", "dusk")],
        )
        out = out.join(moved, [*keys, "date"], "left")
    return out.select(
        *keys, "date", F.coalesce("dawn", "dawn_prev", "dawn_next").alias("dawn"), F.coalesce("dusk", "dusk_prev", "dusk_next").alias("dusk")
    )


def flag_daylight(df: DataFrame, daylight: DataFrame, keys: Sequence[str], ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Add ``is_day``: the reading's local clock lies in its local date's daylight, dusk excluded.

    ``daylight`` is keyed by local date and has local clocks.  ``ts`` is a local clock too,
    or, with ``tz`` (a column), a UTC clock that is moved to its site's zone first, so an
    evening reading behind UTC midnight still belongs to its local day.
    """
    lit = sized(daylight.select(*keys, F.col("date").alias("_date"), "dawn", "dusk"))
    local = F.col(ts) if tz is None else F.from_utc_timestamp(F.col(ts), F.col(tz)).cast("timestamp_ntz")
    out = df.withColumn("_local", local).withColumn("_date", F.to_date("_local")).join(lit, [*keys, "_date"], "left")
    inside = (F.col("_local") >= F.col("dawn")) & (F.col("_local") < F.col("dusk"))
    return out.withColumn("is_day", F.coalesce(inside, F.lit(False))).drop("_date", "_local", "dawn", "dusk")


def same_axis(df: DataFrame, on: Sequence[str], frame: str = "frame") -> DataFrame:
    """Rows present in some but not all frames of a long table; empty when all share one axis.

    The frames are those that ``frame`` names, one pass over the data collects who has what.
    """
    pairs = df.select(*on, F.col(frame).alias("_frame")).distinct()
    n_frames = pairs.agg(F.count_distinct("_frame")).scalar()
    names = F.array_sort(F.collect_list("_frame"))
    return pairs.groupBy(*on).agg(names.alias("present_in")).filter(F.size("present_in") < n_frames)
