"""Wall clocks of many zones to instants, each series judged by whether its zone allows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import scan, series
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import add_time, floor_time, seconds_between
from gridloom.operators.timeaxis import dedupe_first, local_to_instant, spine

#: Clock changes are looked for at this distance; all zones in use change at such times.
STEP_SECONDS = 900


def zone_changes(bounds: DataFrame, tz: str = "tz") -> DataFrame:
    """``tz, at, before, after``: instants at which a zone's offset (seconds) changes.

    ``bounds`` has a row per zone with ``start`` and ``end``.
    """
    axis = spine(bounds, [tz], STEP_SECONDS, name="at")
    local = F.from_utc_timestamp(F.col("at").cast("timestamp"), F.col(tz)).cast("timestamp_ntz")
    offsets = axis.withColumn("after", seconds_between("at", local))
    steps = scan(offsets, series([tz], ["at"], "month"), lag={"before": "after"})
    return steps.filter(F.col("before") != F.col("after")).select(tz, "at", "before", "after")


def doubtful_hours(changes: DataFrame, tz: str = "tz") -> DataFrame:
    """Wall clocks ``[first, last)`` that a change skips or repeats, one row per zone and local date they touch."""
    turns = [add_time("at", F.col(c)) for c in ("before", "after")]
    rows = changes.select(tz, F.least(*turns).alias("first"), F.greatest(*turns).alias("last"), (F.col("after") > F.col("before")).alias("skipped"))
    dates = F.sequence(F.to_date("first"), F.to_date(add_time("last", -1)))
    rows = rows.withColumn("date", F.explode(dates))
    return rows.groupBy(tz, "date").agg(F.collect_list(F.struct("first", "last", "skipped")).alias("changes"))


def judge(df: DataFrame, keys: Sequence[str], tz: str = "tz", ts: str = "ts_local") -> DataFrame:
    """``kind`` of each series: ``zone`` if its zone's rules allow all its wall clocks, else ``fixed``.

    A wall clock in a skipped or repeated hour speaks against the rules.  Beside it ``first``
    and ``last``, and how many such clocks there are.  Readings meet the few dates with a change
    by zone and date, so no series is gathered anywhere.
    """
    keys = list(keys)
    known = df.filter(F.col(tz).isNotNull() & F.col(ts).isNotNull())
    bounds = known.groupBy(tz).agg(
        floor_time("day", add_time(F.min(ts), -2, "day")).alias("start"), floor_time("day", add_time(F.max(ts), 3, "day")).alias("end")
    )
    doubtful = sized(doubtful_hours(zone_changes(sized(bounds), tz), tz).withColumnRenamed("date", "_date"))
    met = known.select(*keys, tz, ts, F.to_date(ts).alias("_date")).join(doubtful, [tz, "_date"], "left")
    inside = F.exists("changes", lambda x: (F.col(ts) >= x["first"]) & (F.col(ts) < x["last"]))
    out = met.groupBy(*keys, tz).agg(F.count_if(inside).alias("n_doubtful"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return out.withColumn("kind", F.when(F.col("n_doubtful") == 0, "zone").otherwise("fixed"))


def localize_judged(
    df: DataFrame, keys: Sequence[str], step_seconds: int, tz: str = "tz", ts: str = "ts_local", order: str | None = None
) -> DataFrame:
    """Instants of wall-clock series, zones by row, with ``kind`` of each series.

    A series that its zone's rules allow is moved by them and keeps its rows.  Any other one was
    recorded without clock changes: the offset at its first stamp holds for all of it, and the
    rows are put on the axis of ``step_seconds`` that the zone's clocks show from first to last
    stamp, so hours that the offset moves outside vanish and absent ones appear with nulls.  Of
    rows with equal time the first by ``order`` stays there.  Rows without a zone or a time give
    no instant and are left out.
    """
    keys = list(keys)
    judged = cut_lineage(judge(df, keys, tz, ts))
    rest = [c for c in df.columns if c not in (*keys, tz, ts)]
    rows = df.join(judged.select(*keys, tz, "kind", "first"), [*keys, tz])
    by_zone = rows.filter("kind = 'zone'").withColumn("instant", local_to_instant(ts, tz).cast("timestamp_ntz"))
    offset = seconds_between("first", local_to_instant("first", tz).cast("timestamp_ntz"))
    fixed = rows.filter("kind = 'fixed'").withColumn("instant", add_time(ts, offset))
    fixed = dedupe_first(fixed.select(*keys, tz, "instant", *rest), [*keys, tz, "instant"], [order or rest[0]])
    ends = judged.filter("kind = 'fixed'").select(
        *keys, tz, local_to_instant("first", tz).cast("timestamp_ntz").alias("start"),
        add_time(local_to_instant("last", tz).cast("timestamp_ntz"), 1).alias("end"),
    )
    axis = spine(ends, [*keys, tz], step_seconds, name="instant")
    columns = [*keys, tz, "kind", "instant", *rest]
    on_axis = axis.join(fixed, [*keys, tz, "instant"], "left").withColumn("kind", F.lit("fixed"))
    return by_zone.filter(F.col("instant").isNotNull()).select(*columns).unionByName(on_axis.select(*columns))
