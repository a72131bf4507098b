"""Landed service payloads: weather, stations, soiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import add_time, convert_unit, to_number
from gridloom.operators.timeaxis import dedupe_first, expand_steps, instant_to_local, local_to_instant, reindex, spine

WEATHER_SCHEMA = "struct<features: array<struct<properties: map<string, map<string, double>>>>>"


def weather_rows(payloads: DataFrame, keys: Sequence[str], body: str = "body") -> DataFrame:
    """Rows (keys, instant, field, value) of landed weather payloads.

    The first feature's properties map a time stamp to its fields.
    """
    parsed = F.from_json(body, WEATHER_SCHEMA)
    by_time = payloads.select(*keys, F.explode(F.get(parsed["features"], F.lit(0))["properties"]).alias("_at", "_fields"))
    stamped = by_time.withColumn(
        "instant",
        F.coalesce(
            F.try_to_timestamp("_at", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
            F.try_to_timestamp("_at", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        ),
    )
    return stamped.select(*keys, "instant", F.explode("_fields").alias("field", "value"))


def weather_hours(
    rows: DataFrame, bounds: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str
) -> DataFrame:
    """Hourly weather on the expected hours: duplicates dropped, extra hours left out.

    ``bounds`` has ``start`` and ``end`` instants per key; ``order`` names the column that
    tells which of two copies came first.
    """
    first = dedupe_first(rows, [*keys, "instant", "field"], [order])
    wide = first.groupBy(*keys, "instant").pivot("field", list(fields)).agg(F.first("value"))
    axis = spine(bounds, keys, 3600, name="instant")
    return reindex(axis, wide, [*keys, "instant"])


def pick_station(candidates: DataFrame, end: Column, site: str = "site") -> DataFrame:
    """Nearest station of each site whose data reaches the end (or the latest date there is).

    ``candidates``: site, station, distance, hourly_end.
    """
    latest = candidates.groupBy(site).agg(F.max("hourly_end").alias("_latest"))
    reach = candidates.join(latest, site).filter(F.col("hourly_end") >= F.least(F.col("_latest"), end))
    nearest = F.struct("distance", "station")
    return reach.groupBy(site).agg(
        F.min_by("station", nearest).alias("station"),
        F.min("distance").alias("distance"),
        F.max("_latest").alias("latest_end"),
    )


def station_weather(rows: DataFrame) -> DataFrame:
    """Station rows with wind in metres per second."""
    return rows.select(
        *[c for c in rows.columns if c not in ("temp", "wspd")],
        F.col("temp").alias("temp_air"),
        convert_unit("wspd", F.lit("kmh_to_mps")).alias("wind_speed"),
    )


def soiling_daily(rows: DataFrame, columns: Sequence[str], average: bool = True) -> DataFrame:
    """Daily soiling per site from its devices.

    Values are read as numbers.  Only days all devices of the site report are kept; with
    ``average`` the devices are averaged, otherwise they stay apart.
    """
    typed = rows.select("site", "device", F.to_date("day").alias("day"), *[to_number(c).alias(c) for c in columns])
    devices = typed.groupBy("site").agg(F.count_distinct("device").alias("_all"))
    complete = (
        typed.groupBy("site", "day").agg(F.count_distinct("device").alias("_n"))
        .join(devices, "site").filter("_n = _all").select("site", "day")
    )
    kept = typed.join(complete, ["site", "day"], "left_semi")
    if not average:
        return kept
    return kept.groupBy("site", "day").agg(*[F.avg(c).alias(c) for c in columns])


def resolve_weather(
    wanted: DataFrame, stored: DataFrame, fetched: DataFrame, today: Column, keys: Sequence[str] = ("site",)
) -> DataFrame:
    """Reference weather by month: stored months first, else the fetched data.

    Fetched data reaches back twelve months at most.  ``wanted`` has site, year, month.
    """
    def months(df: DataFrame) -> DataFrame:
        return df.withColumn("year", F.year("ts")).withColumn("month", F.month("ts"))

    period = [*keys, "year", "month"]
    have = months(stored).join(wanted, period, "left_semi")
    open_months = wanted.join(have.select(*period).distinct(), period, "left_anti")
    earliest = F.date_add(F.add_months(today, -12), 1).cast("timestamp_ntz")
    new = months(fetched).filter(F.col("ts") >= earliest).join(open_months, period, "left_semi")
    return (
        have.withColumn("origin", F.lit("stored"))
        .unionByName(new.withColumn("origin", F.lit("fetched")), allowMissingColumns=True)
        .drop("year", "month")
    )


def resolve_local_weather(
    wanted: DataFrame,
    stored: DataFrame,
    fetched: DataFrame,
    today: Column,
    zones: DataFrame,
    values: Sequence[str],
    step_seconds: int = 3600,
    site: str = "site",
) -> DataFrame:
    """Reference weather on every local hour of the wanted months, or on finer steps.

    ``stored`` and ``fetched`` have site, ts (UTC clock) and ``values``; ``zones`` has site and
    tz; the months of ``wanted`` are months of the site's own clock, as are the ends of the
    fetched data.  A month has the hours its zone's clocks show (one less or more where they
    change); hours without data are null, rows beside the hours vanish.  Steps below an hour
    carry the value of their hour, and end with the month's last hour.
    """
    def local(df: DataFrame) -> DataFrame:
        clock = instant_to_local("instant", "tz")
        return df.withColumnRenamed("ts", "instant").join(zones, site).withColumn("ts", clock).drop("tz")

    rows = resolve_weather(wanted, local(stored), local(fetched), today, [site]).drop("ts")
    rows = dedupe_first(rows, [site, "instant"], [*values])
    first = F.make_date("year", "month", F.lit(1)).cast("timestamp_ntz")
    edges = {"start": first, "end": F.add_months(first, 1).cast("timestamp_ntz")}
    months = wanted.select(site, "year", "month").distinct().join(zones, site)
    months = months.withColumns({n: local_to_instant(e, F.col("tz")).cast("timestamp_ntz") for n, e in edges.items()})
    hours = spine(months, [site, "tz", "year", "month", "end"], 3600, name="instant")
    out = hours.join(rows, [site, "instant"], "left")
    last = add_time("instant", 1, "hour") >= F.col("end")
    steps = F.when(last, F.lit(1)).otherwise(F.lit(max(1, 3600 // step_seconds)))
    out = expand_steps(out, "instant", steps, step_seconds, "ts")
    return out.select(site, "tz", "year", "month", "ts", instant_to_local("ts", "tz").alias("ts_local"), *values, "origin")
