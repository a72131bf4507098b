"""Time-axis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.views import READINGS_SQL, readings, site_series, table
from gridloom.core.ordered import series
from gridloom.core.session import cut_lineage
from gridloom.functions.scalars import add_time, floor_time
from gridloom.operators import timeaxis as ta
from gridloom.operators.events import lost_power
from gridloom.operators.events import offline_events as find_offline_events
from gridloom.sources.intervals import in_period

HOURLY_SQL = f"""
WITH {READINGS_SQL},
hourly AS (
  SELECT site, date_trunc('hour', ts) AS ts, avg(value) AS mean_value, count(*) AS n
  FROM readings GROUP BY 1, 2),
bounds AS (
  SELECT site, date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS z
  FROM readings GROUP BY 1),
axis AS (SELECT site, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM bounds)
"""


def hourly(spark, sf):
    return ta.resample(
        readings(spark, sf), ["site"], 3600, [F.avg("value").alias("mean_value"), F.count("*").alias("n")]
    ).withColumnRenamed("bucket", "ts")


def hourly_axis(spark, sf):
    return ta.spine(ta.observed_bounds(readings(spark, sf), ["site"], "hour"), ["site"], 3600)


@query(f"""
WITH {READINGS_SQL},
fleet AS (SELECT site, count(DISTINCT asset) AS n_assets FROM readings GROUP BY 1),
hourly AS (
  SELECT site, date_trunc('hour', ts) AS ts, sum(value) / 1e3 AS actual_mw, sum(k) / 1e3 AS possible_mw,
         count(DISTINCT CASE WHEN value > 0.1 THEN asset END) AS online
  FROM readings GROUP BY 1, 2),
bounds AS (
  SELECT site, date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS z
  FROM readings GROUP BY 1),
axis AS (SELECT site, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM bounds),
state AS (
  SELECT axis.site, axis.ts, n_assets, n_assets - coalesce(online, 0) AS n_offline,
         greatest(coalesce(possible_mw, 0) - coalesce(actual_mw, 0), 0) AS lost_mw
  FROM axis JOIN fleet USING (site) LEFT JOIN hourly USING (site, ts)),
numbered AS (
  SELECT *, n_offline >= 0.98 * n_assets AS down,
         sum(CASE WHEN n_offline < 0.98 * n_assets THEN 1 ELSE 0 END)
           OVER (PARTITION BY site ORDER BY ts) AS island
  FROM state)
SELECT site, min(ts) AS event_start, max(ts) + INTERVAL 1 HOUR AS event_end,
       round(avg(n_offline), 6) AS n_offline, CAST(round(sum(lost_mw), 0) AS BIGINT) AS lost_mwh,
       count(*)::DOUBLE AS event_hours
FROM numbered WHERE down GROUP BY site, island
""")
def offline_events(spark, sf):
    rows = readings(spark, sf)
    fleet = rows.groupBy("site").agg(F.count_distinct("asset").alias("n_assets"))
    active = F.when(F.col("value") > 0.1, F.col("asset"))
    hours = ta.resample(
        rows, ["site"], 3600,
        [
            F.sum("value").alias("actual_kw"),
            F.sum("k").alias("possible_kw"),
            F.count_distinct(active).alias("online"),
        ],
    ).withColumnRenamed("bucket", "ts")
    state = ta.reindex(hourly_axis(spark, sf), hours, ["site", "ts"]).join(fleet, "site")
    state = state.withColumn("online", F.coalesce("online", F.lit(0)))
    # hourly rows are few; finding the runs reads them twice
    power = cut_lineage(lost_power(state, ["site", "ts"], "n_assets", "online", solar=False))
    by = series(["site"], ["ts"], "month")
    return find_offline_events(power, by, 0.98 * F.col("n_assets")).withColumn(
        "n_offline", F.round("n_offline", 6)
    )


@query(f"""
WITH {READINGS_SQL}
SELECT site, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, round(avg(value), 9) AS mean_value,
       count(*) AS n
FROM readings GROUP BY 1, 2
""")
def quarter_hour_resample(spark, sf):
    aggs = [F.round(F.avg("value"), 9).alias("mean_value"), F.count("*").alias("n")]
    return ta.resample(readings(spark, sf), ["site"], 900, aggs)


@query(f"""
WITH {READINGS_SQL}
SELECT site, date_trunc('hour', ts) AS bucket, round(sum(value), 4) AS energy,
       CAST(count(*) AS BIGINT) AS n, round(avg(k), 9) AS mean_k
FROM readings GROUP BY 1, 2
""")
def resample_mixed(spark, sf):
    aggs = [
        F.round(F.sum("value"), 4).alias("energy"),
        F.count("*").alias("n"),
        F.round(F.avg("k"), 9).alias("mean_k"),
    ]
    return ta.resample(readings(spark, sf), ["site"], 3600, aggs)


@query(HOURLY_SQL + """
SELECT site, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, round(sum(mean_value), 6) AS energy
FROM hourly GROUP BY 1, 2
""")
def daily_energy_two_stage(spark, sf):
    out = ta.two_stage_energy(readings(spark, sf), ["site"], "day")
    return out.withColumn("energy", F.round("energy", 6))


@query(HOURLY_SQL + """
SELECT axis.site, axis.ts, round(mean_value, 9) AS mean_value, coalesce(n, 0) AS n
FROM axis LEFT JOIN hourly USING (site, ts)
""")
def spine_reindex(spark, sf):
    out = ta.reindex(hourly_axis(spark, sf), hourly(spark, sf), ["site", "ts"])
    return out.select(
        "site", "ts", F.round("mean_value", 9).alias("mean_value"), F.coalesce("n", F.lit(0)).alias("n")
    )


@query(f"""
WITH {READINGS_SQL}
SELECT site, asset, ts_hour AS ts, event_id, value FROM (
  SELECT *, date_trunc('hour', ts) AS ts_hour,
         row_number() OVER (PARTITION BY site, asset, date_trunc('hour', ts) ORDER BY event_id) AS rn
  FROM readings) WHERE rn = 1
""")
def dedupe_first(spark, sf):
    rows = readings(spark, sf).withColumn("ts", floor_time("hour", "ts"))
    return ta.dedupe_first(rows, ["site", "asset", "ts"], ["event_id"]).select(
        "site", "asset", "ts", "event_id", "value"
    )


@query(f"""
WITH {READINGS_SQL},
steps AS (
  SELECT site, date_diff('second', date_trunc('second', prev), ts) AS gap,
         CAST(floor((epoch_us(ts) - epoch_us(prev)) / 1000000) AS BIGINT) AS step
  FROM (SELECT *, lag(ts) OVER (PARTITION BY site ORDER BY ts, event_id) AS prev FROM readings))
SELECT site, count(*) AS n_rows, min(step) AS min_step_s, max(step) AS max_step_s,
       coalesce(min(step) = max(step), true) AS uniform
FROM steps GROUP BY 1
""")
def interval_check(spark, sf):
    return ta.interval_check(*site_series(spark, sf))


@query(f"""
WITH {READINGS_SQL},
bounds AS (SELECT site, min(ts) AS a, max(ts) AS z FROM readings GROUP BY 1),
grid AS (
  SELECT site, unnest(generate_series(date_trunc('hour', a), z, INTERVAL 1 HOUR)) AS label FROM bounds)
SELECT grid.site, label, r.value, r.event_id
FROM grid ASOF JOIN readings r ON grid.site = r.site AND grid.label >= r.ts
""")
def ffill_hourly(spark, sf):
    return ta.upsample_ffill(*site_series(spark, sf), ["value", "event_id"], 3600)


@query(f"""
WITH {READINGS_SQL},
seg AS (
  SELECT site, ts, value, lead(ts) OVER w AS t1, lead(value) OVER w AS v1
  FROM readings WINDOW w AS (PARTITION BY site ORDER BY ts, event_id)),
bounds AS (SELECT site, min(ts) AS a, max(ts) AS z FROM readings GROUP BY 1),
grid AS (
  SELECT site, unnest(generate_series(date_trunc('hour', a), z, INTERVAL 1 HOUR)) AS label FROM bounds)
SELECT g.site, label,
       round(value + (v1 - value) * (epoch_us(label) - epoch_us(ts)) / (epoch_us(t1) - epoch_us(ts)), 6) AS value
FROM grid g ASOF JOIN seg ON g.site = seg.site AND g.label >= seg.ts
""")
def interp_hourly(spark, sf):
    out = ta.upsample_linear(*site_series(spark, sf), ["value"], 3600)
    return out.withColumn("value", F.round("value", 6))


@query(HOURLY_SQL + """
SELECT site, ts, round((a.mean_value + b.mean_value) / 2, 9) AS mean_value
FROM (SELECT axis.site, axis.ts, mean_value FROM axis LEFT JOIN hourly USING (site, ts)) a
LEFT JOIN (SELECT site, ts - INTERVAL 1 HOUR AS ts, mean_value FROM hourly) b USING (site, ts)
""")
def recentre_half_hour(spark, sf):
    grid = ta.reindex(hourly_axis(spark, sf), hourly(spark, sf), ["site", "ts"])
    out = ta.recentre_hourly(grid, ["site"], "mean_value")
    return out.withColumn("mean_value", F.round("mean_value", 9))


@query(HOURLY_SQL + """
SELECT site, ts,
       CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN round(lag(
              CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN mean_value END)
              OVER (PARTITION BY site ORDER BY ts), 9) ELSE round(mean_value, 9) END AS mean_value
FROM axis LEFT JOIN hourly USING (site, ts)
""")
def offset_change_shift(spark, sf):
    grid = ta.reindex(hourly_axis(spark, sf), hourly(spark, sf), ["site", "ts"])
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    out = ta.shift_from(grid, ["site"], "mean_value", cut, 3600)
    return out.select("site", "ts", F.round("mean_value", 9).alias("mean_value"))


@query("""
WITH bounds AS (
  SELECT o_orderstatus AS site, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY 1),
pieces AS (SELECT site, z, unnest(generate_series(a, z - INTERVAL 1 SECOND, INTERVAL 11 DAY)) AS range_start FROM bounds)
SELECT site, range_start, least(range_start + INTERVAL 11 DAY, z) AS range_end FROM pieces
""")
def split_ranges(spark, sf):
    bounds = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("site"))
        .agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    )
    return ta.split_range(bounds, 11).select("site", "range_start", "range_end")


@query("""
WITH bounds AS (
  SELECT o_orderpriority AS site, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY 1),
months AS (
  SELECT site, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, z - INTERVAL 1 SECOND, INTERVAL 1 MONTH)) AS m
  FROM bounds),
stored AS (
  SELECT o_orderpriority AS site, year(o_orderdate) AS year, month(o_orderdate) AS month
  FROM orders GROUP BY 1, 2, 3 HAVING count(*) % 2 = 0)
SELECT m.site, year(m.m) AS year, month(m.m) AS month,
       CASE WHEN s.site IS NULL THEN 'fetch' ELSE 'stored' END AS source
FROM months m LEFT JOIN stored s ON s.site = m.site AND s.year = year(m.m) AND s.month = month(m.m)
""")
def coverage_split(spark, sf):
    orders = table(spark, sf, "orders").withColumn("site", F.col("o_orderpriority"))
    bounds = orders.groupBy("site").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end")
    )
    wanted = ta.months_in_range(bounds).select("site", "year", "month")
    months = orders.groupBy("site", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    stored = months.agg(F.count("*").alias("n")).filter("n % 2 = 0")
    return ta.coverage_split(wanted, stored, ["site", "year", "month"])


@query("""
WITH h AS (
  SELECT l_returnflag AS site, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts, l_quantity AS q
  FROM lineitem)
SELECT site, CAST(ts AS DATE) AS day, CAST(hour(ts) + 1 AS INTEGER) AS hour, round(sum(q), 4) AS mwh
FROM h GROUP BY 1, 2, 3
""")
def hour_ending_round_trip(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        F.to_date("l_shipdate").alias("day"),
        (F.col("l_orderkey") % 24 + 1).alias("hour"),
        "l_quantity",
    )
    stamped = lines.withColumn("ts", ta.hour_ending_to_ts("day", "hour"))
    energy = stamped.groupBy("site", "ts").agg(F.round(F.sum("l_quantity"), 4).alias("mwh"))
    return ta.ts_to_hour_ending(energy).select("site", "day", "hour", "mwh")


@query(f"""
WITH {READINGS_SQL},
a AS (SELECT DISTINCT date_trunc('hour', ts) AS ts, site FROM readings)
SELECT ts, string_agg(site, ',' ORDER BY site) AS present_in
FROM a GROUP BY ts HAVING count(*) < (SELECT count(DISTINCT site) FROM a)
""")
def axis_mismatch(spark, sf):
    rows = readings(spark, sf).select(floor_time("hour", "ts").alias("ts"), F.col("site").alias("frame"))
    return ta.same_axis(rows, ["ts"]).withColumn("present_in", F.array_join("present_in", ","))


# Sites west of Greenwich, whose dusk lies behind UTC midnight.
DAY_ZONES = ("America/Chicago", "America/Los_Angeles", "America/New_York")


def zone_of(site):
    return F.get(F.array(*[F.lit(z) for z in DAY_ZONES]), F.length(site) % 3)


def local_clock(tz):
    return F.from_utc_timestamp(F.col("ts"), tz).cast("timestamp_ntz")


def daylight_input(spark, sf):
    """Dawn and dusk by local date; the middle of a month is missing, as on polar days."""
    dates = readings(spark, sf).select("site", F.to_date(local_clock(zone_of("site"))).alias("date")).distinct()
    midnight, day = F.col("date").cast("timestamp_ntz"), F.dayofmonth("date")
    here = day != 15
    return dates.select(
        "site", "date", F.when(here, add_time(midnight, 6 * 3600 + day * 61)).alias("dawn"),
        F.when(here, add_time(midnight, 19 * 3600 + day * 119)).alias("dusk"),
    )


DAYLIGHT_SQL = """
z AS (SELECT *, CASE length(site) % 3 WHEN 0 THEN 'America/Chicago' WHEN 1 THEN 'America/Los_Angeles' ELSE 'America/New_York' END AS tz FROM readings),
l AS (SELECT *, timezone(tz, timezone('UTC', ts)) AS lt FROM z),
days AS (SELECT DISTINCT site, CAST(lt AS DATE) AS date FROM l),
has AS (
  SELECT site, date, date_trunc('minute', date::TIMESTAMP + (6 * 3600 + day(date) * 61 + 30)::INTEGER * INTERVAL 1 SECOND) AS dawn,
         date_trunc('minute', date::TIMESTAMP + (19 * 3600 + day(date) * 119 + 30)::INTEGER * INTERVAL 1 SECOND) AS dusk
  FROM days WHERE day(date) <> 15),
lit AS (
  SELECT days.site, days.date, coalesce(h.dawn, p.dawn + INTERVAL 1 DAY, n.dawn - INTERVAL 1 DAY) AS dawn,
         coalesce(h.dusk, p.dusk + INTERVAL 1 DAY, n.dusk - INTERVAL 1 DAY) AS dusk
  FROM days LEFT JOIN has h ON h.site = days.site AND h.date = days.date
    LEFT JOIN has p ON p.site = days.site AND p.date = days.date - 1 LEFT JOIN has n ON n.site = days.site AND n.date = days.date + 1)
"""


@query(f"""
WITH {READINGS_SQL}, {DAYLIGHT_SQL}
SELECT event_id, l.site, ts, value, coalesce(lt >= dawn AND lt < dusk, false) AS is_day FROM l LEFT JOIN lit ON lit.site = l.site AND lit.date = CAST(lt AS DATE)
""")
def daylight_flag(spark, sf):
    rows = readings(spark, sf).withColumn("tz", zone_of("site"))
    given = cut_lineage(daylight_input(spark, sf))
    lit = ta.complete_daylight(given, given, ["site"])
    return ta.flag_daylight(rows, lit, ["site"], tz="tz").select("event_id", "site", "ts", "value", "is_day")


@query(f"WITH {READINGS_SQL}, {DAYLIGHT_SQL} SELECT site, date, dawn, dusk FROM lit")
def daylight_times(spark, sf):
    given = cut_lineage(daylight_input(spark, sf))
    return ta.complete_daylight(given, given, ["site"])


@query(f"""
WITH {READINGS_SQL}
SELECT event_id, site, ts, value FROM readings WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def period_filter(spark, sf):
    rows = in_period(readings(spark, sf), "2024-01-10", "2024-01-20")
    return rows.select("event_id", "site", "ts", "value")
