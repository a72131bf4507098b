"""Summary, score and event queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.views import READINGS_SQL, readings, site_series, table
from gridloom.core.ordered import fit_series
from gridloom.functions.scalars import add_time, clip
from gridloom.operators import events as ev
from gridloom.operators import lookups as lk
from gridloom.operators import quality as qc
from gridloom.operators import summaries as sm
from gridloom.operators import timeaxis as ta
from gridloom.sources import intervals as iv


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


SEGMENTS_SQL = f"""
WITH {READINGS_SQL},
seg AS (
  SELECT site, ts, value, lead(ts) OVER w AS t1, lead(value) OVER w AS v1
  FROM readings WINDOW w AS (PARTITION BY site ORDER BY ts, event_id)),
cut AS (
  SELECT *, unnest(generate_series(date_trunc('hour', ts), t1 - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS bucket
  FROM seg WHERE t1 > ts),
part AS (
  SELECT *, greatest(ts, bucket) AS s, least(t1, bucket + INTERVAL 1 HOUR) AS e FROM cut),
edge AS (
  SELECT *, (epoch_us(e) - epoch_us(s))::DOUBLE AS dt,
         value + (v1 - value) * ((epoch_us(s) - epoch_us(ts))::DOUBLE / (epoch_us(t1) - epoch_us(ts))) AS ls,
         value + (v1 - value) * ((epoch_us(e) - epoch_us(ts))::DOUBLE / (epoch_us(t1) - epoch_us(ts))) AS le
  FROM part)
"""


@query(SEGMENTS_SQL + """
SELECT site, bucket, round(sum(value * dt) / 3.6e9, 6) AS total, round(sum(value * dt) / sum(dt), 6) AS average,
       min(value) AS minimum, max(value) AS maximum, round(max(value) - min(value), 6) AS range,
       count(*) FILTER (s = ts) AS count, round(100.0 * sum(dt) / 3.6e9, 6) AS percent_good
FROM edge GROUP BY 1, 2
""")
def time_weighted_step(spark, sf):
    out = sm.interval_summary(*site_series(spark, sf), 3600, "time_weighted_discrete")
    return rounded(out, 6, "total", "average", "range", "percent_good")


@query(SEGMENTS_SQL + """
SELECT site, bucket, round(sum((ls + le) / 2 * dt) / 3.6e9, 6) AS total,
       round(sum((ls + le) / 2 * dt) / sum(dt), 6) AS average,
       round(min(least(ls, le)), 6) AS minimum, round(max(greatest(ls, le)), 6) AS maximum,
       round(max(greatest(ls, le)) - min(least(ls, le)), 6) AS range,
       count(*) FILTER (s = ts) AS count, round(100.0 * sum(dt) / 3.6e9, 6) AS percent_good
FROM edge GROUP BY 1, 2
""")
def time_weighted_continuous(spark, sf):
    out = sm.interval_summary(*site_series(spark, sf), 3600, "time_weighted_continuous")
    return rounded(out, 6, "total", "average", "minimum", "maximum", "range", "percent_good")


@query(f"""
WITH {READINGS_SQL}
SELECT site, date_trunc('hour', ts) AS bucket, round(sum(value), 4) AS total, round(avg(value), 9) AS average,
       min(value) AS minimum, max(value) AS maximum, round(max(value) - min(value), 6) AS range,
       count(value) AS count, 100.0 * count(value) / count(*) AS percent_good
FROM readings GROUP BY 1, 2
""")
def event_weighted_hourly(spark, sf):
    out = sm.interval_summary(*site_series(spark, sf), 3600, "event_weighted")
    return rounded(rounded(out, 9, "average"), 4, "total").withColumn("range", F.round("range", 6))


@query(SEGMENTS_SQL.replace("PARTITION BY site ORDER", "PARTITION BY site, asset ORDER")
       .replace("SELECT site, ts, value, lead", "SELECT site, asset, ts, value, lead")
       .replace("date_trunc('hour', ts)", "date_trunc('day', ts)::TIMESTAMP")
       .replace("INTERVAL 1 HOUR", "INTERVAL 1 DAY") + """
SELECT site, asset, bucket, round(max(value) - min(value), 6) AS range FROM edge GROUP BY 1, 2, 3
""")
def tracker_daily_range(spark, sf):
    rows = readings(spark, sf)
    by = fit_series(rows, ["site", "asset"], ["ts", "event_id"])
    out = sm.interval_summary(rows, by, 86400, "time_weighted_discrete")
    return rounded(out, 6, "range").select("site", "asset", "bucket", "range")


@query(f"""
WITH {READINGS_SQL},
side AS (
  SELECT site, asset, arg_max((ts, value), ts) FILTER (ts <= TIMESTAMP '2024-01-05') AS s0,
         arg_min((ts, value), ts) FILTER (ts >= TIMESTAMP '2024-01-05') AS s1,
         arg_max((ts, value), ts) FILTER (ts <= TIMESTAMP '2024-01-20') AS e0,
         arg_min((ts, value), ts) FILTER (ts >= TIMESTAMP '2024-01-20') AS e1
  FROM readings WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT site, asset,
  round(coalesce(s0[2] + (s1[2] - s0[2]) * coalesce((epoch_us(TIMESTAMP '2024-01-05') - epoch_us(s0[1]))::DOUBLE / nullif(epoch_us(s1[1]) - epoch_us(s0[1]), 0), 0), s0[2], s1[2]), 6) AS start_value,
  round(coalesce(e0[2] + (e1[2] - e0[2]) * coalesce((epoch_us(TIMESTAMP '2024-01-20') - epoch_us(e0[1]))::DOUBLE / nullif(epoch_us(e1[1]) - epoch_us(e0[1]), 0), 0), e0[2], e1[2]), 6) AS end_value
FROM side
""")
def boundary_values(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-20"))
    out = sm.boundary_values(readings(spark, sf), ["site", "asset"], start, end)
    return rounded(out, 6, "start_value", "end_value")


@query("""
SELECT event_type AS site, user_id AS asset, count(*) AS n_rows,
       count(try_cast(nullif(json_extract_string(props, '$.k'), '7') AS DOUBLE)) = 0 AS omitted
FROM events GROUP BY 1, 2
""")
def usable_items(spark, sf):
    text = F.get_json_object("props", "$.k")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("site"),
        F.col("user_id").alias("asset"),
        F.when(text == "7", "Bad Data").otherwise(text).alias("value"),
    )
    return sm.usable_items(rows, ["site", "asset"])


@query(f"""
WITH {READINGS_SQL}
SELECT site, date_trunc('hour', ts) AS ts, round(avg(v), 9) AS mean, round(coalesce(sum(v), 0), 4) AS sum,
       max(v) AS max, min(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS all_bad
FROM (SELECT *, CASE WHEN value <= 100 THEN value END AS v FROM readings) GROUP BY 1, 2
""")
def across_assets(spark, sf):
    rows = readings(spark, sf).select(
        "site", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
    )
    return rounded(rounded(sm.across_assets(rows, ["site", "ts"]), 9, "mean"), 4, "sum")


@query(f"""
WITH {READINGS_SQL}
SELECT site, month(ts)::INTEGER AS month, hour(ts)::INTEGER AS hour, round(avg(value), 9) AS profile
FROM readings GROUP BY 1, 2, 3
""")
def month_hour_profile(spark, sf):
    return rounded(sm.month_hour_profile(readings(spark, sf), ["site"]), 9, "profile")


@query(f"""
WITH {READINGS_SQL},
share AS (
  SELECT site, asset, count(*) AS n_rows, avg(CASE WHEN value * 4 < -30 OR value * 4 > 90 THEN 1.0 ELSE 0.0 END) AS share_outside
  FROM readings GROUP BY 1, 2),
site AS (
  SELECT *, count(*) OVER (PARTITION BY site) AS n_sensors,
         count(*) FILTER (share_outside > 0.7) OVER (PARTITION BY site) AS n_bad,
         row_number() OVER (PARTITION BY site ORDER BY CASE WHEN share_outside > 0.7 THEN 0 ELSE 1 END, share_outside, asset) AS rk
  FROM share)
SELECT site, asset, n_rows, round(share_outside, 9) AS share_outside, n_sensors, n_bad,
       share_outside > 0.7 AND n_sensors > 1 AND NOT (n_bad = n_sensors AND rk = 1) AS removed
FROM site
""")
def bad_sensor_share(spark, sf):
    rows = readings(spark, sf).withColumn("value", F.col("value") * 4)
    return rounded(qc.bad_temperature_sensors(rows, ["site"], "asset"), 9, "share_outside")


@query(f"""
WITH {READINGS_SQL}
SELECT site, min(value) AS lowest, max(value) AS highest, round(quantile_cont(value, 0.95), 6) AS p95,
       round(CASE WHEN quantile_cont(value, 0.95) > 0
             THEN (max(value) - quantile_cont(value, 0.95)) / quantile_cont(value, 0.95) ELSE 0 END, 6) AS ratio
FROM readings GROUP BY 1
""")
def spike_ratio(spark, sf):
    return rounded(sm.spike_ratio(readings(spark, sf), ["site"]), 6, "p95", "ratio")


@query(f"""
WITH {READINGS_SQL},
q AS (SELECT site, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM readings GROUP BY 1)
SELECT r.event_id, r.site, r.ts, r.value, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
FROM readings r JOIN q USING (site)
WHERE r.value < q1 - 1.5 * (q3 - q1) OR r.value > q3 + 1.5 * (q3 - q1)
""")
def iqr_outliers(spark, sf):
    out = sm.iqr_outliers(readings(spark, sf), ["site"])
    return rounded(out, 6, "lower", "upper").select("event_id", "site", "ts", "value", "lower", "upper")


@query(f"""
WITH {READINGS_SQL},
z AS (
  SELECT *, CASE WHEN count(value) OVER w = 30 THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS zscore
  FROM readings WINDOW w AS (PARTITION BY site ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT event_id, site, ts, value, round(zscore, 6) AS zscore FROM z WHERE abs(zscore) > 3
""")
def rolling_z_outliers(spark, sf):
    out = qc.rolling_zscore(*site_series(spark, sf), qc.ZSCORE_ROWS[1])
    return rounded(out.filter(F.abs("zscore") > 3), 6, "zscore").select(
        "event_id", "site", "ts", "value", "zscore"
    )


@query(f"""
WITH {READINGS_SQL},
d AS (
  SELECT *, abs(lead(value) OVER (PARTITION BY site ORDER BY ts, event_id) - value) AS d1 FROM readings),
j AS (
  SELECT *, CASE WHEN count(d1) OVER w = 4 THEN avg(d1) OVER w END AS jump
  FROM d WINDOW w AS (PARTITION BY site ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING))
SELECT event_id, site, ts, round(jump, 6) AS jump FROM j WHERE jump > 100
""")
def centred_rolling_outliers(spark, sf):
    out = qc.jump_score(*site_series(spark, sf)).filter(F.col("jump") > 100)
    return rounded(out, 6, "jump").select("event_id", "site", "ts", "jump")


R2 = """CASE WHEN count(t) = 0 THEN NULL WHEN var_pop(t) = 0 THEN CASE WHEN sum((t - p) ** 2) = 0 THEN 1.0 ELSE 0.0 END
     ELSE 1 - sum((t - p) ** 2) / (var_pop(t) * count(t)) END"""


@query(f"""
SELECT l_returnflag AS site, CAST(l_shipdate AS DATE) AS date, round({R2}, 6) AS r2
FROM (SELECT *, l_extendedprice / 2000 AS t, l_quantity AS p FROM lineitem) GROUP BY 1, 2
""")
def r2_by_day(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / 2000).alias("t"),
        F.col("l_quantity").alias("p"),
    )
    return rows.groupBy("site", "date").agg(F.round(sm.r2_score("t", "p"), 6).alias("r2"))


CLEAR_SQL = f"""
WITH rows AS (
  SELECT l_returnflag AS site, l_shipdate AS ts, l_linestatus || l_linenumber AS attribute,
         l_quantity AS t, l_quantity * (0.9 + l_discount * 2) AS p FROM lineitem),
days AS (SELECT site, CAST(ts AS DATE) AS date, {R2} AS r2 FROM rows GROUP BY 1, 2),
pool AS (
  SELECT *, bool_or(abs(r2 - 1) < 0.1) OVER (PARTITION BY site) AS any_clear FROM days WHERE r2 IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY r2 DESC, date) AS rank FROM pool
  WHERE abs(r2 - 1) < 0.1 OR NOT any_clear)
"""


def _clear_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        F.col("l_shipdate").alias("ts"),
        F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("attribute"),
        F.col("l_quantity").alias("t"),
        (F.col("l_quantity") * (0.9 + F.col("l_discount") * 2)).alias("p"),
    )


@query(CLEAR_SQL + "SELECT site, date, round(r2, 6) AS r2, rank::INTEGER AS rank FROM ranked WHERE rank <= 7")
def clear_day_topn(spark, sf):
    out = qc.clear_days(_clear_rows(spark, sf), ["site"], "t", "p", 7)
    return rounded(out, 6, "r2").select("site", "date", "r2", "rank")


@query(CLEAR_SQL + f"""
, ref AS (SELECT site, ts, avg(t) AS ref FROM rows GROUP BY 1, 2),
scored AS (
  SELECT site, attribute, {R2} AS r2 FROM (
    SELECT r.site, r.attribute, CASE WHEN r.p IS NOT NULL THEN ref.ref END AS t, r.p
    FROM rows r JOIN ranked d ON d.site = r.site AND d.date = CAST(r.ts AS DATE) AND d.rank <= 25
    JOIN ref ON ref.site = r.site AND ref.ts = r.ts) GROUP BY 1, 2),
full_list AS (
  SELECT s.site, s.attribute, coalesce(r2, -1000) AS r2
  FROM (SELECT DISTINCT site, attribute FROM rows) s LEFT JOIN scored USING (site, attribute))
SELECT site, attribute, round(r2, 5) AS r2,
       round((r2 - avg(r2) OVER (PARTITION BY site)) / avg(r2) OVER (PARTITION BY site) * 100, 5) AS delta_pct,
       r2 < 0.9 AS bad
FROM full_list
""")
def r2_by_sensor(spark, sf):
    rows = _clear_rows(spark, sf)
    days = qc.clear_days(rows, ["site"], "t", "p", 25)
    ref = rows.groupBy("site", "ts").agg(F.avg("t").alias("ref"))
    sensors = rows.select("site", "attribute", "ts", F.col("p").alias("value"))
    return rounded(qc.sensor_scores(sensors, ref, days, ["site"]), 5, "r2", "delta_pct")


@query(f"""
WITH {READINGS_SQL}
SELECT site, CAST(ts AS DATE) AS day, round(sum(CASE WHEN value - 20 >= 0 THEN value - 20 END) / 60 / 1000, 9) AS kwh_m2
FROM readings GROUP BY 1, 2
""")
def insolation_daily(spark, sf):
    value = F.col("value") - 20
    out = readings(spark, sf).groupBy("site", F.to_date("ts").alias("day"))
    return out.agg(F.round(sm.insolation(value, 1 / 60), 9).alias("kwh_m2"))


@query(f"""
WITH {READINGS_SQL}
SELECT site, asset, date_trunc('hour', ts) AS hour_start,
       CAST(sum(CASE WHEN value > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS minutes_available
FROM readings GROUP BY 1, 2, 3
""")
def availability_minutes(spark, sf):
    return sm.availability_minutes(readings(spark, sf), ["site", "asset"])


@query(f"""
WITH {READINGS_SQL},
v AS (SELECT site, asset, CASE WHEN value < 100 THEN value END AS value FROM readings)
SELECT site, asset, count(*) FILTER (value IS NULL) AS n_missing,
       round(1 - count(*) FILTER (value IS NULL)::DOUBLE / count(*), 9) AS share_present, max(value) AS peak
FROM v GROUP BY 1, 2
""")
def missing_and_peak(spark, sf):
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") < 100, F.col("value")))
    return rounded(sm.missing_hours(rows, ["site", "asset"]), 9, "share_present")




@query("""
SELECT p_type AS parameter, p_brand AS value, count(*) AS count,
       array_to_string(list_sort(list(DISTINCT p_size::VARCHAR)), ', ') AS holders, 1::BIGINT AS part,
       round(count(*)::DOUBLE / (SELECT count(*) FROM part q WHERE q.p_type = part.p_type), 9) AS share
FROM part GROUP BY 1, 2
""")
def param_value_counts(spark, sf):
    return rounded(sm.value_counts(_parameters(spark, sf)), 9, "share")


def _parameters(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_type").alias("parameter"), F.col("p_brand").alias("value"), F.col("p_size").alias("inverter")
    )


@query("""
WITH c AS (
  SELECT p_type AS parameter, p_brand AS value, count(*) AS count FROM part GROUP BY 1, 2),
r AS (
  SELECT *, row_number() OVER (PARTITION BY parameter ORDER BY count DESC, value) AS rk,
         count::DOUBLE / sum(count) OVER (PARTITION BY parameter) AS share FROM c)
SELECT parameter,
""" + ",\n".join(
    f"max(count) FILTER (rk = {i}) AS value_{i}, round(max(share) FILTER (rk = {i}), 9) AS share_{i}"
    for i in range(1, 26)
) + " FROM r GROUP BY 1")
def param_value_counts_wide(spark, sf):
    wide = sm.value_counts_wide(sm.value_counts(_parameters(spark, sf)))
    return rounded(wide, 9, *[c for c in wide.columns if c.startswith("share_")])


@query(f"""
WITH {READINGS_SQL},
m AS (SELECT asset, ts, event_id, value FROM readings WHERE site IN ('click', 'view', 'error', 'purchase')),
t AS (SELECT asset, ts, event_id, value AS target FROM readings WHERE site = 'signup')
SELECT m.asset, m.ts, m.event_id, m.value, t.target
FROM m ASOF LEFT JOIN t ON m.asset = t.asset AND m.ts >= t.ts
""")
def asof_target(spark, sf):
    rows = readings(spark, sf).select("site", "asset", "ts", "event_id", "value")
    by = fit_series(rows, ["asset"], ["ts", "event_id"])
    measured = rows.filter("site != 'signup'").drop("site")
    target = rows.filter("site = 'signup'").drop("site")
    return lk.asof_value(measured, target, by, "value", "target", "event_id")


@query(f"""
WITH {READINGS_SQL},
scale AS (SELECT asset, max(value) > 1000 AS hi FROM readings WHERE site <> 'signup' GROUP BY 1),
m AS (SELECT r.* FROM readings r WHERE site <> 'signup'),
t AS (SELECT asset, ts, event_id, value AS target FROM readings WHERE site = 'signup'),
j AS (
  SELECT m.asset, m.ts, m.event_id, m.value - t.target AS delta, t.target
  FROM m ASOF LEFT JOIN t ON m.asset = t.asset AND m.ts >= t.ts),
n AS (
  SELECT *, coalesce(abs(delta) > 40, false) AS hit,
         sum(CASE WHEN coalesce(abs(delta) > 40, false) THEN 0 ELSE 1 END)
           OVER (PARTITION BY asset ORDER BY ts, event_id) AS island,
         greatest(coalesce(lead(ts) OVER (PARTITION BY asset ORDER BY ts, event_id) - INTERVAL 1 SECOND, ts), ts) AS until FROM j)
SELECT asset, min(ts) AS start_time, arg_min(target, ts) AS start_setpoint, max(until) AS end_time,
       arg_max(target, ts) AS end_setpoint, round(max(delta), 6) AS max_delta, round(min(delta), 6) AS min_delta,
       round((epoch_us(max(until)) - epoch_us(min(ts))) / 6e7, 6) AS minutes
FROM n WHERE hit GROUP BY asset, island
""")
def excursion_events(spark, sf):
    rows = readings(spark, sf).select("site", "asset", "ts", "event_id", "value")
    by = fit_series(rows, ["asset"], ["ts", "event_id"])
    measured = rows.filter("site != 'signup'").drop("site")
    target = rows.filter("site = 'signup'").drop("site")
    out = ev.voltage_excursions(measured, target, by, "event_id", band=40.0)
    return rounded(out, 6, "max_delta", "min_delta", "minutes")


@query(f"""
WITH {READINGS_SQL}
SELECT event_id, site, asset, round(CASE WHEN max(value) OVER (PARTITION BY site, asset) > 200 THEN value * 0.1 ELSE value END, 6) AS value
FROM readings
""")
def rescale_by_max(spark, sf):
    out = ev.rescale_by_max(readings(spark, sf), ["site", "asset"], "value", 200, lambda v: v / 10)
    return rounded(out, 6, "value").select("event_id", "site", "asset", "value")


@query("""
WITH limits AS (
  SELECT s_nationkey, s_suppkey, CASE WHEN s_acctbal > 1000 THEN s_acctbal END AS lim FROM supplier),
mean AS (SELECT s_nationkey, round_even(avg(lim), 0) AS m FROM limits GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_extendedprice > 900 THEN round(least(greatest(l_extendedprice / 8, 1000), coalesce(lim, m)), 6) END AS power
FROM lineitem JOIN limits ON l_suppkey = s_suppkey JOIN mean USING (s_nationkey)
""")
def null_safe_clip(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey", F.when(F.col("s_acctbal") > 1000, F.col("s_acctbal")).alias("lim")
    )
    mean = supplier.groupBy("s_nationkey").agg(F.bround(F.avg("lim"), 0).alias("m"))
    limits = supplier.join(mean, "s_nationkey").select("s_suppkey", F.coalesce("lim", "m").alias("lim"))
    raw = F.when(F.col("l_extendedprice") > 900, F.col("l_extendedprice") / 8)
    out = table(spark, sf, "lineitem").join(limits, F.col("l_suppkey") == F.col("s_suppkey"))
    power = F.round(clip(raw, 1000, F.col("lim")), 6).alias("power")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", power)


@query("""
WITH e AS (
  SELECT o_orderkey, o_orderpriority AS site, o_orderdate AS a,
         o_orderdate + CAST(floor(o_totalprice / 100) AS BIGINT) * INTERVAL 1 MINUTE AS z FROM orders),
w AS (
  SELECT site, min(a) + INTERVAL 700 DAY AS s, min(a) + INTERVAL 702 DAY AS t FROM e GROUP BY 1)
SELECT o_orderkey, site, a AS event_start, z AS event_end, a < s AS existing_event, z > t AS ongoing_event,
       greatest(a, s) AS effective_start, least(z, t) AS effective_end,
       CAST(date_diff('second', greatest(a, s), least(z, t)) AS BIGINT) AS effective_seconds
FROM e JOIN w USING (site)
WHERE a < t AND z > s AND date_diff('second', greatest(a, s), least(z, t)) < date_diff('second', s, t)
""")
def overlap_clip(spark, sf):
    orders = table(spark, sf, "orders")
    minutes = F.floor(F.col("o_totalprice") / 100)
    rows = orders.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("site"),
        F.col("o_orderdate").alias("event_start"),
        add_time("o_orderdate", minutes, "minute").alias("event_end"),
    )
    first = rows.groupBy("site").agg(F.min("event_start").alias("_a"))
    windows = first.select(
        "site", add_time("_a", 700, "day").alias("range_start"), add_time("_a", 702, "day").alias("range_end")
    )
    return lk.overlap_clip(rows, windows, ["site"])


@query("""
SELECT c_mktsegment AS site, o_orderstatus AS category, count(*) AS n_events,
       count(DISTINCT c_nationkey) AS n_assets, CAST(sum(floor(o_totalprice)) AS BIGINT) AS total_seconds,
       round(sum(floor(o_totalprice)) / 3600, 1) AS approx_hours,
       array_to_string(list_sort(list(DISTINCT c_nationkey::VARCHAR)), ', ') AS asset_names, 1::BIGINT AS part
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def event_category_summary(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = orders.select(
        F.col("c_mktsegment").alias("site"),
        F.col("o_orderstatus").alias("category"),
        F.col("c_nationkey").alias("primary_element"),
        F.floor("o_totalprice").alias("duration_s"),
    )
    return ev.category_summary(rows)


@query(f"""
WITH {READINGS_SQL},
f AS (SELECT site, (asset % 3)::VARCHAR AS part, asset, event_id, ts, value, 'file' || (asset % 3)::VARCHAR AS file, 'A' || (asset % 7)::VARCHAR AS attribute FROM readings),
c AS (SELECT site, attribute FROM f GROUP BY 1, 2 HAVING count(DISTINCT file) = (SELECT count(DISTINCT file) FROM f g WHERE g.site = f.site)),
r AS (SELECT f.*, row_number() OVER (PARTITION BY f.site, f.attribute, ts ORDER BY file, event_id) AS rn FROM f JOIN c ON c.site = f.site AND c.attribute = f.attribute)
SELECT site, attribute, ts, value FROM r WHERE rn = 1
""")
def load_periods_common(spark, sf):
    """Files of three periods; only attributes that all files of a site have stay."""
    rows = readings(spark, sf).select(
        "site", F.concat(F.lit("A"), (F.col("asset") % 7).cast("string")).alias("attribute"), "ts", "value", "event_id",
        F.concat(F.lit("file"), (F.col("asset") % 3).cast("string")).alias("file"),
    )
    first = ta.dedupe_first(rows, ["site", "attribute", "ts", "file"], ["event_id"]).drop("event_id")
    return iv.load_periods(first, rows.select("file").distinct(), ["site", "attribute", "ts"]).select("site", "attribute", "ts", "value")


@query(f"""
WITH {READINGS_SQL}
SELECT 'f_' || site AS file, 'V' AS attribute, ts, value FROM (SELECT site, date_trunc('second', ts) AS ts, max(value) AS value FROM readings GROUP BY 1, 2)
UNION ALL SELECT 'f_' || site, 'K', ts, k FROM (SELECT site, date_trunc('second', ts) AS ts, max(k) AS k FROM readings GROUP BY 1, 2)
""")
def wide_csv_rows(spark, sf):
    """Interval files with a header and a footer line, parsed from their lines."""
    rows = readings(spark, sf).groupBy("site", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.max("value").alias("value"), F.max("k").alias("k")
    )
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.coalesce(F.col("value").cast("string"), F.lit("")), F.coalesce(F.col("k").cast("string"), F.lit("")))
    body = rows.select(F.concat(F.lit("f_"), "site").alias("file"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("line_no"), line.alias("line"))
    files = body.select("file").distinct()
    extra = F.array(
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit("Timestamp,V,K").alias("line")),
        F.struct(F.lit(99999999999).cast("bigint").alias("line_no"), F.lit("Total,11,12").alias("line")),
    )
    lines = body.unionByName(files.select("file", F.inline(extra)))
    return iv.wide_rows(lines)
