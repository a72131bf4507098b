"""Quality-control and backfill queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.values import rounded
from gridloom.catalog.views import (
    ATTRIBUTES_SQL,
    READINGS_SQL,
    attribute_readings,
    by_site,
    readings,
)
from gridloom.core.ordered import fit_series
from gridloom.core.session import cut_lineage
from gridloom.functions.scalars import floor_time
from gridloom.operators import naming as nm
from gridloom.operators import quality as qc
from gridloom.plans import backfill as bf

SENSOR = ["site", "attribute"]
RUN_ROWS = {"default": 20, "TEMP": 40, "METER": 40, "PAD": 50, "WIND": 60}


def by_sensor(rows):
    return fit_series(rows, SENSOR, ["ts", "event_id"])


def is_day():
    return F.hour("ts").between(6, 17)


# coarse sensor resolution gives spikes as well as long flat stretches
def coarse():
    return F.floor(F.col("value") / 200) * 2000.0


COARSE_SQL = "floor(value / 200) * 2000.0"


@query(f"""
WITH {ATTRIBUTES_SQL},
v AS (SELECT site, attribute, ts, event_id, value * 10 AS value FROM attribute_readings),
d AS (SELECT *, abs(lead(value) OVER (PARTITION BY attribute ORDER BY ts, event_id) - value) AS d1 FROM v),
j AS (
  SELECT *, CASE WHEN count(d1) OVER w = 4 THEN avg(d1) OVER w END AS jump
  FROM d WINDOW w AS (PARTITION BY attribute ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)),
s AS (
  SELECT attribute, CASE WHEN quantile_cont(value, 0.95) > 0
    THEN (max(value) - quantile_cont(value, 0.95)) / quantile_cont(value, 0.95) ELSE 0 END AS ratio
  FROM v GROUP BY 1),
f AS (
  SELECT j.*, coalesce(CASE WHEN attribute LIKE 'Wind%' THEN abs(value) > 24
              WHEN attribute LIKE '%Temp%' THEN value < -30 OR value > 90 ELSE jump > 1000 END
         AND NOT ((attribute LIKE 'Wind%' OR attribute LIKE 'ActivePower%') AND ratio < 5), false) AS outlier
  FROM j JOIN s USING (attribute))
SELECT attribute, ts, event_id, CASE WHEN NOT outlier THEN round(value, 4) END AS value, outlier FROM f
""")
def null_outliers(spark, sf):
    rows = attribute_readings(spark, sf).withColumn("value", F.col("value") * 10)
    out = qc.null_outliers(rows, by_sensor(rows))
    return rounded(out, 4, "value").select("attribute", "ts", "event_id", "value", "outlier")


MARKED_SQL = """
m1 AS (SELECT *, lead(value) OVER (PARTITION BY attribute ORDER BY ts, event_id) - value AS d1 FROM base),
m2 AS (SELECT *, lead(d1) OVER (PARTITION BY attribute ORDER BY ts, event_id) - d1 AS d2 FROM m1),
m3 AS (
  SELECT *, CASE WHEN count(d2) OVER w = 15 THEN round_even(avg(d2) OVER w, 4) END AS curve
  FROM m2 WINDOW w AS (PARTITION BY attribute ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)),
marked AS (
  SELECT *, coalesce(curve = 0 AND (attribute NOT LIKE 'ActivePower%' OR value > 1), false) AS flat,
         sum(CASE WHEN coalesce(abs(curve) > 0, false) THEN 1 ELSE 0 END)
           OVER (PARTITION BY attribute ORDER BY ts, event_id) AS island,
         hour(ts) BETWEEN 6 AND 17 AS is_day
  FROM m3),
stats AS (
  SELECT attribute, island, count(*) AS n_rows, min(ts) AS run_start, max(ts) AS run_end,
         avg(CASE WHEN is_day THEN 0.0 ELSE 1.0 END) AS pn, avg(value) AS mean, max(value) AS hi,
         avg(abs(d1)) AS step, avg(value) FILTER (NOT is_day) AS nmean, max(value) FILTER (NOT is_day) AS nhi,
         floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) / 3600.0 AS hours
  FROM marked WHERE flat GROUP BY 1, 2),
verdicts AS (
  SELECT *, CASE WHEN attribute LIKE 'Wind%' THEN NULL
    WHEN attribute LIKE '%Temp%' AND pn > 0.70 THEN 'night_temperature'
    WHEN attribute LIKE 'ActivePower%' AND pn < 0.05 AND mean > 25 THEN 'daylight_power'
    WHEN pn < 0.05 AND hours < 2.5 AND mean > 25 AND step > 1 THEN 'daylight_linear'
    WHEN pn > 0.70 AND nmean < 5 AND nhi < 5 THEN 'night_zero'
    WHEN pn > 0.5 AND hours < 8 AND nmean < 5 AND hi < 25 THEN 'mostly_night_zero'
    WHEN pn > 0.2 AND hours < 2 THEN 'short_partial_night' END AS keep
  FROM stats
  WHERE n_rows >= CASE WHEN attribute LIKE '%Temp%' THEN 40 WHEN attribute LIKE 'Wind%' THEN 60 ELSE 20 END)
"""


@query(f"""
WITH {ATTRIBUTES_SQL},
base AS (SELECT site, attribute, ts, event_id, {COARSE_SQL} AS value FROM attribute_readings),
{MARKED_SQL}
SELECT attribute, n_rows, run_start, run_end, round(pn, 9) AS night_share, round(mean, 6) AS mean, keep
FROM verdicts
""")
def flatline_runs(spark, sf):
    rows = attribute_readings(spark, sf).withColumn("value", coarse()).withColumn("is_day", is_day())
    marked = qc.mark_flat(rows, by_sensor(rows))
    out = qc.flat_runs(marked, SENSOR, run_rows=RUN_ROWS)
    return rounded(rounded(out, 9, "night_share"), 6, "mean").select(
        "attribute", "n_rows", "run_start", "run_end", "night_share", "mean", "keep"
    )


@query(f"""
WITH {ATTRIBUTES_SQL}
SELECT attribute, ts, event_id,
       CASE WHEN attribute SIMILAR TO '(POA|GHI|ActivePower).*' AND NOT hour(ts) BETWEEN 6 AND 17 AND value > 15
            THEN 0 ELSE value END AS value
FROM attribute_readings
""")
def night_positive_zero(spark, sf):
    rows = nm.with_qc_type(attribute_readings(spark, sf)).withColumn("is_day", is_day())
    return qc.zero_night(rows).select("attribute", "ts", "event_id", "value")


@query(f"""
WITH {ATTRIBUTES_SQL}
SELECT attribute, ts, event_id,
       round(CASE WHEN attribute SIMILAR TO '(POA|GHI).*' AND value - 20 < -5 THEN 0 ELSE value - 20 END, 4) AS value
FROM attribute_readings
""")
def negative_zero(spark, sf):
    rows = nm.with_qc_type(attribute_readings(spark, sf)).withColumn("value", F.col("value") - 20)
    return rounded(qc.zero_negative(rows), 4, "value").select("attribute", "ts", "event_id", "value")


@query(f"""
WITH {ATTRIBUTES_SQL},
raw AS (
  SELECT site, attribute, ts, event_id, {COARSE_SQL} - CASE WHEN attribute LIKE 'GHI%' THEN 6 ELSE 0 END AS value
  FROM attribute_readings),
d AS (SELECT *, abs(lead(value) OVER (PARTITION BY attribute ORDER BY ts, event_id) - value) AS jd FROM raw),
j AS (
  SELECT *, CASE WHEN count(jd) OVER w = 4 THEN avg(jd) OVER w END AS jump
  FROM d WINDOW w AS (PARTITION BY attribute ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)),
s AS (
  SELECT attribute, CASE WHEN quantile_cont(value, 0.95) > 0
    THEN (max(value) - quantile_cont(value, 0.95)) / quantile_cont(value, 0.95) ELSE 0 END AS ratio
  FROM raw GROUP BY 1),
f AS (
  SELECT j.*, coalesce(CASE WHEN attribute LIKE 'Wind%' THEN abs(value) > 24
              WHEN attribute LIKE '%Temp%' THEN value < -30 OR value > 90 ELSE jump > 1000 END
         AND NOT ((attribute LIKE 'Wind%' OR attribute LIKE 'ActivePower%') AND ratio < 5), false) AS outlier
  FROM j JOIN s USING (attribute)),
base AS (SELECT site, attribute, ts, event_id, outlier, CASE WHEN NOT outlier THEN value END AS value FROM f),
{MARKED_SQL},
out1 AS (
  SELECT m.attribute, m.ts, m.is_day, m.outlier, coalesce(m.ts BETWEEN v.run_start AND v.run_end, false) AS flatline, m.value AS v0
  FROM marked m LEFT JOIN (SELECT * FROM verdicts WHERE keep IS NULL) v
    ON v.attribute = m.attribute AND v.island = m.island),
out2 AS (SELECT *, CASE WHEN NOT flatline THEN v0 END AS v1 FROM out1),
out3 AS (
  SELECT *, coalesce(attribute SIMILAR TO '(POA|GHI|ActivePower).*' AND NOT is_day AND v1 > 15, false) AS night FROM out2),
out4 AS (
  SELECT *, coalesce(attribute SIMILAR TO '(POA|GHI).*' AND CASE WHEN night THEN 0 ELSE v1 END < -5, false) AS neg FROM out3)
SELECT attribute, count(*) AS n_rows, count(*) FILTER (outlier) AS n_outlier, count(*) FILTER (flatline) AS n_flatline,
       count(*) FILTER (night) AS n_night_zeroed, count(*) FILTER (neg) AS n_negative_zeroed,
       count(*) FILTER (outlier OR flatline OR night) AS n_processed
FROM out4 GROUP BY 1
""")
def autoqc_summary(spark, sf):
    offset = F.when(F.col("attribute").startswith("GHI"), 6.0).otherwise(0.0)
    rows = attribute_readings(spark, sf).withColumn("value", coarse() - offset).withColumn("is_day", is_day())
    cleaned = qc.auto_qc(rows, by_sensor(rows), ["site"], run_rows=RUN_ROWS)
    return qc.qc_summary(cleaned, ["attribute"])


@query(f"""
WITH {READINGS_SQL},
b AS (
  SELECT *, CASE WHEN value > 150 THEN NULL WHEN value > 80 THEN 80 ELSE value END AS clean FROM readings),
n AS (
  SELECT *, value IS DISTINCT FROM clean AS diff,
         sum(CASE WHEN value IS DISTINCT FROM clean THEN 0 ELSE 1 END) OVER (PARTITION BY site ORDER BY ts, event_id) AS island
  FROM b)
SELECT site, count(*) AS n_rows, min(ts) AS range_start, max(ts) AS range_end,
       CASE WHEN bool_and(clean IS NULL) THEN 'REMOVED' WHEN bool_or(clean IS NULL) THEN 'REMOVED-MODIFIED' ELSE 'MODIFIED' END AS change
FROM n WHERE diff GROUP BY site, island
""")
def changed_ranges(spark, sf):
    raw = readings(spark, sf)
    limited = F.when(F.col("value") > 80, 80.0).otherwise(F.col("value"))
    clean = raw.withColumn("value", F.when(F.col("value") <= 150, limited))
    return qc.changed_ranges(raw, clean, by_site(raw))


@query(f"""
WITH {READINGS_SQL},
h AS (SELECT site, date_trunc('hour', ts) AS ts, max(value) AS value FROM readings GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN value > 120 THEN NULL WHEN value > 80 THEN 80 ELSE value END AS clean FROM h),
d AS (
  SELECT *, date_diff('second', lag(ts) OVER w, ts) AS p, date_diff('second', ts, lead(ts) OVER w) AS x
  FROM b WHERE value IS DISTINCT FROM clean WINDOW w AS (PARTITION BY site ORDER BY ts)),
n AS (
  SELECT *, coalesce(p, x) AS gap, sum(CASE WHEN coalesce(p, x) > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY ts) AS island FROM d)
SELECT site, count(*) AS n_rows, min(ts) AS range_start, max(ts) AS range_end,
       CASE WHEN bool_and(clean IS NULL) THEN 'REMOVED' WHEN bool_or(clean IS NULL) THEN 'REMOVED-MODIFIED' ELSE 'MODIFIED' END AS change
FROM n WHERE gap = 3600 GROUP BY site, island
""")
def changed_ranges_by_step(spark, sf):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    raw = cut_lineage(readings(spark, sf).groupBy("site", hour).agg(F.max("value").alias("value")))
    limited = F.when(F.col("value") > 80, 80.0).otherwise(F.col("value"))
    clean = raw.withColumn("value", F.when(F.col("value") <= 120, limited))
    return qc.changed_ranges(raw, clean, fit_series(raw, ["site"], ["ts"]), step_seconds=3600)


@query(f"""
WITH {ATTRIBUTES_SQL}
SELECT attribute, count(*) AS n_rows, CAST(sum(CASE
    WHEN attribute SIMILAR TO '(POA|GHI|Wind).*' AND value - 50 < 0 THEN 0
    WHEN attribute SIMILAR TO '(POA|GHI).*' AND value - 50 BETWEEN 0 AND 1500 THEN 0
    WHEN attribute LIKE 'Wind%' AND value - 50 BETWEEN 0 AND 75 THEN 0
    WHEN attribute LIKE '%Temp%' AND value - 50 BETWEEN -35 AND 150 THEN 0 ELSE 1 END) AS BIGINT) AS n_bad
FROM attribute_readings WHERE attribute NOT LIKE 'ActivePower%' GROUP BY 1
""")
def limit_check_bad(spark, sf):
    limits = spark.createDataFrame(
        [(k, lo, hi) for k, (lo, hi) in qc.SENSOR_LIMITS.items()], "sensor_type string, lower double, upper double"
    )
    rows = bf.typed_sensors(attribute_readings(spark, sf)).withColumn("value", F.col("value") - 50)
    return qc.limit_check(rows, limits).groupBy("attribute").agg(
        F.count("*").alias("n_rows"), F.sum("bad").alias("n_bad")
    )


@query(f"""
WITH {ATTRIBUTES_SQL}
SELECT attribute, count(*) FILTER (attribute LIKE 'Wind%' AND value - 50 < 0) AS n_negative,
       count(*) FILTER (CASE WHEN attribute LIKE 'Wind%' THEN value - 50 > 75 WHEN attribute LIKE '%Temp%' THEN value - 50 > 150 ELSE false END) AS n_above,
       count(*) FILTER (attribute LIKE '%Temp%' AND value - 50 < -35) AS n_below
FROM attribute_readings WHERE attribute NOT LIKE 'ActivePower%' GROUP BY 1
""")
def sensor_limit_counts(spark, sf):
    rows = bf.typed_sensors(attribute_readings(spark, sf)).withColumn("value", F.col("value") - 50)
    return qc.negative_check(rows).groupBy("attribute").agg(
        F.count_if("negative").alias("n_negative"),
        F.count_if("above").alias("n_above"),
        F.count_if("below").alias("n_below"),
    )


def met_rows(spark, sf):
    """Three sensors per weather type, minute stamps; wind can be negative."""
    rows = readings(spark, sf)
    kind = (
        F.when(F.col("site") == "click", "POA_")
        .when(F.col("site") == "view", "GHI_")
        .when(F.col("site") == "signup", "Wind_")
        .when(F.col("site") == "error", "Mod_Temp_")
    )
    return rows.filter(kind.isNotNull()).select(
        F.lit("plant").alias("site"),
        F.concat(kind, (F.col("asset") % 3).cast("string")).alias("attribute"),
        floor_time("minute", "ts").alias("ts"),
        F.when(F.col("site") == "signup", F.col("value") - 5).otherwise(F.col("value")).alias("value"),
    )


def weather_rows(spark, sf):
    """Hourly reference weather derived from all readings."""
    rows = readings(spark, sf)

    def mean(kind):
        return F.avg(F.when(F.col("site") == kind, F.col("value")))

    return rows.groupBy(F.lit("plant").alias("site"), floor_time("hour", "ts").alias("ts")).agg(
        mean("view").alias("ghi"),
        (mean("view") + mean("error") / 20).alias("ghi_clearsky"),
        mean("click").alias("poa_global"),
        F.avg("value").alias("temp_air"),
        F.avg("k").alias("wind_speed"),
    )


def met_tables(spark, sf):
    """Sensor and reference weather tables, stored as they would be landed."""
    return cut_lineage(met_rows(spark, sf)), cut_lineage(weather_rows(spark, sf))


MET_SQL = f"""
WITH {READINGS_SQL},
met AS (
  SELECT 'plant' AS site, date_trunc('minute', ts) AS ts,
         CASE site WHEN 'click' THEN 'poa' WHEN 'view' THEN 'ghi' WHEN 'signup' THEN 'wind' ELSE 'mod_temp' END AS sensor_type,
         CASE site WHEN 'click' THEN 'POA_' WHEN 'view' THEN 'GHI_' WHEN 'signup' THEN 'Wind_' ELSE 'Mod_Temp_' END
           || (asset % 3)::VARCHAR AS attribute,
         CASE WHEN site = 'signup' THEN value - 5 ELSE value END AS value
  FROM readings WHERE site <> 'purchase'),
weather AS (
  SELECT 'plant' AS site, date_trunc('hour', ts) AS ts, avg(value) FILTER (site = 'view') AS ghi,
         avg(value) FILTER (site = 'view') + avg(value) FILTER (site = 'error') / 20 AS ghi_clearsky,
         avg(value) FILTER (site = 'click') AS poa_global, avg(value) AS temp_air, avg(k) AS wind_speed
  FROM readings GROUP BY 2),
days AS (
  SELECT CAST(ts AS DATE) AS date,
         1 - sum((ghi_clearsky - ghi) ** 2) / (var_pop(CASE WHEN ghi IS NOT NULL THEN ghi_clearsky END) * count(CASE WHEN ghi IS NOT NULL THEN ghi_clearsky END)) AS r2
  FROM weather WHERE ghi IS NOT NULL AND ghi_clearsky IS NOT NULL GROUP BY 1),
pool AS (SELECT *, bool_or(abs(r2 - 1) < 0.1) OVER () AS any_clear FROM days),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY r2 DESC, date) AS rk FROM pool WHERE abs(r2 - 1) < 0.1 OR NOT any_clear),
hourly AS (
  SELECT sensor_type, attribute, date_trunc('hour', ts) AS ts, avg(greatest(0, least(1500, value))) AS value
  FROM met WHERE sensor_type IN ('poa', 'ghi') GROUP BY 1, 2, 3),
paired AS (
  SELECT h.sensor_type, h.attribute, CASE h.sensor_type WHEN 'poa' THEN poa_global ELSE ghi END AS t, h.value AS p
  FROM hourly h JOIN ranked r ON r.date = CAST(h.ts AS DATE) AND rk <= 5 JOIN weather w ON w.ts = h.ts),
scores AS (
  SELECT sensor_type, attribute, 1 - sum((t - p) ** 2) / (var_pop(t) * count(t)) AS r2 FROM paired GROUP BY 1, 2),
bad AS (SELECT attribute FROM scores WHERE r2 < 1 - 0.6),
kept AS (
  SELECT *, CASE WHEN sensor_type IN ('poa', 'ghi') THEN greatest(0, least(1500, value))
                 WHEN sensor_type = 'wind' AND value < 0 THEN 0 ELSE value END AS cleaned,
         CASE WHEN (sensor_type = 'wind' AND value < 0) OR value IS NULL THEN 1 ELSE 0 END AS bad
  FROM met WHERE attribute NOT IN (SELECT attribute FROM bad)),
averaged AS (
  SELECT ts, sensor_type, avg(cleaned) AS average, min(bad) AS all_bad FROM kept GROUP BY 1, 2),
absent AS (
  SELECT DISTINCT ts, k.sensor_type, NULL::DOUBLE AS average, 1 AS all_bad
  FROM averaged, (SELECT unnest(['poa', 'ghi', 'amb_temp', 'wind']) AS sensor_type) k
  WHERE k.sensor_type NOT IN (SELECT sensor_type FROM averaged)),
profile AS (
  SELECT sensor_type, month(ts) AS m, hour(ts) AS h, avg(average) AS profile FROM averaged GROUP BY 1, 2, 3),
filled AS (
  SELECT a.*, p.profile, CASE a.sensor_type WHEN 'poa' THEN poa_global WHEN 'ghi' THEN ghi WHEN 'amb_temp' THEN temp_air
              WHEN 'wind' THEN wind_speed ELSE p.profile END AS fill
  FROM (SELECT * FROM averaged UNION ALL SELECT * FROM absent) a
  LEFT JOIN profile p ON p.sensor_type = a.sensor_type AND p.m = month(a.ts) AND p.h = hour(a.ts)
  LEFT JOIN weather w ON w.ts = date_trunc('hour', a.ts)),
final AS (
  SELECT *, CASE WHEN all_bad = 0 THEN average ELSE fill END AS processed FROM filled)
"""


@query(MET_SQL + """
SELECT 'plant' AS site, ts, sensor_type, round(average, 9) AS average, all_bad, round(profile, 9) AS profile,
       round(processed, 9) AS processed, average IS DISTINCT FROM processed AS filled
FROM final
""")
def profile_backfill(spark, sf):
    out = bf.backfill(*met_tables(spark, sf), ["site"], max_gap=0.6)
    return rounded(out, 9, "average", "profile", "processed")


@query(MET_SQL + """
SELECT 'plant' AS site, attribute AS item, 'removed_columns' AS rule, 1::BIGINT AS n FROM bad
UNION ALL SELECT 'plant', attribute, 'negative', count(*) FROM kept WHERE sensor_type = 'wind' AND value < 0 GROUP BY attribute
UNION ALL SELECT 'plant', attribute, 'above', count(*) FROM kept
  WHERE cleaned > CASE WHEN sensor_type = 'wind' THEN 75 WHEN sensor_type = 'mod_temp' THEN 150 ELSE 1500 END GROUP BY attribute
UNION ALL SELECT 'plant', sensor_type, 'backfilled_data', count(*) FROM final
  WHERE average IS DISTINCT FROM processed GROUP BY sensor_type
""")
def backfill_change_log(spark, sf):
    return bf.change_log(*met_tables(spark, sf), ["site"], max_gap=0.6)


@query(MET_SQL + """
, mean AS (SELECT ts, avg(value) AS mean FROM met WHERE sensor_type = 'poa' GROUP BY 1),
prof AS (SELECT month(ts) AS m, hour(ts) AS h, avg(mean) AS profile FROM mean GROUP BY 1, 2)
SELECT 'plant' AS site, s.attribute, s.ts, s.value, round(mean, 6) AS mean, round(prof.profile, 6) AS profile, round(poa_global, 6) AS poa_global
FROM met s JOIN mean USING (ts) JOIN prof ON m = month(s.ts) AND h = hour(s.ts)
LEFT JOIN weather w ON w.ts = date_trunc('hour', s.ts) WHERE s.sensor_type = 'poa'
""")
def poa_comparison(spark, sf):
    out = bf.poa_comparison(*met_tables(spark, sf), ["site"])
    return rounded(out, 6, "mean", "profile", "poa_global")
