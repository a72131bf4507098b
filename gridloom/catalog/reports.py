"""Report, curtailment, compliance, combiner and day-ahead queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.values import rounded
from gridloom.catalog.views import READINGS_SQL, readings, table
from gridloom.core.ordered import series
from gridloom.core.session import cut_lineage
from gridloom.functions.scalars import add_time, floor_time
from gridloom.operators.timeaxis import resample
from gridloom.plans import combiner as cb
from gridloom.plans import compliance as cp
from gridloom.plans import curtailment as ct
from gridloom.plans import dayahead as da
from gridloom.plans import modelinputs as mi
from gridloom.plans import report as rp

CAP = 1.5


def production(spark, sf):
    """Production rows: site, inverter and hour of a line item."""
    day = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        (F.col("l_suppkey") % 8).alias("inv"),
        add_time(day, (F.dayofmonth("l_shipdate") % 4) * 24 + F.col("l_linenumber") + 7, "hour").alias("ts"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )


def site_hours(spark, sf):
    q, d, t = F.avg("l_quantity"), F.avg("l_discount"), F.avg("l_tax")
    return production(spark, sf).groupBy("site", "ts").agg(
        (q * 30).alias("poa"),
        (d * 500).alias("module_temp"),
        (t / 10).alias("mods_offline_pct"),
        (d / 10 - 0.002).alias("soiling_pct"),
        (F.sum("l_quantity") / 100 * (0.9 + t * 5)).alias("meter_mwh"),
        F.when(d < 0.035, 0.5).otherwise(CAP).alias("setpoint_mw"),
    )


def inverter_hours(spark, sf):
    kw = F.when(F.col("l_discount") > 0.015, F.col("l_quantity") * 10).otherwise(0.0)
    return production(spark, sf).groupBy("site", "inv", "ts").agg(
        F.avg(kw).alias("kw"),
        F.avg(F.col("l_extendedprice") / 150).alias("model_kw"),
        F.min(F.when(F.col("l_tax") > 0.015, 60).otherwise(30)).alias("avail_min"),
    )


def meta(spark, sf):
    sites = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("site")).distinct()
    return sites.select(
        "site", F.lit(CAP).alias("mwac"), F.lit(1.9).alias("mwdc"), F.lit(0.004).alias("tcoeff")
    )


def overrides(spark, sf):
    """External curtailment totals of one site."""
    return (
        table(spark, sf, "orders")
        .groupBy(floor_time("month", "o_orderdate").alias("month"))
        .agg((F.sum("o_totalprice") / 1e6).alias("curtailment_override"))
        .select(F.lit("A").alias("site"), "month", "curtailment_override", F.lit(None).cast("double").alias("meter_override"))
    )


def report_of(spark, sf):
    return rp.monthly_report(site_hours(spark, sf), inverter_hours(spark, sf), meta(spark, sf), overrides(spark, sf))


PRODUCTION_SQL = """
WITH production AS (
  SELECT l_returnflag AS site, l_suppkey % 8 AS inv,
         date_trunc('month', l_shipdate)::TIMESTAMP + ((day(l_shipdate) % 4) * 24 + l_linenumber + 7)::INTEGER * INTERVAL 1 HOUR AS ts,
         l_quantity AS q, l_extendedprice AS ep, l_discount AS d, l_tax AS t FROM lineitem),
sh AS (
  SELECT site, ts, avg(q) * 30 AS poa, avg(d) * 500 AS module_temp, avg(t) / 10 AS mods, avg(d) / 10 - 0.002::DOUBLE AS soil,
         sum(q) / 100 * (0.9::DOUBLE + avg(t) * 5) AS meter, CASE WHEN avg(d) < 0.035::DOUBLE THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS sp
  FROM production GROUP BY 1, 2),
ih AS (
  SELECT site, inv, ts, avg(CASE WHEN d > 0.015 THEN q * 10 ELSE 0 END) AS kw, avg(ep / 150) AS model_kw,
         min(CASE WHEN t > 0.015 THEN 60 ELSE 30 END) AS avail FROM production GROUP BY 1, 2, 3),
sums AS (
  SELECT site, ts, sum(kw) / 1000 AS actual, sum(model_kw) AS model_sum, count(*) FILTER (kw = 0) AS n_zero
  FROM ih GROUP BY 1, 2),
counts AS (SELECT site, date_trunc('month', ts)::TIMESTAMP AS month, count(DISTINCT inv) AS n_inv FROM ih GROUP BY 1, 2),
r0 AS (
  SELECT sh.*, date_trunc('month', ts)::TIMESTAMP AS month, actual, model_sum, n_zero, least(model_sum / 1000, 1.5::DOUBLE) AS possible,
         module_temp + poa / 1000 * 3 AS tcell FROM sh JOIN sums USING (site, ts)),
r1 AS (
  SELECT *, sum(poa * tcell) OVER (PARTITION BY site, month) / sum(poa) OVER (PARTITION BY site, month) AS tavg FROM r0),
rows AS (
  SELECT r1.*, n_inv, 1.9::DOUBLE * poa / 1000 * (1 - 0.004::DOUBLE * (tavg - tcell)) AS endci,
         mods * possible AS module_loss, greatest(soil * possible, 0) AS soiling_loss,
         CASE WHEN sp < 1.5 AND sp < possible AND possible > meter THEN possible - meter ELSE 0 END AS curt,
         CASE WHEN actual = 0 AND meter > 0 THEN 0 WHEN meter > actual * 1.05::DOUBLE THEN 2 ELSE 1 END AS flag,
         coalesce((meter * 1.02::DOUBLE - actual) * 1000 / nullif(n_zero, 0), 0) AS calc,
         coalesce(possible * 1000 / nullif(model_sum, 0), 1) AS adj
  FROM r1 JOIN counts USING (site, month)),
inv0 AS (
  SELECT ih.*, r.month, poa, curt, flag, calc, adj, meter, n_inv, model_kw * adj AS adj_model
  FROM ih JOIN rows r ON r.site = ih.site AND r.ts = ih.ts),
raw AS (
  SELECT site, month, inv, sum(kw) FILTER (poa >= 25 AND curt = 0 AND avail = 60)
           / nullif(sum(poa) FILTER (poa >= 25 AND curt = 0 AND avail = 60), 0) AS ratio_raw FROM inv0 GROUP BY 1, 2, 3),
ratio AS (
  SELECT *, coalesce(ratio_raw, avg(CASE WHEN ratio_raw > 0 THEN ratio_raw END) OVER (PARTITION BY site, month)) AS ratio FROM raw),
inv1 AS (SELECT i.*, ratio_raw, ratio FROM inv0 i JOIN ratio USING (site, month, inv)),
t0 AS (
  SELECT site, month, inv, max(ratio_raw) AS ratio_raw, max(ratio) AS ratio,
    coalesce(sum(CASE WHEN poa >= 25 AND curt = 0 AND avail < 60 AND flag = 1 AND ratio * poa - kw > 0 THEN ratio * poa - kw END), 0) / 1000 AS downtime,
    (coalesce(sum(adj_model) FILTER (poa >= 25 AND curt > 0), 0)
      - (coalesce(sum(kw) FILTER (poa >= 25 AND curt > 0 AND flag = 1), 0)
         + coalesce(sum(meter * 1000 / n_inv) FILTER (curt > 0 AND flag <> 1), 0))) / 1000 AS curtailment,
    (sum(kw) + coalesce(sum(meter * 1000 / n_inv / 0.98::DOUBLE) FILTER (flag = 0), 0)
      + coalesce(sum(calc) FILTER (flag = 2 AND kw = 0), 0)) / 1000 AS actual,
    sum(adj_model) / 1000 AS possible
  FROM inv1 GROUP BY 1, 2, 3),
totals AS (
  SELECT *, possible - actual - curtailment - downtime AS dc_health, possible - actual - curtailment AS energetic_loss,
    CASE WHEN actual > 0 THEN (actual + curtailment) / nullif(actual + curtailment + downtime, 0) ELSE 0 END AS availability FROM t0),
hours AS (
  SELECT site, month, sum(poa) FILTER (poa >= 0) / 1000 AS insolation, sum(meter) AS meter, sum(module_loss) AS module_loss,
         sum(soiling_loss) AS soiling_loss, sum(curt) AS curt_loss FROM rows GROUP BY 1, 2),
site0 AS (
  SELECT site, month, sum(energetic_loss) AS energetic_loss, sum(dc_health) AS dc_health, sum(downtime) AS downtime,
         sum(curtailment) AS curtailment, sum(actual) AS actual, sum(possible) AS possible FROM totals GROUP BY 1, 2),
ext AS (
  SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, sum(o_totalprice) / 1e6 AS mwh
  FROM orders GROUP BY 1),
site AS (
  SELECT s.* EXCLUDE (curtailment), coalesce(e.mwh, s.curtailment) AS curtailment, insolation, meter, module_loss, soiling_loss, curt_loss
  FROM site0 s JOIN hours USING (site, month)
  LEFT JOIN ext e ON s.site = 'A' AND e.month = s.month)
"""


@query(PRODUCTION_SQL + """
SELECT site, ts, round(actual, 9) AS actual, round(possible, 9) AS possible, round(tcell, 9) AS tcell,
       round(endci, 9) AS endci, round(meter / nullif(endci, 0), 9) AS perf_ratio, round(module_loss, 14) AS module_loss,
       round(soiling_loss, 14) AS soiling_loss, round(curt, 9) AS curt_loss, flag, round(calc, 9) AS calc_kw, round(adj, 9) AS adj_factor
FROM rows
""")
def report_rows(spark, sf):
    out = rounded(
        rp.report_rows(cut_lineage(site_hours(spark, sf)), cut_lineage(inverter_hours(spark, sf)), meta(spark, sf)), 9, "actual", "possible", "tcell", "endci", "perf_ratio", "curt_loss", "adj_factor", "calc_kw"
    )
    return rounded(out, 14, "module_loss", "soiling_loss").select(
        "site", "ts", "actual", "possible", "tcell", "endci", "perf_ratio", "module_loss", "soiling_loss",
        "curt_loss", "flag", "calc_kw", "adj_factor",
    )


TOTALS = ["ratio_raw", "ratio", "downtime", "curtailment", "actual", "possible", "dc_health", "energetic_loss", "availability"]


@query(PRODUCTION_SQL + "SELECT site, month, inv, " + ", ".join(f"round({c}, 9) AS {c}" for c in TOTALS) + " FROM totals")
def inverter_totals(spark, sf):
    return rounded(report_of(spark, sf)["inverters"], 9, *TOTALS)


SITE = ["energetic_loss", "dc_health", "downtime", "curtailment", "actual", "possible", "insolation", "meter",
        "module_loss", "soiling_loss", "curt_loss"]


@query(PRODUCTION_SQL + "SELECT site, month, " + ", ".join(f"round({c}, 9) AS {c}" for c in SITE) + """,
       round((actual + curtailment) / nullif(actual + curtailment + energetic_loss, 0), 9) AS energetic_pct,
       round((actual + curtailment) / nullif(actual + curtailment + dc_health, 0), 9) AS dc_health_pct,
       round((actual + curtailment) / nullif(actual + curtailment + downtime, 0), 9) AS availability,
       round(1 - actual / nullif(actual + curtailment, 0), 9) AS curtailment_pct
FROM site""")
def site_totals(spark, sf):
    out = rounded(report_of(spark, sf)["sites"], 9, *SITE)
    return rounded(out, 9, "energetic_pct", "dc_health_pct", "availability", "curtailment_pct")


@query(PRODUCTION_SQL + """,
wide AS (
  SELECT *, (actual + curtailment) / nullif(actual + curtailment + downtime, 0) AS availability,
         (actual + curtailment) / nullif(actual + curtailment + energetic_loss, 0) AS epct FROM site)
SELECT site, month, u.metric, round(u.value, 9) AS value FROM wide, unnest([
  {'metric': 'Total Energetic Loss', 'value': energetic_loss}, {'metric': 'DC / System Health', 'value': dc_health},
  {'metric': 'Inverter Availability', 'value': availability}, {'metric': 'Downtime', 'value': downtime},
  {'metric': 'Curtailment', 'value': curtailment}, {'metric': 'Actual Generation', 'value': actual},
  {'metric': 'Possible Generation', 'value': possible}, {'metric': 'Meter Generation', 'value': meter},
  {'metric': 'Insolation', 'value': insolation}]) AS t(u)
""")
def report_summary_rows(spark, sf):
    return rounded(rp.summary_rows(report_of(spark, sf)["sites"]), 9, "value")


@query(PRODUCTION_SQL + """,
sih AS (SELECT site, date_trunc('month', ts)::TIMESTAMP AS month, count(*) FILTER (avail > 0) AS sihd FROM ih GROUP BY 1, 2),
h AS (
  SELECT site, month, max(n_inv) AS n_inv, count(*) * max(n_inv) AS calendar_hours,
         count(*) FILTER (curt > 0 AND meter < 1) * max(n_inv) AS rsih, count(*) FILTER (poa <= 20) AS ruihn,
         round(sum(meter) / nullif(sum(endci), 0), 2) AS perf_ratio FROM rows GROUP BY 1, 2),
s AS (SELECT site, month, actual, meter FROM site)
SELECT h.site, h.month, n_inv, ruihn, perf_ratio, sihd, round(meter, 9) AS net, rsih, calendar_hours, calendar_hours AS aih,
       calendar_hours - sihd - rsih - ruihn AS foihd, sihd + rsih + calendar_hours - sihd - rsih - ruihn AS asih,
       round(CASE WHEN actual > 1.15::DOUBLE * meter THEN 1.15::DOUBLE * meter WHEN actual < meter THEN meter ELSE actual END, 9) AS gross
FROM h JOIN sih USING (site, month) JOIN s USING (site, month)
""")
def unit_hours(spark, sf):
    report = report_of(spark, sf)
    out = cp.unit_hours(report["rows"], report["inverter_hours"], report["sites"])
    return rounded(out, 9, "net", "gross")


@query("""
WITH y AS (SELECT DISTINCT year(o_orderdate) + 27 AS year FROM orders),
lim AS (
  SELECT * FROM (VALUES ('solar', 2024, 100.0), ('solar', 2025, 20.0), ('wind', 2024, 100.0), ('wind', 2025, 75.0)) t(fleet, yr, cap)),
s AS (
  SELECT s_name AS site, CASE WHEN s_nationkey < 12 THEN 'solar' ELSE 'wind' END AS fleet, s_acctbal / 50 AS capacity FROM supplier)
SELECT s.fleet, site, round(capacity, 9) AS capacity, y.year::INTEGER AS year, cap::DOUBLE AS min_capacity
FROM s, y, lim WHERE lim.fleet = s.fleet AND lim.yr = least(greatest(y.year, 2024), 2025) AND capacity >= cap
""")
def eligible_sites(spark, sf):
    sites = table(spark, sf, "supplier").select(
        F.col("s_name").alias("site"),
        F.when(F.col("s_nationkey") < 12, "solar").otherwise("wind").alias("fleet"),
        (F.col("s_acctbal") / 50).alias("capacity"),
    )
    fleets = F.explode(F.array(F.lit("solar"), F.lit("wind"))).alias("fleet")
    years = table(spark, sf, "orders").select((F.year("o_orderdate") + 27).alias("year")).distinct().select("year", fleets)
    return rounded(cp.eligible_sites(sites, years, cp.capacity_limits(spark)), 9, "capacity")


@query(PRODUCTION_SQL + """,
on_count AS (SELECT site, ts, count(*) FILTER (avail = 60) + 0.4::DOUBLE AS online, avg(poa) AS poa FROM inv0 GROUP BY 1, 2),
p AS (SELECT site, ts, sum(kw) / 1e3 AS actual_mw, sum(model_kw) / 1e3 AS possible_mw FROM ih GROUP BY 1, 2)
SELECT site, ts, round(actual_mw, 9) AS actual_mw, round(possible_mw, 9) AS possible_mw, 8 AS n_assets, online, round(poa, 9) AS poa,
       round(greatest(possible_mw - actual_mw, 0), 9) AS lost_mw,
       CASE WHEN poa < 250 OR possible_mw <= 0 THEN 0 ELSE CAST(floor(8 - online) AS BIGINT) END AS n_offline
FROM on_count JOIN p USING (site, ts)
""")
def compliance_production(spark, sf):
    inv = inverter_hours(spark, sf)
    online = inv.groupBy("site", "ts").agg((F.count_if(F.col("avail_min") == 60) + 0.4).alias("online"))
    hours = online.join(site_hours(spark, sf).select("site", "ts", "poa"), ["site", "ts"])
    assets = inv.select("site", "ts", F.col("inv").alias("asset"), F.col("kw").alias("actual_kw"), F.col("model_kw").alias("possible_kw"))
    sites = meta(spark, sf).select("site", F.lit(8).alias("n_assets"))
    out = cp.production_hours(hours, assets, sites, solar=True)
    return rounded(out, 9, "actual_mw", "possible_mw", "lost_mw", "poa")


# --- curtailment -------------------------------------------------------------------

CAPACITY = 40.0


def minutes(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        add_time("l_shipdate", F.col("l_orderkey") % 1440, "minute").alias("ts"),
        (F.col("l_extendedprice") / 2000).alias("possible_mw"),
        F.col("l_quantity").alias("setpoint_mw"),
        (F.col("l_extendedprice") / 2000 * (1 - F.col("l_discount") * 3)).alias("meter_mw"),
        F.col("l_quantity").alias("dot"),
        F.when(F.col("l_tax") >= 0.015, F.when(F.col("l_tax") > 0.045, -F.col("l_tax") * 100).otherwise(0.0)).alias("supp"),
        F.lit(0.04).alias("rate_per_kwh"),
    )


MINUTES_SQL = """
WITH m AS (
  SELECT l_returnflag AS site, l_shipdate + (l_orderkey % 1440)::INTEGER * INTERVAL 1 MINUTE AS ts,
         least(l_extendedprice / 2000, 40) AS possible, l_quantity AS sp, l_extendedprice / 2000 * (1 - l_discount * 3) AS meter,
         coalesce(CASE WHEN l_tax >= 0.015 THEN CASE WHEN l_tax > 0.045 THEN -l_tax * 100 ELSE 0 END END, 0) AS supp
  FROM lineitem),
c AS (
  SELECT *, CASE WHEN sp < 40 AND sp < possible AND possible > meter THEN (possible - meter) * 1e3 / 60 ELSE 0 END AS kwh,
         CASE WHEN supp = 0 THEN 40 ELSE sp END AS msp FROM m),
k AS (
  SELECT *, CASE WHEN msp < 40 AND msp < possible AND possible > meter THEN (possible - meter) / 12 ELSE 0 END AS lost FROM c)
"""


@query(MINUTES_SQL + """
SELECT site, CAST(ts AS DATE) AS day, round(sum(kwh), 7) AS curtailed_kwh, round(count(*) FILTER (kwh > 0) / 60.0::DOUBLE, 9) AS curtailed_hours,
       round(sum(kwh) * 0.0625::DOUBLE, 11) AS lost_revenue
FROM c GROUP BY 1, 2
""")
def setpoint_curtailment_daily(spark, sf):
    rows = ct.setpoint_intervals(minutes(spark, sf), F.lit(CAPACITY))
    out = ct.daily_summary(rows, ["site"]).filter("day IS NOT NULL")
    return rounded(rounded(rounded(out, 7, "curtailed_kwh"), 9, "curtailed_hours"), 11, "lost_revenue")


@query(MINUTES_SQL + """
SELECT site, round(sum(kwh), 5) AS curtailed_kwh, round(count(*) FILTER (kwh > 0) / 60.0::DOUBLE, 9) AS curtailed_hours,
       round(sum(kwh) * 0.0625::DOUBLE, 4) AS lost_revenue
FROM c GROUP BY 1
""")
def setpoint_curtailment_totals(spark, sf):
    rows = ct.setpoint_intervals(minutes(spark, sf), F.lit(CAPACITY))
    out = ct.daily_summary(rows, ["site"]).filter("day IS NULL").drop("day")
    return rounded(rounded(rounded(out, 5, "curtailed_kwh"), 9, "curtailed_hours"), 4, "lost_revenue")


@query(MINUTES_SQL + """
SELECT site, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, round(sum(kwh), 12) AS curtailed_kwh, round(sum(kwh * 0.0625::DOUBLE), 12) AS lost_revenue,
       count(*) FILTER (kwh > 0) AS n_curtailments, round(avg(possible), 12) AS possible_mw, round(avg(meter), 12) AS meter_mw,
       round(avg(sp), 12) AS setpoint_mw
FROM c GROUP BY 1, 2
""")
def setpoint_curtailment_5min(spark, sf):
    rows = ct.setpoint_intervals(minutes(spark, sf), F.lit(CAPACITY))
    out = rounded(ct.interval_totals(rows, ["site"]), 12, "curtailed_kwh", "possible_mw", "meter_mw", "setpoint_mw")
    return rounded(out, 12, "lost_revenue")


@query("""
WITH r AS (
  SELECT l_returnflag AS site, l_shipdate + (l_orderkey % 1440)::INTEGER * INTERVAL 1 MINUTE AS ts_utc, l_extendedprice AS e,
         l_extendedprice * (1 - l_discount * 3) AS m, l_quantity * 2000 AS l FROM lineitem)
SELECT site, CAST(ts_utc - INTERVAL 6 HOUR AS DATE) AS day, count(*) AS n,
       round(sum(CASE WHEN e > m AND l < 80000 AND e > l THEN e - m ELSE 0 END), 2) AS curtailed_kw
FROM r WHERE ts_utc - INTERVAL 6 HOUR BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01' GROUP BY 1, 2
""")
def scada_curtailment(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        add_time("l_shipdate", F.col("l_orderkey") % 1440, "minute").alias("ts_utc"),
        F.col("l_extendedprice").alias("expected_kw"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount") * 3)).alias("meter_kw"),
        (F.col("l_quantity") * 2000).alias("limit_kw"),
        F.lit(80000.0).alias("capacity_kw"),
    )
    out = ct.scada_rows(rows, "1996-01-01", "1999-01-01")
    return out.groupBy("site", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.sum("curtailed_kw"), 2).alias("curtailed_kw")
    )


@query(MINUTES_SQL + """
SELECT site, CAST(ts AS DATE) AS day, round(sum(lost), 12) AS lost_mwh, count(*) FILTER (lost > 0) AS n_events,
       round(sum(lost * 0.04::DOUBLE * 1000), 12) AS lost_revenue
FROM k GROUP BY 1, 2
""")
def market_curtailment_daily(spark, sf):
    rows = ct.market_intervals(minutes(spark, sf), F.lit(CAPACITY))
    return rounded(rounded(ct.market_daily(rows, ["site"]), 12, "lost_mwh"), 12, "lost_revenue")


@query(MINUTES_SQL + """
, h AS (
  SELECT site, date_trunc('hour', ts) AS hour_start, sum(sp) / 12 AS dot, sum(supp) / 12 AS supp, count(*) FILTER (supp < 0) AS n_negative
  FROM m GROUP BY 1, 2)
SELECT site, hour_start, round(dot, 12) AS dot, round(supp, 12) AS supp, n_negative,
       round(CASE WHEN supp >= 0 THEN 40 ELSE dot END, 12) AS setpoint_mw FROM h
""")
def market_hourly_setpoint(spark, sf):
    out = ct.market_hourly(minutes(spark, sf), ["site"], F.lit(CAPACITY))
    return rounded(out, 12, "dot", "supp", "setpoint_mw")


@query("""
WITH f AS (
  SELECT o_orderpriority AS site, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
         CASE o_orderstatus WHEN 'F' THEN 'Final_' ELSE 'Draft_' END || c_mktsegment AS file,
         sum(o_totalprice) / 1e3 AS mwh, max(o_orderdate) AS file_ts
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3),
r AS (
  SELECT *, row_number() OVER (PARTITION BY site, month ORDER BY lower(file) LIKE '%final%' DESC, file_ts DESC, file DESC) AS rn FROM f)
SELECT site, month, round(mwh, 6) AS total_mwh, file AS source FROM r WHERE rn = 1
""")
def invoice_curtailment(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("o_orderstatus") == "F", "Final_").otherwise("Draft_")
    rows = orders.select(
        F.col("o_orderpriority").alias("site"),
        floor_time("month", "o_orderdate").alias("month"),
        F.concat(kind, F.col("c_mktsegment")).alias("file"),
        F.col("o_orderdate").alias("file_ts"),
        (F.col("o_totalprice") / 1e3).alias("mwh"),
    )
    return rounded(ct.invoice_totals(rows, ["site", "month"]), 6, "total_mwh")


@query(MINUTES_SQL + """
, s AS (
  SELECT l_returnflag AS site, sum(CASE WHEN e > m AND l < 80000 AND e > l THEN e - m ELSE 0 END) / 60 / 1e3 AS scada
  FROM (SELECT l_returnflag, l_extendedprice AS e, l_extendedprice * (1 - l_discount * 3) AS m, l_quantity * 2000 AS l FROM lineitem) GROUP BY 1)
SELECT site, round(sum(kwh) / 1e3, 6) AS plant, round(max(scada), 6) AS scada FROM c JOIN s USING (site) GROUP BY 1
""")
def curtailment_sources(spark, sf):
    plant = ct.setpoint_intervals(minutes(spark, sf), F.lit(CAPACITY))
    lines = table(spark, sf, "lineitem")
    e, m = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount") * 3)
    limit = F.col("l_quantity") * 2000
    held = ct.curtailed_power(limit, e, m, F.lit(80000.0)) / 60
    scada = lines.select(F.col("l_returnflag").alias("site"), held.alias("curtailed_kwh"))
    return rounded(ct.compare_sources({"plant": plant, "scada": scada}, ["site"]), 6, "plant", "scada")


# --- combiners ---------------------------------------------------------------------


def combiner_tables(spark, sf):
    """Combiner currents from readings: event type as inverter, user as combiner."""
    rows = readings(spark, sf)
    hour = floor_time("hour", "ts")
    cmb = (F.col("asset") % 4).cast("string")
    currents = rows.groupBy(F.lit("plant").alias("site"), F.col("site").alias("inv"), cmb.alias("cmb"), hour.alias("ts")).agg(
        F.avg("value").alias("amps"), F.avg(F.col("k") * 1.5).alias("i_mp")
    )
    inverters = rows.groupBy(F.lit("plant").alias("site"), F.col("site").alias("inv"), hour.alias("ts")).agg(
        F.sum(F.col("value") - 20).alias("kw"), F.sum("k").alias("possible_kw")
    )
    curtailed = rows.groupBy(F.lit("plant").alias("site"), hour.alias("ts")).agg(
        F.avg((F.col("k") < 42).cast("double")).alias("curtailed")
    )
    design = currents.groupBy("site", "inv", "cmb").agg(F.max("i_mp").alias("kwdc"))
    return currents, inverters, curtailed, design


COMBINER_SQL = f"""
WITH {READINGS_SQL},
cur AS (
  SELECT site AS inv, (asset % 4)::VARCHAR AS cmb, date_trunc('hour', ts) AS ts, greatest(avg(value), 0) AS amps, avg(k * 1.5) AS imp
  FROM readings GROUP BY 1, 2, 3),
inv AS (SELECT site AS inv, date_trunc('hour', ts) AS ts, sum(value - 20) AS kw, sum(k) AS poss FROM readings GROUP BY 1, 2),
curt AS (SELECT date_trunc('hour', ts) AS ts, avg(CASE WHEN k < 42 THEN 1.0 ELSE 0.0 END) AS flag FROM readings GROUP BY 1),
design AS (
  SELECT inv, cmb, max(imp) AS kwdc, max(imp) / avg(max(imp)) OVER (PARTITION BY inv) AS dc_weight,
         max(imp) / avg(max(imp)) OVER (PARTITION BY inv) / count(*) OVER (PARTITION BY inv) AS w FROM cur GROUP BY 1, 2),
r AS (
  SELECT cur.*, kw, poss, flag, poss * w AS cposs FROM cur JOIN design USING (inv, cmb) JOIN inv USING (inv, ts) LEFT JOIN curt USING (ts)),
d AS (
  SELECT inv, cmb, CAST(ts AS DATE) AS date, count(*) FILTER (kw > 0) AS n, sum(kw) FILTER (kw > 0) AS kwh, sum(poss) FILTER (kw > 0) AS pk,
    coalesce(avg(flag) FILTER (poss > 0), 0) AS cf, coalesce(sum(cposs) FILTER (kw > 0), 0) / 1e3 AS full_mwh,
    max(amps) FILTER (kw > 0) - min(amps) FILTER (kw > 0) AS rng, coalesce(sum(amps) FILTER (kw > 0), 0) AS act,
    coalesce(sum(imp) FILTER (kw > 0), 0) AS imp, count(*) FILTER (hour(ts) = 1) AS ncal, max(amps) FILTER (hour(ts) = 1) AS cal,
    count(*) FILTER (kw > 0 AND hour(ts) = 10) AS n10, count(*) FILTER (kw > 0 AND hour(ts) = 12) AS n12, count(*) FILTER (kw > 0 AND hour(ts) = 14) AS n14,
    max(amps) FILTER (kw > 0 AND hour(ts) = 10) AS a10, max(amps) FILTER (kw > 0 AND hour(ts) = 12) AS a12, max(amps) FILTER (kw > 0 AND hour(ts) = 14) AS a14,
    max(imp) FILTER (kw > 0 AND hour(ts) = 10) AS p10, max(imp) FILTER (kw > 0 AND hour(ts) = 12) AS p12, max(imp) FILTER (kw > 0 AND hour(ts) = 14) AS p14
  FROM r GROUP BY 1, 2, 3),
e AS (SELECT *, full_mwh * (1 - cf) AS pm, act / nullif(imp, 0) AS ratio FROM d WHERE n > 0 AND NOT coalesce(kwh > 0.95::DOUBLE * pk, false)),
f AS (
  SELECT *, CASE WHEN cf > 0.625 THEN 'curtailment' WHEN rng < 1 AND act > 5 THEN 'comms' WHEN rng < 1 THEN 'offline'
    WHEN ncal = 1 AND cal > 20 THEN 'calibration' WHEN NOT coalesce(ratio < 0.75, false) THEN NULL
    WHEN n10 > 0 AND n12 > 0 AND n14 > 0 AND NOT (n10 = 1 AND n12 = 1 AND n14 = 1 AND a10 IS NOT NULL AND a12 IS NOT NULL AND a14 IS NOT NULL) THEN NULL
    WHEN n10 > 0 AND n12 > 0 AND n14 > 0 AND a14 - a10 > 50 THEN 'tracker_west'
    WHEN n10 > 0 AND n12 > 0 AND n14 > 0 AND a14 - a10 < -50 THEN 'tracker_east'
    WHEN n10 > 0 AND n12 > 0 AND n14 > 0 AND (p10 IS NULL OR p12 IS NULL OR p14 IS NULL) THEN NULL
    WHEN n10 > 0 AND n12 > 0 AND n14 > 0 AND p10 - a10 > 50 AND p14 - a14 > 50 AND p12 - a12 < 50 THEN 'tracker_center'
    ELSE 'underperform' END AS flag FROM e),
flags AS (
  SELECT 'plant' AS site, inv, cmb, date, flag,
    CASE WHEN flag IN ('comms', 'calibration') THEN 0 WHEN flag IN ('curtailment', 'offline') THEN pm ELSE pm * (1 - ratio) END AS loss_mwh
  FROM f WHERE flag IS NOT NULL)
"""


def flags_of(spark, sf):
    currents, inverters, curtailed, design = combiner_tables(spark, sf)
    rows = cb.combiner_rows(currents, inverters, cb.dc_weights(design), curtailed)
    return cb.daily_flags(rows)


@query(COMBINER_SQL + "SELECT site, inv, cmb, date, flag, round(loss_mwh, 9) AS loss_mwh FROM flags")
def combiner_daily_flags(spark, sf):
    return rounded(flags_of(spark, sf), 9, "loss_mwh")


@query(COMBINER_SQL + "SELECT 'plant' AS site, inv, cmb, round(kwdc, 6) AS kwdc, round(dc_weight, 9) AS dc_weight, round(w, 9) AS dc_weight_adj FROM design")
def dc_weights(spark, sf):
    design = combiner_tables(spark, sf)[3]
    return rounded(rounded(cb.dc_weights(design), 9, "dc_weight", "dc_weight_adj"), 6, "kwdc")


@query(COMBINER_SQL + """
SELECT site, inv, cmb, flag, count(*) AS n_days, round(sum(loss_mwh), 8) AS loss_mwh FROM flags GROUP BY 1, 2, 3, 4
""")
def combiner_losses(spark, sf):
    return rounded(cb.loss_by_flag(flags_of(spark, sf)), 8, "loss_mwh")


MATRIX_SQL = COMBINER_SQL + """
, l AS (SELECT inv, cmb, flag, sum(loss_mwh) AS loss FROM flags GROUP BY 1, 2, 3),
rank AS (
  SELECT inv, cmb, arg_max((flag, loss), list_position(['offline', 'underperform', 'comms', 'calibration', 'curtailment', 'tracker_east', 'tracker_west', 'tracker_center'], flag)) AS f
  FROM l GROUP BY 1, 2),
cell AS (
  SELECT design.inv, design.cmb,
    CASE WHEN f IS NULL THEN '' ELSE CASE f[1] WHEN 'offline' THEN 'OFF' WHEN 'underperform' THEN 'UND' WHEN 'comms' THEN 'COMMS'
      WHEN 'calibration' THEN 'CAL' WHEN 'curtailment' THEN 'CURT' ELSE 'TRK' END END AS category,
    CASE WHEN f IS NULL THEN '' ELSE printf('%.4f', f[2]) END AS loss
  FROM design LEFT JOIN rank USING (inv, cmb))
"""


def _matrix_sql(show: str) -> str:
    columns = ", ".join(f"coalesce(max({show}) FILTER (cmb = '{i}'), '-/-') AS \"{i}\"" for i in range(4))
    return f"{MATRIX_SQL} SELECT 'plant' AS site, inv, {columns} FROM cell GROUP BY inv"


def _matrix(spark, sf, show):
    design = combiner_tables(spark, sf)[3]
    losses = cb.loss_by_flag(flags_of(spark, sf))
    return cb.loss_matrix(losses, design, show=show)


@query(_matrix_sql("loss"))
def loss_matrix(spark, sf):
    return _matrix(spark, sf, "loss")


@query(_matrix_sql("category"))
def category_matrix(spark, sf):
    return _matrix(spark, sf, "category")


@query("""
WITH d AS (
  SELECT s_nationkey AS inv, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS position, s_name AS cmb FROM supplier),
a AS (
  SELECT c_nationkey AS inv, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS position, c_name AS attribute FROM customer)
SELECT coalesce(d.inv, a.inv) AS inv, coalesce(d.position, a.position) AS position, cmb, attribute,
       CASE WHEN cmb IS NULL THEN 'extra attribute' WHEN attribute IS NULL THEN 'extra design row' ELSE 'matched' END AS status
FROM d FULL JOIN a ON d.inv = a.inv AND d.position = a.position
""")
def design_reconcile_sequence(spark, sf):
    design = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("inv"), "s_suppkey", F.col("s_name").alias("cmb"))
    attributes = table(spark, sf, "customer").select(F.col("c_nationkey").alias("inv"), "c_custkey", F.col("c_name").alias("attribute"))
    return cb.reconcile_design(
        design, attributes, series(["inv"], ["s_suppkey"], 1000), series(["inv"], ["c_custkey"], 1000), by_id=False
    )


@query("""
WITH d AS (SELECT s_nationkey AS inv, s_name AS cmb, (s_suppkey % 10)::VARCHAR || (s_suppkey // 10 % 10)::VARCHAR AS cmb_pi FROM supplier),
a AS (SELECT c_nationkey AS inv, 'Amps_' || c_custkey::VARCHAR AS attribute FROM customer)
SELECT d.inv, cmb, min(attribute) AS attribute,
       CASE count(attribute) WHEN 1 THEN 'matched' WHEN 0 THEN 'no attribute' ELSE 'ambiguous' END AS status
FROM d LEFT JOIN a ON a.inv = d.inv AND contains(a.attribute, d.cmb_pi) GROUP BY 1, 2
""")
def design_reconcile_ids(spark, sf):
    key = F.col("s_suppkey")
    cmb_pi = F.concat((key % 10).cast("string"), (F.floor(key / 10) % 10).cast("string"))
    design = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("inv"), F.col("s_name").alias("cmb"), cmb_pi.alias("cmb_pi")
    )
    attributes = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("inv"), F.concat(F.lit("Amps_"), F.col("c_custkey").cast("string")).alias("attribute")
    )
    by = series(["inv"], ["cmb"], 1000)
    return cb.reconcile_design(design, attributes, by, by, by_id=True)


# --- possible power inputs ---------------------------------------------------------


@query("""
SELECT s_name AS site, round(round_even((100 - (2024 - (2000 + s_nationkey)) * 0.5::DOUBLE) / 100, 2)
  * ((100 - s_acctbal / 1000) / 100) * ((100 - 2::DOUBLE) / 100) * ((100 - 0.5::DOUBLE) / 100) * ((100 - 1::DOUBLE) / 100) * ((100 - 1.5::DOUBLE) / 100), 9) AS array_factor,
  round((100 - 2::DOUBLE) / 100 * 0.99::DOUBLE, 9) AS dc_factor, 0.98::DOUBLE AS ac_factor FROM supplier
""")
def system_losses(spark, sf):
    lit = {"degradation": 0.5, "soiling": 2.0, "quality": 0.5, "mismatch": 1.0, "lid": 1.5, "wiring": 2.0,
           "dc_adjustment": 0.99, "ac_adjustment": 0.98}
    sites = table(spark, sf, "supplier").select(
        F.col("s_name").alias("site"), (F.col("s_nationkey") + 2000).alias("cod_year"),
        (F.col("s_acctbal") / 1000).alias("shading"), *[F.lit(v).alias(k) for k, v in lit.items()],
    )
    out = mi.system_losses(sites, F.lit(2024))
    return rounded(out, 9, "array_factor", "dc_factor").select("site", "array_factor", "dc_factor", "ac_factor")


@query(f"""
WITH {READINGS_SQL},
m AS (SELECT event_id, site, ts, value AS poa, k / 2 AS temp_air, k / 10 AS wind_speed,
             CASE WHEN site = 'click' OR value > 40 THEN value / 10 END AS module_temp FROM readings),
u AS (SELECT site, avg(CASE WHEN module_temp IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AS ok FROM m GROUP BY 1)
SELECT event_id, site, round(poa * 0.9::DOUBLE * 0.98::DOUBLE, 6) AS effective_irradiance,
       round(CASE WHEN ok THEN module_temp ELSE poa * exp(-3.56::DOUBLE + -0.075::DOUBLE * wind_speed) + temp_air END, 6) AS module_temp
FROM m JOIN u USING (site)
""")
def model_weather(spark, sf):
    rows = readings(spark, sf)
    met = rows.select(
        "event_id", "site", "ts", F.col("value").alias("poa"), (F.col("k") / 2).alias("temp_air"),
        (F.col("k") / 10).alias("wind_speed"),
        F.when((F.col("site") == "click") | (F.col("value") > 40), F.col("value") / 10).alias("module_temp"),
    )
    losses = rows.select("site").distinct().select("site", F.lit(0.9).alias("array_factor"), F.lit(0.98).alias("dc_factor"))
    out = mi.model_weather(met, losses).select("event_id", "site", "effective_irradiance", "module_temp")
    return rounded(out, 6, "effective_irradiance", "module_temp")


@query("""
WITH s AS (
  SELECT p_partkey, p_size % 9 + 1 AS c1, 18 AS l1, 300 + p_size AS w1,
         CASE WHEN p_size > 25 THEN p_size % 7 + 1 END AS c2, CASE WHEN p_size > 25 THEN 21 END AS l2, CASE WHEN p_size > 25 THEN 350 END AS w2 FROM part),
t AS (
  SELECT p_partkey, CASE WHEN c2 IS NULL THEN 1 ELSE 2 END AS n_slots, l1 * c1 + coalesce(l2 * c2, 0) AS mods,
         w1 * l1 * c1 + coalesce(w2 * l2 * c2, 0) AS watt, c1,
         CASE WHEN c2 IS NULL THEN 18 ELSE 19 END AS len FROM s)
SELECT p_partkey AS cmb, n_slots::BIGINT AS n_slots, mods::DOUBLE AS n_modules, watt::DOUBLE AS wattage, len AS string_length,
       CASE WHEN n_slots = 1 THEN c1 ELSE CAST(trunc(watt / (320.0 * len)) AS INTEGER) END AS string_count FROM t
""")
def combiner_modules(spark, sf):
    size = F.col("p_size")
    second = size > 25
    design = table(spark, sf, "part").select(
        F.lit("plant").alias("site"), F.lit("i").alias("inv"), F.col("p_partkey").alias("cmb"), F.lit(320.0).alias("stc"),
        (size % 9 + 1).alias("string_count_1"), F.lit(18).alias("string_length_1"), (300 + size).alias("mod_wattage_1"),
        F.when(second, size % 7 + 1).alias("string_count_2"), F.when(second, 21).alias("string_length_2"),
        F.when(second, 350).alias("mod_wattage_2"),
    )
    return mi.combiner_modules(design).drop("site", "inv")


@query(PRODUCTION_SQL + """,
lim AS (SELECT site, inv, CASE WHEN inv % 3 = 0 THEN 0 ELSE 250 + inv * 10 END AS lim FROM (SELECT DISTINCT site, inv FROM ih)),
cap AS (SELECT site, inv, coalesce(nullif(lim, 0), round_even(avg(nullif(lim, 0)) OVER (PARTITION BY site), 0)) AS cap FROM lim),
c AS (SELECT site, inv, ts, least(greatest(model_kw - 50, 0), cap) AS p, kw AS a FROM ih JOIN cap USING (site, inv))
SELECT site, ts, round(sum(p), 5) AS total_possible, round(sum(a), 5) AS total_actual FROM c GROUP BY 1, 2
""")
def possible_vs_actual(spark, sf):
    inv = inverter_hours(spark, sf)
    limits = inv.select("site", "inv").distinct().withColumn(
        "limit_kw", F.when(F.col("inv") % 3 == 0, 0.0).otherwise(250.0 + F.col("inv") * 10)
    )
    possible = inv.select("site", "inv", "ts", (F.col("model_kw") - 50).alias("kw"))
    merged = rp.possible_vs_actual(possible, inv.select("site", "inv", "ts", "kw"), limits)
    return rounded(mi.possible_vs_actual_hourly(merged), 5, "total_possible", "total_actual")


@query(f"""
WITH {READINGS_SQL}
SELECT site, date_trunc('hour', ts) AS ts, round(avg(value), 9) AS poa, round(avg(CASE WHEN k > 80 THEN 1.0 ELSE 0.0 END) * 60, 6) AS poa_minutes_filled
FROM readings GROUP BY 1, 2
""")
def poa_minutes_filled(spark, sf):
    met = readings(spark, sf).select(
        "site", "ts", F.col("value").alias("poa"), F.when(F.col("k") > 80, 1).otherwise(0).alias("poa_all_bad")
    )
    return rounded(rounded(mi.poa_minutes_filled(met), 9, "poa"), 6, "poa_minutes_filled")


# --- day ahead ---------------------------------------------------------------------


def forecast(spark, sf):
    rows = readings(spark, sf).filter(F.col("value").isNotNull())
    return resample(
        rows, ["site"], 3600,
        [(F.avg("value") / 4 + 25).alias("temp_f"), F.avg("k").alias("humidity")],
    ).withColumnRenamed("bucket", "ts")


@query(f"""
WITH {READINGS_SQL},
f AS (
  SELECT site, date_trunc('hour', ts) AS ts, avg(value) / 4 + 25 AS t FROM readings WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY site, CAST(ts AS DATE) ORDER BY t DESC, ts) AS rn FROM f)
SELECT site, CAST(ts AS DATE) AS day, ts, round(t, 7) AS temp_f FROM r WHERE rn = 1
""")
def daily_peak_rows(spark, sf):
    out = da.daily_peaks(forecast(spark, sf), ["site"]).select("site", "day", "ts", "temp_f")
    return rounded(out, 7, "temp_f")
