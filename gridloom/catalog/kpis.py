"""KPI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.reports import (
    PRODUCTION_SQL,
    inverter_hours,
    production,
    report_of,
    site_hours,
)
from gridloom.catalog.values import rounded
from gridloom.catalog.views import READINGS_SQL, readings, table
from gridloom.core.ordered import series
from gridloom.core.session import cut_lineage
from gridloom.functions.scalars import floor_time
from gridloom.plans import kpi as kp
from gridloom.plans import report as rp

KEYS = ["site", "month"]


def raw_kpis(spark, sf):
    """Monthly KPI rows from production sums; money stands in for energy."""
    c = F.col
    ep, d, t, q = F.floor("l_extendedprice"), c("l_discount"), c("l_tax"), c("l_quantity")
    site = F.concat("l_returnflag", "l_linestatus")
    rows = table(spark, sf, "lineitem").groupBy(site.alias("site"), floor_time("month", "l_shipdate").alias("month")).agg(
        (F.sum(ep) / 1000).alias("possible_generation"),
        (F.sum(ep * (1 - d)) / 1000).alias("inverter_generation"),
        (F.sum(ep * (1 - t)) / 1000).alias("meter_generation"),
        (F.sum(ep * d) / 2000 - 40).alias("dc_health_loss"),
        (F.sum(ep * t) / 4000 - 30).alias("downtime_loss"),
        (F.sum(q) / 400).alias("ac_module_loss"),
        (F.sum(q * d) / 20).alias("soiling_loss"),
        (F.sum(q * t) / 10).alias("curtailment_non_compensable"),
        (F.sum(q * d) / 16).alias("curtailment_compensable"),
        (F.avg(d) * 20).alias("inverter_availability"),
        (F.sum(q) / 100).alias("poa_insolation"),
    )
    missing = [x for x in kp.KPI_COLUMNS if x not in rows.columns]
    return rows.withColumns({x: F.lit(None).cast("double") for x in missing})


def claims(spark, sf):
    orders = table(spark, sf, "orders")
    site = F.when(F.col("o_orderstatus") == "F", "AF").when(F.col("o_orderstatus") == "O", "NO").otherwise("RF")
    amount = F.when(F.month("o_orderdate") % 3 == 0, 0.0).otherwise(F.floor(F.col("o_totalprice") / 5000).cast("double"))
    return orders.select(site.alias("site"), floor_time("month", "o_orderdate").alias("month"), amount.alias("mwh"))


def snow(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("site"), floor_time("month", "l_shipdate").alias("month"),
        (F.col("l_quantity") / 100).alias("derate_lost_mwh"), F.when(F.col("l_tax") > 0.02, F.col("l_quantity") / 50).alias("outage_lost_mwh"),
    )
    return kp.snow_losses(rows)


def ruled(spark, sf, gross="net"):
    comp = F.col("site").startswith("R")
    return kp.apply_rules(raw_kpis(spark, sf), comp, gross, claims(spark, sf), snow(spark, sf))


KPI_SQL = """
WITH s AS (
  SELECT l_returnflag || l_linestatus AS site, date_trunc('month', l_shipdate)::TIMESTAMP AS month, sum(ep) / 1000 AS possible, sum(ep * (1 - d)) / 1000 AS inv0,
         sum(ep * (1 - t)) / 1000 AS meter, greatest(sum(ep * d) / 2000 - 40, 0) AS dc0, greatest(sum(ep * t) / 4000 - 30, 0) AS down0, sum(q) / 400 AS ac_module,
         sum(q * d) / 20 AS soiling, sum(q * t) / 10 AS non0, sum(q * d) / 16 AS comp0, least(avg(d) * 20, 1) AS avail, sum(q) / 100 AS poa
  FROM (SELECT *, floor(l_extendedprice) AS ep, l_discount AS d, l_tax AS t, l_quantity AS q FROM lineitem) GROUP BY 1, 2),
ins AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'AF' WHEN 'O' THEN 'NO' ELSE 'RF' END AS site, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
         sum(CASE WHEN month(o_orderdate) % 3 = 0 THEN 0 ELSE floor(o_totalprice / 5000) END) AS mwh FROM orders GROUP BY 1, 2),
sn AS (
  SELECT l_returnflag || l_linestatus AS site, date_trunc('month', l_shipdate)::TIMESTAMP AS month,
         sum(l_quantity / 100 + CASE WHEN l_tax > 0.02 THEN l_quantity / 50 ELSE 0 END) AS mwh
  FROM lineitem GROUP BY 1, 2),
k AS (
  SELECT s.site, s.month, possible, greatest(inv0, meter) AS inverter, meter, dc0, down0, ac_module, soiling, avail, poa,
         CASE WHEN s.site LIKE 'R%' THEN non0 ELSE comp0 END AS comp, CASE WHEN s.site NOT LIKE 'R%' THEN non0 END AS non,
         greatest(CASE WHEN s.site LIKE 'R%' THEN non0 ELSE comp0 END, CASE WHEN s.site NOT LIKE 'R%' THEN non0 END) AS curt,
         nullif(ins.mwh, 0) AS ins, coalesce(sn.mwh, 0) AS snow
  FROM s LEFT JOIN ins ON ins.site = s.site AND ins.month = s.month LEFT JOIN sn ON sn.site = s.site AND sn.month = s.month),
b AS (
  SELECT site, month, possible, inverter, meter, soiling, snow AS snow_derate, greatest(dc0 - soiling - ac_module - snow, 0) AS dc_health, ac_module,
         down0 AS downtime, curt AS curtailment, inverter - meter AS ac_line_losses, coalesce(ins, 0) AS insurance_bi FROM k),
v AS (
  SELECT *, possible - (soiling + snow_derate + dc_health + ac_module + downtime + curtailment + ac_line_losses) - insurance_bi - meter AS delta FROM b)
"""


@query(KPI_SQL + """
SELECT site, month, round(possible, 7) AS possible_generation, round(inverter, 7) AS inverter_generation, round(meter, 7) AS meter_generation,
  round(dc0, 7) AS dc_health_loss, round(down0, 7) AS downtime_loss, round(comp, 7) AS curtailment_compensable, round(non, 7) AS curtailment_non_compensable,
  round(curt, 7) AS curtailment_total, round(ins, 7) AS insurance_bi_adjustment, round(snow, 7) AS snow_derate_loss, round(avail, 9) AS inverter_availability
FROM k
""")
def kpi_rules(spark, sf):
    out = rounded(ruled(spark, sf), 7, "possible_generation", "inverter_generation", "meter_generation")
    out = rounded(rounded(out, 7, "dc_health_loss", "downtime_loss"), 9, "inverter_availability")
    curt = ["curtailment_compensable", "curtailment_non_compensable", "curtailment_total"]
    out = rounded(out, 7, *curt, "insurance_bi_adjustment", "snow_derate_loss")
    return out.select(
        *KEYS, "possible_generation", "inverter_generation", "meter_generation", "dc_health_loss", "downtime_loss", *curt,
        "insurance_bi_adjustment", "snow_derate_loss", "inverter_availability",
    )


@query(KPI_SQL + "SELECT s.site, s.month, round(CASE WHEN inv0 >= meter THEN inv0 END, 7) AS inverter_generation FROM s")
def kpi_gross_missing(spark, sf):
    out = ruled(spark, sf, "missing")
    return rounded(out, 7, "inverter_generation").select(*KEYS, "inverter_generation")


PARTS = ["possible", "inverter", "meter", "soiling", "snow_derate", "dc_health", "ac_module", "downtime", "curtailment", "ac_line_losses", "insurance_bi"]


@query(KPI_SQL + "SELECT site, month, " + ", ".join(f"round({c}, 7) AS {c}" for c in PARTS) + ", round(delta, 7) AS delta, round(delta, 5) = 0 AS valid FROM v")
def kpi_breakdown(spark, sf):
    out = kp.validate(kp.breakdown(ruled(spark, sf)))
    return rounded(out, 7, *PARTS, "delta")


@query(KPI_SQL + """,
x0 AS (
  SELECT * EXCLUDE (downtime, delta), CASE WHEN delta < 0 AND insurance_bi > 0 AND downtime > 0 THEN greatest(downtime - insurance_bi, 0) ELSE downtime END AS downtime FROM v),
x1 AS (
  SELECT *, greatest(-(possible - (soiling + snow_derate + dc_health + ac_module + downtime + curtailment + ac_line_losses) - insurance_bi - meter), 0) AS need FROM x0),
x2 AS (
  SELECT *, greatest(dc_health, 0) AS g1, greatest(downtime, 0) AS g2, greatest(soiling, 0) AS g3, greatest(snow_derate, 0) AS g4, greatest(ac_module, 0) AS g5, greatest(curtailment, 0) AS g6 FROM x1),
x3 AS (
  SELECT site, month, possible, inverter, meter, ac_line_losses, insurance_bi,
    dc_health - least(g1, need) AS dc_health, downtime - least(g2, greatest(need - g1, 0)) AS downtime,
    soiling - least(g3, greatest(need - g1 - g2, 0)) AS soiling, snow_derate - least(g4, greatest(need - g1 - g2 - g3, 0)) AS snow_derate,
    ac_module - least(g5, greatest(need - g1 - g2 - g3 - g4, 0)) AS ac_module,
    curtailment - least(g6, greatest(need - g1 - g2 - g3 - g4 - g5, 0)) AS curtailment FROM x2)
SELECT site, month, """ + ", ".join(f"round({c}, 7) AS {c}" for c in PARTS) + """,
  round(possible - (soiling + snow_derate + dc_health + ac_module + downtime + curtailment + ac_line_losses) - insurance_bi - meter, 7) + 0.0 AS delta FROM x3
""")
def kpi_reconcile(spark, sf):
    out = kp.reconcile(kp.breakdown(ruled(spark, sf))).drop("valid")
    out = rounded(out, 7, *PARTS, "delta")
    return out.withColumn("delta", F.col("delta") + 0.0)


@query(KPI_SQL + """
SELECT site, month, u.position::INTEGER AS position, u.step, round(u.value, 7) + 0.0 AS value FROM b, unnest([
  {'position': 1, 'step': 'possible', 'value': possible}, {'position': 2, 'step': 'snow_derate_loss', 'value': -snow_derate},
  {'position': 3, 'step': 'soiling_loss', 'value': -soiling}, {'position': 4, 'step': 'dc_health_loss', 'value': -dc_health},
  {'position': 5, 'step': 'module_loss', 'value': -ac_module}, {'position': 6, 'step': 'downtime_loss', 'value': -downtime},
  {'position': 7, 'step': 'insurance_bi', 'value': -insurance_bi}, {'position': 8, 'step': 'curtailment', 'value': -curtailment},
  {'position': 9, 'step': 'inverter', 'value': inverter}, {'position': 10, 'step': 'ac_line_losses', 'value': -ac_line_losses},
  {'position': 11, 'step': 'meter', 'value': meter}]) t(u)
""")
def waterfall(spark, sf):
    out = kp.waterfall(kp.breakdown(ruled(spark, sf)))
    return out.withColumn("value", F.round("value", 7) + 0.0)


@query(KPI_SQL + """,
l AS (SELECT site, strftime(month, '%Y-%m') AS m, u.kpi, u.value FROM k, unnest([
  {'kpi': 'possible_generation', 'value': possible}, {'kpi': 'meter_generation', 'value': meter}, {'kpi': 'curtailment_total', 'value': curt}]) t(u))
SELECT site, kpi, min(m) FILTER (value IS NOT NULL) AS first_month, count(value) AS n_months, round(coalesce(sum(value), 0), 4) AS total FROM l GROUP BY 1, 2
""")
def kpi_history_pivot(spark, sf):
    """History of all months, one column each, summed up over its columns."""
    kpis = cut_lineage(ruled(spark, sf))
    out = kp.history(kpis, ["site"], ["possible_generation", "meter_generation", "curtailment_total"])
    months = sorted(c for c in out.columns if c not in ("site", "kpi"))
    present = [F.when(F.col(m).isNotNull(), F.lit(m)) for m in months]
    return out.select(
        "site", "kpi", F.least(*present).alias("first_month"),
        sum((F.when(F.col(m).isNotNull(), 1).otherwise(0) for m in months), F.lit(0)).cast("long").alias("n_months"),
        F.round(sum((F.coalesce(m, F.lit(0.0)) for m in months), F.lit(0.0)), 4).alias("total"),
    )


@query(KPI_SQL + """,
bud AS (
  SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) / 10.0::DOUBLE AS bpoa, sum(floor(o_totalprice)) / 1e4 AS bprod, count(*) / 50.0::DOUBLE AS bcurt
  FROM orders GROUP BY 1)
SELECT site, k.month, round(1 + ((meter + snow + coalesce(ins, 0)) + (curt - coalesce(bcurt, 0)) - poa / nullif(coalesce(bpoa, 0), 0) * coalesce(bprod, 0)) / nullif(coalesce(bprod, 0), 0), 7) AS perf_availability
FROM k LEFT JOIN bud ON bud.month = k.month
""")
def perf_availability(spark, sf):
    budget = table(spark, sf, "orders").groupBy(floor_time("month", "o_orderdate").alias("month")).agg(
        (F.count("*") / 10).alias("budget_poa"), (F.sum(F.floor("o_totalprice")) / 1e4).alias("budget_production"),
        (F.count("*") / 50).alias("budget_curtailment"),
    )
    rows = ruled(spark, sf).join(budget, "month", "left")
    return rows.select(*KEYS, F.round(kp.performance_availability(), 7).alias("perf_availability"))


@query(KPI_SQL + """
SELECT n.site, count(k.month) AS n_months, round(sum(k.possible), 5) AS possible_generation
FROM (SELECT DISTINCT site FROM s UNION SELECT n_name FROM nation) n LEFT JOIN k ON k.site = n.site GROUP BY 1
""")
def multi_site_kpis(spark, sf):
    kpis = ruled(spark, sf)
    fleet = kpis.select("site").distinct().union(table(spark, sf, "nation").select("n_name"))
    out = kp.with_all_sites(kpis, fleet)
    return out.groupBy("site").agg(
        F.count("month").alias("n_months"), F.round(F.sum("possible_generation"), 5).alias("possible_generation")
    )


@query(PRODUCTION_SQL + """
SELECT site, month, round(insolation, 10) AS poa_insolation, round(possible, 10) AS possible_generation, round(actual, 10) AS inverter_generation,
       round(meter, 10) AS meter_generation, round(dc_health, 10) AS dc_health_loss, round(downtime, 10) AS downtime_loss,
       round(curtailment, 10) AS curtailment_non_compensable
FROM site
""")
def kpis_from_report(spark, sf):
    out = kp.kpis_from_summary(rp.summary_rows(report_of(spark, sf)["sites"]), KEYS)
    names = ["poa_insolation", "possible_generation", "inverter_generation", "meter_generation", "dc_health_loss", "downtime_loss",
             "curtailment_non_compensable"]
    return rounded(out, 10, *names).select(*KEYS, *names)


@query(PRODUCTION_SQL + "SELECT site, month, inv, " + ", ".join(
    f"round(greatest({c}, 0), 10) AS {c}" for c in ("energetic_loss", "dc_health", "downtime", "curtailment", "actual", "possible")) + " FROM totals")
def inverter_summary(spark, sf):
    names = ["energetic_loss", "dc_health", "downtime", "curtailment", "actual", "possible"]
    return rounded(rp.inverter_summary(report_of(spark, sf)["inverters"]).drop("availability"), 10, *names)


@query(PRODUCTION_SQL + """
SELECT sh.site, sh.ts, round(sum(kw) / 1e3, 9) AS inv_total_mw, round(max(meter), 9) AS meter_mw, round(sum(model_kw) / 1e3, 9) AS possible_mw
FROM sh JOIN ih ON ih.site = sh.site AND ih.ts = sh.ts GROUP BY 1, 2
""")
def site_power(spark, sf):
    inv = inverter_hours(spark, sf)
    meter = site_hours(spark, sf).select("site", "ts", F.col("meter_mwh").alias("mw"))
    model = inv.select("site", "ts", F.col("model_kw").alias("kw"))
    return rounded(kp.site_power(inv, model, meter), 9, "inv_total_mw", "meter_mw", "possible_mw")


@query(PRODUCTION_SQL + """
, m AS (SELECT site, inv, ts, q * 10 AS kw, ep / 150 AS model FROM production),
a AS (
  SELECT site, inv, date_trunc('hour', ts) AS ts, avg(kw) AS kw, avg(model) AS model_kw, CAST(sum(CASE WHEN kw > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS avail_min
  FROM m GROUP BY 1, 2, 3)
SELECT site, inv, ts, round(kw, 9) AS kw, round(model_kw, 9) AS model_kw, avail_min FROM a
""")
def report_interval_table(spark, sf):
    rows = production(spark, sf)
    minutes = rows.select("site", "inv", "ts", (F.col("l_quantity") * 10).alias("kw"))
    model = rows.select("site", "inv", "ts", (F.col("l_extendedprice") / 150).alias("kw"))
    return rounded(rp.hourly_inverters(minutes, model, site_hours(spark, sf)), 9, "kw", "model_kw")


@query(PRODUCTION_SQL + """,
m AS (
  SELECT site, ts, avg(q * 30) AS poa, avg(CASE WHEN d < 0.02 THEN 1.0 ELSE 0.0 END) AS bad, avg(d * 500) AS mt, avg(t / 10) AS mods
  FROM production GROUP BY 1, 2),
so AS (SELECT site, date_trunc('day', ts)::TIMESTAMP AS ts, avg(d) * 10 AS soiling FROM production GROUP BY 1, 2),
j AS (SELECT m.*, so.soiling FROM m ASOF LEFT JOIN so ON m.site = so.site AND m.ts >= so.ts)
SELECT j.site, j.ts, round(poa, 7) AS poa, round(bad, 7) AS poa_all_bad, round(mt, 7) AS module_temperature, round(mods, 9) AS modules_offline_pct,
  CASE WHEN j.ts <= (SELECT max(ts) FROM so WHERE so.site = j.site) THEN round(soiling / 100, 9) END AS soiling_share,
  inv, round(kw, 7) AS kw, round(model_kw, 7) AS model_kw, avail AS avail_min
FROM j LEFT JOIN ih ON ih.site = j.site AND ih.ts = j.ts
""")
def report_intervals_full(spark, sf):
    rows = production(spark, sf)
    met = rows.select(
        "site", "ts", (F.col("l_quantity") * 30).alias("poa"), F.when(F.col("l_discount") < 0.02, 1.0).otherwise(0.0).alias("poa_all_bad"),
        (F.col("l_discount") * 500).alias("module_temperature"),
    )
    modules = rows.select("site", "ts", (F.col("l_tax") / 10).alias("modules_offline_pct"))
    soiling = rows.groupBy("site", floor_time("day", "ts").alias("ts")).agg((F.avg("l_discount") * 10).alias("soiling"))
    out = rp.interval_table(met, modules, cut_lineage(soiling), inverter_hours(spark, sf), series(["site"], ["ts"], "month"))
    out = rounded(out, 7, "poa", "poa_all_bad", "module_temperature", "kw", "model_kw")
    return rounded(out, 9, "modules_offline_pct", "soiling_share")


def _resolution_sql(name: str, seconds: int | None) -> str:
    at = "ts" if seconds is None else f"time_bucket(INTERVAL '{seconds} seconds', ts)"
    return f"""
SELECT '{name}' AS resolution, i.site, i.ts, round(inv, 9) AS inv_total_mw, round(mw, 9) AS meter_mw, round(model, 9) AS possible_mw FROM (
  SELECT site, ts, coalesce(sum(kw), 0) / 1e3 AS inv, coalesce(sum(k), 0) / 1e3 AS model FROM (
    SELECT site, asset, {at} AS ts, {"value" if seconds is None else "avg(value)"} AS kw, {"k" if seconds is None else "avg(k)"} AS k
    FROM readings {"" if seconds is None else "GROUP BY 1, 2, 3"}) GROUP BY 1, 2) i
LEFT JOIN (SELECT site, {at} AS ts, avg(mw) AS mw FROM mt GROUP BY 1, 2) m ON m.site = i.site AND m.ts = i.ts"""


RESOLUTIONS = {"native": None, "quarter": 900, "hour": 3600, "day": 86400}


@query(f"WITH {READINGS_SQL}, mt AS (SELECT site, ts, avg(k) / 10 AS mw FROM readings GROUP BY 1, 2)" + " UNION ALL ".join(
    _resolution_sql(n, s) for n, s in RESOLUTIONS.items()))
def summary_power(spark, sf):
    rows = readings(spark, sf).withColumn("inv", F.col("asset"))
    inverters = rows.select("site", "inv", "ts", F.col("value").alias("kw"))
    model = rows.select("site", "inv", "ts", F.col("k").alias("kw"))
    meter = rows.groupBy("site", "ts").agg((F.avg("k") / 10).alias("mw"))
    out = None
    for name, seconds in RESOLUTIONS.items():
        part = kp.site_power_at(inverters, model, meter, seconds).withColumn("resolution", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, 9, "inv_total_mw", "meter_mw", "possible_mw")


@query("""
SELECT l_returnflag || l_linestatus AS site, date_trunc('month', l_shipdate)::TIMESTAMP AS month,
       round(sum(l_quantity / 100 + CASE WHEN l_tax > 0.02 THEN l_quantity / 50 ELSE 0 END), 6) AS mwh
FROM lineitem GROUP BY 1, 2
""")
def snow_loss_totals(spark, sf):
    return rounded(snow(spark, sf), 6, "mwh")
