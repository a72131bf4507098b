"""Lookup, naming, landing and status queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.values import rounded
from gridloom.catalog.views import READINGS_SQL, readings, table
from gridloom.core.ordered import global_position, series
from gridloom.core.session import shared_folder
from gridloom.functions.scalars import (
    add_time,
    convert_unit,
    digits_part,
    floor_time,
    header_key,
    label_key,
    letters_part,
)
from gridloom.operators import lookups as lk
from gridloom.operators import naming as nm
from gridloom.operators.quality import drop_empty
from gridloom.plans.curtailment import effective_setpoint
from gridloom.plans.dayahead import precipitation_label
from gridloom.plans.insurance import claims, parse_outage_dates
from gridloom.plans.status import pipeline_status as status_of
from gridloom.sources import files as fl
from gridloom.sources import intervals as iv
from gridloom.sources import meters as mt
from gridloom.sources import parameters as pm
from gridloom.sources import payloads as pl
from gridloom.sources import spreadsheet as ss


def rates(spark, sf):
    """Monthly rate per segment, from order counts."""
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        orders.groupBy(F.col("c_mktsegment").alias("site"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg((F.count("*") / 100).alias("rate"))
    )


RATES_SQL = """rates AS (
  SELECT c_mktsegment AS site, strftime(o_orderdate, '%Y-%m') AS month, count(*) / 100.0::DOUBLE AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(f"""
WITH {RATES_SQL},
w AS (SELECT o_orderkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'UNKNOWN' ELSE c_mktsegment END AS site,
             strftime(o_orderdate + to_months((24 * (o_orderkey % 2))::INTEGER), '%Y-%m') AS month
      FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, w.site, w.month, coalesce(rate, 0) AS rate
FROM w LEFT JOIN rates r ON r.site = w.site AND r.month = least(w.month, (SELECT max(month) FROM rates))
""")
def rate_lookup_clamped(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    site = F.when(F.col("c_mktsegment") == "FURNITURE", "UNKNOWN").otherwise(F.col("c_mktsegment"))
    # odd orders ask for a month two years on, often beyond the last known rate
    month = F.add_months("o_orderdate", (F.col("o_orderkey") % 2 * 24).cast("int"))
    wanted = orders.select("o_orderkey", site.alias("site"), F.date_format(month, "yyyy-MM").alias("month"))
    return lk.clamped_rate(wanted, rates(spark, sf))


@query("""
WITH o AS (SELECT c_mktsegment AS site, year(o_orderdate)::VARCHAR AS month FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT DISTINCT site FROM o), y AS (SELECT DISTINCT month FROM o)
SELECT s.site, y.month, (SELECT count(*) FROM o WHERE o.site = s.site AND o.month = y.month) / 10.0::DOUBLE AS rate FROM s, y
""")
def rate_matrix_rows(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    years = [r.y for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect()]
    matrix = orders.groupBy(F.col("c_mktsegment").alias("site")).agg(
        *[(F.count_if(F.year("o_orderdate") == y) / 10).alias(str(y)) for y in sorted(years)]
    )
    return lk.unpivot_months(matrix)


def tracker(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.groupBy(
        F.col("c_mktsegment").alias("site"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("production"))


@query("""
WITH t AS (
  SELECT c_mktsegment AS site, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, round(sum(o_totalprice), 2) AS production
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT * FROM t WHERE site IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING sum(c_acctbal) > 0)
  AND (year, month) IN (SELECT (year(l_shipdate), month(l_shipdate)) FROM lineitem GROUP BY year(l_shipdate), month(l_shipdate) HAVING count(*) % 2 = 0)
""")
def tracker_selection(spark, sf):
    sites = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("site")).agg(F.sum("c_acctbal").alias("b")).filter("b > 0")
    months = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    periods = months.agg(F.count("*").alias("n")).filter("n % 2 = 0").select("year", "month")
    return lk.tracker_rows(tracker(spark, sf), sites, periods)


@query("""
WITH t AS (SELECT c_name AS project, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
b AS (SELECT c_name AS project, c_acctbal AS budget_poa, c_acctbal * 2 AS budget_production FROM customer WHERE c_custkey % 3 > 0)
SELECT t.project, n, budget_poa, budget_production FROM t LEFT JOIN b USING (project)
""")
def budget_join(spark, sf):
    customer = table(spark, sf, "customer")
    kpis = customer.join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(
        F.col("c_name").alias("project")).agg(F.count("o_orderkey").alias("n"))
    budget = customer.filter("c_custkey % 3 > 0").select(
        F.col("c_name").alias("project"), F.col("c_acctbal").alias("budget_poa"), (F.col("c_acctbal") * 2).alias("budget_production")
    )
    return lk.join_budget(kpis, budget)


@query("""
WITH a AS (
  SELECT o_custkey AS site, sum(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE 0 END) AS production,
         sum(floor(o_totalprice)) AS report FROM orders GROUP BY 1)
SELECT site, CASE WHEN production = 0 THEN report ELSE production END AS production FROM a
""")
def fill_zero_kpis(spark, sf):
    orders = table(spark, sf, "orders")
    whole = F.floor("o_totalprice").cast("double")
    main = orders.groupBy(F.col("o_custkey").alias("site")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", whole).otherwise(0.0)).alias("production")
    )
    report = orders.groupBy(F.col("o_custkey").alias("site")).agg(F.sum(whole).alias("production"))
    return lk.fill_zero(main, report, ["site"], "production")


@query(f"""
WITH {READINGS_SQL},
i AS (SELECT asset AS site, date_trunc('hour', ts) AS ts, sum(value) AS inv_mwh FROM readings WHERE length(site) % 3 = 2 GROUP BY 1, 2),
p AS (SELECT asset AS site, date_trunc('hour', ts) AS ts, sum(value) AS plant_mwh FROM readings WHERE length(site) % 3 = 1 GROUP BY 1, 2),
u AS (SELECT asset AS site, date_trunc('hour', ts) AS ts, sum(value) AS utility_mwh FROM readings WHERE length(site) % 3 = 0 GROUP BY 1, 2)
SELECT site, ts, round(plant_mwh, 4) AS plant_mwh, round(inv_mwh, 4) AS inv_mwh, round(utility_mwh, 4) AS utility_mwh,
       round(inv_mwh - plant_mwh, 4) AS inv_minus_plant, round(plant_mwh - utility_mwh, 4) AS plant_minus_utility
FROM p FULL JOIN i USING (site, ts) FULL JOIN u USING (site, ts)
""")
def meter_compare(spark, sf):
    rows = readings(spark, sf)

    def energy(kind, name):
        picked = rows.filter(F.length("site") % 3 == kind)
        return picked.groupBy(F.col("asset").alias("site"), floor_time("hour", "ts").alias("ts")).agg(F.sum("value").alias(name))

    out = lk.compare_meters(energy(1, "plant_mwh"), energy(2, "inv_mwh"), energy(0, "utility_mwh"), ["site", "ts"])
    return rounded(out, 4, "plant_mwh", "inv_mwh", "utility_mwh", "inv_minus_plant", "plant_minus_utility")


def even_nations(spark, sf):
    """Nations with an even number of customers."""
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("site")).agg(F.count("*").alias("n"))
    return counts.filter("n % 2 = 0").select("site")


@query("""
SELECT DISTINCT s.s_nationkey AS site, c_nationkey IS NOT NULL AS found
FROM supplier s LEFT JOIN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) % 2 = 0) c ON c.c_nationkey = s.s_nationkey
""")
def presence_split(spark, sf):
    wanted = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("site"))
    return lk.presence(wanted, even_nations(spark, sf), ["site"])


@query("""
WITH f AS (
  SELECT o_orderkey, c_nationkey AS site, o_orderpriority AS file, o_orderdate AS file_ts, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey),
b AS (SELECT site, file FROM (
  SELECT site, file, row_number() OVER (PARTITION BY site ORDER BY file_ts DESC, file DESC) AS rn FROM f) WHERE rn = 1)
SELECT f.* FROM f JOIN b USING (site, file)
""")
def first_wins(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.select(
        "o_orderkey", F.col("c_nationkey").alias("site"), F.col("o_orderpriority").alias("file"),
        F.col("o_orderdate").alias("file_ts"), "o_totalprice",
    )
    return lk.latest_wins(rows, ["site"], ["file_ts"], "file")


def meter_months(spark, sf, half):
    """Monthly values from even (0) or odd (1) orders."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey") % 2 == half)
    return orders.groupBy(
        F.col("o_custkey").alias("site"), floor_time("month", "o_orderdate").alias("month")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("mwh"))


MONTHS_SQL = """
WITH m AS (
  SELECT o_orderkey % 2 AS half, o_custkey AS site, date_trunc('month', o_orderdate)::TIMESTAMP AS month, round(sum(o_totalprice), 2) AS mwh
  FROM orders GROUP BY 1, 2, 3),
old AS (SELECT site, month, mwh FROM m WHERE half = 0), new AS (SELECT site, month, mwh FROM m WHERE half = 1)
"""


@query(MONTHS_SQL + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE (site, month) NOT IN (SELECT (site, month) FROM old)")
def upsert_missing(spark, sf):
    return lk.insert_missing(meter_months(spark, sf, 0), meter_months(spark, sf, 1), ["site", "month"])


@query(MONTHS_SQL + "SELECT * FROM new UNION ALL SELECT * FROM old WHERE (site, month) NOT IN (SELECT (site, month) FROM new)")
def upsert_replace(spark, sf):
    return lk.replace_keys(meter_months(spark, sf, 0), meter_months(spark, sf, 1), ["site", "month"])


@query(MONTHS_SQL + """
SELECT coalesce(s.site, t.site) AS site, coalesce(s.month, t.month) AS month,
       CASE WHEN s.site IS NULL THEN 'no_data' WHEN t.site IS NULL THEN 'copied_data' ELSE 'already_exists' END AS status
FROM new s FULL JOIN old t ON s.site = t.site AND s.month = t.month
""")
def copy_forward_status(spark, sf):
    return lk.copy_status(meter_months(spark, sf, 1), meter_months(spark, sf, 0), ["site", "month"], overwrite=False)


@query(MONTHS_SQL + "SELECT * FROM new WHERE (site, month) NOT IN (SELECT (site, month) FROM old)")
def incremental_groups(spark, sf):
    return fl.new_groups(meter_months(spark, sf, 1), meter_months(spark, sf, 0), ["site", "month"])


@query("""
WITH t AS (
  SELECT c_custkey AS site, CASE WHEN c_acctbal > 5000 THEN c_acctbal END AS poa, CASE WHEN c_nationkey > 12 THEN c_acctbal / 2 END AS net FROM customer),
n AS (
  SELECT o_custkey AS site, CASE WHEN count(*) > 9 THEN count(*)::DOUBLE END AS poa, floor(max(o_totalprice)) AS net FROM orders GROUP BY 1)
SELECT t.site, coalesce(t.poa, n.poa) AS poa, coalesce(t.net, n.net) AS net,
       CASE WHEN (t.poa IS NULL AND n.poa IS NOT NULL) OR (t.net IS NULL AND n.net IS NOT NULL) THEN 'filled' ELSE 'kept' END AS action
FROM t LEFT JOIN n USING (site)
""")
def fill_null_only(spark, sf):
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("site"), F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal")).alias("poa"),
        F.when(F.col("c_nationkey") > 12, F.col("c_acctbal") / 2).alias("net"),
    )
    new = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("site")).agg(
        F.when(F.count("*") > 9, F.count("*").cast("double")).alias("poa"), F.floor(F.max("o_totalprice")).cast("double").alias("net")
    )
    return lk.fill_cells(target, new, ["site"], ["poa", "net"])


@query("""
SELECT code, row_number() OVER (ORDER BY regexp_replace(code, '[^A-Za-z]', '', 'g'), regexp_replace(code, '[^0-9]', '', 'g')::BIGINT, code) AS position
FROM (SELECT DISTINCT p_type || '_' || p_size::VARCHAR AS code FROM part)
""")
def natural_order(spark, sf):
    names = table(spark, sf, "part").select(F.concat("p_type", F.lit("_"), F.col("p_size").cast("string")).alias("code"))
    rows = names.distinct().withColumn("letters", letters_part("code")).withColumn("digits", digits_part("code"))
    return global_position(rows, ["letters", "digits", "code"], "position").select("code", "position")


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
SELECT s_suppkey, s_nationkey, CAST(floor((rn - 1) / ceil(n / 3.0)) + 1 AS BIGINT) AS chunk FROM s
""")
def even_chunks(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return lk.even_chunks(rows, series(["s_nationkey"], ["s_suppkey"], 1000), 3)


@query("""
WITH i AS (SELECT p_partkey, p_name AS site, list_filter(string_split(replace(p_name, '-', ' '), ' '), lambda x: x <> '') AS w FROM part),
names AS (SELECT DISTINCT site, w FROM i),
k AS (SELECT site, list_last(list_filter(w, lambda x: length(x) = list_max(list_transform(w, lambda y: length(y))))) AS word FROM names),
t AS (SELECT DISTINCT p_type || ' ' || string_split(p_name, ' ')[2] AS table_name FROM part)
SELECT k.site, CASE WHEN count(t.table_name) = 1 THEN min(t.table_name) END AS table_name
FROM k LEFT JOIN t ON contains(t.table_name, k.word) GROUP BY 1
""")
def table_by_longest_word(spark, sf):
    part = table(spark, sf, "part")
    items = part.select(F.col("p_name").alias("site")).distinct()
    names = part.select(F.concat("p_type", F.lit(" "), F.split("p_name", " ")[1]).alias("table_name")).distinct()
    return lk.longest_word_match(items, names)


TYPES_SQL = """
CASE WHEN regexp_matches(lower(a), 'amb|air_temp|temp_air|temp_c_skid') THEN 'amb_temp'
     WHEN regexp_matches(lower(a), 'mod|mdl|mts|mst|pnltemp|pnltmp|bom') THEN 'mod_temp'
     WHEN regexp_matches(lower(a), 'wind|wnd|speed|ws_ms') THEN 'wind'
     WHEN regexp_matches(lower(a), 'ghi|global|hor') THEN 'ghi'
     WHEN regexp_matches(lower(a), 'poa|plane|irr') THEN 'poa' END"""
ATTRIBUTE = """CASE p_size % 8 WHEN 0 THEN 'POA_' WHEN 1 THEN 'GHI_irr_' WHEN 2 THEN 'Amb_Temp_' WHEN 3 THEN 'BOM_' WHEN 4 THEN 'WS_ms_'
  WHEN 5 THEN 'ActivePower_' WHEN 6 THEN 'MeterMW_' ELSE 'Plane_Speed_' END || p_brand"""


def attribute_column():
    names = ["POA_", "GHI_irr_", "Amb_Temp_", "BOM_", "WS_ms_", "ActivePower_", "MeterMW_", "Plane_Speed_"]
    return F.concat(F.get(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 8), F.col("p_brand"))


@query(f"""
SELECT p_partkey, a AS attribute, {TYPES_SQL} AS sensor_type,
  regexp_matches(lower(a), 'ghi|hor') AS is_ghi, regexp_matches(lower(a), 'poa|plane|irr') AND NOT regexp_matches(lower(a), 'ghi|hor') AS is_poa,
  regexp_matches(lower(a), 'temp|tmp|bom|mts|mst|mdl|mod') AS is_temp, regexp_matches(lower(a), 'wind|wnd|speed|ws_ms') AS is_wind,
  contains(a, 'ActivePower') AS is_inv, contains(a, 'MeterMW') AS is_meter
FROM (SELECT p_partkey, {ATTRIBUTE} AS a FROM part)
""")
def sensor_type_classify(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", attribute_column().alias("attribute"))
    out = nm.with_qc_type(rows.withColumn("sensor_type", nm.met_type(F.col("attribute"))))
    return out.drop("needs_sun")


@query(f"""
SELECT p_partkey, a AS attribute, regexp_matches(lower(a), 'poa|plane|irr') AND NOT regexp_matches(lower(a), 'ghi|global|hor') AS in_poa,
  regexp_matches(lower(a), 'ghi|global|hor') AS in_ghi, regexp_matches(lower(a), 'amb|air_temp|temp_air|temp_c_skid') AS in_ambtemp,
  regexp_matches(lower(a), 'mod|mdl|mts|mst|pnltemp|pnltmp|bom') AS in_modtemp, regexp_matches(lower(a), 'wind|wnd|speed|ws_ms') AS in_wind
FROM (SELECT p_partkey, {ATTRIBUTE} AS a FROM part)
""")
def sensor_groups(spark, sf):
    return nm.with_met_groups(table(spark, sf, "part").select("p_partkey", attribute_column().alias("attribute")))


def paths(spark, sf):
    """Attribute paths of supplier assets: nation as site, two groups in even nations."""
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    group = F.when((F.col("s_suppkey") % 2 == 1) & (F.col("n_nationkey") % 2 == 0), "Met").otherwise("Inverters")
    path = F.concat(
        F.lit("\\\\srv\\db\\fleet\\"), F.col("n_name"), F.lit("\\"), group, F.lit("\\"), F.col("s_name"),
        F.when(F.col("s_suppkey") % 3 == 0, "\\Sub1").otherwise(""), F.lit("|ActivePower"),
    )
    return rows.select("s_suppkey", path.alias("path"))


@query(r"""
WITH p AS (
  SELECT s_suppkey, n_name AS site, CASE WHEN s_suppkey % 2 = 1 AND n_nationkey % 2 = 0 THEN 'Met' ELSE 'Inverters' END AS asset_group, s_name,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Sub1' END AS sub FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT site, count(DISTINCT asset_group) AS n FROM p GROUP BY 1)
SELECT s_suppkey, p.site, asset_group, 'ActivePower' AS attribute, CASE WHEN sub IS NULL THEN 3 ELSE 4 END AS level,
       concat_ws('_', 'ActivePower', sub, s_name, CASE WHEN n > 1 THEN asset_group END) AS column_name
FROM p JOIN g USING (site)
""")
def path_to_column(spark, sf):
    out = nm.column_names(nm.parse_path(paths(spark, sf)))
    return out.select("s_suppkey", "site", "asset_group", "attribute", "level", "column_name")


@query("""
SELECT r_name AS site, n_name AS asset_group, s_name AS asset
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def hierarchy_flatten(spark, sf):
    # nested form first: one row per site and group with its asset list
    rows = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    nested = rows.select(F.col("r_name").alias("site"), F.create_map("n_name", F.array("s_name")).alias("groups"))
    return nm.flatten_hierarchy(nested)


@query(f"""
WITH a AS (SELECT p_partkey AS asset, p_type AS site, p_brand AS asset_group, {ATTRIBUTE} AS attribute FROM part),
w AS (SELECT DISTINCT asset_group, attribute FROM a)
SELECT a.site, a.asset, a.asset_group, w.attribute, e.asset IS NOT NULL AS valid
FROM a JOIN w USING (asset_group) LEFT JOIN a e ON e.site = a.site AND e.asset = a.asset AND e.attribute = w.attribute
""")
def valid_attributes(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("asset"), F.col("p_type").alias("site"), F.col("p_brand").alias("asset_group"),
        attribute_column().alias("attribute"),
    )
    wanted = rows.select("asset_group", "attribute").distinct()
    return nm.wanted_attributes(rows.drop("attribute"), wanted, rows)


@query(f"""
WITH {READINGS_SQL}
SELECT asset, date_trunc('day', ts)::TIMESTAMP AS ts, """ + ", ".join(f"round(sum(value) FILTER (site = '{s}'), 4) AS {s}" for s in ("click", "error", "purchase", "signup", "view")) + """
FROM readings GROUP BY 1, 2
""")
def long_to_wide(spark, sf):
    rows = readings(spark, sf).groupBy("asset", floor_time("day", "ts").alias("ts"), F.col("site").alias("attribute")).agg(
        F.round(F.sum("value"), 4).alias("value")
    )
    return nm.wide(rows, ["ts", "asset"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipmode AS rule, round(v, 6) AS value FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_linenumber WHEN 1 THEN 'F_to_C' WHEN 2 THEN 'C_to_F' WHEN 3 THEN 'mph_to_mps' WHEN 4 THEN 'kW_to_MW' ELSE 'none' END AS l_shipmode,
    CASE l_linenumber WHEN 1 THEN (l_quantity - 32) * 5 / 9 WHEN 2 THEN l_quantity * 1.8 + 32 WHEN 3 THEN l_quantity * 0.44704
      WHEN 4 THEN l_quantity / 1000 ELSE l_quantity END AS v FROM lineitem)
""")
def unit_conversion(spark, sf):
    names = F.array(*[F.lit(r) for r in ("F_to_C", "C_to_F", "mph_to_mps", "kW_to_MW")])
    rule = F.coalesce(F.get(names, F.col("l_linenumber") - 1), F.lit("none"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rule.alias("rule"),
        F.round(convert_unit("l_quantity", rule), 6).alias("value"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_tax = 0 THEN 120 ELSE l_quantity END AS setpoint FROM lineitem
""")
def effective_setpoints(spark, sf):
    sp = effective_setpoint(F.col("l_tax"), F.col("l_quantity"), F.lit(120.0))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sp.alias("setpoint"))


@query("""
SELECT p_partkey, lower(replace(p_name, ' ', '_')) || '_' || lower(p_type) || '_health_loss' AS kpi,
       lower(replace(p_name, ' ', '_')) || '_' || lower(p_brand) AS header, (p_size % 9)::VARCHAR AS code,
       CASE p_size % 9 WHEN 1 THEN 'snow' WHEN 2 THEN 'rain' WHEN 3 THEN 'rain and snow' WHEN 4 THEN 'freezing rain' WHEN 5 THEN 'sleet'
         WHEN 6 THEN 'drizzle' WHEN 7 THEN 'freezing drizzle' WHEN 8 THEN 'thunderstorms' END AS label FROM part
""")
def label_keys(spark, sf):
    kpi = F.concat("p_name", F.lit(" - "), "p_type", F.lit("/System Health Loss (MWh)"))
    header = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    code = (F.col("p_size") % 9).cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", label_key(kpi).alias("kpi"), header_key(header).alias("header"), code.alias("code"),
        precipitation_label(code).alias("label"),
    )


@query("""
WITH f AS (SELECT c_name || '_' || c_mktsegment || '.csv' AS name FROM customer),
p AS (SELECT n_name AS site, '*' || lpad(n_nationkey::VARCHAR, 3, '0') || '_*' || ['FURN', 'MACH', 'BUIL', 'AUTO', 'HOUSE'][n_nationkey % 5 + 1] || '*' AS pattern FROM nation)
SELECT f.name, CASE WHEN count(p.site) = 1 THEN min(p.site) END AS site, count(p.site) AS n_matches, count(p.site) > 1 AS error
FROM f LEFT JOIN p ON contains(f.name, string_split(pattern, '*')[2]) AND contains(f.name, string_split(pattern, '*')[3]) GROUP BY 1
""")
def file_routing(spark, sf):
    files = table(spark, sf, "customer").select(
        F.col("c_name").alias("path"), F.concat("c_name", F.lit("_"), "c_mktsegment", F.lit(".csv")).alias("name")
    )
    words = F.array(*[F.lit(w) for w in ("FURN", "MACH", "BUIL", "AUTO", "HOUSE")])
    pattern = F.concat(
        F.lit("*"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), F.lit("_*"), F.get(words, F.col("n_nationkey") % 5), F.lit("*")
    )
    patterns = table(spark, sf, "nation").select(F.col("n_name").alias("site"), pattern.alias("pattern"))
    return fl.route_files(files, patterns).drop("path")


@query("""
SELECT event_type AS site, event_id, date_trunc('second', ts) AS instant, f.field, f.value
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
  unnest([{'field': 'airTemp', 'value': value}, {'field': 'windSpeed', 'value': k}]) t(f)
""")
def weather_payload_rows(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = F.create_map(
        F.lit("airTemp"), F.col("value"), F.lit("windSpeed"), F.get_json_object("props", "$.k").cast("double")
    )
    body = F.to_json(F.struct(F.array(F.struct(F.create_map(stamp, fields).alias("properties"))).alias("features")))
    landed = table(spark, sf, "events").select(F.col("event_type").alias("site"), "event_id", body.alias("body"))
    out = pl.weather_rows(landed, ["site", "event_id"])
    return out.withColumn("instant", F.col("instant").cast("timestamp_ntz"))


@query(f"""
WITH {READINGS_SQL},
d AS (
  SELECT *, row_number() OVER (PARTITION BY site, date_trunc('hour', ts) ORDER BY event_id) AS rn FROM readings),
b AS (SELECT site, date_trunc('day', min(ts))::TIMESTAMP AS a, date_trunc('day', max(ts))::TIMESTAMP + INTERVAL 1 DAY AS z FROM readings GROUP BY 1),
axis AS (SELECT site, unnest(generate_series(a, z - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS instant FROM b)
SELECT axis.site, instant, d.value AS temp, d.k AS wind
FROM axis LEFT JOIN d ON d.site = axis.site AND date_trunc('hour', d.ts) = instant AND rn = 1
""")
def weather_expected_hours(spark, sf):
    rows = readings(spark, sf)
    day = floor_time("day", F.min("ts")), add_time(floor_time("day", F.max("ts")), 1, "day")
    bounds = rows.groupBy("site").agg(day[0].alias("start"), day[1].alias("end"))
    long = rows.withColumn("instant", floor_time("hour", "ts")).unpivot(
        ["site", "instant", "event_id"], ["value", "k"], "field", "v").withColumnRenamed("v", "value")
    out = pl.weather_hours(long, bounds, ["site"], ["value", "k"], "event_id")
    return out.select("site", "instant", F.col("value").alias("temp"), F.col("k").alias("wind"))


@query("""
WITH c AS (
  SELECT c_nationkey AS site, c_custkey AS station, abs(c_acctbal - 5000) AS distance, o.last AS hourly_end
  FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1) o ON o_custkey = c_custkey),
l AS (SELECT site, max(hourly_end) AS latest FROM c GROUP BY 1),
r AS (
  SELECT c.*, latest, row_number() OVER (PARTITION BY site ORDER BY distance, station) AS rn FROM c JOIN l USING (site)
  WHERE hourly_end >= least(latest, TIMESTAMP '2001-07-30'))
SELECT site, station, round(distance, 6) AS distance, latest AS latest_end FROM r WHERE rn = 1
""")
def station_pick(spark, sf):
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("hourly_end"))
    candidates = table(spark, sf, "customer").join(last, "c_custkey").select(
        F.col("c_nationkey").alias("site"), F.col("c_custkey").alias("station"),
        F.abs(F.col("c_acctbal") - 5000).alias("distance"), "hourly_end",
    )
    return rounded(pl.pick_station(candidates, F.lit("2001-07-30").cast("timestamp_ntz")), 6, "distance")


@query("""
WITH s AS (
  SELECT l_returnflag AS site, l_linestatus AS device, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS soiling, sum(floor(l_extendedprice)) AS insolation
  FROM lineitem GROUP BY 1, 2, 3),
k AS (SELECT site, day FROM s GROUP BY 1, 2 HAVING count(*) = 2)
SELECT site, day, avg(soiling) AS soiling, avg(insolation) AS insolation FROM s JOIN k USING (site, day) GROUP BY 1, 2
""")
def soiling_merge(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("site"), F.col("l_linestatus").alias("device"), F.to_date("l_shipdate").alias("day")
    ).agg(F.sum("l_quantity").cast("string").alias("soiling"), F.sum(F.floor("l_extendedprice")).cast("string").alias("insolation"))
    return pl.soiling_daily(rows, ["soiling", "insolation"])


@query("""
WITH r AS (SELECT o_orderstatus AS site, o_orderdate AS ts, floor(o_totalprice) AS ghi, o_orderpriority AS p FROM orders),
w AS (SELECT DISTINCT site, year(ts) AS y, month(ts) AS m FROM r),
s AS (SELECT site, ts, sum(ghi) AS ghi FROM r WHERE p = '1-URGENT' AND month(ts) % 2 = 0 GROUP BY 1, 2),
f AS (SELECT site, ts, sum(ghi) AS ghi FROM r GROUP BY 1, 2)
SELECT site, ts, ghi, 'stored' AS origin FROM s
UNION ALL SELECT site, ts, ghi, 'fetched' FROM f
WHERE ts >= DATE '2000-01-02' AND (site, year(ts), month(ts)) NOT IN (SELECT (site, year(ts), month(ts)) FROM s)
""")
def weather_resolver(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("site"), F.col("o_orderdate").alias("ts"), F.floor("o_totalprice").cast("double").alias("ghi"),
        "o_orderpriority",
    )
    wanted = rows.select("site", F.year("ts").alias("year"), F.month("ts").alias("month")).distinct()

    def daily(df):
        return df.groupBy("site", "ts").agg(F.sum("ghi").alias("ghi"))

    stored = daily(rows.filter((F.col("o_orderpriority") == "1-URGENT") & (F.month("ts") % 2 == 0)))
    return pl.resolve_weather(wanted, stored, daily(rows), F.lit("2001-01-01").cast("date"))


@query("""
SELECT p_brand || '_' || (p_partkey // 100)::VARCHAR AS inverter, 'K' || p_type || ':v1' AS full_device_key, 'K' || p_type AS device_key,
       'par' || p_partkey::VARCHAR AS parameter, p_size::VARCHAR AS value FROM part
""")
def param_text_rows(spark, sf):
    part = table(spark, sf, "part")
    folder = F.concat("p_brand", F.lit("_"), F.floor(F.col("p_partkey") / 100).cast("string"))
    file = F.concat(F.lit("/plant/"), folder, F.lit("/"), F.col("p_type"), F.col("p_partkey").cast("string"), F.lit(".rec"))
    lines = F.array(
        F.concat(F.lit('<device key="K'), "p_type", F.lit(':v1">')),
        F.concat(F.lit('  <param key="par'), F.col("p_partkey").cast("string"), F.lit('">'), F.col("p_size").cast("string")),
        F.lit("</device>"),
    )
    rows = part.select(file.alias("file"), F.explode(lines).alias("line"))
    return pm.parameter_rows(rows)


@query("""
SELECT DISTINCT p_brand AS inverter, '<info type="' || p_type || '"><rev>' || (p_size % 3)::VARCHAR || '</rev>' AS metadata FROM part
""")
def param_metadata_rows(spark, sf):
    part = table(spark, sf, "part")
    file = F.concat(F.lit("/plant/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".re2"))
    text = F.concat(
        F.lit('<info type="'), "p_type", F.lit('">\n\n  <rev>'), (F.col("p_size") % 3).cast("string"),
        F.lit('</rev>\n<paramList>\n<x>\n<param uid="17" value="4"/>\n'),
    )
    return pm.parameter_metadata(part.select(file.alias("file"), text.alias("text")))


@query("""
SELECT 'f' || s_nationkey::VARCHAR AS file, s_name AS "Resource", round(s_acctbal, 2) AS "Value" FROM supplier
""")
def xml_rows(spark, sf):
    def cell(text):
        return F.concat(F.lit('<Cell><Data ss:Type="String">'), text, F.lit("</Data></Cell>"))

    supplier = table(spark, sf, "supplier").withColumn("file", F.concat(F.lit("f"), F.col("s_nationkey").cast("string")))
    row = F.concat(F.lit('<Row xmlns:ss="urn:s">'), cell(F.col("s_name")), cell(F.col("s_acctbal").cast("string")), F.lit("</Row>"))
    head = F.concat(F.lit('<Row xmlns:ss="urn:s">'), cell(F.lit("Resource")), cell(F.lit("Value")), F.lit("</Row>"))
    documents = supplier.select("file", row.alias("body")).unionByName(supplier.select("file", head.alias("body")).distinct())
    rows = ss.records(ss.parse_rows(documents, "body"), "Resource", ["file"])
    return rows.select(
        "file", F.col("fields")["Resource"].alias("Resource"), F.round(F.col("fields")["Value"].cast("double"), 2).alias("Value")
    )


def outages(spark, sf):
    orders = table(spark, sf, "orders")
    restored = add_time("o_orderdate", F.floor(F.col("o_totalprice") / 1000) * 24 + 6, "hour")
    return orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("site"), F.col("o_orderdate").alias("date_offline"),
        F.when(F.col("o_orderstatus") != "O", restored).alias("date_restored"), (F.col("o_custkey") % 3 + 1).alias("n_inv"),
    )


CLAIMS_SQL = """
WITH o AS (
  SELECT o_orderkey, o_orderpriority AS site, o_orderdate AS a,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + CAST(floor(o_totalprice / 1000) * 24 + 6 AS INTEGER) * INTERVAL 1 HOUR END AS z,
         o_custkey % 3 + 1 AS n_inv FROM orders),
k AS (SELECT * FROM o WHERE (z IS NULL OR z >= TIMESTAMP '1998-03-01') AND a < TIMESTAMP '1998-03-01'),
c AS (
  SELECT *, greatest(0, date_diff('day', greatest(CAST(a + INTERVAL 1 MONTH AS DATE), DATE '1998-03-01'),
      least(coalesce(CAST(z AS DATE) + 1, DATE '1998-03-31'), DATE '1998-03-31')) + 1) AS n_claim_days FROM k)
"""


@query(CLAIMS_SQL + "SELECT o_orderkey, site, a AS date_offline, z AS date_restored, n_inv, n_claim_days::INTEGER AS n_claim_days, (n_claim_days * n_inv)::BIGINT AS outage_days FROM c")
def claim_days(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1998-03-01", "1998-04-01"))
    return lk.claim_days(outages(spark, sf), start, end)


@query(CLAIMS_SQL + """,
fleet AS (SELECT o_orderpriority AS site, count(DISTINCT o_custkey % 20) AS n_inverters FROM orders GROUP BY 1),
p AS (SELECT o_orderpriority AS site, sum(floor(o_totalprice)) / 1000 AS mwh FROM orders WHERE o_orderdate >= '1998-03-01' AND o_orderdate < '1998-04-01' GROUP BY 1),
d AS (SELECT site, sum(n_claim_days * n_inv) AS days FROM c GROUP BY 1)
SELECT fleet.site, CAST(coalesce(days, 0) AS BIGINT) AS outage_days, round(mwh / (n_inverters * 31), 6) AS mwh_per_inverter_day,
       round(coalesce(mwh / (n_inverters * 31) * days, 0), 4) AS claim_mwh
FROM fleet LEFT JOIN p USING (site) LEFT JOIN d USING (site)
""")
def insurance_claim(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1998-03-01", "1998-04-01"))
    orders = table(spark, sf, "orders").withColumn("site", F.col("o_orderpriority"))
    fleet = orders.groupBy("site").agg(F.count_distinct(F.col("o_custkey") % 20).alias("n_inverters"))
    possible = orders.filter("o_orderdate >= '1998-03-01' AND o_orderdate < '1998-04-01'").groupBy("site").agg(
        (F.sum(F.floor("o_totalprice")) / 1000).alias("possible_mwh")
    )
    out = claims(outages(spark, sf), possible, fleet, start, end)
    return rounded(rounded(out, 6, "mwh_per_inverter_day"), 4, "claim_mwh")


@query("""
SELECT o_orderkey, o_orderdate AS date_offline, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 3 DAY END AS date_restored FROM orders
""")
def outage_log_dates(spark, sf):
    orders = table(spark, sf, "orders")
    log = orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("date_offline"),
        F.when(
            F.col("o_orderstatus") != "O",
            F.date_format(add_time("o_orderdate", 3, "day"), "MM/dd/yy"),
        ).alias("date_restored"),
    )
    return parse_outage_dates(log, ["date_offline", "date_restored"])


@query("""
WITH f AS (
  SELECT c_nationkey AS site, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
         CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'inverters' ELSE 'met' END AS grp,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'raw' WHEN '2-HIGH' THEN 'cleaned' WHEN '3-MEDIUM' THEN 'processed' WHEN '5-LOW' THEN 'model' ELSE 'report' END AS version,
         o_orderstatus = 'P' AS draft FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (
  SELECT site, month, bool_or(version = 'raw' AND grp = 'met') AS met_raw, bool_or(version = 'cleaned' AND grp = 'met') AS met_cleaned,
    bool_or(version = 'processed' AND grp = 'met') AS met_processed, bool_or(version = 'cleaned' AND grp = 'inverters') AS inv_cleaned,
    bool_or(version = 'model') AS model, bool_or(version = 'report') AS report,
    coalesce(bool_and(draft) FILTER (version = 'report'), false) AS draft FROM f GROUP BY 1, 2)
SELECT *, CASE WHEN model THEN NULL WHEN met_processed THEN 'model' WHEN met_cleaned THEN 'backfill' WHEN met_raw THEN 'auto_qc' ELSE 'query' END AS model_next,
  CASE WHEN report AND draft THEN 'await utility meter' WHEN report THEN 'nothing' WHEN model AND inv_cleaned THEN 'report'
    WHEN met_processed AND NOT model THEN 'model' WHEN met_cleaned AND NOT met_processed THEN 'backfill' ELSE 'manual qc' END AS next_step,
  nullif(concat_ws('+', CASE WHEN NOT met_cleaned THEN 'met' END, CASE WHEN NOT inv_cleaned THEN 'inv' END), '') AS needs_qc
FROM g
""")
def pipeline_status(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    names = {"1-URGENT": "raw", "2-HIGH": "cleaned", "3-MEDIUM": "processed", "5-LOW": "model"}
    mapping = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    group = F.when(F.col("c_mktsegment").isin("FURNITURE", "MACHINERY"), "inverters").otherwise("met")
    files = orders.select(
        F.col("c_nationkey").alias("site"), floor_time("month", "o_orderdate").alias("month"), group.alias("group"),
        F.coalesce(mapping[F.col("o_orderpriority")], F.lit("report")).alias("version"), (F.col("o_orderstatus") == "P").alias("draft"),
    )
    return status_of(files)


@query("SELECT DISTINCT o_orderpriority AS site, strftime(o_orderdate, '%Y%m') AS period FROM orders")
def stored_periods(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("site"), F.col("o_orderdate").alias("ts"))
    return fl.stored_periods(rows)


@query("""
WITH f AS (
  SELECT c_nationkey AS site, date_trunc('month', o_orderdate)::TIMESTAMP AS month, o_orderkey::VARCHAR || CASE o_orderstatus WHEN 'F' THEN '_CLEANED' WHEN 'P' THEN '_CLEANED_PROCESSED' ELSE '' END AS path,
         CASE o_orderstatus WHEN 'F' THEN 'cleaned' WHEN 'P' THEN 'processed' ELSE 'raw' END AS version, o_orderdate AS modified FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT *, row_number() OVER (PARTITION BY site, month, version ORDER BY modified DESC, path DESC) AS rn FROM f)
SELECT site, month, version, path, modified FROM r WHERE rn = 1
""")
def latest_versions(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    suffix = F.when(F.col("o_orderstatus") == "F", "_CLEANED").when(F.col("o_orderstatus") == "P", "_CLEANED_PROCESSED").otherwise("")
    name = F.concat(F.col("o_orderkey").cast("string"), suffix)
    files = orders.select(
        F.col("c_nationkey").alias("site"), floor_time("month", "o_orderdate").alias("month"), name.alias("path"), name.alias("name"),
        F.col("o_orderdate").alias("modified"),
    )
    return fl.latest_files(fl.with_version(files), ["site", "month", "version"])


@query("""
SELECT c_nationkey AS site FROM customer GROUP BY 1 HAVING count(*) % 2 = 0 INTERSECT SELECT s_nationkey FROM supplier
""")
def common_sites(spark, sf):
    return even_nations(spark, sf).intersect(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("site")))


@query("""
SELECT DISTINCT p_brand, p_size FROM part WHERE p_partkey % 2 = 0 EXCEPT SELECT p_brand, p_size FROM part WHERE p_partkey % 2 = 1
""")
def removed_items(spark, sf):
    part = table(spark, sf, "part")
    early, late = part.filter("p_partkey % 2 = 0"), part.filter("p_partkey % 2 = 1")
    return early.select("p_brand", "p_size").dropDuplicates().join(late, ["p_brand", "p_size"], "left_anti")


@query("""
SELECT 'kpi' AS file, c_custkey + 5 AS row_no, c_name AS "Site", c_mktsegment AS "Notes", CASE WHEN c_custkey % 3 > 0 THEN c_acctbal::VARCHAR END AS "KPI"
FROM customer
""")
def kpi_notes_table(spark, sf):
    """A sheet with a title, the header in its third row, and loose cells."""
    rows = table(spark, sf, "customer").withColumn("row_no", F.col("c_custkey") + 5)

    def cell(col, text):
        return F.struct(F.col("row_no"), F.lit(col).alias("col_no"), text.cast("string").alias("text"))

    kpi = F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal").cast("string"))
    body = rows.select(F.inline(F.array(
        cell(0, F.concat(F.lit("  "), "c_name")), cell(1, kpi), cell(2, F.concat("c_mktsegment", F.lit(" "))), cell(4, F.lit("margin"))
    )))
    head = [(1, 0, "KPI table"), (3, 0, " Site"), (3, 1, "KPI"), (3, 2, "Notes ")]
    cells = spark.createDataFrame(head, "row_no bigint, col_no int, text string").unionByName(body).withColumn("file", F.lit("kpi"))
    return mt.labelled_table(cells, "Site", ["Site", "Notes", "KPI"])


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def numeric_columns(spark, sf):
    return iv.numeric_columns(table(spark, sf, "supplier"), ["s_name"])


@query(f"""
WITH {READINGS_SQL},
r AS (SELECT site, asset, ts, event_id, CASE WHEN asset % 5 > 0 THEN value END AS value FROM readings)
SELECT * FROM r WHERE (site, asset) IN (SELECT (site, asset) FROM r WHERE value IS NOT NULL)
""")
def drop_empty_series(spark, sf):
    value = F.when(F.col("asset") % 5 > 0, F.col("value")).alias("value")
    return drop_empty(readings(spark, sf).select("site", "asset", "ts", "event_id", value), ["site", "asset"])


@query("""
SELECT o_orderkey, o_orderpriority AS site, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '3', '5') THEN 2 * o_totalprice ELSE o_totalprice END AS value FROM orders
""")
def versioned_sink(spark, sf):
    """All sites are written, some of them once more; the newest version of each counts."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("site"), F.col("o_totalprice").alias("value"))
    again = rows.filter(F.substring("site", 1, 1).isin("1", "3", "5")).withColumn("value", F.col("value") * 2)
    path = f"{shared_folder(spark)}/gridloom/{uuid.uuid4().hex}"
    fl.write_version(rows, path, F.lit(1), ["site"])
    fl.write_version(again, path, F.lit(2), ["site"])
    return fl.latest_version(spark.read.parquet(path), ["site"]).select("o_orderkey", "site", "value")
