"""Meter file queries: grids of cells derived from dated production rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.catalog.values import rounded
from gridloom.catalog.views import READINGS_SQL, readings, table
from gridloom.core.session import cut_lineage
from gridloom.functions.scalars import add_time
from gridloom.operators.timeaxis import (
    instant_to_local,
    local_to_instant,
    localize_fixed_offset,
    repair_meter_hours,
    standardize_local,
)
from gridloom.sources import meters as mt

# Lines are grouped into files by return flag; a file has a title row, a header row and
# one row per day or interval.
def day_row():
    return F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")) + 3


def cell(row, col, text):
    return F.struct(
        row.cast("bigint").alias("row_no"), (F.lit(col) if isinstance(col, int) else col).cast("int").alias("col_no"),
        text.cast("string").alias("text"),
    )


def grid(spark, sf, body, header):
    """Cells of the body plus a title, the header names and a trailing total row."""
    files = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("file")).distinct()
    names = [cell(F.lit(2), i, F.lit(n)) for i, n in enumerate(header)]
    extra = [cell(F.lit(1), 0, F.lit("Meter report")), cell(F.lit(10_000_000), 0, F.lit("Total"))]
    cells = body.select("file", "row_no", "col_no", "text").unionByName(
        files.select("file", F.inline(F.array(*names, *extra)))
    )
    return cut_lineage(cells)  # the landed grid, which a layout reads several times


def lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("file", F.col("l_returnflag")).withColumn(
        "hour", (F.col("l_orderkey") % 24 + 1).cast("int")
    )


def wide_grid(spark, sf):
    rows = lines(spark, sf)
    energy = rows.groupBy("file", day_row().alias("row_no"), F.col("hour").alias("col_no")).agg(
        F.sum("l_quantity").cast("string").alias("text")
    )
    days = rows.select("file", day_row().alias("row_no"), F.lit(0).alias("col_no"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("text")).distinct()
    return grid(spark, sf, energy.unionByName(days), ["Day", *[f"HE {h:02d} (MWh)" for h in range(1, 25)]])


@query("""
SELECT l_returnflag AS file, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts_local, sum(l_quantity) AS mwh FROM lineitem GROUP BY 1, 2
""")
def wide_hours_melt(spark, sf):
    out = mt.read_layout(wide_grid(spark, sf), mt.LAYOUTS["wide_hours_mwh"])
    return out.select("file", "ts_local", "mwh")


@query("SELECT DISTINCT l_returnflag AS file, 2::BIGINT AS header_row FROM lineitem")
def header_location(spark, sf):
    return mt.header_rows(wide_grid(spark, sf), "Day")


@query("""
SELECT l_returnflag AS file, CAST(l_shipdate AS DATE) AS day, CAST(l_orderkey % 24 + 1 AS INTEGER) AS hour, sum(l_quantity) AS mwh FROM lineitem GROUP BY 1, 2, 3
""")
def meter_output_table(spark, sf):
    out = mt.read_layout(wide_grid(spark, sf), mt.LAYOUTS["wide_hours_mwh"])
    return mt.meter_table(out, ["file"])


@query("""
WITH r AS (
  SELECT l_returnflag AS file, CAST(l_shipdate AS DATE) AS day, l_orderkey % 96 AS q, sum(l_quantity) AS mwh FROM lineitem GROUP BY 1, 2, 3),
e AS (
  SELECT *, CASE WHEN q = 95 THEN '00:00' ELSE lpad(((q + 1) // 4)::VARCHAR, 2, '0') || ':' || lpad(((q + 1) % 4 * 15)::VARCHAR, 2, '0') END AS ending FROM r),
b AS (SELECT *, coalesce(lag(ending) OVER (PARTITION BY file ORDER BY day, q), '00:00') AS label FROM e)
SELECT file, day::TIMESTAMP + CAST(substr(label, 1, 2) AS INTEGER) * INTERVAL 1 HOUR AS ts_local, -sum(mwh) AS mwh FROM b GROUP BY 1, 2
""")
def interval_ending_shift(spark, sf):
    quarter = (F.col("l_orderkey") % 96).cast("int")
    rows = lines(spark, sf).groupBy("file", "l_shipdate", quarter.alias("q"), (day_row() * 100 + quarter).alias("row_no")).agg(
        F.sum("l_quantity").alias("mwh")
    )
    end = F.col("q") + 1
    label = F.concat_ws(
        ":", F.lpad(F.floor(end / 4).cast("string"), 2, "0"), F.lpad((end % 4 * 15).cast("string"), 2, "0")
    )
    cells = F.inline(
        F.array(
            cell(F.col("row_no"), 0, F.date_format("l_shipdate", "yyyy-MM-dd")),
            cell(F.col("row_no"), 1, label),
            cell(F.col("row_no"), 2, F.col("mwh")),
        )
    )
    body = rows.select("file", cells)
    out = mt.read_layout(grid(spark, sf, body, ["Flowday", "Interval", "RTEI_QTY"]), mt.LAYOUTS["quarter_import"])
    return out.select("file", "ts_local", "mwh")


@query("""
SELECT l_returnflag AS file, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts_local, round(sum(l_quantity) * 0.001::DOUBLE, 6) AS mwh FROM lineitem GROUP BY 1, 2
""")
def long_packed_hours(spark, sf):
    rows = lines(spark, sf).groupBy("file", "l_shipdate", "hour", (day_row() * 100 + F.col("hour")).alias("row_no")).agg(
        F.sum("l_quantity").alias("kw")
    )
    packed = F.regexp_replace(F.date_format("l_shipdate", "MMddyy"), "^0", "")
    cells = F.inline(
        F.array(
            cell(F.col("row_no"), 0, F.lit("x")),
            cell(F.col("row_no"), 1, packed),
            cell(F.col("row_no"), 2, F.col("hour") * 100),
            cell(F.col("row_no"), 3, F.col("kw")),
            cell(F.col("row_no"), 4, F.col("kw") * 7),
        )
    )
    body = rows.select("file", cells)
    out = mt.read_layout(grid(spark, sf, body, ["ID", "DATE", "HOUR", "KW 1", "KW 1"]), mt.LAYOUTS["long_packed_kw"])
    return rounded(out.select("file", "ts_local", "mwh"), 6, "mwh")


@query("""
WITH h AS (
  SELECT l_returnflag AS file, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts_local, sum(l_quantity) AS mwh FROM lineitem GROUP BY 1, 2)
SELECT file, ts_local, coalesce(lag(mwh) OVER (PARTITION BY file ORDER BY ts_local), 0) AS mwh FROM h
""")
def shifted_schedule(spark, sf):
    rows = lines(spark, sf).groupBy("file", "l_shipdate", "hour", (day_row() * 100 + F.col("hour")).alias("row_no")).agg(
        F.sum("l_quantity").alias("mwh")
    )
    cells = F.inline(
        F.array(
            cell(F.col("row_no"), 0, F.date_format("l_shipdate", "M/d/yyyy")),
            cell(F.col("row_no"), 1, F.col("hour")),
            cell(F.col("row_no"), 2, F.col("mwh")),
        )
    )
    body = rows.select("file", cells)
    out = mt.read_layout(grid(spark, sf, body, ["CT Date", "CT Hour", "Scheduled"]), mt.LAYOUTS["long_scheduled_mwh"])
    return out.select("file", "ts_local", "mwh")


@query(f"""
WITH {READINGS_SQL}
SELECT site AS file, date_trunc('hour', ts) AS ts_local, round(avg(value), 9) AS mwh FROM readings GROUP BY 1, 2
""")
def stamped_mean(spark, sf):
    rows = readings(spark, sf)
    cells = F.inline(
        F.array(
            cell(F.col("event_id") + 5, 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
            cell(F.col("event_id") + 5, 1, F.col("value")),
        )
    )
    header = rows.select(F.col("site").alias("file")).distinct().select(
        "file", F.inline(F.array(cell(F.lit(2), 0, F.lit("Timestamp")), cell(F.lit(2), 1, F.lit("MeterMW"))))
    )
    grid_cells = rows.select(F.col("site").alias("file"), cells).unionByName(header)
    out = mt.read_layout(grid_cells, mt.LAYOUTS["stamped_mean_mw"])
    return rounded(out.select("file", "ts_local", "mwh"), 9, "mwh")


@query("""
WITH r AS (
  SELECT l_suppkey, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts_local, coalesce(CASE WHEN l_quantity > 5 THEN l_quantity END, 0) AS v
  FROM lineitem WHERE l_linestatus = 'F')
SELECT coalesce(CASE WHEN s_suppkey % 4 > 0 THEN s_name END, 'R' || l_suppkey::VARCHAR) AS site, ts_local, round(avg(v), 9) AS mwh
FROM r JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2
""")
def settlement_pivot(spark, sf):
    rows = lines(spark, sf).select(
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("resource_id"), F.to_date("l_shipdate").alias("trade_date"),
        F.col("hour").alias("interval_id"), F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("value"),
        F.when(F.col("l_linestatus") == "F", "GEN").otherwise("LOAD").alias("measurement_type"),
    )
    resources = table(spark, sf, "supplier").filter("s_suppkey % 4 > 0").select(
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("resource_id"), F.col("s_name").alias("site")
    )
    return rounded(mt.settlement(rows, resources), 9, "mwh")


@query("""
WITH h AS (
  SELECT l_returnflag AS site, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts, sum(l_quantity) AS mwh, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT site, date_trunc('month', ts)::TIMESTAMP AS month, sum(mwh) AS mwh, count(*) FILTER (n > 1) AS n_repeated_hours FROM h GROUP BY 1, 2
""")
def monthly_meter_totals(spark, sf):
    rows = lines(spark, sf).select(
        F.col("file").alias("site"), (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("hour") - 1)).alias("ts_local"),
        F.col("l_quantity").alias("mwh"),
    )
    return mt.monthly_totals(rows)


ZONES = {"A": "America/Chicago", "N": "America/New_York", "R": "America/Phoenix"}


def local_rows(spark, sf):
    """Local wall-clock hours with up to two rows each, ordered by line status."""
    zone = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    return (
        lines(spark, sf)
        .groupBy(
            F.col("file").alias("site"), zone[F.col("file")].alias("tz"), F.col("l_linestatus").alias("row"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("hour") - 1)).alias("ts_local"),
        )
        .agg(F.sum("l_quantity").alias("mwh"))
    )


LOCAL_SQL = """
WITH r AS (
  SELECT l_returnflag AS site, CASE l_returnflag WHEN 'A' THEN 'America/Chicago' WHEN 'N' THEN 'America/New_York' ELSE 'America/Phoenix' END AS tz,
         l_linestatus AS row, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts, sum(l_quantity) AS mwh FROM lineitem GROUP BY 1, 2, 3, 4),
m AS (
  SELECT site, tz, ts, arg_min(mwh, row) AS v1, arg_max(mwh, row) AS v2, count(*) AS n FROM r GROUP BY 1, 2, 3),
i AS (
  SELECT *, CASE WHEN timezone(tz, timezone(tz, ts) - INTERVAL 1 HOUR) = ts THEN timezone(tz, ts) - INTERVAL 1 HOUR ELSE timezone(tz, ts) END AS u FROM m),
"""


@query(LOCAL_SQL + """
p AS (
  SELECT site, tz, CASE WHEN timezone(tz, u) <> ts THEN u - INTERVAL 1 HOUR ELSE u END AS u, v1 AS v, timezone(tz, u) <> ts AS moved FROM i
  UNION ALL SELECT site, tz, u + INTERVAL 1 HOUR, v2, false FROM i WHERE n > 1 AND timezone(tz, u + INTERVAL 1 HOUR) = ts),
q AS (SELECT site, tz, u, arg_max(v, moved::INTEGER) AS v FROM p GROUP BY 1, 2, 3),
b AS (SELECT site, tz, min(u) AS a, max(u) AS z FROM q GROUP BY 1, 2),
axis AS (SELECT site, tz, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS u FROM b),
f AS (SELECT axis.site, timezone(axis.tz, axis.u) AS ts, coalesce(v, 0) AS v FROM axis LEFT JOIN q ON q.site = axis.site AND q.u = axis.u)
SELECT site, date_trunc('month', ts)::TIMESTAMP AS month, count(*) AS n_hours, sum(v) AS mwh, count(*) FILTER (v = 0) AS n_zero FROM f GROUP BY 1, 2
""")
def dst_repair(spark, sf):
    out = repair_meter_hours(local_rows(spark, sf), ["site"], "tz", "row")
    month = F.date_trunc("month", "ts_local").cast("timestamp_ntz").alias("month")
    return out.groupBy("site", month).agg(
        F.count("*").alias("n_hours"), F.sum("mwh").alias("mwh"), F.count_if(F.col("mwh") == 0).alias("n_zero")
    )


@query(LOCAL_SQL + """
k AS (SELECT site, ts, row_number() OVER (PARTITION BY site, ts ORDER BY u) AS rn, v1 FROM (
  SELECT site, tz, timezone(tz, u) AS ts, u, v1 FROM i)),
b AS (SELECT site, min(ts) AS a, max(ts) AS z FROM k GROUP BY 1),
axis AS (SELECT site, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM b)
SELECT axis.site, date_trunc('month', axis.ts)::TIMESTAMP AS month, count(*) AS n_hours, count(v1) AS n_values, sum(v1) AS mwh
FROM axis LEFT JOIN k ON k.site = axis.site AND k.ts = axis.ts AND rn = 1 GROUP BY 1, 2
""")
def local_standard_axis(spark, sf):
    rows = local_rows(spark, sf).groupBy("site", "tz", "ts_local").agg(F.min_by("mwh", "row").alias("mwh"))
    # a skipped hour keeps its instant; the earlier row of an equal wall clock stays
    instants = rows.withColumn("instant", local_to_instant("ts_local", "tz")).drop("ts_local")
    out = standardize_local(instants, ["site"], "tz", 3600)
    month = F.date_trunc("month", "ts_local").cast("timestamp_ntz").alias("month")
    return out.groupBy("site", month).agg(
        F.count("*").alias("n_hours"), F.count("mwh").alias("n_values"), F.sum("mwh").alias("mwh")
    )


@query("""
WITH z AS (
  SELECT l_returnflag AS site, CASE l_returnflag WHEN 'A' THEN 'America/Chicago' WHEN 'N' THEN 'America/New_York' ELSE 'America/Phoenix' END AS tz,
         l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts, l_quantity FROM lineitem),
f AS (SELECT site, tz, min(ts) AS t0 FROM z GROUP BY 1, 2),
o AS (SELECT site, timezone(tz, t0) - timezone('UTC', t0) AS shift FROM f)
SELECT z.site, date_trunc('month', timezone(tz, timezone('UTC', ts) + shift))::TIMESTAMP AS month, hour(timezone(tz, timezone('UTC', ts) + shift))::INTEGER AS hour,
       sum(l_quantity) AS mwh FROM z JOIN o USING (site) GROUP BY 1, 2, 3
""")
def fixed_offset_localize(spark, sf):
    zone = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    rows = lines(spark, sf).select(
        F.col("file").alias("site"), zone[F.col("file")].alias("tz"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("hour") - 1)).alias("ts_local"), "l_quantity",
    )
    out = localize_fixed_offset(rows, ["site"], "tz").withColumn("local", instant_to_local("instant", "tz"))
    month = F.date_trunc("month", "local").cast("timestamp_ntz").alias("month")
    return out.groupBy("site", month, F.hour("local").alias("hour")).agg(F.sum("l_quantity").alias("mwh"))


# Lines moved to the days on which the clocks change, so that every row of the table meets one.
ROUTES = {
    "A": ("wide_hours_mwh", "America/Chicago"),
    "N": ("quarter_generation", "America/New_York"),
    "R": ("long_trading_kw", "America/Denver"),
}
CHANGE_ZONE = "America/Chicago"


def day_hours(day, tz):
    midnight = F.col(day).cast("timestamp_ntz")
    return F.timestamp_diff("HOUR", local_to_instant(midnight, tz), local_to_instant(add_time(midnight, 1, "day"), tz))


def change_days(spark, sf):
    """Days of 23 or 25 hours within the dates of the table, numbered."""
    span = table(spark, sf, "lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("z"))
    days = span.select(F.explode(F.sequence(F.to_date("a"), F.to_date("z"))).alias("day"))
    days = days.filter(day_hours("day", F.lit(CHANGE_ZONE)) != 24)
    numbers = days.agg(F.array_sort(F.collect_list("day")).alias("d"))  # two a year
    return numbers.select(F.size("d").alias("n_days"), F.posexplode("d").alias("i", "day"))


def change_lines(spark, sf, zones):
    """site, tz, i, day, hours (length of the day), k (spreads rows over it), mwh."""
    days = change_days(spark, sf)
    n_days = days.count()
    zone = F.create_map(*[F.lit(x) for kv in zones.items() for x in kv])
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("site"), zone[F.col("l_returnflag")].alias("tz"), (F.col("l_orderkey") % n_days).cast("int").alias("i"),
        F.floor(F.col("l_orderkey") / 7).alias("k"), F.col("l_quantity").alias("mwh"),
    )
    return rows.join(days.drop("n_days"), "i").withColumn("hours", day_hours("day", F.col("tz")))


def change_sql(zones, per_hour=1, sign=1, error=False):
    zone = " ".join(f"WHEN '{k}' THEN '{z}'" for k, z in zones.items())
    return f"""
WITH s AS (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS z FROM lineitem),
e AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM s),
d AS (
  SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM e
  WHERE date_diff('hour', timezone('{CHANGE_ZONE}', d::TIMESTAMP), timezone('{CHANGE_ZONE}', (d + 1)::TIMESTAMP)) <> 24),
l AS (
  SELECT l_returnflag AS site, CASE l_returnflag {zone} END AS tz, i, l_orderkey // 7 AS k, l_quantity AS v
  FROM (SELECT *, l_orderkey % (SELECT count(*) FROM d) AS i FROM lineitem)),
m AS (
  SELECT site, tz, timezone(tz, d::TIMESTAMP) AS u0, date_diff('hour', timezone(tz, d::TIMESTAMP), timezone(tz, (d + 1)::TIMESTAMP)) AS n, k, v
  FROM l JOIN d USING (i)),
h AS (SELECT site, tz, u0 + (k % (n * {per_hour}) // {per_hour}) * INTERVAL 1 HOUR AS u, {sign} * sum(v) AS v FROM m GROUP BY 1, 2, 3),
x AS (SELECT site, tz, min(u) AS a, max(u) AS z FROM h GROUP BY 1, 2),
axis AS (SELECT site, tz, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS u FROM x),
f AS (SELECT axis.site, timezone(axis.tz, axis.u) AS ts, coalesce(v, 0) AS v FROM axis LEFT JOIN h ON h.site = axis.site AND h.u = axis.u)
SELECT site, date_trunc('month', ts)::TIMESTAMP AS month, count(*) AS n_hours, sum(v) AS mwh, count(*) FILTER (v = 0) AS n_zero
  {", NULL::VARCHAR AS error" if error else ""}
FROM f GROUP BY 1, 2
"""


def by_month(hours):
    month = F.date_trunc("month", "ts_local").cast("timestamp_ntz").alias("month")
    return hours.groupBy("site", month).agg(
        F.count("*").alias("n_hours"), F.sum("mwh").alias("mwh"), F.count_if(F.col("mwh") == 0).alias("n_zero")
    )


def header_cells(sites, names):
    return sites.select("file", F.inline(F.array(*[cell(F.lit(2), i, F.lit(n)) for i, n in enumerate(names)])))


def wide_change_cells(lines_):
    """Day rows with up to 25 hour columns; a day of 23 hours has none for hour 3."""
    e = (F.col("k") % F.col("hours")).cast("int")
    label = F.when((F.col("hours") == 23) & (e >= 2), e + 2).otherwise(e + 1)
    energy = lines_.groupBy(F.col("site").alias("file"), (F.col("i") + 3).cast("bigint").alias("row_no"), label.alias("col_no")).agg(
        F.sum("mwh").cast("string").alias("text")
    )
    days = lines_.select(
        F.col("site").alias("file"), (F.col("i") + 3).cast("bigint").alias("row_no"), F.lit(0).alias("col_no"), F.date_format("day", "yyyy-MM-dd").alias("text")
    ).distinct()
    head = header_cells(days.select("file").distinct(), ["Day", *[f"HE {h:02d}" for h in range(1, 26)]])
    return energy.unionByName(days).unionByName(head)


def quarter_change_cells(lines_, value):
    """All quarters of the days, by interval-ending clock labels."""
    days = lines_.select("site", "tz", "i", "day", "hours").distinct()
    axis = days.select("*", F.explode(F.sequence(F.lit(0), (F.col("hours") * 4 - 1).cast("int"))).alias("q"))
    sums = lines_.groupBy("site", "i", (F.col("k") % (F.col("hours") * 4)).cast("int").alias("q")).agg(F.sum("mwh").alias("mwh"))
    start = local_to_instant(F.col("day").cast("timestamp_ntz"), F.col("tz"))
    end = F.date_format(instant_to_local(add_time(start, (F.col("q") + 1) * 15, "minute"), F.col("tz")), "HH:mm")
    label = F.when(F.col("q") == F.col("hours") * 4 - 1, "24:00").otherwise(end)
    row = F.col("i") * 200 + F.col("q") + 3
    rows = axis.join(sums, ["site", "i", "q"], "left").select(
        F.col("site").alias("file"),
        F.inline(F.array(cell(row, 0, F.date_format("day", "yyyy-MM-dd")), cell(row, 1, label), cell(row, 2, F.col("mwh")))),
    )
    return rows.unionByName(header_cells(days.select(F.col("site").alias("file")).distinct(), ["Flowday", "Interval", value]))


def long_change_cells(lines_):
    """A row per hour of a day in order; the hour of a repeated label comes twice."""
    e = (F.col("k") % F.col("hours")).cast("int").alias("e")
    rows = lines_.groupBy("site", "i", "day", "hours", e).agg((F.sum("mwh") * 1000).alias("kw"))
    label = F.when((F.col("hours") == 25) & (F.col("e") >= 2), F.col("e")).when((F.col("hours") == 23) & (F.col("e") >= 2), F.col("e") + 2)
    label = label.otherwise(F.col("e") + 1)
    row = F.col("i") * 200 + F.col("e") + 3
    body = rows.select(
        F.col("site").alias("file"),
        F.inline(F.array(cell(row, 0, F.date_format("day", "yyyy-MM-dd")), cell(row, 1, label), cell(row, 2, F.col("kw")))),
    )
    return body.unionByName(header_cells(rows.select(F.col("site").alias("file")).distinct(), ["TradingDate", "TradingHour", "Meter_KW"]))


def routing_of(spark, layouts):
    return spark.createDataFrame([(s, s, x, z) for s, (x, z) in layouts.items()], "file string, site string, layout string, tz string")


@query(change_sql(ZONES))
def wide_25_hours(spark, sf):
    lines_ = cut_lineage(change_lines(spark, sf, ZONES))
    routing = routing_of(spark, {s: ("wide_hours_mwh", z) for s, z in ZONES.items()})
    return by_month(mt.meter_router(cut_lineage(wide_change_cells(lines_)), routing))


@query(change_sql(ZONES, per_hour=4, sign=-1))
def quarter_25_hours(spark, sf):
    lines_ = cut_lineage(change_lines(spark, sf, ZONES))
    routing = routing_of(spark, {s: ("quarter_import", z) for s, z in ZONES.items()})
    return by_month(mt.meter_router(cut_lineage(quarter_change_cells(lines_, "RTEI_QTY")), routing))


MIXED = {s: z for s, (_, z) in ROUTES.items()}


@query(f"""
WITH w AS ({change_sql(MIXED)}), q AS ({change_sql(MIXED, per_hour=4)})
SELECT *, NULL::VARCHAR AS error FROM w WHERE site <> 'N'
UNION ALL SELECT *, NULL FROM q WHERE site = 'N'
UNION ALL SELECT 'unread', NULL, 1, NULL, 0, 'no header row'
""")
def meter_router(spark, sf):
    """Three sites with files of three layouts, and a file without a header row."""
    lines_ = cut_lineage(change_lines(spark, sf, MIXED))
    parts = [
        wide_change_cells(lines_.filter("site = 'A'")),
        quarter_change_cells(lines_.filter("site = 'N'"), "GEN_MWH_INT"),
        long_change_cells(lines_.filter("site = 'R'")),
    ]
    cells = parts[0].unionByName(parts[1]).unionByName(parts[2])
    headless = cells.filter("file = 'A' AND row_no > 2").withColumn("file", F.lit("unread"))
    routing = routing_of(spark, {**ROUTES, "unread": ROUTES["A"]})
    hours = mt.meter_router(cut_lineage(cells.unionByName(headless)), routing)
    month = F.date_trunc("month", "ts_local").cast("timestamp_ntz").alias("month")
    return hours.groupBy("site", month, "error").agg(
        F.count("*").alias("n_hours"), F.sum("mwh").alias("mwh"), F.count_if(F.col("mwh") == 0).alias("n_zero")
    )


@query("""
WITH h AS (
  SELECT l_returnflag || l_linestatus AS site, CAST(l_shipdate AS DATE) + ((l_orderkey % 24) * INTERVAL 1 HOUR) AS ts_local,
         CASE WHEN l_returnflag = 'R' OR l_linenumber = 2 THEN NULL ELSE l_quantity END AS mwh FROM lineitem)
SELECT site, date_trunc('month', ts_local)::TIMESTAMP AS month, count(*) AS n_rows, count(mwh) AS n_values, sum(mwh) AS mwh
FROM h WHERE site IN (SELECT site FROM h WHERE mwh IS NOT NULL) GROUP BY 1, 2
""")
def meter_history_scan(spark, sf):
    """Stored text values; one site has none, and some cells are no numbers."""
    bad = F.when(F.col("l_returnflag") == "R", F.lit(None)).when(F.col("l_linenumber") == 2, "n/a")
    text = F.when((F.col("l_returnflag") == "R") | (F.col("l_linenumber") == 2), bad).otherwise(F.col("l_quantity").cast("string"))
    rows = lines(spark, sf).select(
        F.concat("l_returnflag", "l_linestatus").alias("site"), F.to_date("l_shipdate").alias("day"), "hour", text.alias("text")
    )
    return mt.meter_history(rows).groupBy("site", F.date_trunc("month", "ts_local").cast("timestamp_ntz").alias("month")).agg(
        F.count("*").alias("n_rows"), F.count("mwh").alias("n_values"), F.sum("mwh").alias("mwh")
    )
