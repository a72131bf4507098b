"""Monthly performance report: interval table, inverter totals and site totals.

The tables are long: ``site_hours`` has one row per site and hour, ``inverter_hours`` one
per site, inverter and hour.  All sites and months run in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import floor_time, sum0
from gridloom.operators.summaries import insolation, with_group
from gridloom.operators.timeaxis import upsample_ffill
from gridloom.plans.curtailment import curtailed_power

# Meter deviation limit, irradiance threshold, line-loss shares.
SENSITIVITY = 0.05
MIN_POA = 25.0
FULL_HOUR = 60
METER_TO_INVERTER = 1.02
INVERTER_TO_METER = 0.98
ONLINE_KW = 0.1


def hourly_inverters(
    minutes: DataFrame, model: DataFrame, site_hours: DataFrame, data_interval_minutes: int = 1
) -> DataFrame:
    """Hourly inverter power, modelled power and available minutes.

    ``minutes`` and ``model`` hold (site, inv, ts, kw).  Missing hours count as zero power;
    availability counts the intervals above the online threshold in minutes.
    """
    on = F.when(F.col("kw") > ONLINE_KW, data_interval_minutes).otherwise(0)
    actual = minutes.groupBy("site", "inv", floor_time("hour", "ts").alias("ts")).agg(
        F.coalesce(F.avg("kw"), F.lit(0.0)).alias("kw"), F.sum(on).alias("avail_min")
    )
    modelled = model.groupBy("site", "inv", floor_time("hour", "ts").alias("ts")).agg(
        F.avg("kw").alias("model_kw")
    )
    axis = site_hours.select("site", "ts").distinct()
    out = axis.join(modelled.join(actual, ["site", "inv", "ts"], "full"), ["site", "ts"])
    return out.select(
        "site", "inv", "ts",
        F.coalesce("kw", F.lit(0.0)).alias("kw"),
        "model_kw",
        F.coalesce("avail_min", F.lit(0)).alias("avail_min"),
    )


def interval_table(
    met: DataFrame, modules: DataFrame, soiling: DataFrame, inverters: DataFrame, soiling_by: Series
) -> DataFrame:
    """The report's hourly interval table: site columns beside those of each inverter.

    ``met``: site, ts, poa, poa_all_bad, module_temperature and optionally poa_reference, which
    stands in where a site has no sensor at all; missing columns are zero.  ``modules``: site,
    ts, modules_offline_pct.  Both are averaged by hour.  ``soiling``: site, ts, soiling (in
    percent), each value holds until the next one; it becomes a share.  ``inverters``: site,
    inv, ts, kw, model_kw, avail_min by hour.  Sites without modules or soiling have nulls; the
    hours are those of ``met``.
    """
    columns = ("poa", "poa_reference", "poa_all_bad", "module_temperature")
    given = met.withColumns({c: F.lit(None if c.startswith("poa_r") else 0.0).cast("double") for c in columns if c not in met.columns})
    hour = floor_time("hour", "ts").alias("ts")
    hours = given.groupBy("site", hour).agg(*[F.avg(c).alias(c) for c in columns])
    sensors = sized(hours.groupBy("site").agg((F.count("poa") > 0).alias("_sensor")))
    hours = hours.join(sensors, "site").withColumn("poa", F.when(F.col("_sensor"), F.col("poa")).otherwise(F.col("poa_reference")))
    offline = modules.groupBy("site", hour).agg(F.avg("modules_offline_pct").alias("modules_offline_pct"))
    filled = upsample_ffill(soiling, soiling_by, ["soiling"], 3600).select(
        "site", F.col("label").alias("ts"), (F.col("soiling") / 100).alias("soiling_share")
    )
    site = hours.drop("_sensor", "poa_reference").join(offline, ["site", "ts"], "left").join(filled, ["site", "ts"], "left")
    return site.join(inverters, ["site", "ts"], "left")


def report_rows(site_hours: DataFrame, inverter_hours: DataFrame, meta: DataFrame) -> DataFrame:
    """Site-level row formulas of the report.

    ``site_hours``: site, ts, poa, module_temp, mods_offline_pct, soiling_pct, meter_mwh,
    setpoint_mw.  ``meta``: site, mwac, mwdc, tcoeff.
    """
    sums = inverter_hours.groupBy("site", "ts").agg(
        (sum0("kw") / 1000).alias("actual"),
        sum0("model_kw").alias("model_sum"),
        F.count_if(F.col("kw") == 0).alias("n_zero"),
    )
    counts = sized(
        inverter_hours.groupBy("site", floor_time("month", "ts").alias("month")).agg(
            F.count_distinct("inv").alias("n_inv")
        )
    )
    rows = (
        site_hours.join(sums, ["site", "ts"])
        .join(sized(meta), "site")
        .withColumn("month", floor_time("month", "ts"))
        .withColumn("possible", F.least(F.col("model_sum") / 1000, F.col("mwac")))
        .withColumn("tcell", F.col("module_temp") + F.col("poa") / 1000 * 3)
    )
    typical = F.try_divide(F.sum(F.col("poa") * F.col("tcell")), F.sum("poa")).alias("tcell_avg")
    rows = with_group(rows, ["site", "month"], typical).join(counts, ["site", "month"])
    meter, actual, possible = F.col("meter_mwh"), F.col("actual"), F.col("possible")
    endci = (
        F.col("mwdc") * F.col("poa") / 1000 * (1 - F.col("tcoeff") * (F.col("tcell_avg") - F.col("tcell")))
    )
    soiling = F.col("soiling_pct") * possible
    flag = (
        F.when((actual == 0) & (meter > 0), 0).when(meter > actual * (1 + SENSITIVITY), 2).otherwise(1)
    )
    calc = F.coalesce(
        F.try_divide((meter * METER_TO_INVERTER - actual) * 1000, F.col("n_zero")), F.lit(0.0)
    )
    return (
        rows.withColumn("endci", endci)
        .withColumn("perf_ratio", F.try_divide(meter, F.col("endci")))
        .withColumn("module_loss", F.col("mods_offline_pct") * possible)
        .withColumn("soiling_loss", F.when(soiling > 0, soiling).otherwise(0.0))
        .withColumn("curt_loss", curtailed_power(F.col("setpoint_mw"), possible, meter, F.col("mwac")))
        .withColumn("flag", flag)
        .withColumn("calc_kw", calc)
        .withColumn("adj_factor", F.coalesce(F.try_divide(possible * 1000, F.col("model_sum")), F.lit(1.0)))
    )


def _inverter_rows(rows: DataFrame, inverter_hours: DataFrame) -> DataFrame:
    needed = rows.select(
        "site", "ts", "month", "poa", "curt_loss", "flag", "calc_kw", "adj_factor", "meter_mwh", "n_inv"
    )
    return inverter_hours.join(needed, ["site", "ts"]).withColumn(
        "adj_model", F.col("model_kw") * F.col("adj_factor")
    )


def _sum_if(condition: Column, value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def production_ratios(inverter_rows: DataFrame) -> DataFrame:
    """Power per irradiance of full, uncurtailed, sunny hours; the mean of the positive
    ratios of the site stands in where an inverter has none."""
    good = (F.col("poa") >= MIN_POA) & (F.col("curt_loss") == 0) & (F.col("avail_min") == FULL_HOUR)
    raw = inverter_rows.groupBy("site", "month", "inv").agg(
        F.try_divide(_sum_if(good, "kw"), _sum_if(good, "poa")).alias("ratio_raw")
    )
    mean = raw.groupBy("site", "month").agg(
        F.avg(F.when(F.col("ratio_raw") > 0, F.col("ratio_raw"))).alias("_mean")
    )
    return raw.join(mean, ["site", "month"]).select(
        "site", "month", "inv", "ratio_raw", F.coalesce("ratio_raw", "_mean").alias("ratio")
    )


def inverter_totals(rows: DataFrame, inverter_hours: DataFrame) -> DataFrame:
    """Monthly energy balance of every inverter (MWh)."""
    inv = _inverter_rows(rows, inverter_hours)
    inv = inv.join(sized(production_ratios(inv)), ["site", "month", "inv"])
    sunny, curtailed = F.col("poa") >= MIN_POA, F.col("curt_loss") > 0
    flag = F.col("flag")
    gap = F.col("ratio") * F.col("poa") - F.col("kw")
    lost = F.when(
        sunny & (F.col("curt_loss") == 0) & (F.col("avail_min") < FULL_HOUR) & (flag == 1) & (gap > 0), gap
    ).otherwise(0.0)
    share = F.col("meter_mwh") * 1000 / F.col("n_inv")
    held_back = _sum_if(sunny & curtailed, "adj_model") - (
        _sum_if(sunny & curtailed & (flag == 1), "kw") + _sum_if(curtailed & (flag != 1), share)
    )
    actual = (
        sum0("kw")
        + _sum_if(flag == 0, share / INVERTER_TO_METER)
        + _sum_if((flag == 2) & (F.col("kw") == 0), "calc_kw")
    )
    out = inv.groupBy("site", "month", "inv").agg(
        F.first("ratio_raw").alias("ratio_raw"),
        F.first("ratio").alias("ratio"),
        (F.sum(lost) / 1000).alias("downtime"),
        (held_back / 1000).alias("curtailment"),
        (actual / 1000).alias("actual"),
        (sum0("adj_model") / 1000).alias("possible"),
    )
    c = F.col
    balance = c("actual") + c("curtailment")
    return (
        out.withColumn("dc_health", c("possible") - c("actual") - c("curtailment") - c("downtime"))
        .withColumn("energetic_loss", c("dc_health") + c("downtime"))
        .withColumn(
            "availability",
            F.when(c("actual") > 0, F.try_divide(balance, balance + c("downtime"))).otherwise(0.0),
        )
    )


def site_totals(
    rows: DataFrame, totals: DataFrame, overrides: DataFrame | None = None
) -> DataFrame:
    """Monthly site balance.

    ``overrides`` (site, month, curtailment_override, meter_override) replaces the
    curtailment by an external or market total and the meter by a utility total.
    """
    inv = totals.groupBy("site", "month").agg(
        *[F.sum(c).alias(c) for c in ("energetic_loss", "dc_health", "downtime", "curtailment", "actual", "possible")]
    )
    hours = rows.groupBy("site", "month").agg(
        insolation(F.col("poa"), 1.0).alias("insolation"),
        sum0("meter_mwh").alias("meter"),
        sum0("module_loss").alias("module_loss"),
        sum0("soiling_loss").alias("soiling_loss"),
        sum0("curt_loss").alias("curt_loss"),
    )
    out = inv.join(hours, ["site", "month"])
    if overrides is not None:
        out = (
            out.join(overrides, ["site", "month"], "left")
            .withColumn("curtailment", F.coalesce("curtailment_override", "curtailment"))
            .withColumn("meter", F.coalesce("meter_override", "meter"))
            .drop("curtailment_override", "meter_override")
        )
    balance = F.col("actual") + F.col("curtailment")

    def share(loss: str) -> Column:
        return F.try_divide(balance, balance + F.col(loss))

    return (
        out.withColumn("energetic_pct", share("energetic_loss"))
        .withColumn("dc_health_pct", share("dc_health"))
        .withColumn("availability", share("downtime"))
        .withColumn("curtailment_pct", 1 - F.try_divide(F.col("actual"), balance))
    )


def summary_rows(totals: DataFrame) -> DataFrame:
    """Site totals as metric rows; a metric without a value takes its percentage."""
    rows = [
        ("Total Energetic Loss", "energetic_loss", "energetic_pct"),
        ("DC / System Health", "dc_health", "dc_health_pct"),
        ("Inverter Availability", None, "availability"),
        ("Downtime", "downtime", None),
        ("Curtailment", "curtailment", "curtailment_pct"),
        ("Actual Generation", "actual", None),
        ("Possible Generation", "possible", None),
        ("Meter Generation", "meter", None),
        ("Insolation", None, "insolation"),
    ]
    none = F.lit(None).cast("double")
    items = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.coalesce(F.col(v) if v else none, F.col(p) if p else none).alias("value"),
        )
        for metric, v, p in rows
    ]
    return totals.select("site", "month", F.inline(F.array(*items)))


def inverter_summary(totals: DataFrame) -> DataFrame:
    """Inverter totals with negative figures shown as zero."""
    columns = ["energetic_loss", "dc_health", "availability", "downtime", "curtailment", "actual", "possible"]
    return totals.select(
        "site", "month", "inv",
        *[F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)).alias(c) for c in columns],
    )


def possible_vs_actual(
    possible: DataFrame, actual: DataFrame, limits: DataFrame, keys: Sequence[str] = ("site", "inv")
) -> DataFrame:
    """Modelled beside measured power, the model floored at zero and capped per inverter.

    A missing or zero limit is replaced by the rounded mean of the site's valid limits.
    """
    valid = F.when(F.col("limit_kw") != 0, F.col("limit_kw"))
    default = limits.groupBy("site").agg(F.bround(F.avg(valid), 0).alias("_default"))
    caps = limits.join(default, "site").select("site", "inv", F.coalesce(valid, "_default").alias("_cap"))
    merged = possible.groupBy(*keys, "ts").agg(
        F.avg(F.greatest(F.col("kw"), F.lit(0.0))).alias("possible_kw")
    )
    merged = merged.join(actual.withColumnRenamed("kw", "actual_kw"), [*keys, "ts"])
    capped = F.when(
        F.col("possible_kw").isNotNull(), F.least(F.col("possible_kw"), F.col("_cap"))
    )
    return merged.join(caps, list(keys), "left").withColumn("possible_kw", capped).drop("_cap")


def monthly_report(
    site_hours: DataFrame,
    inverter_hours: DataFrame,
    meta: DataFrame,
    overrides: DataFrame | None = None,
    materialize=cut_lineage,
) -> dict[str, DataFrame]:
    """Rows, inverter totals and site totals of all sites and months.

    The hourly inputs and the row formulas are stored once, as every later table reads
    them again; raw interval data is therefore scanned a single time.
    """
    site_hours, inverter_hours = materialize(site_hours), materialize(inverter_hours)
    rows = materialize(report_rows(site_hours, inverter_hours, meta))
    totals = materialize(inverter_totals(rows, inverter_hours))
    return {
        "site_hours": site_hours,
        "inverter_hours": inverter_hours,
        "rows": rows,
        "inverters": totals,
        "sites": site_totals(rows, totals, overrides),
    }
