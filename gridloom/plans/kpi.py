"""Monthly KPIs: rules, loss breakdown, reconciliation and historical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import sum0
from gridloom.operators.timeaxis import resample

# Report metric to KPI column.
METRIC_COLUMNS = {
    "Insolation": "poa_insolation",
    "Possible Generation": "possible_generation",
    "Actual Generation": "inverter_generation",
    "Meter Generation": "meter_generation",
    "DC / System Health": "dc_health_loss",
    "Downtime": "downtime_loss",
    "Curtailment": "curtailment_non_compensable",
    "Inverter Availability": "inverter_availability",
}
# KPI columns in reporting order.
KPI_COLUMNS = [
    "reference_insolation",
    "poa_insolation",
    "ghi_insolation",
    "possible_generation",
    "inverter_generation",
    "meter_generation",
    "meter_generation_adjusted",
    "ac_module_loss",
    "tracker_loss",
    "soiling_loss",
    "dc_health_loss",
    "snow_derate_loss",
    "downtime_loss",
    "curtailment_compensable",
    "curtailment_non_compensable",
    "curtailment_total",
    "insurance_bi_adjustment",
    "inverter_availability",
]
LOSSES = ["soiling", "snow_derate", "dc_health", "ac_module", "downtime", "curtailment", "ac_line_losses"]
# Losses in the order in which they are given up.
CUT_ORDER = ["dc_health", "downtime", "soiling", "snow_derate", "ac_module", "curtailment"]


def kpis_from_summary(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metric rows to one KPI row per site and month; absent KPIs are null."""
    wide = summary.groupBy(*keys).pivot("metric", list(METRIC_COLUMNS)).agg(F.first("value"))
    for metric, column in METRIC_COLUMNS.items():
        wide = wide.withColumnRenamed(metric, column)
    missing = [c for c in KPI_COLUMNS if c not in wide.columns]
    wide = wide.withColumns({c: F.lit(None).cast("double") for c in missing})
    return wide.select(*keys, *KPI_COLUMNS)


def apply_rules(
    kpis: DataFrame,
    compensable: Column | None = None,
    gross_below_net: str = "net",
    insurance: DataFrame | None = None,
    snow: DataFrame | None = None,
    keys: Sequence[str] = ("site", "month"),
) -> DataFrame:
    """KPI rules.

    ``compensable`` marks sites whose curtailment is compensable altogether.  Gross below
    net generation becomes ``net``, ``missing`` or stays (``keep``).  ``insurance`` and
    ``snow`` give ``mwh`` per key; a zero claim is missing, absent snow loss is zero.
    """
    c = F.col
    swap = F.lit(False) if compensable is None else F.coalesce(compensable, F.lit(False))
    comp = F.when(swap, c("curtailment_non_compensable")).otherwise(c("curtailment_compensable"))
    non = F.when(~swap, c("curtailment_non_compensable"))
    below = c("inverter_generation") < c("meter_generation")
    replaced = {"net": c("meter_generation"), "missing": F.lit(None), "keep": c("inverter_generation")}
    out = kpis.withColumns({"curtailment_compensable": comp, "curtailment_non_compensable": non})
    out = out.withColumn(
        "curtailment_total", F.greatest("curtailment_compensable", "curtailment_non_compensable")
    )
    for column in ("dc_health_loss", "downtime_loss"):
        out = out.withColumn(column, F.when(c(column) < 0, 0.0).otherwise(c(column)))
    out = out.withColumn(
        "inverter_generation",
        F.when(below, replaced[gross_below_net]).otherwise(c("inverter_generation")),
    ).withColumn(
        "inverter_availability",
        F.when(c("inverter_availability") > 1, 1.0).otherwise(c("inverter_availability")),
    )
    for table, column in ((insurance, "insurance_bi_adjustment"), (snow, "snow_derate_loss")):
        if table is not None:
            given = table.groupBy(*keys).agg(F.sum("mwh").alias("_mwh"))
            out = out.join(given, list(keys), "left").withColumn(column, c("_mwh")).drop("_mwh")
    return out.withColumn(
        "insurance_bi_adjustment",
        F.when(c("insurance_bi_adjustment") != 0, c("insurance_bi_adjustment")),
    ).withColumn("snow_derate_loss", F.coalesce("snow_derate_loss", F.lit(0.0)))


def snow_losses(rows: DataFrame, keys: Sequence[str] = ("site", "month")) -> DataFrame:
    """Derate plus outage snow loss per site and month."""
    lost = [c for c in rows.columns if "lost_mwh" in c]
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in lost), F.lit(0.0))
    return rows.groupBy(*keys).agg(F.sum(total).alias("mwh"))


def breakdown(kpis: DataFrame, keys: Sequence[str] = ("site", "month"), calculated: str | None = None):
    """Generation, losses and adjustments of each KPI row.

    Module, soiling and snow losses are taken out of DC health (not below zero); a
    positive calculated curtailment replaces the reported one.
    """
    c = F.col
    dc = c("dc_health_loss") - c("soiling_loss") - c("ac_module_loss") - c("snow_derate_loss")
    curtailment = c("curtailment_total")
    if calculated is not None:
        curtailment = F.when(c(calculated) > 0, c(calculated)).otherwise(curtailment)
    return kpis.select(
        *keys,
        c("possible_generation").alias("possible"),
        c("inverter_generation").alias("inverter"),
        c("meter_generation").alias("meter"),
        c("soiling_loss").alias("soiling"),
        c("snow_derate_loss").alias("snow_derate"),
        F.when(dc < 0, 0.0).otherwise(dc).alias("dc_health"),
        c("ac_module_loss").alias("ac_module"),
        c("downtime_loss").alias("downtime"),
        curtailment.alias("curtailment"),
        (c("inverter_generation") - c("meter_generation")).alias("ac_line_losses"),
        F.coalesce("insurance_bi_adjustment", F.lit(0.0)).alias("insurance_bi"),
    )


def balance_gap() -> Column:
    """Possible minus losses and adjustments minus metered generation."""
    losses = sum((F.col(x) for x in LOSSES[1:]), F.col(LOSSES[0]))
    return F.col("possible") - losses - F.col("insurance_bi") - F.col("meter")


def validate(rows: DataFrame) -> DataFrame:
    return rows.withColumn("delta", balance_gap()).withColumn("valid", F.round("delta", 5) == 0)


def reconcile(rows: DataFrame) -> DataFrame:
    """Reduce over-estimated losses until the balance closes.

    Claims covered by insurance leave downtime first; then the losses are cut one after
    the other in the fixed order, each at most to zero.
    """
    over = balance_gap() < 0
    covered = over & (F.col("insurance_bi") > 0) & (F.col("downtime") > 0)
    rows = rows.withColumn(
        "downtime",
        F.when(covered, F.greatest(F.col("downtime") - F.col("insurance_bi"), F.lit(0.0))).otherwise(F.col("downtime")),
    )
    rows = rows.withColumn("_need", F.greatest(-balance_gap(), F.lit(0.0)))
    for loss in CUT_ORDER:
        cut = F.when(F.col(loss) > 0, F.least(F.col(loss), F.col("_need"))).otherwise(0.0)
        rows = rows.withColumn("_cut", F.coalesce(cut, F.lit(0.0)))
        rows = rows.withColumns({loss: F.col(loss) - F.col("_cut"), "_need": F.col("_need") - F.col("_cut")})
    return validate(rows.drop("_need", "_cut"))


# Waterfall steps in order; losses and adjustments count negative.
WATERFALL = [
    ("possible", "possible", 1),
    ("snow_derate_loss", "snow_derate", -1),
    ("soiling_loss", "soiling", -1),
    ("dc_health_loss", "dc_health", -1),
    ("module_loss", "ac_module", -1),
    ("downtime_loss", "downtime", -1),
    ("insurance_bi", "insurance_bi", -1),
    ("curtailment", "curtailment", -1),
    ("inverter", "inverter", 1),
    ("ac_line_losses", "ac_line_losses", -1),
    ("meter", "meter", 1),
]


def waterfall(rows: DataFrame, keys: Sequence[str] = ("site", "month")) -> DataFrame:
    """One signed row per waterfall step."""
    steps = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(name).alias("step"), (F.col(column) * sign).alias("value")
        )
        for i, (name, column, sign) in enumerate(WATERFALL)
    ]
    return rows.select(*keys, F.inline(F.array(*steps)))


def with_all_sites(kpis: DataFrame, sites: DataFrame, site: str = "site") -> DataFrame:
    """One row for every site of the fleet; sites without KPIs are blank."""
    return sites.select(site).distinct().join(kpis, site, "left")


def history(kpis: DataFrame, keys: Sequence[str], columns: Sequence[str], months: Sequence[str] | None = None, month="month"):
    """KPI rows by ``yyyy-MM`` month columns: all months that occur, or a wanted range of them."""
    labelled = kpis.withColumn("_m", F.date_format(month, "yyyy-MM"))
    if months is not None:
        labelled = labelled.filter(F.col("_m").isin(*months))
    long = labelled.unpivot([*keys, "_m"], list(columns), "kpi", "value")
    return long.groupBy(*keys, "kpi").pivot("_m", None if months is None else list(months)).agg(F.first("value"))


def performance_availability() -> Column:
    """Metered generation against the weather-adjusted budget.

    Missing figures count as zero; without a budget there is no result.
    """
    def v(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    credited = v("meter_generation") + v("snow_derate_loss") + v("insurance_bi_adjustment")
    curtailed = v("curtailment_total") - v("budget_curtailment")
    weather = F.try_divide(v("poa_insolation"), v("budget_poa")) * v("budget_production")
    return 1 + F.try_divide(credited + curtailed - weather, v("budget_production"))


def site_power_at(
    inverters: DataFrame, model: DataFrame, meter: DataFrame, seconds: int | None = None
) -> DataFrame:
    """:func:`site_power` at the native interval or as means of ``seconds`` (900, 3600, 86400).

    Means are taken of each series first, so series of different intervals fit together.
    """
    if seconds is None:
        return site_power(inverters, model, meter)

    def mean(df: DataFrame, keys: list[str], value: str) -> DataFrame:
        return resample(df, keys, seconds, [F.avg(value).alias(value)]).withColumnRenamed("bucket", "ts")

    return site_power(mean(inverters, ["site", "inv"], "kw"), mean(model, ["site", "inv"], "kw"), mean(meter, ["site"], "mw"))


def site_power(
    inverters: DataFrame, model: DataFrame, meter: DataFrame, on: Sequence[str] = ("site", "ts")
) -> DataFrame:
    """Site-level inverter total, possible and metered power (MW) side by side."""
    total = inverters.groupBy(*on).agg((sum0("kw") / 1e3).alias("inv_total_mw"))
    possible = model.groupBy(*on).agg((sum0("kw") / 1e3).alias("possible_mw"))
    return total.join(meter.select(*on, F.col("mw").alias("meter_mw")), list(on), "left").join(
        possible, list(on), "left"
    )
