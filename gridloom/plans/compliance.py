"""Outage compliance reporting: site eligibility, hours and monthly production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import floor_time, sum0
from gridloom.operators.events import lost_power

# Capacity limit (MW) by fleet and reference year.
CAPACITY_LIMITS = {
    "solar": {2024: 100.0, 2025: 20.0},
    "wind": {2024: 100.0, 2025: 75.0},
}
NIGHT_POA = 20.0


def eligible_sites(sites: DataFrame, years: DataFrame, limits: DataFrame) -> DataFrame:
    """Sites at or above the capacity limit of each year.

    ``limits`` has fleet, year and min_capacity; years outside it use the nearest known.
    ``years`` is joined through the fleet's year range, one row per site and year.
    """
    span = limits.groupBy("fleet").agg(F.min("year").alias("_lo"), F.max("year").alias("_hi"))
    wanted = years.select("year", "fleet")
    asked = wanted.join(span, "fleet").withColumn(
        "_ref", F.least(F.greatest(F.col("year"), F.col("_lo")), F.col("_hi"))
    )
    rules = asked.join(
        limits.select("fleet", F.col("year").alias("_ref"), "min_capacity"), ["fleet", "_ref"]
    ).select("fleet", "year", "min_capacity")
    return sites.join(rules, "fleet").filter(F.col("capacity") >= F.col("min_capacity"))


def capacity_limits(spark) -> DataFrame:
    rows = [(f, y, c) for f, years in CAPACITY_LIMITS.items() for y, c in years.items()]
    return spark.createDataFrame(rows, "fleet string, year int, min_capacity double")


def unit_hours(rows: DataFrame, inverter_hours: DataFrame, totals: DataFrame) -> DataFrame:
    """Unit-hour counts and bounded gross generation per site and month."""
    inv = inverter_hours.groupBy("site", floor_time("month", "ts").alias("month")).agg(
        F.count_if(F.col("avail_min") > 0).alias("sihd")
    )
    hours = rows.groupBy("site", "month").agg(
        F.count("*").alias("_rows"),
        F.max("n_inv").alias("n_inv"),
        F.count_if((F.col("curt_loss") > 0) & (F.col("meter_mwh") < 1)).alias("_idle"),
        F.count_if(F.col("poa") <= NIGHT_POA).alias("ruihn"),
        F.round(F.try_divide(sum0("meter_mwh"), F.sum("endci")), 2).alias("perf_ratio"),
    )
    c = F.col
    out = hours.join(inv, ["site", "month"]).join(
        totals.select("site", "month", c("actual").alias("_gross"), c("meter").alias("net")), ["site", "month"]
    )
    return (
        out.withColumn("rsih", c("_idle") * c("n_inv"))
        .withColumn("calendar_hours", c("_rows") * c("n_inv"))
        .withColumn("aih", c("calendar_hours"))
        .withColumn("foihd", c("aih") - c("sihd") - c("rsih") - c("ruihn"))
        .withColumn("asih", c("sihd") + c("rsih") + c("foihd"))
        .withColumn("gross", F.greatest(F.least("_gross", 1.15 * c("net")), c("net")))
        .drop("_rows", "_idle", "_gross")
    )


def production_hours(
    site_hours: DataFrame, asset_hours: DataFrame, sites: DataFrame, solar: bool
) -> DataFrame:
    """Hourly production table of eligible sites: actual, possible, lost power, assets offline.

    ``site_hours``: site, ts, online (and poa for solar); ``asset_hours``: site, asset, ts,
    actual_kw, possible_kw; ``sites``: site, n_assets.
    """
    power = asset_hours.groupBy("site", "ts").agg(
        sum0("actual_kw").alias("actual_kw"), sum0("possible_kw").alias("possible_kw")
    )
    joined = site_hours.join(power, ["site", "ts"], "left").join(sites, "site")
    return lost_power(joined, ["site", "ts"], "n_assets", "online", solar, "poa" if solar else None)
