"""Inputs of the possible-power model: losses, temperature and combiner make-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import sized
from gridloom.functions.scalars import floor_time
from gridloom.operators.summaries import with_group

# Open-rack glass/polymer module temperature parameters.
TEMPERATURE_A = -3.56
TEMPERATURE_B = -0.075
MODULE_SLOTS = 6


def system_losses(meta: DataFrame, year: Column) -> DataFrame:
    """Array, DC and AC loss factors of each site for ``year``.

    ``meta``: cod_year, degradation, shading, soiling, quality, mismatch, lid, wiring (all
    in percent), dc_adjustment, ac_adjustment.
    """
    degradation = F.bround((100 - (year - F.col("cod_year")) * F.col("degradation")) / 100, 2)
    array = degradation
    for loss in ("shading", "soiling", "quality", "mismatch", "lid"):
        array = array * ((100 - F.col(loss)) / 100)
    return (
        meta.withColumn("array_factor", array)
        .withColumn("dc_factor", (100 - F.col("wiring")) / 100 * F.col("dc_adjustment"))
        .withColumn("ac_factor", F.col("ac_adjustment"))
    )


def model_weather(met: DataFrame, losses: DataFrame) -> DataFrame:
    """Effective irradiance and module temperature per site and time.

    ``met``: site, ts, poa, temp_air, wind_speed, module_temp.  Sites whose module
    temperature is missing in more than half of the rows use the temperature model.
    """
    measured = (F.avg(F.col("module_temp").isNull().cast("double")) <= 0.5).alias("_measured")
    modelled = F.col("poa") * F.exp(TEMPERATURE_A + TEMPERATURE_B * F.col("wind_speed")) + F.col("temp_air")
    factors = sized(losses.select("site", "array_factor", "dc_factor"))
    out = with_group(met, ["site"], measured).join(factors, "site")
    return (
        out.withColumn("effective_irradiance", F.col("poa") * F.col("array_factor") * F.col("dc_factor"))
        .withColumn("module_temp", F.when(F.col("_measured"), F.col("module_temp")).otherwise(modelled))
        .drop("_measured", "array_factor", "dc_factor")
    )


def combiner_modules(design: DataFrame, keys: Sequence[str] = ("site", "inv", "cmb")) -> DataFrame:
    """Modules, wattage, string length and (equivalent) string count of each combiner.

    ``design`` has up to six slots ``string_count_i``, ``string_length_i``,
    ``mod_wattage_i`` and the rated wattage ``stc``.  Mixed combiners use the mean string
    length cut to an integer and the string count that gives their total wattage.
    """
    slots = [
        F.struct(
            F.col(f"string_count_{i}").cast("double").alias("n"),
            F.col(f"string_length_{i}").cast("double").alias("len"),
            F.col(f"mod_wattage_{i}").cast("double").alias("watt"),
        )
        for i in range(1, MODULE_SLOTS + 1)
        if f"string_count_{i}" in design.columns
    ]
    rows = design.select(*keys, "stc", F.inline(F.array(*slots))).filter(
        F.coalesce("n", "len", "watt").isNotNull()
    )
    modules = F.col("len") * F.col("n")
    total = rows.groupBy(*keys).agg(
        F.count("*").alias("n_slots"),
        F.sum(modules).alias("n_modules"),
        F.sum(F.col("watt") * modules).alias("wattage"),
        F.avg("len").alias("_len"),
        F.max("len").alias("_only_len"),
        F.max("n").alias("_only_n"),
        F.max("stc").alias("stc"),
    )
    mixed = F.col("n_slots") > 1
    length = F.when(mixed, F.col("_len")).otherwise(F.col("_only_len")).cast("int")
    strings = F.when(
        mixed, F.try_divide(F.col("wattage"), F.col("stc") * length).cast("int")
    ).otherwise(F.col("_only_n").cast("int"))
    return (
        total.withColumn("string_length", length)
        .withColumn("string_count", strings)
        .drop("_len", "_only_len", "_only_n", "stc")
    )


def poa_minutes_filled(met: DataFrame) -> DataFrame:
    """Minutes per hour whose irradiance was filled (mean of the all-bad flag times 60)."""
    return met.groupBy("site", floor_time("hour", "ts").alias("ts")).agg(
        F.avg("poa").alias("poa"), (F.avg("poa_all_bad") * 60).alias("poa_minutes_filled")
    )


def possible_vs_actual_hourly(merged: DataFrame) -> DataFrame:
    """Site totals of modelled and measured power per hour (kW)."""
    per_inv = merged.groupBy("site", "inv", floor_time("hour", "ts").alias("ts")).agg(
        F.avg("possible_kw").alias("p"), F.avg("actual_kw").alias("a")
    )
    return per_inv.groupBy("site", "ts").agg(
        F.coalesce(F.sum("p"), F.lit(0.0)).alias("total_possible"),
        F.coalesce(F.sum("a"), F.lit(0.0)).alias("total_actual"),
    )
