"""Weather sensor cleaning and backfill from reference weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import clip, floor_time
from gridloom.operators.naming import met_type
from gridloom.operators.quality import clear_days, negative_check, sensor_scores
from gridloom.operators.summaries import month_hour_profile

# Reference column that fills each sensor type; module temperature is
# filled from its own month by hour profile.
FILL_COLUMNS = {
    "poa": "poa_global",
    "ghi": "ghi",
    "amb_temp": "temp_air",
    "wind": "wind_speed",
}
SCORED_TYPES = {"poa": "poa_global", "ghi": "ghi"}


def typed_sensors(readings: DataFrame) -> DataFrame:
    """Weather readings with their sensor type; other attributes are left out."""
    return readings.withColumn("sensor_type", met_type(F.col("attribute"))).filter(
        F.col("sensor_type").isNotNull()
    )


def irradiance_scores(
    sensors: DataFrame, weather: DataFrame, site_keys: Sequence[str], n_clear: int, max_gap: float
) -> DataFrame:
    """Scores of the irradiance sensors on the best clear days of their site."""
    keys = list(site_keys)
    days = clear_days(weather, keys, "ghi_clearsky", "ghi", n_clear)
    wide = [F.struct(F.lit(k).alias("sensor_type"), F.col(c).alias("ref")) for k, c in SCORED_TYPES.items()]
    ref = weather.select(*keys, "ts", F.explode(F.array(*wide)).alias("_r")).select(*keys, "ts", "_r.*")
    hourly = (
        sensors.filter(F.col("sensor_type").isin(*SCORED_TYPES))
        .groupBy(*keys, "sensor_type", "attribute", floor_time("hour", "ts").alias("ts"))
        .agg(F.avg(clip("value", 0.0, 1500.0)).alias("value"))
    )
    typed = [*keys, "sensor_type"]
    kinds = F.explode(F.array(*[F.lit(k) for k in SCORED_TYPES])).alias("sensor_type")
    scored_days = days.select(*keys, "date", kinds)
    return sensor_scores(hourly, ref, scored_days, typed, max_gap=max_gap)


def backfill(
    readings: DataFrame,
    weather: DataFrame,
    site_keys: Sequence[str],
    n_clear: int = 5,
    max_gap: float = 0.1,
    from_profile: bool = False,
    materialize=cut_lineage,
) -> DataFrame:
    """One gap-free weather value per site, time stamp and sensor type.

    Bad irradiance sensors are removed, the remaining sensors cleaned and averaged.  Where
    every sensor of a type is bad the value comes from the reference weather of that hour,
    or from the sensors' month by hour profile (always with ``from_profile``).  Types
    without any sensor are taken from the reference alone.  Sites all of whose sensors are
    bad drop out.
    """
    keys = list(site_keys)
    sensors = typed_sensors(readings)
    scores = irradiance_scores(sensors, weather, keys, n_clear, max_gap)
    removed = sized(scores.filter("bad").select(*keys, "attribute"))
    kept = sensors.join(removed, [*keys, "attribute"], "left_anti")
    cleaned = negative_check(kept)
    averaged = materialize(
        cleaned.groupBy(*keys, "ts", "sensor_type").agg(
            F.avg("cleaned").alias("average"), F.min("bad").alias("all_bad")
        )
    )
    present = averaged.select(*keys, "sensor_type").distinct()
    # types without a sensor get one row per time stamp of the site, filled further down
    stamps = averaged.select(*keys, "ts").distinct()
    kinds = F.explode(F.array(*[F.lit(k) for k in FILL_COLUMNS])).alias("sensor_type")
    absent = (
        stamps.select("*", kinds)
        .join(present, [*keys, "sensor_type"], "left_anti")
        .withColumn("average", F.lit(None).cast("double"))
        .withColumn("all_bad", F.lit(1))
    )
    profile = sized(month_hour_profile(averaged, [*keys, "sensor_type"], "average"))
    rows = (
        averaged.unionByName(absent)
        .withColumn("month", F.month("ts"))
        .withColumn("hour", F.hour("ts"))
        .join(profile, [*keys, "sensor_type", "month", "hour"], "left")
        .withColumn("_hour", floor_time("hour", "ts"))
    )
    fills = weather.select(*keys, F.col("ts").alias("_hour"), *FILL_COLUMNS.values())
    rows = rows.join(fills, [*keys, "_hour"], "left")
    fill = F.col("profile")
    if not from_profile:
        for kind, column in FILL_COLUMNS.items():
            fill = F.when(F.col("sensor_type") == kind, F.col(column)).otherwise(fill)
    return (
        rows.withColumn("fill", fill)
        .withColumn("processed", F.when(F.col("all_bad") == 0, F.col("average")).otherwise(F.col("fill")))
        .withColumn("filled", ~F.col("average").eqNullSafe(F.col("processed")))
        .select(*keys, "ts", "sensor_type", "average", "all_bad", "profile", "processed", "filled")
    )


def change_log(
    readings: DataFrame, weather: DataFrame, site_keys: Sequence[str], n_clear=5, max_gap=0.1,
    materialize=cut_lineage,
) -> DataFrame:
    """Audit rows: removed sensors, negative and out-of-limit counts, filled rows."""
    keys = list(site_keys)
    sensors = typed_sensors(readings)
    scores = materialize(irradiance_scores(sensors, weather, keys, n_clear, max_gap).filter("bad"))
    removed = scores.select(
        *keys, F.col("attribute").alias("item"), F.lit("removed_columns").alias("rule"), F.lit(1).cast("bigint").alias("n")
    )
    kept = negative_check(sensors.join(scores, [*keys, "attribute"], "left_anti"))
    counts = kept.groupBy(*keys, F.col("attribute").alias("item")).agg(
        F.count_if("negative").alias("negative"),
        F.count_if("above").alias("above"),
        F.count_if("below").alias("below"),
    )
    outliers = counts.unpivot([*keys, "item"], ["negative", "above", "below"], "rule", "n").filter("n > 0")
    filled = (
        backfill(readings, weather, keys, n_clear, max_gap)
        .filter("filled")
        .groupBy(*keys, F.col("sensor_type").alias("item"))
        .agg(F.count("*").alias("n"))
        .withColumn("rule", F.lit("backfilled_data"))
    )
    return removed.unionByName(outliers).unionByName(filled)


def poa_comparison(readings: DataFrame, weather: DataFrame, site_keys: Sequence[str]) -> DataFrame:
    """Plane-of-array sensors beside their mean, month by hour profile and the reference."""
    keys = list(site_keys)
    poa = typed_sensors(readings).filter("sensor_type = 'poa'")
    mean = poa.groupBy(*keys, "ts").agg(F.avg("value").alias("mean"))
    profile = sized(month_hour_profile(mean, keys, "mean"))
    out = (
        poa.select(*keys, "attribute", "ts", "value")
        .join(mean, [*keys, "ts"])
        .withColumn("month", F.month("ts"))
        .withColumn("hour", F.hour("ts"))
        .join(profile, [*keys, "month", "hour"], "left")
        .withColumn("_hour", floor_time("hour", "ts"))
    )
    ref = weather.select(*keys, F.col("ts").alias("_hour"), "poa_global")
    return out.join(ref, [*keys, "_hour"], "left").drop("_hour", "month", "hour")
