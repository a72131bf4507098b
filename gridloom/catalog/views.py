"""How the star-schema tables stand in for telemetry tables.

``events`` are readings: the event type is the site, the user the asset and ``ts`` the
irregular time stamp.  ``lineitem`` rows are dated production rows, ``orders`` are outages
and claims, ``supplier``/``nation``/``region`` an asset hierarchy and ``part`` device
parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, fit_series
from gridloom.functions.scalars import nan_to_null

# Telemetry attribute each event type stands for.
ATTRIBUTES = {
    "click": "POA_1",
    "view": "GHI_1",
    "signup": "Wind_1",
    "error": "Mod_Temp_1",
    "purchase": "ActivePower_1",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """site, asset, ts, value, event_id, k (the JSON extra)."""
    return table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("site"),
        F.col("user_id").alias("asset"),
        "ts",
        nan_to_null("value").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def by_site(rows: DataFrame) -> Series:
    """The rows of a site in time order, in chunks of checked size."""
    return fit_series(rows, ["site"], ["ts", "event_id"])


def site_series(spark: SparkSession, sf: str) -> tuple[DataFrame, Series]:
    rows = readings(spark, sf)
    return rows, by_site(rows)


def attribute_readings(spark: SparkSession, sf: str) -> DataFrame:
    """site, attribute, ts, event_id, value with attribute names of the sensor classes."""
    mapping = F.create_map(*[F.lit(x) for kv in ATTRIBUTES.items() for x in kv])
    return readings(spark, sf).select(
        F.lit("plant").alias("site"),
        F.coalesce(mapping[F.col("site")], F.col("site")).alias("attribute"),  # other kinds keep their name
        "ts",
        "event_id",
        "value",
    )


READINGS_SQL = """readings AS (
  SELECT event_id, event_type AS site, user_id AS asset, ts,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

ATTRIBUTES_SQL = """attribute_readings AS (
  SELECT 'plant' AS site,
         CASE event_type WHEN 'click' THEN 'POA_1' WHEN 'view' THEN 'GHI_1'
              WHEN 'signup' THEN 'Wind_1' WHEN 'error' THEN 'Mod_Temp_1'
              WHEN 'purchase' THEN 'ActivePower_1' ELSE event_type END AS attribute,
         ts, event_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value
  FROM events)"""
