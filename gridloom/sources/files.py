"""File listings, versions, routing, and versioned sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.core.session import sized
from gridloom.functions.text import containing


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, name and modification time of the files below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified")
    )


def with_version(files: DataFrame) -> DataFrame:
    """Version of a data set file by its name: raw, cleaned or processed."""
    version = (
        F.when(F.col("name").contains("PROCESSED"), "processed")
        .when(F.col("name").contains("CLEANED"), "cleaned")
        .otherwise("raw")
    )
    return files.withColumn("version", version)


def latest_files(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The most recent file of each key."""
    order = F.struct("modified", "path")
    return files.groupBy(*keys).agg(F.max_by("path", order).alias("path"), F.max("modified").alias("modified"))


def stored_periods(readings: DataFrame, ts: str = "ts") -> DataFrame:
    """Sites and months that have data."""
    return readings.select("site", F.date_format(ts, "yyyyMM").alias("period")).distinct()


def route_files(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Site of each file by name pattern; more than one match is an error row.

    A pattern's parts between asterisks must all occur in the name.  ``patterns`` has
    site and pattern.  The longest part is looked up by an index of short runs of letters
    (:func:`containing`); the other parts are then tested on the hits only.
    """
    parts = F.filter(F.split("pattern", r"\*"), lambda p: p != "")
    anchor = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    keyed = sized(patterns.select("site", parts.alias("_parts"), anchor.alias("_piece")))
    hits = containing(files.select("path", "name"), "name", keyed, "_piece").filter(
        F.forall("_parts", lambda p: F.contains(F.col("name"), p))
    )
    matched = hits.select("path", "site").distinct().groupBy("path").agg(
        F.count("*").alias("n_matches"), F.min("site").alias("_site")
    )
    out = files.select("path", "name").join(matched, "path", "left")
    return out.select(
        "path", "name",
        F.when(F.col("n_matches") == 1, F.col("_site")).alias("site"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        (F.coalesce("n_matches", F.lit(0)) > 1).alias("error"),
    )


def write_version(df: DataFrame, path: str, run_ts: Column, partitions: Sequence[str] = ("site", "month")) -> None:
    """Append a new version of a data set; older versions stay.

    Rows are rebalanced by partition, so a large partition is written by several tasks.
    """
    stamped = df.withColumn("run_ts", run_ts).hint("rebalance", *partitions)
    stamped.write.mode("append").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str] = ("site", "month")) -> None:
    """Overwrite exactly the partitions ``df`` holds."""
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def latest_version(df: DataFrame, keys: Sequence[str] = ("site", "month")) -> DataFrame:
    """Rows of the newest version of each key."""
    newest = df.groupBy(*keys).agg(F.max("run_ts").alias("run_ts"))
    return df.join(newest, [*keys, "run_ts"], "left_semi")


def new_groups(incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = ("site", "group", "month")) -> DataFrame:
    """Rows whose group is not stored yet for the period."""
    return incoming.join(stored.select(*keys).distinct(), list(keys), "left_anti")
