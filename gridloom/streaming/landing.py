"""Pick up only new interval files and store them by site and month.

The batch form of this rule is :func:`gridloom.sources.files.new_groups`.  Here the file
source remembers which files it has read, so a scheduled run with the available-now
trigger processes just the files that arrived since the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.timeaxis import dedupe_first

READING_SCHEMA = "site string, asset string, attribute string, ts timestamp_ntz, value double"


def land_readings(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = READING_SCHEMA
) -> StreamingQuery:
    """Append the readings of new CSV files to ``target`` partitioned by month and site.

    ``checkpoint`` must be a shared folder.  Copies inside one batch are dropped (first
    file wins); each batch is written with its id, so a repeated batch replaces itself.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("header", "true")
        .csv(source)
        .withColumn("file", F.col("_metadata.file_path"))
        .withColumn("month", F.date_format("ts", "yyyy-MM"))
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        first = dedupe_first(batch, ["site", "asset", "attribute", "ts"], ["file"])
        (
            first.withColumn("batch", F.lit(batch_id))
            .hint("rebalance", "batch", "month", "site")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch", "month", "site")
            .parquet(target)
        )

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
