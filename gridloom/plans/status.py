"""How far each site's monthly reporting has come and what is next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline_status(files: DataFrame, keys: Sequence[str] = ("site", "month")) -> DataFrame:
    """Status from the stored data sets (keys, group, version, draft).

    ``version`` is raw, cleaned, processed, model or report; ``draft`` marks a report made
    without the utility meter.
    """
    def has(version: str, group: str | None = None):
        hit = F.col("version") == version
        if group is not None:
            hit = hit & (F.col("group") == group)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    flags = files.groupBy(*keys).agg(
        has("raw", "met").alias("met_raw"),
        has("cleaned", "met").alias("met_cleaned"),
        has("processed", "met").alias("met_processed"),
        has("cleaned", "inverters").alias("inv_cleaned"),
        has("model").alias("model"),
        has("report").alias("report"),
        F.coalesce(F.bool_and(F.when(F.col("version") == "report", F.col("draft"))), F.lit(False)).alias("draft"),
    )
    model_step = (
        F.when(F.col("model"), F.lit(None))
        .when(F.col("met_processed"), "model")
        .when(F.col("met_cleaned"), "backfill")
        .when(F.col("met_raw"), "auto_qc")
        .otherwise("query")
    )
    next_step = (
        F.when(F.col("report") & F.col("draft"), "await utility meter")
        .when(F.col("report"), "nothing")
        .when(F.col("model") & F.col("inv_cleaned"), "report")
        .when(F.col("met_processed") & ~F.col("model"), "model")
        .when(F.col("met_cleaned") & ~F.col("met_processed"), "backfill")
        .otherwise("manual qc")
    )
    needs_qc = F.concat_ws(
        "+",
        F.when(~F.col("met_cleaned"), "met"),
        F.when(~F.col("inv_cleaned"), "inv"),
    )
    return (
        flags.withColumn("model_next", model_step)
        .withColumn("next_step", next_step)
        .withColumn("needs_qc", F.when(needs_qc != "", needs_qc))
    )
