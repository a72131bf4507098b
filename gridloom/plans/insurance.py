"""Insurance claims for long inverter outages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import short_year_date
from gridloom.operators.lookups import claim_days


def parse_outage_dates(log: DataFrame, columns: list[str]) -> DataFrame:
    """Read the two-format date columns of an outage log.

    Dates are month/day/year, with or without leading zeros, with a year of four or two
    digits; a time behind them is cut off.  Unreadable rows are dropped when a column has
    fewer than three of them; more raise an error when the plan runs.
    """
    for c in columns:
        text = F.trim(F.col(c))
        day = F.split(text, " ")[0]
        parsed = F.coalesce(
            F.when(day.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(day, F.lit("M/d/yyyy"))),
            F.when(day.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), short_year_date(day, "M/d/yy").cast("timestamp")),
            F.try_to_timestamp(text),
        ).cast("timestamp_ntz")
        log = log.withColumn(f"_{c}", parsed)
        log = log.withColumn(f"_bad_{c}", F.col(c).isNotNull() & F.col(f"_{c}").isNull())
    bad = log.agg(*[F.count_if(f"_bad_{c}").alias(c) for c in columns])
    worst = bad.select(F.greatest(*columns, F.lit(0))).scalar()
    guard = F.when(worst >= 3, F.raise_error(F.lit("too many unreadable dates")).cast("boolean")).otherwise(
        F.lit(True)
    )
    readable = F.lit(True)
    for c in columns:
        readable = readable & ~F.col(f"_bad_{c}")
    out = log.filter(guard & readable).withColumns({c: F.col(f"_{c}") for c in columns})
    return out.drop(*[f"_{c}" for c in columns], *[f"_bad_{c}" for c in columns])


def claims(
    outages: DataFrame, possible: DataFrame, fleet: DataFrame, start: Column, end: Column
) -> DataFrame:
    """Claimed energy per site for the period ``[start, end)``.

    ``possible`` has site and possible_mwh of the period, ``fleet`` site and n_inverters.
    Every site is listed; one without outages claims zero.
    """
    days = claim_days(outages, start, end).groupBy("site").agg(F.sum("outage_days").alias("outage_days"))
    n_days = F.datediff(F.to_date(end), F.to_date(start))
    rows = fleet.join(possible, "site", "left").join(days, "site", "left")
    per_day = F.try_divide(F.col("possible_mwh"), F.col("n_inverters") * n_days)
    return rows.select(
        "site",
        F.coalesce("outage_days", F.lit(0)).alias("outage_days"),
        per_day.alias("mwh_per_inverter_day"),
        F.coalesce(per_day * F.col("outage_days"), F.lit(0.0)).alias("claim_mwh"),
    )
