"""Event detection: offline, excursion and category summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, runs, scan
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import add_time, seconds_between, sum0
from gridloom.operators.lists import PART_ITEMS, join_null_safe, list_parts
from gridloom.operators.lookups import asof_value


def lost_power(
    df: DataFrame, on: Sequence[str], n_assets: str, online: str, solar: bool, poa: str | None = None,
    actual="actual_kw", possible="possible_kw",
) -> DataFrame:
    """Site power, lost power and number of assets offline per hour.

    Powers are given in kW per asset row set and summed to MW.  For solar sites hours
    with weak sun or nothing possible count as fully online.
    """
    site = df.groupBy(*on).agg(
        (sum0(actual) / 1e3).alias("actual_mw"),
        (sum0(possible) / 1e3).alias("possible_mw"),
        F.max(n_assets).alias("n_assets"),
        F.max(online).alias("online"),
        *([F.max(poa).alias("poa")] if poa else []),
    )
    offline = F.floor(F.col("n_assets") - F.col("online"))
    if solar:
        weak = F.col("possible_mw") <= 0
        if poa:
            weak = F.coalesce(F.col("poa") < 250, F.lit(False)) | weak
        offline = F.when(weak, 0).otherwise(offline)
    lost = F.greatest(F.col("possible_mw") - F.col("actual_mw"), F.lit(0.0))
    return site.withColumn("lost_mw", lost).withColumn("n_offline", offline)


def offline_events(df: DataFrame, by: Series, threshold: Column | int, ts: str = "ts") -> DataFrame:
    """Runs of hours with at least ``threshold`` assets offline.

    The end is one hour after the last row; hours are total hours.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    found = runs(
        df, by, F.col("n_offline") >= limit,
        [
            F.min(ts).alias("event_start"),
            add_time(F.max(ts), 1, "hour").alias("event_end"),
            F.avg("n_offline").alias("n_offline"),
            F.round(sum0("lost_mw"), 0).cast("bigint").alias("lost_mwh"),
        ],
        F.col("n_offline") < limit,
    )
    hours = seconds_between("event_start", "event_end") / F.lit(3600.0)
    return found.withColumn("event_hours", hours).drop("island")


def rescale_by_max(
    df: DataFrame, keys: Sequence[str], value: str, limit: float,
    change: Callable[[Column], Column], above: bool = True,
) -> DataFrame:
    """Apply ``change`` to a series whose maximum is above (or below) ``limit``."""
    peak = sized(df.groupBy(*keys).agg(F.max(value).alias("_peak")))
    hit = F.col("_peak") > limit if above else F.col("_peak") < limit
    out = df.join(peak, list(keys))
    return out.withColumn(
        value, F.when(F.coalesce(hit, F.lit(False)), change(F.col(value))).otherwise(F.col(value))
    ).drop("_peak")


def voltage_excursions(
    measured: DataFrame, target: DataFrame, by: Series, tie: str, band: float = 4.0,
    value="value", ts="ts", materialize=cut_lineage,
) -> DataFrame:
    """Runs in which the measured voltage leaves the band around the latest target.

    A recorded value holds until one second before the next one of its series, so a run
    ends there.  The paired values are stored, as finding the runs reads them twice.
    """
    m = rescale_by_max(measured, by.keys, value, 1e3, lambda v: v / 10)
    t = rescale_by_max(target, by.keys, value, 1e3, lambda v: v / 10)
    paired = asof_value(m, t, by, value, "target", tie).withColumn(
        "delta", F.col(value) - F.col("target")
    )
    order = [c for c in by.order if c not in by.keys]
    joined = materialize(scan(paired.select(*by.keys, *order, "target", "delta"), by, lead={"_next": ts}))
    until = F.greatest(F.coalesce(add_time("_next", -1), F.col(ts)), F.col(ts))
    position = F.struct(*by.order)
    found = runs(
        joined, by, F.abs("delta") > band,
        [
            F.min(ts).alias("start_time"),
            F.min_by("target", position).alias("start_setpoint"),
            F.max(until).alias("end_time"),
            F.max_by("target", position).alias("end_setpoint"),
            F.max("delta").alias("max_delta"),
            F.min("delta").alias("min_delta"),
        ],
    )
    minutes = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / F.lit(6e7)
    return found.withColumn("minutes", minutes).drop("island")


def category_summary(
    events: DataFrame, site="site", category="category", asset="primary_element", seconds="duration_s", part_items=PART_ITEMS
) -> DataFrame:
    """Events, assets and time per site and category, with the list of assets.

    A long list has several rows, told apart by ``part``; the figures stand in each.
    """
    per_asset = cut_lineage(
        events.groupBy(site, category, asset).agg(F.count("*").alias("_n"), F.sum(seconds).alias("_s"))
    )
    names = list_parts(per_asset, [site, category], asset, "asset_names", part_items)
    figures = per_asset.groupBy(site, category).agg(
        F.sum("_n").alias("n_events"),
        F.count(asset).alias("n_assets"),
        F.coalesce(F.sum("_s"), F.lit(0)).alias("total_seconds"),
        F.round(F.sum("_s") / 3600, 1).alias("approx_hours"),
    )
    return join_null_safe(figures, names, [site, category])
