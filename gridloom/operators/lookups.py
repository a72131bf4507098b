"""Joins, presence checks, precedence rules and upserts between tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, ordinal, scan
from gridloom.core.session import sized
from gridloom.functions.scalars import seconds_between
from gridloom.functions.text import containing


def clamped_rate(
    wanted: DataFrame, rates: DataFrame, site="site", month="month", rate="rate", default=0.0
) -> DataFrame:
    """Rate of a site and month; months after the last one use the last, unknown sites the default."""
    rates = sized(rates)
    last = rates.agg(F.max(month).alias("_last")).scalar()
    priced = rates.select(site, F.col(month).alias("_month"), F.col(rate).alias("_rate"))
    out = wanted.withColumn("_month", F.least(F.col(month), last)).join(priced, [site, "_month"], "left")
    return out.withColumn(rate, F.coalesce("_rate", F.lit(default))).drop("_month", "_rate")


def unpivot_months(matrix: DataFrame, site="site") -> DataFrame:
    """Site by month matrix to rows."""
    months = [c for c in matrix.columns if c != site]
    return matrix.unpivot([site], months, "month", "rate")


def asof_value(
    left: DataFrame, right: DataFrame, by: Series, value: str, name: str, tie: str
) -> DataFrame:
    """Latest ``right`` value at or before each ``left`` row.

    Both sides are laid in one series and the value is filled forward, so no row is
    compared with more than its neighbours.  ``tie`` orders equal time stamps; right rows
    come first.
    """
    keys, ts = list(by.keys), by.order[0]
    a = left.withColumn("_side", F.lit(1)).withColumn(name, F.lit(None).cast("double"))
    b = right.select(*keys, ts, tie, F.col(value).cast("double").alias(name)).withColumn("_side", F.lit(0))
    lined = a.unionByName(b, allowMissingColumns=True)
    track = replace(by, order=(ts, "_side", tie))
    return scan(lined, track, fill={name: name}).filter("_side = 1").drop("_side")


def overlap_clip(
    events: DataFrame, windows: DataFrame, on: Sequence[str], start="event_start", end="event_end"
) -> DataFrame:
    """Events overlapping their group's search window, clipped to it.

    ``windows`` has one row per group with ``range_start`` and ``range_end``.  Events at
    least as long as the whole range once clipped are dropped.
    """
    out = events.join(sized(windows), list(on)).filter(
        (F.col(start) < F.col("range_end")) & (F.col(end) > F.col("range_start"))
    )
    out = (
        out.withColumn("existing_event", F.col(start) < F.col("range_start"))
        .withColumn("ongoing_event", F.col(end) > F.col("range_end"))
        .withColumn("effective_start", F.greatest(start, "range_start"))
        .withColumn("effective_end", F.least(end, "range_end"))
        .withColumn("effective_seconds", seconds_between("effective_start", "effective_end"))
    )
    return out.filter(
        F.col("effective_seconds") < seconds_between("range_start", "range_end")
    ).drop("range_start", "range_end")


def claim_days(outages: DataFrame, start: Column, end: Column) -> DataFrame:
    """Days an outage may be claimed for in ``[start, end)``.

    A claim starts one month after the outage and runs to the (rounded up) restoration or
    the last day of the period.  Only outages that began before the period count.
    """
    first, last = F.to_date(start), F.date_add(F.to_date(end), -1)
    offline = F.to_date("date_offline")
    restored = F.to_date("date_restored")
    whole = F.col("date_restored") == restored.cast("timestamp_ntz")
    claim_end = F.when(whole, restored).otherwise(F.date_add(restored, 1))
    claim_end = F.coalesce(claim_end, last)
    days = F.datediff(F.least(claim_end, last), F.greatest(F.add_months(offline, 1), first)) + 1
    return (
        outages.filter(
            (F.col("date_restored").isNull() | (F.col("date_restored") >= start))
            & (F.col("date_offline") < start)
        )
        .withColumn("n_claim_days", F.greatest(days, F.lit(0)))
        .withColumn("outage_days", F.col("n_claim_days") * F.col("n_inv"))
    )


def presence(wanted: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """Split wanted items into found and missing."""
    have = stored.select(*on).distinct().withColumn("found", F.lit(True))
    return wanted.select(*on).distinct().join(have, list(on), "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def latest_wins(df: DataFrame, item: Sequence[str], rank: Sequence[str], source: str) -> DataFrame:
    """Rows of each item from the latest source that holds it."""
    best = sized(df.groupBy(*item).agg(F.max_by(source, F.struct(*rank, source)).alias(source)))
    return df.join(best, [*item, source], "left_semi")


def insert_missing(existing: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Existing rows plus the new rows whose key is not stored yet."""
    added = new.join(existing.select(*on).distinct(), list(on), "left_anti")
    return existing.unionByName(added)


def replace_keys(existing: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """New rows replace every existing row of the same key."""
    kept = existing.join(new.select(*on).distinct(), list(on), "left_anti")
    return kept.unionByName(new)


def fill_cells(
    target: DataFrame, new: DataFrame, on: Sequence[str], columns: Sequence[str], overwrite=False
) -> DataFrame:
    """Write new values into empty target cells; nulls are never written.

    ``action`` tells per row whether a cell was ``filled``, ``replaced`` or ``kept``.
    """
    fresh = new.select(*on, *[F.col(c).alias(f"_n_{c}") for c in columns])
    out = target.join(fresh, list(on), "left")
    filled, replaced = F.lit(False), F.lit(False)
    values = {}
    for c in columns:
        old, inc = F.col(c), F.col(f"_n_{c}")
        filled = filled | (old.isNull() & inc.isNotNull())
        if overwrite:
            replaced = replaced | F.coalesce(old != inc, F.lit(False))
        values[c] = F.coalesce(inc, old) if overwrite else F.coalesce(old, inc)
    action = F.when(replaced, "replaced").when(filled, "filled").otherwise("kept")
    return out.withColumn("action", action).withColumns(values).drop(*[f"_n_{c}" for c in columns])


def copy_status(source: DataFrame, target: DataFrame, on: Sequence[str], overwrite: bool) -> DataFrame:
    """What a copy does per item: no_data, copied_data, replaced_data or already_exists."""
    s = source.select(*on).distinct().withColumn("_s", F.lit(True))
    t = target.select(*on).distinct().withColumn("_t", F.lit(True))
    status = (
        F.when(F.col("_s").isNull(), "no_data")
        .when(F.col("_t").isNull(), "copied_data")
        .when(F.lit(overwrite), "replaced_data")
        .otherwise("already_exists")
    )
    return s.join(t, list(on), "full").withColumn("status", status).drop("_s", "_t")


def tracker_rows(
    tracker: DataFrame, sites: DataFrame, periods: DataFrame, site="site", period=("year", "month")
) -> DataFrame:
    """Tracker rows of the chosen sites and periods, ordered by site, latest period first."""
    chosen = tracker.join(sites.select(site).distinct(), site, "left_semi").join(
        periods.select(*period).distinct(), list(period), "left_semi"
    )
    return chosen.orderBy(F.col(site), *[F.col(p).desc() for p in period])


def join_budget(kpis: DataFrame, budget: DataFrame, on: str = "project") -> DataFrame:
    """KPI rows with their budget columns, sorted by project regardless of case."""
    return kpis.join(budget, on, "left").orderBy(F.lower(on), F.col(on))


def fill_zero(df: DataFrame, source: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Replace zero cells by the value of another table."""
    other = source.select(*on, F.col(column).alias("_v"))
    return (
        df.join(other, list(on), "left")
        .withColumn(column, F.when(F.col(column) == 0, F.col("_v")).otherwise(F.col(column)))
        .drop("_v")
    )


def compare_meters(
    plant: DataFrame, inverters: DataFrame, utility: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Plant meter, inverter sum and utility meter side by side with differences."""
    out = plant.join(inverters, list(on), "full").join(utility, list(on), "full")
    return out.withColumn("inv_minus_plant", F.col("inv_mwh") - F.col("plant_mwh")).withColumn(
        "plant_minus_utility", F.col("plant_mwh") - F.col("utility_mwh")
    )


def even_chunks(df: DataFrame, by: Series, n_chunks: int, name: str = "chunk") -> DataFrame:
    """Cut each group's ordered items into ``n_chunks`` equally sized consecutive chunks."""
    sizes = sized(df.groupBy(*by.keys).agg(F.count("*").alias("_all")))
    placed = ordinal(df, by).join(sizes, list(by.keys))
    width = F.ceil(F.col("_all") / F.lit(n_chunks))
    return placed.withColumn(name, F.floor((F.col("_ordinal") - 1) / width) + 1).drop("_ordinal", "_all")


def longest_word_match(items: DataFrame, tables: DataFrame, item="site", table="table_name") -> DataFrame:
    """Pick for each item the one table whose name contains the item's longest word.

    Of equally long words the last counts.  Items without exactly one match get null.
    The names are looked up by an index of short runs of letters (:func:`containing`) instead
    of comparing every word with every name.
    """
    words = F.filter(
        F.split(F.replace(F.col(item), F.lit("-"), F.lit(" ")), r"\s+"), lambda w: w != ""
    )
    ranked = F.transform(
        words, lambda w, i: F.struct(F.length(w).alias("n"), i.alias("i"), w.alias("w"))
    )
    keyed = sized(items.select(item, F.array_max(ranked)["w"].alias("_word")))
    words = keyed.select("_word").distinct()
    named = containing(tables.select(table).distinct(), table, words, "_word")
    hits = keyed.join(named, "_word").groupBy(item).agg(
        F.count_distinct(table).alias("_n"), F.min(table).alias("_hit")
    )
    return items.select(item).join(hits, item, "left").select(
        item, F.when(F.col("_n") == 1, F.col("_hit")).alias(table)
    )
