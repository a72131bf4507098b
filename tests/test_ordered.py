"""Chunked order-dependent operators against plain windows."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.core.ordered import FIT_UNITS, fit_series, global_position, islands, ordinal, rolling, runs, scan, series
from tests.helpers import rows, ts
import datetime as dt


@pytest.fixture(scope="module")
def hot(spark):
    """One series holds most of the rows; gaps, nulls and a single-row series included."""
    rng = random.Random(7)
    data, t0 = [], ts("2024-01-01T00:00:00")
    for key, n in (("hot", 900), ("b", 150), ("c", 1)):
        t = t0
        for i in range(n):
            t += dt.timedelta(seconds=rng.choice([5, 30, 60, 60, 7200]))
            data.append((key, t, len(data), rng.choice([None, 1.0, 2.0, 5.0, 5.0])))
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, event_id bigint, value double").cache()


@pytest.mark.parametrize("chunk", ["second", "hour", "day", "year"])
def test_scan_equals_plain_windows(hot, chunk):
    by = series(["k"], ["ts", "event_id"], chunk)
    got = scan(
        hot, by, lead={"nxt": "value", "nts": "ts"}, lag={"prv": "value"}, fill={"ff": "value"},
        total={"run": F.when(F.col("value") > 1, F.lit(1))},
    )
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select(
        "*", F.lead("value").over(w).alias("nxt"), F.lead("ts").over(w).alias("nts"), F.lag("value").over(w).alias("prv"),
        F.last("value", True).over(upto).alias("ff"),
        F.coalesce(F.sum(F.when(F.col("value") > 1, 1)).over(upto), F.lit(0)).alias("run"),
    )
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("block", [10, 64, 5000])
def test_rolling_equals_plain_window(hot, block):
    by = series(["k"], ["ts", "event_id"], "hour")

    def build(df, w):
        frame = w.rowsBetween(-3, 4)
        return df.withColumn("m", F.avg("value").over(frame)).withColumn("n", F.count("value").over(frame))

    got = rolling(hot, by, 3, 4, build, block_rows=block)
    frame = Window.partitionBy("k").orderBy("ts", "event_id").rowsBetween(-3, 4)
    want = hot.select("*", F.avg("value").over(frame).alias("m"), F.count("value").over(frame).alias("n"))
    assert rows(got, *want.columns) == rows(want)


def test_rolling_rejects_a_halo_as_wide_as_a_block(hot):
    with pytest.raises(ValueError):
        rolling(hot, series(["k"], ["ts"], "day"), 10, 0, lambda d, w: d, block_rows=10)


def test_ordinal_counts_every_row_once(hot):
    got = ordinal(hot, series(["k"], ["ts", "event_id"], "minute"))
    assert rows(got.groupBy("k").agg(F.count("*"), F.count_distinct("_ordinal"), F.max("_ordinal"))) == [
        ("b", 150, 150, 150), ("c", 1, 1, 1), ("hot", 900, 900, 900)
    ]


def test_runs_cover_exactly_the_condition_rows(hot):
    by = series(["k"], ["ts", "event_id"], "hour")
    found = runs(hot, by, F.col("value") >= 2, [F.count("*").alias("n"), F.min("value").alias("low")])
    assert found.agg(F.sum("n")).first()[0] == hot.filter("value >= 2").count()
    assert found.filter("low < 2").count() == 0


def test_unknown_rows_neither_join_nor_split_an_island(spark):
    data = [(i, v) for i, v in enumerate([1.0, None, 1.0, -1.0, 1.0])]
    df = spark.createDataFrame(data, "pos bigint, x double").withColumn("k", F.lit("a"))
    by = series(["k"], ["pos"], 2)
    numbered = islands(df, by, F.col("x") < 0)
    assert [r.island for r in numbered.orderBy("pos").collect()] == [0, 0, 0, 1, 1]


def test_fit_series_cuts_dense_series_finer(hot):
    assert fit_series(hot, ["k"], ["ts"], rows_per_chunk=10_000).units is None
    finer = fit_series(hot, ["k"], ["ts"], rows_per_chunk=3).units.collect()
    assert finer and all(FIT_UNITS.index(r._unit) > 0 for r in finer)


@pytest.mark.parametrize("chunk", ["second", "day"])
def test_deep_edges_equal_plain_windows(hot, chunk):
    by = replace(series(["k"], ["ts", "event_id"], chunk), deep=True)
    got = scan(hot, by, lead={"nxt": "value"}, lag={"prv": "value"}, fill={"ff": "value"}, total={"n": F.lit(1)})
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select(
        "*", F.lead("value").over(w).alias("nxt"), F.lag("value").over(w).alias("prv"), F.last("value", True).over(upto).alias("ff"),
        F.count("*").over(upto).alias("n"),
    )
    assert rows(got, *want.columns) == rows(want)


def test_each_series_gets_its_own_unit(spark):
    data = [("hot", ts("2024-01-01T00:00:00") + dt.timedelta(seconds=i), i) for i in range(900)]
    data += [(k, ts("2024-01-01T00:00:00") + dt.timedelta(hours=i), i) for k in "abcde" for i in range(20)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, event_id bigint")
    by = fit_series(df, ["k"], ["ts", "event_id"], rows_per_chunk=100, many_chunks=10)
    assert {r.k: r._unit for r in by.units.collect()} == {"hot": "minute"} and by.deep
    sizes = by.chunked(df).groupBy("k", "_chunk").count().collect()
    assert max(r["count"] for r in sizes) <= 100 and sum(r.k == "a" for r in sizes) == 1
    assert [r.n for r in ordinal(df.filter("k = 'hot'"), by, "n").orderBy("ts").collect()] == list(range(1, 901))
    # the edges of the hot series are chunked too
    assert by.of_chunks().chunk == "month" and not fit_series(df, ["k"], ["ts"], 1000).deep


def test_equal_stamps_that_fill_a_chunk_are_an_error(spark):
    df = spark.createDataFrame([("a", ts("2024-01-01T00:00:00"), i) for i in range(50)], "k string, ts timestamp_ntz, event_id bigint")
    with pytest.raises(ValueError, match="share one time stamp"):
        fit_series(df, ["k"], ["ts"], rows_per_chunk=49)


def test_global_position(spark):
    rng = random.Random(2)
    data = [(rng.choice("aab"), rng.randint(0, 300), i) for i in range(2000)]
    df = spark.createDataFrame(data, "letters string, digits int, i int").repartition(5)
    got = [r.position for r in global_position(df, ["letters", "digits", "i"], "position").orderBy("letters", "digits", "i").collect()]
    assert got == list(range(1, 2001))
