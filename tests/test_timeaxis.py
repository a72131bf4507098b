import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.core.ordered import series
from gridloom.functions.scalars import bucket_start, ceil_time, clip, convert_unit, label_key, short_year_date
from gridloom.operators import timeaxis as ta
from tests.helpers import rows, series_df, ts

BY = series(["k"], ["ts"], "hour")


def test_spine_is_half_open_and_complete(spark):
    df = spark.createDataFrame([("a", ts("2024-01-01T00:00:00"), ts("2024-01-15T00:00:30"))], "k string, start timestamp_ntz, end timestamp_ntz")
    got = ta.spine(df, ["k"], 60).agg(F.count("*"), F.count_distinct("ts"), F.min("ts"), F.max("ts")).first()
    assert tuple(got) == (20161, 20161, ts("2024-01-01T00:00:00"), ts("2024-01-15T00:00:00"))


def test_reindex_adds_missing_and_drops_foreign_rows(spark):
    axis = spark.createDataFrame([("a", 1), ("a", 2)], "k string, t int")
    data = spark.createDataFrame([("a", 2, 5.0), ("a", 9, 7.0)], "k string, t int, v double")
    assert rows(ta.reindex(axis, data, ["k", "t"])) == [("a", 1, None), ("a", 2, 5.0)]


def test_dedupe_keeps_the_first_row_whole(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, None), ("a", 3, 4.0)], "k string, n int, v double")
    assert rows(ta.dedupe_first(df, ["k"], ["n"])) == [("a", 1, None)]


def test_upsample_ffill_matches_pandas(spark):
    pd = pytest.importorskip("pandas")
    stamps = ["2024-01-01T00:00:20", "2024-01-01T00:01:00", "2024-01-01T00:03:30", "2024-01-01T00:05:00"]
    df = spark.createDataFrame([("a", ts(t), float(i)) for i, t in enumerate(stamps)], "k string, ts timestamp_ntz, value double")
    got = {r.label: r.value for r in ta.upsample_ffill(df, BY, ["value"], 60).collect()}
    want = pd.Series([0.0, 1, 2, 3], index=pd.to_datetime(stamps)).resample("1min").ffill().dropna()
    assert got == {k.to_pydatetime(): v for k, v in want.items()}


def test_upsample_linear_hits_recorded_points(spark):
    df = spark.createDataFrame(
        [("a", ts("2024-01-01T00:00:00"), 0.0), ("a", ts("2024-01-01T01:00:00"), 60.0)], "k string, ts timestamp_ntz, value double"
    )
    got = ta.upsample_linear(df, BY, ["value"], 60)
    assert [r.value for r in got.orderBy("label").collect()] == [pytest.approx(i) for i in range(61)]


def test_recentre_and_last_hour(spark):
    got = ta.recentre_hourly(series_df(spark, [1, 3, 7, 4], step_s=3600, k="a"), ["k"], "value")
    assert [r.value for r in got.orderBy("ts").collect()] == [2.0, 5.0, 5.5, None]


def test_shift_fills_only_the_first_row(spark):
    df = series_df(spark, [5, None, 7], k="a")
    got = ta.shift_rows(df, series(["k"], ["event_id"], 2), "value")
    assert [r.value for r in got.orderBy("event_id").collect()] == [0.0, 5.0, None]


def test_beginning_labels(spark):
    data = [("f", i, t) for i, t in enumerate(["00:15", "23:45", "24:00", "00:15", "total line"])]
    df = spark.createDataFrame(data, "k string, n bigint, label string")
    got = ta.beginning_labels(df, series(["k"], ["n"], 2), "label")
    assert [r.label for r in got.orderBy("n").collect()] == ["00:00", "00:15", "23:45", "00:00", "00:15"]


def test_split_and_months(spark):
    df = spark.createDataFrame([(ts("2024-01-30T00:00:00"), ts("2024-03-01T00:00:00"))], "start timestamp_ntz, end timestamp_ntz")
    parts = rows(ta.split_range(df, 11), "range_start", "range_end")
    assert parts == [
        (ts("2024-01-30T00:00:00"), ts("2024-02-10T00:00:00")),
        (ts("2024-02-10T00:00:00"), ts("2024-02-21T00:00:00")),
        (ts("2024-02-21T00:00:00"), ts("2024-03-01T00:00:00")),
    ]
    assert rows(ta.months_in_range(df), "year", "month") == [(2024, 1), (2024, 2)]


def meter(spark, start, hours, values=None):
    t0 = ts(start)
    data = [("s", "America/Chicago", i, t0 + dt.timedelta(hours=h), float(values[i] if values else h + 1)) for i, h in enumerate(hours)]
    return spark.createDataFrame(data, "site string, tz string, row int, ts_local timestamp_ntz, mwh double")


def repaired(df):
    got = ta.repair_meter_hours(df, ["site"], "tz", "row").orderBy("instant").collect()
    return [(r.ts_local.hour, r.mwh) for r in got]


def test_clock_ordinary_day_keeps_24_hours(spark):
    assert repaired(meter(spark, "2024-06-01T00:00:00", range(24))) == [(h, h + 1.0) for h in range(24)]


def test_clock_autumn_25_rows_keep_both_passes(spark):
    hours = [0, 1, 1, *range(2, 24)]
    got = repaired(meter(spark, "2024-11-03T00:00:00", hours, range(25)))
    assert [h for h, _ in got] == hours
    assert [v for _, v in got] == [float(i) for i in range(25)]


def test_clock_autumn_24_rows_get_a_zero_second_pass(spark):
    got = repaired(meter(spark, "2024-11-03T00:00:00", range(24)))
    assert len(got) == 25
    assert got[1] == (1, 2.0) and got[2] == (1, 0.0)


def test_clock_spring_skipped_row_replaces_the_hour_before(spark):
    got = repaired(meter(spark, "2024-03-10T00:00:00", range(24)))
    assert len(got) == 23
    assert got[:3] == [(0, 1.0), (1, 3.0), (3, 4.0)]


def test_clock_spring_23_rows_stay(spark):
    hours = [0, 1, *range(3, 24)]
    assert [h for h, _ in repaired(meter(spark, "2024-03-10T00:00:00", hours))] == hours


def test_fixed_offset_and_standard_axis(spark):
    # recorded in standard time throughout: 02:30 exists in the file, not on the wall
    df = meter(spark, "2024-03-10T00:00:00", range(5))
    fixed = ta.localize_fixed_offset(df, ["site"], "tz")
    local = fixed.withColumn("l", ta.instant_to_local("instant", "tz")).orderBy("instant")
    assert [r.l.hour for r in local.collect()] == [0, 1, 3, 4, 5]
    wall = ta.standardize_local(fixed.drop("ts_local"), ["site"], "tz", 3600).orderBy("ts_local").collect()
    assert [(r.ts_local.hour, r.mwh) for r in wall] == [(0, 1.0), (1, 2.0), (2, None), (3, 3.0), (4, 4.0), (5, 5.0)]


def daylight(spark, days):
    data = [("a", dt.date.fromisoformat(d), d and ts(f"{d}T{x}"), ts(f"{d}T{y}")) if x else ("a", dt.date.fromisoformat(d), None, None) for d, x, y in days]
    return spark.createDataFrame(data, "site string, date date, dawn timestamp_ntz, dusk timestamp_ntz")


def test_daylight_borrows_from_neighbours_and_rounds(spark):
    lit = daylight(spark, [("2024-06-20", "05:10:31", "20:30:29"), ("2024-06-21", None, None), ("2024-06-24", "05:12:00", "20:31:00")])
    dates = spark.createDataFrame([("a", dt.date(2024, 6, d)) for d in (20, 21, 22, 23, 24)], "site string, date date")
    got = [(r.date.day, r.dawn and r.dawn.strftime("%d %H:%M"), r.dusk and r.dusk.strftime("%d %H:%M")) for r in ta.complete_daylight(dates, lit, ["site"]).orderBy("date").collect()]
    assert got == [
        (20, "20 05:11", "20 20:30"), (21, "21 05:11", "21 20:30"), (22, None, None), (23, "23 05:12", "23 20:31"), (24, "24 05:12", "24 20:31"),
    ]


def test_evening_readings_belong_to_their_local_day(spark):
    lit = daylight(spark, [("2024-06-20", "05:05:00", "20:18:00"), ("2024-06-21", "05:05:00", "20:18:00")])
    stamps = ["2024-06-20T10:04:59", "2024-06-20T10:05:00", "2024-06-21T00:30:00", "2024-06-21T01:17:59", "2024-06-21T01:18:00"]
    df = spark.createDataFrame([("a", "America/Chicago", ts(t)) for t in stamps], "site string, tz string, ts timestamp_ntz")
    got = ta.flag_daylight(df, lit, ["site"], tz="tz").orderBy("ts")
    assert [r.is_day for r in got.collect()] == [False, True, True, True, False]
    local = spark.createDataFrame([("a", ts("2024-06-20T20:17:59")), ("a", ts("2024-06-20T20:18:00")), ("a", ts("2024-07-20T12:00:00"))], "site string, ts timestamp_ntz")
    assert [r.is_day for r in ta.flag_daylight(local, lit, ["site"]).orderBy("ts").collect()] == [True, False, False]


def test_same_axis_finds_rows_that_a_frame_lacks(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1), ("x", 2), ("x", 2)], "frame string, k int")
    assert rows(ta.same_axis(df, ["k"]), "k", "present_in") == [(2, ["x"])]


def test_scalar_rules(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (2000.0,)], "v double")
    assert [r[0] for r in df.select(clip("v", 0.0, 1500.0)).collect()] == [None, 0.0, 1500.0]
    got = spark.range(1).select(
        convert_unit(F.lit(212.0), F.lit("F_to_C")).alias("c"),
        convert_unit(F.lit(3.5), F.lit("unknown")).alias("u"),
        label_key(F.lit("DC/System Health Loss (MWh)")).alias("l"),
        label_key(F.lit("Curtailment - Total (MWh)")).alias("m"),
        short_year_date(F.lit("010599"), "MMddyy").alias("y1"),
        short_year_date(F.lit("010524"), "MMddyy").alias("y2"),
        ceil_time("day", F.lit("2024-01-01 00:00:01").cast("timestamp_ntz")).alias("d"),
        bucket_start(F.lit("2024-01-01 00:07:31").cast("timestamp_ntz"), 300).alias("b"),
    ).first()
    assert got.c == pytest.approx(100.0) and got.u == 3.5
    assert (got.l, got.m) == ("dc_health_loss", "curtailment_total")
    assert (got.y1, got.y2) == (dt.date(1999, 1, 5), dt.date(2024, 1, 5))
    assert (got.d, got.b) == (ts("2024-01-02T00:00:00"), ts("2024-01-01T00:05:00"))
