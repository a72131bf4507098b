import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridloom.core.ordered import series
from gridloom.operators import events as ev
from gridloom.operators import lookups as lk
from gridloom.operators import summaries as sm
from tests.helpers import rows, series_df, ts

BY = series(["k"], ["ts"], "hour")


def brute_average(points, start, seconds, continuous):
    """Integrate second by second (stamps are whole seconds)."""
    total = weight = 0.0
    for (t0, v0), (t1, v1) in zip(points, points[1:]):
        span = (t1 - t0).total_seconds()
        for s in range(int(span)):
            t = t0 + dt.timedelta(seconds=s)
            if start <= t < start + dt.timedelta(seconds=seconds):
                total += v0 + (v1 - v0) * (s + 0.5) / span if continuous else v0
                weight += 1
    return total / weight if weight else None


@pytest.mark.parametrize("continuous", [True, False])
def test_time_weighted_average_against_integration(spark, continuous):
    rng = random.Random(11)
    t, points = ts("2024-01-01T00:10:00"), []
    for _ in range(60):
        points.append((t, float(rng.randint(0, 50))))
        t += dt.timedelta(seconds=rng.choice([7, 90, 400, 5000]))
    df = spark.createDataFrame([("a", *p) for p in points], "k string, ts timestamp_ntz, value double")
    basis = "time_weighted_continuous" if continuous else "time_weighted_discrete"
    got = sm.interval_summary(df, BY, 3600, basis).collect()
    assert len(got) > 5
    for r in got:
        assert r.average == pytest.approx(brute_average(points, r.bucket, 3600, continuous), rel=1e-9)


def test_bad_values_lower_percent_good(spark):
    df = series_df(spark, [10, 20, 30], "2024-01-01T00:00:00", 1800, k="a").withColumn("good", F.col("value") != 10)
    got = sm.interval_summary(df, BY, 3600, "time_weighted_discrete", good="good").first()
    assert (got.average, got.percent_good) == (20.0, 50.0)


def test_unknown_basis(spark):
    with pytest.raises(ValueError):
        sm.interval_summary(series_df(spark, [1], k="a"), BY, 60, "median")


def test_boundary_values_interpolate_or_hold(spark):
    df = series_df(spark, [0, 10], "2024-01-01T00:00:00", 600, k="a")
    a, z = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-01 00:03:00", "2024-01-01 02:00:00"))
    assert rows(sm.boundary_values(df, ["k"], a, z)) == [("a", 3.0, 10.0)]


def test_across_assets_missing_rules(spark):
    df = spark.createDataFrame([("s", 1, None), ("s", 1, None), ("s", 2, 4.0), ("s", 2, None)], "site string, ts int, value double")
    assert rows(sm.across_assets(df, ["site", "ts"])) == [("s", 1, None, 0.0, None, 1), ("s", 2, 4.0, 4.0, 4.0, 0)]


def test_offline_events_total_hours(spark):
    n = [0] * 3 + [8] * 30 + [7] * 2 + [0] + [9]
    df = series_df(spark, n, step_s=3600, site="s").select("site", "ts", F.col("value").alias("n_offline"), F.lit(1.4).alias("lost_mw"))
    got = ev.offline_events(df, series(["site"], ["ts"], "day"), 7)
    assert rows(got, "event_hours", "lost_mwh") == [(1.0, 1), (32.0, 45)]


def test_weak_sun_counts_as_online(spark):
    data = [("s", 1, 100.0, 200.0, 10, 3.5, 249.0), ("s", 2, 100.0, 200.0, 10, 3.5, 250.0), ("s", 3, 0.0, 0.0, 10, 3.5, 500.0)]
    df = spark.createDataFrame(data, "site string, ts int, actual_kw double, possible_kw double, n_assets int, online double, poa double")
    got = ev.lost_power(df, ["site", "ts"], "n_assets", "online", True, "poa")
    assert rows(got, "ts", "n_offline", "lost_mw") == [(1, 0, 0.1), (2, 6, 0.1), (3, 0, 0.0)]


def test_excursion_band_is_exclusive_and_scaled(spark):
    poi = [138.0, 142.0, 142.1, 143.0, 138.0, 150.0]
    measured = series_df(spark, [p * 10 for p in poi], k="a")
    target = series_df(spark, [138.0], k="a")
    got = ev.voltage_excursions(measured, target, BY, "event_id")
    assert rows(got, "max_delta", "minutes", "start_setpoint") == [(12.0, 0.0, 138.0), (5.0, 1.983333, 138.0)]


def test_excursion_lasts_until_the_next_recorded_value(spark):
    stamps = [("a", ts(f"2024-01-01T00:{m:02d}:00"), m, v) for m, v in ((0, 138.0), (10, 120.0), (50, 138.0))]
    measured = spark.createDataFrame(stamps, "k string, ts timestamp_ntz, event_id int, value double")
    target = series_df(spark, [138.0], k="a")
    got = ev.voltage_excursions(measured, target, BY, "event_id").collect()
    assert [(r.start_time.minute, r.end_time.minute, r.end_time.second) for r in got] == [(10, 49, 59)]


def test_asof_takes_the_latest_target_at_or_before(spark):
    left = series_df(spark, [1, 2, 3, 4], k="a")
    right = series_df(spark, [10, 20], "2024-01-01T00:01:00", 60, k="a")
    got = lk.asof_value(left, right, BY, "value", "target", "event_id")
    assert [r.target for r in got.orderBy("ts").collect()] == [None, 10.0, 20.0, 20.0]


def test_overlap_drops_events_as_long_as_the_range(spark):
    t = lambda h: ts("2024-01-01T00:00:00") + dt.timedelta(hours=h)
    events = spark.createDataFrame(
        [("s", t(-5), t(2)), ("s", t(5), t(30)), ("s", t(-5), t(40)), ("s", t(0), t(24)), ("s", t(-5), t(0)), ("s", t(3), t(4))],
        "site string, event_start timestamp_ntz, event_end timestamp_ntz",
    )
    windows = spark.createDataFrame([("s", t(0), t(24))], "site string, range_start timestamp_ntz, range_end timestamp_ntz")
    got = lk.overlap_clip(events, windows, ["site"])
    assert rows(got, "existing_event", "ongoing_event", "effective_seconds") == [
        (False, False, 3600), (False, True, 19 * 3600), (True, False, 2 * 3600)
    ]


def test_claim_days(spark):
    data = [
        ("open", ts("2024-01-31T10:00:00"), None, 2),
        ("start", ts("2024-03-01T00:00:00"), None, 1),
        ("short", ts("2024-01-10T00:00:00"), ts("2024-03-03T07:00:00"), 1),
        ("late", ts("2024-02-20T00:00:00"), None, 1),
        ("done", ts("2024-01-01T00:00:00"), ts("2024-02-29T00:00:00"), 1),
    ]
    df = spark.createDataFrame(data, "site string, date_offline timestamp_ntz, date_restored timestamp_ntz, n_inv int")
    a, z = (F.lit(x).cast("timestamp_ntz") for x in ("2024-03-01", "2024-04-01"))
    assert rows(lk.claim_days(df, a, z), "site", "n_claim_days", "outage_days") == [("late", 12, 12), ("open", 31, 62), ("short", 4, 4)]


def test_fill_cells_never_writes_null_and_overwrites_on_demand(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None)], "site string, v double")
    new = spark.createDataFrame([("a", 9.0), ("b", 2.0), ("c", None)], "site string, v double")
    assert rows(lk.fill_cells(target, new, ["site"], ["v"])) == [("a", 1.0, "kept"), ("b", 2.0, "filled"), ("c", None, "kept")]
    assert rows(lk.fill_cells(target, new, ["site"], ["v"], overwrite=True)) == [
        ("a", 9.0, "replaced"), ("b", 2.0, "filled"), ("c", None, "kept")
    ]


def test_even_chunks_like_list_slices(spark):
    df = spark.createDataFrame([("s", i) for i in range(7)], "site string, n int")
    got = lk.even_chunks(df, series(["site"], ["n"], 3), 3).orderBy("n").collect()
    assert [r.chunk for r in got] == [1, 1, 1, 2, 2, 2, 3]


def test_longest_word(spark):
    items = spark.createDataFrame([("CW-Corcoran",), ("Old River One",), ("Ab Cd",)], "site string")
    tables = spark.createDataFrame([("xCorcoran 2",), ("River",), ("Cd1",), ("Cd2",)], "table_name string")
    assert rows(lk.longest_word_match(items, tables)) == [("Ab Cd", None), ("CW-Corcoran", "xCorcoran 2"), ("Old River One", "River")]


def test_value_counts(spark):
    data = [("p", "1", "A"), ("p", "1", "B"), ("p", "2", "C"), ("q", "9", "A")]
    df = spark.createDataFrame(data, "parameter string, value string, inverter string")
    counts = sm.value_counts(df)
    assert rows(counts, "parameter", "value", "count", "holders", "share") == [
        ("p", "1", 2, "A, B", 0.666667), ("p", "2", 1, "C", 0.333333), ("q", "9", 1, "A", 1.0)
    ]
    assert rows(sm.value_counts_wide(counts)) == [("p", 2, 0.666667, 1, 0.333333), ("q", 1, 1.0, None, None)]
