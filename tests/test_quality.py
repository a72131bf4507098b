import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridloom.core.ordered import series
from gridloom.operators import naming as nm
from gridloom.operators import quality as qc
from gridloom.operators.summaries import r2_score
from tests.helpers import rows, series_df, ts

BY = series(["attribute"], ["ts", "event_id"], "hour")


def wiggle(i):
    return 50.0 + (i * i * 37 % 101)


def flat_case(spark, n_flat, attribute="POA_1", level=300.0, start="2024-06-01T08:00:00", day=True):
    """Wiggly, then ``n_flat`` equal rows, then wiggly again; one row per minute."""
    values = [wiggle(i) for i in range(40)] + [level] * n_flat + [wiggle(i) for i in range(40)]
    return series_df(spark, values, start, attribute=attribute).withColumn("is_day", F.lit(day))


def verdicts(spark, df):
    return qc.flat_runs(qc.mark_flat(df, BY, block_rows=64), ["attribute"]).collect()


def test_flat_run_length_threshold(spark):
    # 17 equal rows are needed for one flat row, so n equal rows give n - 16
    assert verdicts(spark, flat_case(spark, 119 + 16)) == []
    found = verdicts(spark, flat_case(spark, 120 + 16))
    assert [(r.n_rows, r.removed) for r in found] == [(120, True)]


def test_flat_run_is_nulled_and_neighbours_stay(spark):
    df = flat_case(spark, 200)
    marked = qc.mark_flat(df, BY, block_rows=64)
    out = qc.null_flat_runs(marked, qc.flat_runs(marked, ["attribute"]), ["attribute"])
    hit = out.filter("flatline").agg(F.count("*"), F.min("event_id"), F.max("event_id"), F.count("value")).first()
    assert tuple(hit) == (184, 47, 230, 0)
    assert out.count() == df.count()


@pytest.mark.parametrize(
    "attribute,level,day,n,keep",
    [
        ("Mod_Temp_1", 20.0, False, 300, "night_temperature"),
        ("ActivePower_1", 300.0, True, 300, "daylight_power"),
        ("ActivePower_1", 1.0, True, 300, "absent"),
        ("POA_1", 0.0, False, 300, "night_zero"),
        ("MeterMW_1", 0.01, True, 300, "meter_outage"),
        ("Wind_1", 3.0, True, 1500, None),
        ("Wind_1", 3.0, True, 1400, "absent"),
        ("POA_1", 300.0, True, 300, None),
    ],
)
def test_flat_run_exemptions(spark, attribute, level, day, n, keep):
    found = verdicts(spark, flat_case(spark, n, attribute, level, day=day))
    if keep == "absent":
        assert found == []
    else:
        assert [(r.keep, r.removed) for r in found] == [(keep, keep is None)]


def test_temperature_sensors_keep_the_least_bad(spark):
    data = [("s", a, v) for a, vs in {"a": [100, 100, 1], "b": [100] * 3, "c": [100] * 3}.items() for v in map(float, vs)]
    data += [("t", "x", 200.0)] * 2
    df = spark.createDataFrame(data, "site string, attribute string, value double")
    got = qc.bad_temperature_sensors(df, ["site"], "attribute")
    assert rows(got, "site", "attribute", "removed") == [
        ("s", "a", False), ("s", "b", True), ("s", "c", True), ("t", "x", False)
    ]
    worse = df.withColumn("value", F.lit(200.0))
    got = qc.bad_temperature_sensors(worse, ["site"], "attribute").filter("removed")
    assert rows(got, "attribute") == [("b",), ("c",)]


def test_auto_qc_against_row_by_row_rules(spark):
    """Night values, negatives, spikes and gone series in one pass."""
    rng = random.Random(3)
    start = ts("2024-06-01T00:00:00")
    data = []
    for i in range(600):
        t = start + dt.timedelta(minutes=i)
        data.append(("p", "POA_1", t, i, 5000.0 if 300 <= i < 303 else rng.uniform(20, 60)))
        data.append(("p", "GHI_1", t, i, rng.uniform(-9, -1)))
        data.append(("p", "Amb_Temp_1", t, i, 95.0 if i % 50 == 0 else rng.uniform(0, 30)))
        data.append(("p", "Wind_9", t, i, None))
    df = spark.createDataFrame(data, "site string, attribute string, ts timestamp_ntz, event_id bigint, value double")
    df = df.withColumn("is_day", F.hour("ts") >= 6)
    by = series(["site", "attribute"], ["ts", "event_id"], "hour")
    out = qc.auto_qc(df, by, ["site"], block_rows=128).cache()
    assert rows(out.select("attribute").distinct()) == [("Amb_Temp_1",), ("GHI_1",), ("POA_1",)]
    summary = {r.attribute: r for r in qc.qc_summary(out, ["attribute"]).collect()}
    temps = summary["Amb_Temp_1"]
    assert (temps.n_outlier, temps.n_processed) == (12, 12)
    jumps = [abs(a - b) for a, b in zip([d[4] for d in data if d[1] == "POA_1"][1:], [d[4] for d in data if d[1] == "POA_1"])]
    expect = sum(1 for i in range(600) if 2 <= i <= 597 and sum(jumps[i - 2 : i + 2]) / 4 > 1000)
    assert summary["POA_1"].n_outlier == expect
    # hours 0 to 5 are night; the spike lies in them and is already nulled
    assert summary["POA_1"].n_night_zeroed == 360 - expect
    ghi = summary["GHI_1"]
    assert ghi.n_negative_zeroed == sum(1 for d in data if d[1] == "GHI_1" and d[4] < -5)
    assert ghi.n_processed == 0


def test_changed_ranges_by_step(spark):
    raw = series_df(spark, range(10), k="a")
    clean = raw.withColumn(
        "value", F.when(F.col("event_id").isin(2, 3, 4), None).when(F.col("event_id").isin(7, 8), 0.5).otherwise(F.col("value"))
    )
    by = series(["k"], ["ts"], "hour")
    plain = rows(qc.changed_ranges(raw, clean, by), "n_rows", "change")
    assert plain == [(2, "MODIFIED"), (3, "REMOVED")]
    stepped = qc.changed_ranges(raw, clean, by, step_seconds=60)
    assert rows(stepped, "n_rows", "change") == [(1, "MODIFIED"), (3, "REMOVED")]
    assert rows(qc.changed_ranges(raw, clean, by, step_seconds=60, min_modified=240), "change") == [("REMOVED",)]


def test_negative_check_effective_rules(spark):
    data = [("poa", -5.0), ("poa", 1600.0), ("poa", None), ("wind", -1.0), ("wind", 80.0), ("amb_temp", -40.0)]
    df = spark.createDataFrame(data, "sensor_type string, value double")
    got = rows(qc.negative_check(df), "sensor_type", "cleaned", "bad", "above", "below")
    assert got == sorted(
        [
            ("poa", 0.0, 0, False, False), ("poa", 1500.0, 0, False, False), ("poa", None, 1, False, False),
            ("wind", 0.0, 1, False, False), ("wind", 80.0, 0, True, False), ("amb_temp", -40.0, 0, False, True),
        ],
        key=repr,
    )


def test_r2_score_edge_cases(spark):
    cases = {
        "perfect": [(1.0, 1.0), (2.0, 2.0)],
        "flat_exact": [(3.0, 3.0), (3.0, 3.0)],
        "flat_off": [(3.0, 3.0), (3.0, 4.0)],
        "mean": [(1.0, 2.0), (3.0, 2.0)],
        "missing": [(None, 1.0), (1.0, None)],
        "holes": [(1.0, 1.0), (2.0, None), (3.0, 3.0), (9.0, None)],
    }
    data = [(k, t, p) for k, vs in cases.items() for t, p in vs]
    df = spark.createDataFrame(data, "k string, t double, p double")
    got = {r.k: r.s for r in df.groupBy("k").agg(r2_score("t", "p").alias("s")).collect()}
    assert got == {"perfect": 1.0, "flat_exact": 1.0, "flat_off": 0.0, "mean": 0.0, "missing": None, "holes": 1.0}


def test_clear_days_fall_back_to_all_days(spark):
    data = [("a", ts(f"2024-01-0{d}T{h:02d}:00:00"), float(h), float(h) * f) for d, f in ((1, 1.0), (2, 0.3)) for h in range(5)]
    data += [("b", ts(f"2024-01-0{d}T{h:02d}:00:00"), float(h), float(h) * f) for d, f in ((1, 0.2), (2, 0.3)) for h in range(5)]
    df = spark.createDataFrame(data, "site string, ts timestamp_ntz, ref double, ghi double")
    got = qc.clear_days(df, ["site"], "ref", "ghi", 5)
    assert rows(got, "site", "date", "rank") == [
        ("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 1), 2), ("b", dt.date(2024, 1, 2), 1)
    ]


def test_sensor_types(spark):
    names = ["Amb_Temp", "BOM_1", "ws_ms", "Global_POA", "plane_irr", "hor_irr", "Other"]
    df = spark.createDataFrame([(n,) for n in names], "attribute string")
    got = [r.t for r in df.select(nm.met_type(F.col("attribute")).alias("t")).collect()]
    assert got == ["amb_temp", "mod_temp", "wind", "ghi", "poa", "ghi", None]
    flags = {r.attribute: r for r in nm.with_qc_type(df).collect()}
    assert not flags["hor_irr"].is_poa and flags["hor_irr"].is_ghi and flags["Amb_Temp"].is_temp


def test_paths(spark):
    data = [(r"\\srv\db\fleet\S\Inverters\I1\C2|ActivePower",), (r"\\srv\db\fleet\S|MeterMW",), (r"\\srv\db\fleet\S\Met\M1|POA",)]
    parsed = nm.parse_path(spark.createDataFrame(data, "path string"))
    got = rows(nm.column_names(parsed), "site", "asset_group", "elements", "attribute", "column_name")
    assert got == sorted(
        [
            ("S", "Inverters", ["I1", "C2"], "ActivePower", "ActivePower_C2_I1_Inverters"),
            ("S", None, [], "MeterMW", "MeterMW"),
            ("S", "Met", ["M1"], "POA", "POA_M1_Met"),
        ],
        key=repr,
    )


def test_series_without_values_are_left_out(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.0), ("b", None), ("b", None)], "k string, value double")
    assert qc.drop_empty(df, ["k"]).select("k").distinct().collect()[0].k == "a" and qc.drop_empty(df, ["k"]).count() == 2
