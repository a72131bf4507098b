import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage, shared_folder
from gridloom.sources import files as fl
from gridloom.sources import intervals as iv
from gridloom.sources import parameters as pm
from gridloom.sources import payloads as pl
from gridloom.sources import spreadsheet as ss
from gridloom.streaming.landing import land_readings
from tests.helpers import rows, ts


def test_wide_csv_files_of_different_shape(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Timestamp,POA_1,GHI_1\n2024-01-01 00:00:00,1.5,bad\n2024-01-01 00:01:00,,7\n")
    (tmp_path / "b.csv").write_text('"Time",POA_1,"Extra, quoted"\n2024-07-01 00:00:00-05:00,2,3\n')
    got = iv.read_wide_csv(spark, str(tmp_path), F.lit("America/Chicago")).cache()
    assert rows(got, "attribute", "ts", "value") == sorted(
        [
            ("POA_1", ts("2024-01-01T00:00:00"), 1.5), ("GHI_1", ts("2024-01-01T00:00:00"), None),
            ("POA_1", ts("2024-01-01T00:01:00"), None), ("GHI_1", ts("2024-01-01T00:01:00"), 7.0),
            ("POA_1", ts("2024-07-01T00:00:00"), 2.0), ("Extra, quoted", ts("2024-07-01T00:00:00"), 3.0),
        ],
        key=repr,
    )
    assert rows(iv.common_attributes(got).select("attribute").distinct()) == [("POA_1",)]


def test_footer_lines_are_no_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Timestamp,P\n2024-01-01 00:00:00,1\n2024-01-01 00:01:00,2\nTotal,11\n")
    got = iv.read_wide_csv(spark, str(tmp_path))
    assert rows(got, "attribute", "value") == [("P", 1.0), ("P", 2.0)]


def test_common_attributes_are_per_site(spark):
    data = [("s", "f1", "P"), ("s", "f2", "P"), ("s", "f1", "Q"), ("t", "g1", "R")]
    df = spark.createDataFrame([(*d, ts("2024-01-01T00:00:00"), 1.0) for d in data], "site string, file string, attribute string, ts timestamp_ntz, value double")
    assert rows(iv.common_attributes(df, site=["site"]).select("site", "attribute").distinct()) == [("s", "P"), ("t", "R")]
    latest = spark.createDataFrame([("f1",), ("f2",), ("g1",)], "file string")
    assert rows(iv.load_periods(df, latest, ["site", "attribute", "ts"]), "site", "attribute") == [("s", "P"), ("t", "R")]


def test_load_periods_keeps_the_first_of_equal_stamps(spark):
    data = [("f1", "P", ts("2024-01-01T00:00:00"), 1.0), ("f2", "P", ts("2024-01-01T00:00:00"), 9.0), ("f2", "P", ts("2024-01-01T00:02:00"), 3.0), ("old", "P", ts("2024-01-01T00:00:00"), 5.0), ("f1", "Q", ts("2024-01-01T00:00:00"), 1.0)]
    df = spark.createDataFrame(data, "file string, attribute string, ts timestamp_ntz, value double")
    latest = spark.createDataFrame([("f1",), ("f2",)], "file string")
    assert rows(iv.load_periods(df, latest), "attribute", "ts", "value") == [
        ("P", ts("2024-01-01T00:00:00"), 1.0), ("P", ts("2024-01-01T00:02:00"), 3.0)
    ]
    fine = rows(iv.load_periods(df, latest, upsample=True), "ts", "value")
    assert [v for _, v in fine] == [1.0, 2.0, 3.0]


def test_parameter_files(spark, tmp_path):
    for inv, body in {"INV 1": '<params>\n<device key="K7:v2">\n <param key="a">1</param>\n<param key="b">x y\n\n', "INV2": '<device key="K8:v1">\n<param key="a">2\n'}.items():
        (tmp_path / inv).mkdir()
        (tmp_path / inv / "p.rec").write_text(body)
    (tmp_path / "INV3").mkdir()
    (tmp_path / "INV3" / "p.re2").write_text('<meta>\n<paramList>\n<x>\n<param uid="17" value="4.5"/>\n')
    (tmp_path / "INV3" / "notes.txt").write_text('<param key="z">9\n')
    got = pm.read_parameters(spark, str(tmp_path / "*"))
    assert rows(got) == sorted(
        [
            ("INV 1", "K7:v2", "K7", "a", "1"), ("INV 1", "K7:v2", "K7", "b", "x y"), ("INV2", "K8:v1", "K8", "a", "2"),
            ("INV3", None, None, "17", "4.5"),
        ],
        key=repr,
    )


def test_parameter_metadata(spark, tmp_path):
    for inv, name in (("INV3", "p.re2"), ("INV3", "q.re2"), ("INV4", "r.rec")):
        (tmp_path / inv).mkdir(exist_ok=True)
        (tmp_path / inv / name).write_text('<meta>\n\n  <rev>2</rev>\n<paramList>\n<x>\n<param uid="17" value="4.5"/>\n')
    assert rows(pm.read_parameter_metadata(spark, str(tmp_path / "*"))) == [("INV3", "<meta><rev>2</rev>")]


def test_spreadsheet_xml(spark, tmp_path):
    def row(*cells):
        return "<Row>" + "".join(f'<Cell><Data ss:Type="String">{c}</Data></Cell>' for c in cells) + "</Row>"

    (tmp_path / "m.xml").write_text(
        '<?xml version="1.0"?><Workbook xmlns:ss="urn:s"><Worksheet><Table>' + row("Report")
        + row("Trade Date", "Value", "Value") + row("01/02/2024", "5", "6") + row("01/03/2024", "7", "8") + "</Table></Worksheet></Workbook>"
    )
    got = ss.records(ss.xml_rows(spark, str(tmp_path)), "Trade Date", ["file"])
    assert rows(got.select(F.col("fields")["Trade Date"], F.col("fields")["Value"])) == [("01/02/2024", "5"), ("01/03/2024", "7")]


def test_listing_versions_and_latest(spark, tmp_path):
    import os

    for i, name in enumerate(["Met_2024-01.csv", "Met_2024-01_CLEANED.csv", "Met_2024-01_CLEANED(1).csv", "Met_2024-01_CLEANED_PROCESSED.csv", "x.txt"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    files = fl.with_version(fl.list_files(spark, str(tmp_path), "*.csv"))
    got = fl.latest_files(files, ["version"]).select("version", F.element_at(F.split("path", "/"), -1))
    assert rows(got) == [("cleaned", "Met_2024-01_CLEANED(1).csv"), ("processed", "Met_2024-01_CLEANED_PROCESSED.csv"), ("raw", "Met_2024-01.csv")]


def test_routing_reports_double_matches(spark):
    files = spark.createDataFrame([(n, n) for n in ("2024-05_North_gen.csv", "2024-05_South.csv", "other.csv", "North_South.csv")], "path string, name string")
    patterns = spark.createDataFrame([("N", "*North*"), ("S", "South*"), ("G", "2024-05*gen*xlsx")], "site string, pattern string")
    assert rows(fl.route_files(files, patterns), "name", "site", "n_matches", "error") == [
        ("2024-05_North_gen.csv", "N", 1, False), ("2024-05_South.csv", "S", 1, False), ("North_South.csv", None, 2, True), ("other.csv", None, 0, False)
    ]


def test_versioned_and_replacing_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "2024-01", 1.0), ("b", "2024-01", 2.0)], "site string, month string, v double")
    fl.write_version(df, path, F.lit(1))
    fl.write_version(df.filter("site = 'a'").withColumn("v", F.lit(5.0)), path, F.lit(2))
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    assert rows(fl.latest_version(stored), "site", "v") == [("a", 5.0), ("b", 2.0)]
    other = str(tmp_path / "r")
    fl.replace_partitions(df, other)
    fl.replace_partitions(df.filter("site = 'b'").withColumn("v", F.lit(9.0)), other)
    assert rows(spark.read.parquet(other), "site", "v") == [("a", 1.0), ("b", 9.0)]


def test_weather_payload(spark):
    body = {"features": [{"properties": {"2024-01-01T06:00:00Z": {"airTemp": 1.5, "windSpeed": 3.0}, "2024-01-01T07:00:00Z": {"airTemp": 2.5}}}, {"properties": {}}]}
    df = spark.createDataFrame([("s", 1, json.dumps(body)), ("s", 2, json.dumps(body).replace("1.5", "9.5")), ("t", 3, "{}")], "site string, n int, body string")
    long = pl.weather_rows(df, ["site", "n"])
    assert long.count() == 6
    bounds = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 9))], "site string, start timestamp, end timestamp")
    got = pl.weather_hours(long, bounds, ["site"], ["airTemp", "windSpeed"], "n").orderBy("instant").collect()
    assert [(r.airTemp, r.windSpeed) for r in got] == [(1.5, 3.0), (2.5, None), (None, None)]


def test_station_must_reach_the_end(spark):
    data = [("s", "near", 1.0, ts("2024-01-05T00:00:00")), ("s", "far", 9.0, ts("2024-01-31T00:00:00")), ("t", "only", 3.0, ts("2023-01-01T00:00:00"))]
    df = spark.createDataFrame(data, "site string, station string, distance double, hourly_end timestamp_ntz")
    got = pl.pick_station(df, F.lit("2024-01-20").cast("timestamp_ntz"))
    # distance is that of the nearest station that reaches the end
    assert rows(got, "site", "station", "distance") == [("s", "far", 9.0), ("t", "only", 3.0)]


def test_soiling_needs_all_devices(spark):
    data = [("s", "d1", "2024-01-01", "1.0"), ("s", "d2", "2024-01-01", "3.0"), ("s", "d1", "2024-01-02", "5"), ("t", "x", "2024-01-01", "n/a")]
    df = spark.createDataFrame(data, "site string, device string, day string, soiling string")
    assert rows(pl.soiling_daily(df, ["soiling"]), "site", "soiling") == [("s", 2.0), ("t", None)]


def test_resolver_prefers_stored_months_and_clamps(spark):
    stored = spark.createDataFrame([("s", ts("2024-05-01T00:00:00"), 1.0)], "site string, ts timestamp_ntz, ghi double")
    fetched = spark.createDataFrame([("s", ts(t), 2.0) for t in ("2022-01-01T00:00:00", "2024-05-02T00:00:00", "2024-06-01T00:00:00")], "site string, ts timestamp_ntz, ghi double")
    wanted = spark.createDataFrame([("s", 2024, 5), ("s", 2024, 6), ("s", 2022, 1)], "site string, year int, month int")
    got = pl.resolve_weather(wanted, stored, fetched, F.lit("2024-06-15").cast("date"))
    assert rows(got, "ts", "origin") == [(ts("2024-05-01T00:00:00"), "stored"), (ts("2024-06-01T00:00:00"), "fetched")]


def test_landing_takes_only_new_files(spark, tmp_path):
    src, dst, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    (tmp_path / "in").mkdir()
    head = "site,asset,attribute,ts,value\n"
    (tmp_path / "in" / "a.csv").write_text(head + "s,1,P,2024-01-31 23:59:00,1\ns,1,P,2024-02-01 00:00:00,2\ns,1,P,2024-02-01 00:00:00,3\n")
    land_readings(spark, src, dst, chk).awaitTermination()
    assert spark.read.parquet(dst).count() == 2
    (tmp_path / "in" / "b.csv").write_text(head + "s,1,P,2024-02-01 00:01:00,4\n")
    land_readings(spark, src, dst, chk).awaitTermination()
    got = spark.read.parquet(dst)
    assert got.count() == 3 and got.filter("batch = 1").count() == 1


def test_stored_copies_lie_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert df.count() == 5 and df.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark))


def test_numeric_columns_and_period(spark):
    df = spark.createDataFrame([(ts(f"2024-01-0{d}T00:00:00"), "x", 1.0, d) for d in (1, 2, 3)], "ts timestamp_ntz, name string, v double, n int")
    assert iv.numeric_columns(df, keep=["ts"]).columns == ["ts", "v", "n"]
    assert rows(iv.in_period(df, "2024-01-01", "2024-01-03"), "n") == [(1,), (2,)]


def test_station_weather_units(spark):
    df = spark.createDataFrame([("s", 10.0, 36.0)], "station string, temp double, wspd double")
    got = pl.station_weather(df).first()
    assert (got.station, got.temp_air, round(got.wind_speed, 6)) == ("s", 10.0, 10.0)


def test_lookups_by_key_length(spark):
    from gridloom.functions.text import key_lengths, substrings

    keys = spark.createDataFrame([("ab",), ("xyz",), ("",), (None,), ("cd",)], "k string")
    assert key_lengths(keys, "k") == [2, 3]
    names = spark.createDataFrame([("abcab",), ("a",), ("",)], "n string")
    got = [sorted(r.p) for r in names.select("n", substrings("n", [2, 3]).alias("p")).orderBy(F.length("n")).collect()]
    assert got == [[], [], ["ab", "abc", "bc", "bca", "ca", "cab"]]


def test_weather_on_local_hours_and_half_hours(spark):
    zones = spark.createDataFrame([("a", "America/Chicago")], "site string, tz string")
    wanted = spark.createDataFrame([("a", 2024, 3), ("a", 2024, 11)], "site string, year int, month int")
    t0 = ts("2024-03-01T06:00:00")  # midnight in Chicago
    rows_ = [("a", t0 + dt.timedelta(hours=k), float(k)) for k in (-1, 0, 2, 742)] + [("a", t0 + dt.timedelta(minutes=90), 9.0)]
    data = spark.createDataFrame(rows_, "site string, ts timestamp_ntz, temp double")
    today = F.lit("2024-12-01").cast("date")
    got = pl.resolve_local_weather(wanted, data.limit(0), data, today, zones, ["temp"])
    counts = {r.month: r["count"] for r in got.groupBy("month").count().collect()}
    assert counts == {3: 31 * 24 - 1, 11: 30 * 24 + 1}
    march = got.filter("month = 3 AND temp IS NOT NULL").orderBy("ts").collect()
    assert [r.temp for r in march] == [0.0, 2.0, 742.0] and march[0].ts_local == ts("2024-03-01T00:00:00")
    assert march[-1].ts_local == ts("2024-03-31T23:00:00")
    fine = pl.resolve_local_weather(wanted.filter("month = 3"), data.limit(0), data, today, zones, ["temp"], 1200)
    assert fine.count() == 3 * (31 * 24 - 1) - 2
    assert [r.temp for r in fine.filter("temp IS NOT NULL").orderBy("ts").collect()] == [0.0] * 3 + [2.0] * 3 + [742.0]
