import pytest
from pyspark.sql import functions as F

from gridloom.sources import meters as mt
from gridloom.sources.meters import LAYOUTS
from tests.helpers import rows, ts


def grid(spark, table, file="f"):
    cells = [(file, r, c, None if v is None else str(v)) for r, row in enumerate(table) for c, v in enumerate(row)]
    return spark.createDataFrame(cells, "file string, row_no bigint, col_no int, text string")


def hours(df):
    return [(r.ts_local, round(r.mwh, 6)) for r in df.orderBy("ts_local", "row_no").collect()]


def test_wide_hours_with_hour_25_and_total(spark):
    table = [
        ["Plant report", None, None, None, None],
        ["Day", "HE 1", "HE 2", "HE25", "Note"],
        ["2024-11-02", 1, 2, 0, "a"],
        ["2024-11-03", 3, "x", 7, "b"],
        ["Total", 4, 2, 7, None],
    ]
    got = mt.read_layout(grid(spark, table), LAYOUTS["wide_hours_mwh"])
    assert [(r.ts_local.day, r.ts_local.hour, r.mwh) for r in got.orderBy("ts_local").collect()] == [
        (2, 0, 1.0), (2, 1, 2.0), (3, 0, 3.0), (3, 1, None), (3, 23, 7.0)
    ]
    out = rows(mt.meter_table(got, ["file"]), "hour", "mwh")
    assert (2, 0.0) in out and (24, 7.0) in out


def test_wide_clock_columns_and_scale(spark):
    table = [["DATE", "01:00:00", "00:00:00"], ["10224", 5, 6]]
    got = mt.read_layout(grid(spark, table), LAYOUTS["wide_packed_date_mwh"])
    assert hours(got) == [(ts("2024-01-02T00:00:00"), 5.0), (ts("2024-01-02T23:00:00"), 6.0)]
    table = [["Date", "Hour 1", "Total"], ["2024-01-02", 1500, 9999]]
    got = mt.read_layout(grid(spark, table), LAYOUTS["wide_date_kwh"])
    assert hours(got) == [(ts("2024-01-02T00:00:00"), 1.5)]


def test_quarter_labels_sum_to_hours(spark):
    labels = ["00:15", "00:30", "00:45", "01:00", "01:15"]
    table = [["Flowday", "Interval", "GEN_MWH_INT"], *[["2024-01-01", t, i + 1] for i, t in enumerate(labels)], [None, "Total of day", 99]]
    got = mt.read_layout(grid(spark, table), LAYOUTS["quarter_generation"])
    assert hours(got) == [(ts("2024-01-01T00:00:00"), 10.0), (ts("2024-01-01T01:00:00"), 5.0)]


def test_quarter_block_of_the_named_site(spark):
    table = [
        [None, None, "West block", None, "East block"],
        ["Flowday", "Interval", "Quantity (MWh)", "Price", "Quantity (MWh)"],
        ["2024-01-01", "00:15", 1, 50, 8],
        ["2024-01-01", "24:00", 2, 50, 9],
    ]
    east = mt.site_columns(grid(spark, table), "Flowday", ["east"])
    got = mt.read_layout(east, LAYOUTS["quarter_flowday"])
    assert hours(got) == [(ts("2024-01-01T00:00:00"), 17.0)]


def test_long_hours_packed_with_repeated_columns(spark):
    table = [["ID", "DATE", "HOUR", "KW 1", "KW 1"], ["x", "10524", "100", 1000, 5], ["x", "010524", "2400", 2500, 5], ["x", None, None, 9, 9]]
    got = mt.read_layout(grid(spark, table), LAYOUTS["long_packed_kw"])
    assert hours(got) == [(ts("2024-01-05T00:00:00"), 1.0), (ts("2024-01-05T23:00:00"), 2.5)]


def test_long_hours_shifted_and_out_of_range(spark):
    table = [["CT Date", "CT Hour", "Scheduled"], *[["1/5/2024", h, h * 10] for h in (1, 2, 3, 25)]]
    got = mt.read_layout(grid(spark, table), LAYOUTS["long_scheduled_mwh"])
    assert hours(got) == [(ts("2024-01-05T00:00:00"), 0.0), (ts("2024-01-05T01:00:00"), 10.0), (ts("2024-01-05T02:00:00"), 20.0)]


def test_clock_file_with_wrong_first_stamp_is_relabelled(spark):
    # three rows over a span of three hours: the values are complete, the stamps are not
    table = [
        ["DATE", "TIME", "kWh", "kWh"], [None, None, 1, 1000], ["01/05/2024", "02:00", 2, 2000], ["01/05/2024", "03:00", 3, 3000],
    ]
    got = mt.read_layout(grid(spark, table), LAYOUTS["long_clock_kwh"])
    assert hours(got) == [(ts("2024-01-05T00:00:00"), 1.0), (ts("2024-01-05T01:00:00"), 2.0), (ts("2024-01-05T02:00:00"), 3.0)]


def test_value_column_is_picked_by_position(spark):
    table = [["Flowday", "Interval", "zz Quantity (MWh)", "aa Quantity (MWh)"], ["2024-01-01", "00:15", 5, 7]]
    assert hours(mt.read_layout(grid(spark, table), LAYOUTS["quarter_flowday"])) == [(ts("2024-01-01T00:00:00"), 7.0)]
    table = [["TradingDate", "TradingHour", "z Meter_KW", "a Meter_KW"], ["2024-01-01", 1, 1000, 9]]
    assert hours(mt.read_layout(grid(spark, table), LAYOUTS["long_trading_kw"])) == [(ts("2024-01-01T00:00:00"), 1.0)]


def test_grid_of_text_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Report, "x, y"\n\nDay,HE 1,HE 2\n2024-01-01,"1,5",\n', encoding="utf-8")
    (tmp_path / "b.txt").write_text("DATE\tHOUR\r\n010524\t0100\r\n", encoding="utf-8")
    got = mt.read_grid(spark, str(tmp_path))
    cells = sorted((r.file.rsplit("/", 1)[1], r.row_no, r.col_no, r.text) for r in got.collect())
    assert cells == [
        ("a.csv", 0, 0, "Report"), ("a.csv", 0, 1, "x, y"), ("a.csv", 2, 0, "Day"), ("a.csv", 2, 1, "HE 1"), ("a.csv", 2, 2, "HE 2"),
        ("a.csv", 3, 0, "2024-01-01"), ("a.csv", 3, 1, "1,5"), ("a.csv", 3, 2, None),
        ("b.txt", 0, 0, "DATE"), ("b.txt", 0, 1, "HOUR"), ("b.txt", 1, 0, "010524"), ("b.txt", 1, 1, "0100"),
    ]


ZONE = "America/Chicago"


def route(spark, tables, zone=ZONE):
    """Hours of files {name: (layout, table)} as (utc hour, local hour, MWh)."""
    cells = None
    for name, (_, table) in tables.items():
        part = grid(spark, table, name)
        cells = part if cells is None else cells.unionByName(part)
    routing = [(name, "S", layout, zone) for name, (layout, _) in tables.items()]
    out = mt.meter_router(cells, spark.createDataFrame(routing, "file string, site string, layout string, tz string"))
    rows_ = out.filter("error IS NULL").orderBy("instant").collect()
    return [(str(r.instant)[5:13], str(r.ts_local)[5:13], round(r.mwh, 6)) for r in rows_]


AUTUMN, SPRING = "2024-11-03", "2024-03-10"


def longest(day):
    return 25 if day == AUTUMN else 23


def hour_labels(day):
    """Hour-ending clock labels of a day in order."""
    return [1, 2, *range(2, 25)] if day == AUTUMN else [1, 2, *range(4, 25)]


@pytest.mark.parametrize("day", [AUTUMN, SPRING])
@pytest.mark.parametrize("family", ["wide", "long", "quarter", "stamped", "stamped_quarter"])
def test_days_on_which_clocks_change_keep_their_energy(spark, day, family):
    n = longest(day)
    energy = [10 * (k + 1) for k in range(n)]
    if family == "wide":
        heads = [f"HE {h}" for h in range(1, 26)]
        by_label = energy if n == 25 else [*energy[:2], None, *energy[2:], None]
        layout, table = "wide_hours_mwh", [["Day", *heads], [day, *by_label]]
    elif family == "long":
        rows_ = [[day, h, 1000 * e] for h, e in zip(hour_labels(day), energy, strict=True)]
        layout, table = "long_trading_kw", [["TradingDate", "TradingHour", "Meter_KW"], *rows_]
    elif family == "quarter":
        ends = [f"{h - (q < 3):02d}:{(q + 1) * 15 % 60:02d}" for h in hour_labels(day) for q in range(4)]
        rows_ = [[day, t, energy[k // 4] / 4] for k, t in enumerate(ends)]
        layout, table = "quarter_generation", [["Flowday", "Interval", "GEN_MWH_INT"], *rows_]
    elif family == "stamped":
        rows_ = [[f"{day} {h - 1:02d}:00", e] for h, e in zip(hour_labels(day), energy, strict=True)]
        layout, table = "stamped_mwh", [["Timestamp", "MWh"], *rows_]
    else:
        rows_ = [[f"{day} {h - 1:02d}:{15 * q:02d}", 1000 * e] for h, e in zip(hour_labels(day), energy, strict=True) for q in range(4)]
        layout, table = "stamped_quarter_kw", [["Timestamp", "kW"], *rows_]
    got = route(spark, {"f": (layout, table)})
    assert [v for _, _, v in got] == energy
    assert [int(x[1][6:8]) + 1 for x in got] == hour_labels(day)
    assert len({x[0] for x in got}) == n


def test_router_reports_files_that_it_cannot_read(spark):
    cells = grid(spark, [["no", "header"], ["2024-01-01", 4]], "a").unionByName(grid(spark, [["Day", "HE1"], ["2024-01-01", 4]], "b"))
    routing = [("a", "S1", "wide_hours_mwh", ZONE), ("b", "S2", "wide_hours_mwh", ZONE), ("c", "S3", "long_kwh", ZONE), ("b", "S4", "odd", ZONE)]
    got = mt.meter_router(cells, spark.createDataFrame(routing, "file string, site string, layout string, tz string"))
    assert rows(got, "site", "mwh", "error") == [
        ("S1", None, "no header row"), ("S2", 4.0, None), ("S3", None, "no such file"), ("S4", None, "unknown layout")
    ]


def test_files_without_header_or_heading_are_listed(spark):
    cells = grid(spark, [["x", None, "West"], ["Flowday", "Interval", "Quantity (MWh)"]], "a").unionByName(grid(spark, [["x"]], "b"))
    assert rows(mt.unreadable(cells, "Flowday")) == [("b", "no header row")]
    assert rows(mt.without_heading(cells, "Flowday", ["east"])) == [("a", "no site heading")]
    assert rows(mt.without_heading(cells, "Flowday", ["west"])) == []


def test_stamped_layouts(spark):
    table = [["HourBegin", "Generation_MW"], ["2024-01-01 00:00", 5], ["2024-01-01 01:00", 6], ["Total", 11]]
    assert hours(mt.read_layout(grid(spark, table), LAYOUTS["stamped_mw_total"])) == [(ts("2024-01-01T00:00:00"), 5.0), (ts("2024-01-01T01:00:00"), 6.0)]
    table = [["Timestamp", "Plant.MeterMW"], ["2024-01-01 00:00:00", 4], ["2024-01-01 00:30:00", 6]]
    assert hours(mt.read_layout(grid(spark, table), LAYOUTS["stamped_mean_mw"])) == [(ts("2024-01-01T00:00:00"), 5.0)]
    table = [["Timestamp", "kW"], ["2024-01-01 00:00", 4000], ["2024-01-01 00:15", 2000]]
    assert hours(mt.read_layout(grid(spark, table), LAYOUTS["stamped_quarter_kw"])) == [(ts("2024-01-01T00:00:00"), 1.5)]


def test_header_is_the_first_row_with_the_marker(spark):
    table = [["junk", None], ["x", "Day"], ["2024", "Day"]]
    assert rows(mt.header_rows(grid(spark, table), "Day")) == [("f", 1)]


def test_routed_files_in_several_layouts(spark):
    a = grid(spark, [["Day", "HE1"], ["2024-01-01", 4]], "a")
    b = grid(spark, [["TradingDate", "TradingHour", "Meter_KW"], ["2024-01-01", 3, 1500]], "b")
    routing = spark.createDataFrame([("a", "S1", "wide_hours_mwh"), ("b", "S2", "long_trading_kw")], "file string, site string, layout string")
    got = mt.read_all(a.unionByName(b), routing).filter("mwh IS NOT NULL")
    assert rows(got, "site", "ts_local", "mwh") == [("S1", ts("2024-01-01T00:00:00"), 4.0), ("S2", ts("2024-01-01T02:00:00"), 1.5)]


def test_settlement_rows(spark):
    data = [("R1", 1, 2.0, "GEN"), ("R1", 1, 4.0, "GEN"), ("R1", 2, None, "GEN"), ("R1", 25, 9.0, "GEN"), ("R1", 1, 50.0, "LOAD"), ("R9", 1, 1.0, "GEN")]
    df = spark.createDataFrame(data, "resource_id string, interval_id int, value double, measurement_type string").withColumn("trade_date", F.lit("2024-01-01").cast("date"))
    names = spark.createDataFrame([("R1", "Alpha")], "resource_id string, site string")
    assert rows(mt.settlement(df, names), "site", "mwh") == [("Alpha", 0.0), ("Alpha", 3.0), ("R9", 1.0)]


def test_meter_history_of_a_month(spark):
    data = [("a", "2024-01-31", 24, "5"), ("a", "2024-02-01", 1, "x"), ("a", "2024-02-29", 24, "2.5"), ("b", "2024-02-02", 1, None), ("b", "2024-03-01", 1, "7")]
    df = spark.createDataFrame(data, "site string, day string, hour int, text string").withColumn("day", F.col("day").cast("date"))
    assert rows(mt.meter_history(df, 2024, 2), "ts_local", "mwh") == sorted([(ts("2024-02-01T00:00:00"), None), (ts("2024-02-29T23:00:00"), 2.5)], key=repr)
    assert mt.meter_history(df, 2024).count() == 5 and mt.meter_history(df, month=3).count() == 1


def test_monthly_totals_count_repeated_hours(spark):
    df = spark.createDataFrame([("s", ts("2024-01-01T00:00:00"), 1.0), ("s", ts("2024-01-01T00:00:00"), 2.0), ("s", ts("2024-01-01T01:00:00"), 3.0)], "site string, ts_local timestamp_ntz, mwh double")
    assert rows(mt.monthly_totals(df), "mwh", "n_repeated_hours") == [(6.0, 1)]


@pytest.mark.parametrize("name", LAYOUTS)
def test_every_layout_has_a_reader(name):
    assert LAYOUTS[name].family in mt.FAMILIES
