import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from tests.helpers import rows, ts

from gridloom.operators.zones import judge, localize_judged, zone_changes

SCHEMA = "site string, tz string, ts_local timestamp_ntz, v double"
CHICAGO = ZoneInfo("America/Chicago")


def hours(site, tz, start, n, step=3600):
    t0 = ts(start)
    return [(site, tz, t0 + dt.timedelta(seconds=step * k), float(k)) for k in range(n)]


def utc(local, zone, fold=0):
    return local.replace(tzinfo=zone, fold=fold).astimezone(dt.UTC).replace(tzinfo=None)


def test_changes_of_zones(spark):
    zones = [(z, ts("2024-01-01T00:00:00"), ts("2025-01-01T00:00:00")) for z in ("America/Chicago", "Australia/Lord_Howe", "America/Phoenix")]
    got = rows(zone_changes(spark.createDataFrame(zones, "tz string, start timestamp_ntz, end timestamp_ntz")), "tz", "at", "before", "after")
    assert sorted(got) == [
        ("America/Chicago", ts("2024-03-10T08:00:00"), -21600, -18000),
        ("America/Chicago", ts("2024-11-03T07:00:00"), -18000, -21600),
        ("Australia/Lord_Howe", ts("2024-04-06T15:00:00"), 39600, 37800),
        ("Australia/Lord_Howe", ts("2024-10-05T15:30:00"), 37800, 39600),
    ]


@pytest.fixture
def table(spark):
    data = hours("spring", "America/Chicago", "2024-03-09T20:00:00", 12)  # counts through the skipped hour
    data += hours("autumn", "America/Chicago", "2024-11-02T22:00:00", 9)  # has the repeated hour once
    data += [x for x in hours("clean", "America/Chicago", "2024-03-09T20:00:00", 12) if x[2].hour != 2]
    data += hours("phoenix", "America/Phoenix", "2024-03-09T20:00:00", 12)
    data += hours("half", "Australia/Lord_Howe", "2024-04-07T00:00:00", 8, 1800)
    data += [("spring", None, ts("2024-03-10T02:00:00"), 1.0), ("spring", "America/Chicago", None, 1.0)]
    return spark.createDataFrame(data, SCHEMA)


def test_series_are_judged(table):
    assert rows(judge(table, ["site"]), "site", "kind", "n_doubtful") == [
        ("autumn", "fixed", 1), ("clean", "zone", 0), ("half", "fixed", 1), ("phoenix", "zone", 0), ("spring", "fixed", 1)
    ]


def test_instants(table):
    out = localize_judged(table, ["site"], 3600).filter("site <> 'half'")
    got = {}
    for r in out.collect():
        got.setdefault((r.site, r.kind), []).append((r.instant, r.v))
    assert set(got) == {("spring", "fixed"), ("autumn", "fixed"), ("clean", "zone"), ("phoenix", "zone")}
    first = ts("2024-03-10T02:00:00")  # 20:00 in Chicago
    hour = dt.timedelta(hours=1)
    # the zone's clocks show eleven hours from 20:00 to 07:00: the twelfth row falls off
    assert sorted(got["spring", "fixed"]) == [(first + k * hour, float(k)) for k in range(11)]
    # and ten from 22:00 to 06:00 in autumn: the last one has no row
    first = ts("2024-11-03T03:00:00")
    assert sorted(got["autumn", "fixed"], key=lambda x: x[0]) == [(first + k * hour, float(k) if k < 9 else None) for k in range(10)]
    clean = [(utc(x[2], CHICAGO), x[3]) for x in hours("", "", "2024-03-09T20:00:00", 12) if x[2].hour != 2]
    assert sorted(got["clean", "zone"]) == clean
    assert sorted(got["phoenix", "zone"]) == [(x[2] + 7 * hour, x[3]) for x in hours("", "", "2024-03-09T20:00:00", 12)]


def test_half_hours(table):
    out = localize_judged(table.filter("site = 'half'"), ["site"], 1800).orderBy("instant").collect()
    # clocks go back by half an hour at 02:00, so the local span of 3.5 hours is 4 hours long
    assert [r.instant for r in out] == [ts("2024-04-06T13:00:00") + k * dt.timedelta(minutes=30) for k in range(9)]
    assert [r.v for r in out] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, None]


def test_empty(spark):
    assert localize_judged(spark.createDataFrame([], SCHEMA), ["site"], 3600).collect() == []
