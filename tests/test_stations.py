import math
import random

import pytest
from tests.helpers import rows, ts
from pyspark.sql import functions as F

from gridloom.sources.stations import first_level, nearest_reaching_station, nearest_stations, on_sphere


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def points(rng, n, dense):
    out = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    out += [(40 + rng.random(), -100 + rng.random()) for _ in range(dense)]
    return out + [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (1.0, 179.9), (89.9, 120.0)]


@pytest.mark.parametrize(("n", "dense", "k"), [(60, 300, 10), (5, 0, 3), (3, 0, 20)])
def test_equals_all_pairs(spark, n, dense, k):
    rng = random.Random(n)
    sites, stations = points(rng, 40, 20), points(rng, n, dense)
    a = spark.createDataFrame([(i, *x) for i, x in enumerate(sites)] + [(900, None, 1.0)], "site int, lat double, lon double")
    b = spark.createDataFrame([(i, *x) for i, x in enumerate(stations)] + [(901, 1.0, None)], "station int, lat double, lon double")
    got = {(r.site, r["rank"]): (r.station, r.distance) for r in nearest_stations(a, b, k).collect()}
    assert len(got) == len(sites) * min(k, len(stations))
    for i, p in enumerate(sites):
        near = sorted(km(p, q) for q in stations)[:k]
        for rank, want in enumerate(near, 1):
            station, distance = got[i, rank]
            assert distance == pytest.approx(want, abs=1e-6) and km(p, stations[station]) == pytest.approx(want, abs=1e-6)


def test_search_begins_where_cells_are_not_full(spark):
    same = spark.range(50).select(F.lit(10.0).alias("lat"), F.lit(20.0).alias("lon"))
    assert first_level(on_sphere(same), 20) == 0 and first_level(on_sphere(same), 10) == 20


def test_station_that_reaches_the_end(spark):
    sites = spark.createDataFrame([("a", 0.0, 0.0)], "site string, lat double, lon double")
    stations = [(1, 0.0, 1.0, ts("2024-01-05")), (2, 0.0, 2.0, ts("2024-02-05")), (3, 0.0, 3.0, ts("2024-02-05")), (4, 0.0, 9.0, ts("2024-09-01"))]
    stations = spark.createDataFrame(stations, "station int, lat double, lon double, hourly_end timestamp_ntz")
    end = F.lit("2024-03-01").cast("timestamp_ntz")
    # the fourth reaches the end but is not among the nearest three, whose data ends in February
    assert rows(nearest_reaching_station(sites, stations, end, 3), "site", "station") == [("a", 2)]
    assert rows(nearest_reaching_station(sites, stations, end, 4), "site", "station") == [("a", 4)]
    assert nearest_stations(sites.limit(0), stations, 3).collect() == []
