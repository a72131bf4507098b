"""Nearest weather stations of sites by great-circle distance, through an index of cells."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage, sized
from gridloom.sources.payloads import pick_station

EARTH_KM = 6371.0
#: Stations of the fullest cell, in multiples of the number wanted, at which the search begins.
FULL = 4
#: Cells have edges of 2 to the power of minus so much, on the unit sphere, at the finest.
FINEST = 20

_AXES = ("_x", "_y", "_z")


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance between points in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    half = lambda d: F.pow(F.sin(d / 2), 2)
    h = half(b - a) + F.cos(a) * F.cos(b) * half(F.radians(lon2) - F.radians(lon1))
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def on_sphere(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points in three dimensions: cells there know neither poles nor a date line."""
    a, b = F.radians(lat), F.radians(lon)
    return df.withColumns({"_x": F.cos(a) * F.cos(b), "_y": F.cos(a) * F.sin(b), "_z": F.sin(a)})


def cell(edge: float) -> list[Column]:
    return [F.floor(F.col(c) / F.lit(edge)).alias(f"_c{c}") for c in _AXES]


def first_level(stations: DataFrame, k: int) -> int:
    """The finest level needed: the coarsest at which no cell holds more than ``FULL * k`` stations.

    Without stations a single cell will do (-1).
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(FINEST))).alias("_level")
    rows = stations.select(*_AXES, levels)
    at = [F.floor(F.col(c) * F.pow(F.lit(2.0), "_level")).alias(f"_c{c}") for c in _AXES]
    counts = rows.groupBy("_level", *at).agg(F.count("*").alias("n")).groupBy("_level").agg(F.max("n").alias("n"))
    fits, most = counts.agg(F.min(F.when(F.col("n") <= FULL * k, F.col("_level"))), F.max("n")).first()
    return -1 if most is None else FINEST if fits is None else fits


def nearest_stations(sites: DataFrame, stations: DataFrame, k: int = 10, site: str = "site", station: str = "station") -> DataFrame:
    """``site, station, distance, rank`` of the ``k`` nearest stations of each site, in kilometres.

    Both tables have ``lat`` and ``lon``.  A site meets the stations of its own and the 26
    cells around it.  If ``k`` of them are no farther than a cell's edge nothing nearer can lie
    outside and the site is done; the others go on with cells of twice the edge.  Cells are
    small at first, so that sites among many stations meet few of them.  Of equally distant
    stations the smaller id comes first.  Rows without coordinates have no neighbours.
    """
    placed = lambda df, name: on_sphere(df.select(name, "lat", "lon").dropna().dropDuplicates([name]))
    there = cut_lineage(placed(stations, station).withColumnsRenamed({"lat": "_lat", "lon": "_lon"}))
    left = cut_lineage(placed(sites, site).withColumnsRenamed({c: f"{c}_s" for c in _AXES}))
    found = None
    for level in range(first_level(there, k), -2, -1):
        edge = 2.0**-level
        around = F.explode(F.array(*(F.struct(*(F.lit(d).alias(c) for d, c in zip(step, _AXES, strict=True))) for step in product((-1, 0, 1), repeat=3))))
        asked = left.withColumn("_d", around)
        asked = asked.withColumns({f"_c{c}": F.floor(F.col(f"{c}_s") / F.lit(edge)) + F.col(f"_d.{c}") for c in _AXES})
        met = asked.join(there.select("*", *cell(edge)), [f"_c{c}" for c in _AXES])
        km = great_circle_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
        chord = F.sqrt(sum((F.pow(F.col(f"{c}_s") - F.col(c), 2) for c in _AXES), F.lit(0.0)))
        met = met.select(site, station, km.alias("distance"), chord.alias("_chord"))
        rank = F.row_number().over(Window.partitionBy(site).orderBy("distance", station))
        best = cut_lineage(met.withColumn("rank", rank).filter(F.col("rank") <= k))
        if level > -1:
            # a little less than the edge, for distances that are equal but for rounding
            done = best.groupBy(site).agg(F.count_if(F.col("_chord") <= edge * (1 - 1e-9)).alias("_n")).filter(F.col("_n") >= k)
            done = sized(done.select(site))
            best, left = best.join(done, site, "left_semi"), cut_lineage(left.join(done, site, "left_anti"))
        found = best if found is None else found.unionByName(best)
        if level > -1 and left.isEmpty():
            break
    return found.select(site, station, "distance", "rank")


def nearest_reaching_station(sites: DataFrame, stations: DataFrame, end: Column, k: int = 10) -> DataFrame:
    """Of the ``k`` nearest stations of a site the nearest whose data reaches ``end``, or the latest date these have.

    ``stations`` has station, lat, lon and hourly_end.
    """
    near = nearest_stations(sites, stations, k)
    return pick_station(near.join(stations.select("station", "hourly_end"), "station"), end)
