import datetime as dt

import pytest
from tests.helpers import rows, ts
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, IsNotNull, LessThan, LessThanOrEqual

from gridloom.sources.segmented import SegmentedSource, SegmentReader, read_segments, segments

START, END = ts("2024-01-01T00:00:00"), ts("2024-01-21T00:00:00")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("segments") / "readings")
    df = spark.range(0, 24 * 20).selectExpr(
        "id", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,id,0,0) ts", "concat('s', id % 3) site", "if(id % 7 = 0, null, id / 2.0D) v"
    )
    df.repartitionByRange(4, "ts").write.parquet(path)
    return path


def reader_of(folder, days=3):
    options = {"path": folder, "time": "ts", "start": START.isoformat(), "end": END.isoformat(), "days": str(days)}
    source = SegmentedSource(options)
    return SegmentReader(source.schema(), options)


def test_segments_cover_the_range():
    parts = segments(START, END, 9)
    assert [(p.end - p.start).days for p in parts] == [9, 9, 2]
    assert parts[0].start == START and parts[-1].end == END and all(a.end == b.start for a, b in zip(parts, parts[1:], strict=False))
    assert segments(END, START, 9) == []


def test_filters_prune_partitions(folder):
    r = reader_of(folder)
    assert len(r.partitions()) == 7
    day = dt.timedelta(days=1)
    given = [GreaterThanOrEqual(("ts",), START + 4 * day), LessThan(("ts",), START + 8 * day), EqualTo(("site",), "s1"), IsNotNull(("v",))]
    assert list(r.pushFilters(given)) == given[3:]
    assert [(p.start, p.end) for p in r.partitions()] == [(START + 4 * day, START + 7 * day), (START + 7 * day, START + 8 * day)]
    got = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert {x["site"] for x in got} == {"s1"} and len(got) == 32
    r = reader_of(folder)
    assert list(r.pushFilters([GreaterThan(("ts",), START), LessThanOrEqual(("ts",), START)])) == []
    assert [x for p in r.partitions() for x in r.read(p)] == []


def test_scan_equals_spark(spark, folder):
    plain = spark.read.parquet(folder)
    got = read_segments(spark, "ts", START, END, days=3, path=folder)
    assert got.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert got.rdd.getNumPartitions() == 7 and rows(got) == rows(plain)
    some = (F.col("ts") >= F.lit(START).cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-05 06:00").cast("timestamp_ntz"))
    some = some & (F.col("site") == "s2") & F.col("v").isNotNull()
    narrow = got.filter(some)
    assert rows(narrow) == rows(plain.filter(some)) and narrow.count() > 10
    assert narrow.rdd.getNumPartitions() == 2  # 4.25 days


def test_empty_range(spark, folder):
    assert read_segments(spark, "ts", END, START, path=folder).count() == 0
