import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from gridloom.sources.published import Conflict, Published

SCHEMA = "site string, month string, v int"


@pytest.fixture
def place(spark, tmp_path):
    return Published(spark, str(tmp_path / "table"))


def data(spark, *cells):
    return spark.createDataFrame(list(cells), SCHEMA)


def seen(place, version=None):
    return rows(place.snapshot(version), "site", "month", "v")


def test_versions_stay_readable(spark, place):
    with pytest.raises(ValueError, match="nothing is published"):
        place.snapshot()
    assert place.append(data(spark, ("a", "1", 1), ("b", "1", 2)), "r1").version == 1
    assert place.append(data(spark, ("a", "1", 3)), "r2").version == 2
    assert place.replace(data(spark, ("a", "1", 9), ("c", "1", 4)), "r3").version == 3
    assert place.append(data(spark, ("a", "1", 10)), "r4").version == 4
    assert seen(place, 1) == [("a", "1", 1), ("b", "1", 2)]
    assert seen(place, 2) == [("a", "1", 1), ("a", "1", 3), ("b", "1", 2)]
    assert seen(place, 3) == [("a", "1", 9), ("b", "1", 2), ("c", "1", 4)]
    assert seen(place) == [("a", "1", 10), ("a", "1", 9), ("b", "1", 2), ("c", "1", 4)]


def test_a_retried_run_is_written_once(spark, place):
    first = place.append(data(spark, ("a", "1", 1)), "r1")
    again = place.append(data(spark, ("a", "1", 1)), "r1")
    assert (first.version, first.new, again.version, again.new) == (1, True, 1, False)
    assert seen(place) == [("a", "1", 1)]


def test_a_write_that_stops_halfway_is_invisible(spark, place):
    place.append(data(spark, ("a", "1", 1)), "r1")
    # rows are stored, the record is not; then a job that fails while it stores rows
    attempt = place.stage(data(spark, ("a", "1", 2), ("z", "1", 3)))
    broken = data(spark, ("a", "1", 5), ("b", "2", 6)).repartition(2, "v")
    broken = broken.withColumn("v", F.when(F.col("v") == 6, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        place.append(broken, "r2")
    assert seen(place) == [("a", "1", 1)] and place.last_version() == 1
    assert attempt in place.unpublished()
    # the retry of the run counts once
    assert place.append(data(spark, ("a", "1", 5)), "r2").new
    assert seen(place) == [("a", "1", 1), ("a", "1", 5)]


def test_a_record_that_was_not_renamed_is_invisible(spark, place):
    place.append(data(spark, ("a", "1", 1)), "r1")
    df = data(spark, ("a", "1", 2))
    attempt = place.stage(df)
    place._store_record(df.schema, attempt, "r2", "append", f"{place.path}/pending/{attempt}")
    assert seen(place) == [("a", "1", 1)]


def test_conflicts(spark, place):
    place.append(data(spark, ("a", "1", 1), ("b", "1", 1)), "r1")
    base = place.last_version()
    place.replace(data(spark, ("a", "1", 2)), "r2", base)
    with pytest.raises(Conflict):
        place.replace(data(spark, ("a", "1", 3)), "r3", base)
    assert place.replace(data(spark, ("b", "1", 3)), "r4", base).version == 3  # other partitions do not matter
    assert seen(place) == [("a", "1", 2), ("b", "1", 3)]


def test_two_writers_of_one_version(spark, place):
    """Both are ready to become version 2; the second one finds it taken and goes on to 3."""
    place.append(data(spark, ("a", "1", 1)), "r1")
    df = data(spark, ("a", "1", 2))
    waiting = place.stage(df)
    taken = place._renamed

    def slower(source, target):
        place._renamed = taken
        place.append(data(spark, ("a", "1", 3)), "r2")
        return taken(source, target)

    place._renamed = slower
    assert place.commit(df.schema, waiting, "r3", "append", 1).version == 3
    assert seen(place) == [("a", "1", 1), ("a", "1", 2), ("a", "1", 3)]


def test_insert_keeps_what_is_there(spark, place):
    place.append(data(spark, ("a", "1", 1)), "r1")
    place.insert(data(spark, ("a", "1", 9), ("a", "2", 2)), "r2")
    place.insert(data(spark, ("a", "1", 9), ("a", "2", 8)), "r3")  # nothing new: an empty commit
    assert seen(place) == [("a", "1", 1), ("a", "2", 2)] and place.last_version() == 3


def test_null_partitions_are_refused_and_new_columns_are_null_before(spark, place):
    with pytest.raises(Exception, match="partition column is null"):
        place.append(data(spark, ("a", None, 1)), "r1")
    place.append(data(spark, ("a", "1", 1)), "r2")
    place.append(data(spark, ("a", "2", 2)).withColumn("w", F.lit("x")), "r3")
    assert rows(place.snapshot(), "month", "v", "w") == [("1", 1, None), ("2", 2, "x")]
    assert "w" not in place.snapshot(1).columns


def test_folders_are_pruned(spark, place):
    place.append(data(spark, ("a", "1", 1)), "r1")
    place.replace(data(spark, ("a", "1", 2)), "r2")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans shorten what is longer
    plan = place.snapshot().filter("site = 'a'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "(site" in filters and "dynamicpruning" in filters
