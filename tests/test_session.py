import os

import pytest
from pyspark.sql import SparkSession

from gridloom.core.session import cut_lineage, scratch, shared_folder, sized, use_folder


def folder_of(df):
    """Where a stored table lies; other programs may use the shared folder too."""
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_stored_tables_go_with_their_scope(spark):
    lasting = cut_lineage(spark.range(2))
    with scratch(spark):
        outer = cut_lineage(spark.range(5))
        with scratch(spark):
            inner = sized(spark.range(3))
            paths = [folder_of(x) for x in (lasting, outer, inner)]
            assert inner.count() == 3 and all(map(os.path.isdir, paths))
            assert all(x.startswith(shared_folder(spark).removeprefix("file:")) for x in paths)
        assert [os.path.isdir(x) for x in paths] == [True, True, False] and outer.count() == 5
    assert [os.path.isdir(x) for x in paths] == [True, False, False]


def test_a_named_folder_is_not_replaced(spark):
    before = shared_folder(spark)
    use_folder(spark, "/elsewhere")
    assert shared_folder(spark) == before


def test_there_is_no_default_folder():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"x": 1}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    assert SparkSession is not None
