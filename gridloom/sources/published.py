"""Published tables: readers see whole commits, retries and conflicts are told apart.

A table is a folder with data and commit records::

    data/attempt=<id>/site=.../month=.../part-*.parquet
    commits/version=<n>/part-*.parquet

A write first stores its rows under an attempt of its own, then a record of the partitions it
holds, and at last renames the record to the next version.  The rename is atomic and fails if
that version is there, on HDFS and on local disks; stores without such a rename are not fit
for the records.  Rows of an attempt that no record names are invisible, so a write that
stopped halfway leaves nothing to see.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

APPEND, REPLACE, INSERT = "append", "replace", "insert"
ATTEMPT, VERSION = "attempt", "version"


class Conflict(Exception):
    """Another commit has changed partitions that this write relies on."""


@dataclass(frozen=True)
class Commit:
    version: int
    #: False if this run was committed before and nothing was written
    new: bool


class Published:
    """A partitioned table at ``path``; its partition columns are strings and never null."""

    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ("site", "month")):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), tuple(partitions)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        root = self._path(self.path)
        self._fs = root.getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        none = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
        self._rename_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        self._rename_options[0] = none

    # ------------------------------------------------------------------ reading

    def _record_type(self) -> T.StructType:
        columns = [T.StructField(c, T.StringType()) for c in self.partitions]
        own = [T.StructField(c, T.StringType()) for c in ("run", "kind", ATTEMPT, "schema")]
        return T.StructType([*columns, *own, T.StructField("n_rows", T.LongType()), T.StructField(VERSION, T.LongType())])

    def last_version(self) -> int:
        """The newest version, 0 before the first commit; one listing of the records."""
        folder = self._path(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return 0
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return max((int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}=")), default=0)

    def commits(self, version: int | None = None) -> DataFrame:
        """Records up to ``version``: one row per commit without partition, and one per partition it holds."""
        last = self.last_version()
        if not last:
            return self.spark.createDataFrame([], self._record_type())
        rows = self.spark.read.schema(self._record_type()).parquet(f"{self.path}/commits")
        return rows.filter(F.col(VERSION) <= (last if version is None else version))

    def live(self, version: int | None = None) -> DataFrame:
        """Partitions and the attempts whose rows they show: the last replacement and what came after."""
        held = self.commits(version).filter(F.col(self.partitions[0]).isNotNull())
        fresh = held.groupBy(*self.partitions).agg(F.max(F.when(F.col("kind") == REPLACE, F.col(VERSION))).alias("_since"))
        shown = held.join(fresh, list(self.partitions)).filter(F.col(VERSION) >= F.coalesce("_since", F.lit(0)))
        return shown.select(*self.partitions, ATTEMPT, VERSION, "n_rows")

    def schema(self, version: int | None = None) -> T.StructType | None:
        """Columns of the newest commit with rows."""
        rows = self.commits(version).filter(F.col("schema").isNotNull())
        newest = rows.agg(F.max_by("schema", VERSION)).first()[0]
        return T.StructType.fromJson(json.loads(newest)) if newest else None

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The rows of one version.  Folders are pruned by the records, rows are never compared.

        A version that is read goes on to exist whatever is committed meanwhile.
        """
        version = self.last_version() if version is None else version
        schema = self.schema(version)
        if schema is None:
            raise ValueError(f"nothing is published at {self.path}")
        stored = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.path}/data")
        return rows.join(self.live(version).select(*self.partitions, ATTEMPT), [*self.partitions, ATTEMPT], "left_semi").drop(ATTEMPT)

    # ------------------------------------------------------------------ writing

    def append(self, df: DataFrame, run: str) -> Commit:
        """Add rows.  A run that was committed before is not written again."""
        return self._write(df, run, APPEND)

    def replace(self, df: DataFrame, run: str, base: int | None = None) -> Commit:
        """Replace exactly the partitions that ``df`` holds.

        ``base`` is the version that ``df`` was computed from (default: the newest one now).  If
        one of these partitions was changed after it, the write is a :class:`Conflict`.
        """
        return self._write(df, run, REPLACE, base)

    def insert(self, df: DataFrame, run: str) -> Commit:
        """Add the partitions of ``df`` that are not there yet; the others keep what they have."""
        base = self.last_version()
        there = self.live(base).select(*self.partitions).distinct()
        return self._write(df.join(there, list(self.partitions), "left_anti"), run, INSERT, base)

    def _write(self, df: DataFrame, run: str, kind: str, base: int | None = None) -> Commit:
        base = self.last_version() if base is None else base
        done = self._version_of(run)
        if done:
            return Commit(done, False)
        attempt = self.stage(df)
        return self.commit(df.schema, attempt, run, kind, base)

    def stage(self, df: DataFrame) -> str:
        """Store rows under a new attempt, which nobody sees before its commit."""
        attempt = uuid.uuid4().hex
        columns = [F.col(c).cast("string").alias(c) if c in self.partitions else F.col(c) for c in df.columns]
        named = reduce(lambda a, c: a & F.col(c).isNotNull(), self.partitions, F.lit(True))
        checked = df.select(*columns).withColumn(self.partitions[0], self._or_fail(named))
        checked.hint("rebalance", *self.partitions).write.partitionBy(*self.partitions).parquet(self._data(attempt))
        return attempt

    def _or_fail(self, named: Column) -> Column:
        return F.when(named, F.col(self.partitions[0])).otherwise(F.raise_error(F.lit("a partition column is null")))

    def commit(self, schema: T.StructType, attempt: str, run: str, kind: str, base: int) -> Commit:
        """Publish a stored attempt as the next version after all that was committed since ``base``."""
        record = f"{self.path}/pending/{attempt}"
        self._store_record(schema, attempt, run, kind, record)
        while True:
            last = self.last_version()
            done = self._version_of(run)
            if done:
                return Commit(done, False)
            if kind != APPEND and self._changed(record, base, last):
                raise Conflict(f"partitions of run {run} were changed after version {base}")
            if self._renamed(record, f"{self.path}/commits/{VERSION}={last + 1}"):
                return Commit(last + 1, True)

    def _store_record(self, schema: T.StructType, attempt: str, run: str, kind: str, path: str) -> None:
        strings = {c: T.StructField(c, T.StringType()) for c in self.partitions}
        stored = T.StructType([strings.get(f.name, f) for f in schema.fields])
        parts = self.spark.read.schema(stored).option("basePath", self._data(attempt)).parquet(self._data(attempt))
        parts = parts.groupBy(*self.partitions).agg(F.count("*").alias("n_rows")).withColumn("schema", F.lit(None).cast("string"))
        nulls = [F.lit(None).cast("string").alias(c) for c in self.partitions]
        mark = self.spark.range(1).select(*nulls, F.lit(0).cast("long").alias("n_rows"), F.lit(stored.json()).alias("schema"))
        rows = parts.unionByName(mark).withColumns({"run": F.lit(run), "kind": F.lit(kind), ATTEMPT: F.lit(attempt)})
        rows.write.parquet(path)

    def _changed(self, record: str, base: int, last: int) -> bool:
        """Whether a commit after ``base`` holds a partition of this record."""
        if last <= base:
            return False
        mine = self.spark.read.parquet(record).filter(F.col(self.partitions[0]).isNotNull()).select(*self.partitions)
        since = self.commits(last).filter(F.col(VERSION) > base).select(*self.partitions)
        return not mine.join(since, list(self.partitions), "left_semi").isEmpty()

    def _renamed(self, source: str, target: str) -> bool:
        """Rename a folder; False if somebody else has taken the target."""
        self._fs.mkdirs(self._path(target).getParent())
        try:
            self._files.rename(self._path(source), self._path(target), self._rename_options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or self._fs.exists(self._path(target)):
                return False
            raise
        return True

    def _version_of(self, run: str) -> int:
        found = self.commits().filter((F.col("run") == run) & F.col("schema").isNotNull())
        return found.agg(F.min(VERSION)).first()[0] or 0

    def _data(self, attempt: str) -> str:
        return f"{self.path}/data/{ATTEMPT}={attempt}"

    def unpublished(self) -> list[str]:
        """Attempts without a record: writes under way, or ones that stopped halfway."""
        folder = self._path(f"{self.path}/data")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName().split("=")[1] for s in self._fs.listStatus(folder) if s.getPath().getName().startswith(ATTEMPT)]
        there = self.spark.createDataFrame([(n,) for n in names], f"{ATTEMPT} string")
        return sorted(r[0] for r in there.join(self.commits().select(ATTEMPT).distinct(), ATTEMPT, "left_anti").collect())
