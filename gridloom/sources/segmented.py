"""Interval readings fetched by parts of their time range, as a Spark data source.

Historians, databases and web services answer requests of a few days each.  The source plans
one partition per part; filters on the time column move the ends of the range, so parts
outside are never asked for, and equalities go to the client.  What answers is a client class;
the one here reads Parquet files through Arrow.
"""

from __future__ import annotations

import datetime as dt
import importlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from gridloom.core.session import let_workers_import

TICK = dt.timedelta(microseconds=1)


class ParquetClient:
    """Answers a request from the Parquet files below ``path``; row groups outside are skipped."""

    def __init__(self, options: dict[str, str]):
        self.files = ds.dataset(options["path"], format="parquet", exclude_invalid_files=False)

    def schema(self) -> pa.Schema:
        return self.files.schema

    def fetch(self, time: str, start: dt.datetime, end: dt.datetime, equal: dict[str, list], columns: list[str]) -> Iterator[pa.RecordBatch]:
        kind = self.files.schema.field(time).type
        wanted = (pc.field(time) >= pa.scalar(start, kind)) & (pc.field(time) < pa.scalar(end, kind))
        for name, values in equal.items():
            wanted &= pc.field(name).isin(pa.array(values, self.files.schema.field(name).type))
        yield from self.files.to_batches(columns=columns, filter=wanted)


@dataclass
class Segment(InputPartition):
    start: dt.datetime
    end: dt.datetime

    def __post_init__(self):
        super().__init__((self.start, self.end))


def segments(start: dt.datetime, end: dt.datetime, days: float) -> list[Segment]:
    """Consecutive parts of ``[start, end)`` of at most ``days`` days."""
    width, out = dt.timedelta(days=days), []
    while start < end:
        out.append(Segment(start, min(start + width, end)))
        start += width
    return out


class SegmentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options, self.time = schema, dict(options), options["time"]
        self.start, self.end = (dt.datetime.fromisoformat(options[x]) for x in ("start", "end"))
        self.equal: dict[str, list] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the time column and equalities are met here in full, Spark does the rest."""
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if name == self.time and isinstance(getattr(f, "value", None), dt.datetime):
            at = f.value.replace(tzinfo=None)
            if isinstance(f, GreaterThanOrEqual):
                self.start = max(self.start, at)
            elif isinstance(f, GreaterThan):
                self.start = max(self.start, at + TICK)
            elif isinstance(f, LessThan):
                self.end = min(self.end, at)
            elif isinstance(f, LessThanOrEqual):
                self.end = min(self.end, at + TICK)
            else:
                return False
            return True
        if name in self.schema.names and name != self.time and name not in self.equal and isinstance(f, (EqualTo, In)):
            values = [f.value] if isinstance(f, EqualTo) else list(f.value)
            if values and all(isinstance(v, (str, int)) for v in values):
                self.equal[name] = values
                return True
        return False

    def partitions(self) -> list[Segment]:
        # a source without partitions would be asked for all of it once
        return segments(self.start, self.end, float(self.options["days"])) or [Segment(self.start, self.start)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        """One request; a failed one is repeated by Spark as a whole."""
        if partition.start >= partition.end:
            return
        wanted = to_arrow_schema(self.schema)
        client = client_of(self.options)
        for batch in client.fetch(self.time, partition.start, partition.end, self.equal, wanted.names):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, wanted, strict=True)], schema=wanted)


def client_of(options: dict[str, str]):
    module, _, name = options.get("client", f"{__name__}:ParquetClient").partition(":")
    return getattr(importlib.import_module(module), name)(options)


class SegmentedSource(DataSource):
    """Format ``gridloom_segments``: options ``time``, ``start``, ``end``, ``days``, ``client`` and the client's own."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_segments"

    def schema(self) -> StructType:
        return from_arrow_schema(client_of(dict(self.options)).schema(), prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(schema, dict(self.options))


def read_segments(
    spark: SparkSession, time: str, start: dt.datetime, end: dt.datetime, days: float = 9, **options: str
) -> DataFrame:
    """Rows with ``time`` in ``[start, end)``, one partition per part of ``days`` days.

    ``options`` go to the client (``path`` for the Parquet one); ``client`` names another
    class as ``module:Class``.
    """
    let_workers_import(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SegmentedSource)
    given = {"time": time, "start": start.isoformat(), "end": end.isoformat(), "days": str(days), **options}
    return spark.read.format(SegmentedSource.name()).options(**given).load()
