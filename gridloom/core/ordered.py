"""Order-dependent operators that never put a whole series into one task.

A plain ``Window.partitionBy(series)`` sends every row of a series to one task, which
fails as soon as one series holds a large part of the data.  Here a series is cut into
*chunks* (for instance its days).  Windows run inside ``(series, chunk)``; what has to
cross a chunk border travels through an *edge table* with one row per series and chunk,
built by a partially aggregated ``groupBy``.  Row-bounded rolling windows are cut by row
ordinal instead of time, so their blocks have the same size however dense the series is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage, sized

CHUNK = "_chunk"
CHUNK_ORDER = "_chunk_order"
BLOCK = "_block"
ORDINAL = "_ordinal"


@dataclass(frozen=True)
class Series:
    """Identity, total order and chunking of an ordered series.

    ``chunk`` is a ``date_trunc`` unit applied to the first order column, or an integer
    width for a numeric first order column, or the name of an existing column that
    rises with the order.  ``units`` lists the series (keys, _unit) that need a finer unit.
    With ``deep`` a series has so many chunks that its edges are chunked again.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunk: str | int = "day"
    units: DataFrame | None = field(default=None, compare=False)
    deep: bool = False

    _UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond")

    def chunked(self, df: DataFrame) -> DataFrame:
        """``df`` with the chunk of each row."""
        first = F.col(self.order[0])
        if isinstance(self.chunk, int):
            return df.withColumn(CHUNK, F.floor(first / F.lit(self.chunk)))
        if self.chunk not in self._UNITS:
            return df.withColumn(CHUNK, F.col(self.chunk))
        usual = F.date_trunc(self.chunk, first)
        if self.units is None:
            return df.withColumn(CHUNK, usual)
        finer = F.coalesce(*[F.when(F.col("_unit") == u, F.date_trunc(u, first)) for u in FIT_UNITS], usual)
        return df.join(self.units, list(self.keys), "left").withColumn(CHUNK, finer).drop("_unit")

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)

    def chunk_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(CHUNK)

    def of_chunks(self) -> Series:
        """The chunks of this series as a series, in chunks of their own."""
        timed = self.chunk in self._UNITS
        return Series(self.keys, (CHUNK_ORDER,), "month" if timed else EDGE_BLOCK)


# Chunk units from coarse to fine, for :func:`fit_series`.
FIT_UNITS = ("day", "hour", "minute", "second", "millisecond")
#: Edges in a chunk of edges, and chunks of a series beyond which edges are chunked.
EDGE_BLOCK, MANY_CHUNKS = 4096, 1_000_000


def fit_series(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_chunk: int = 2_000_000, many_chunks: int = MANY_CHUNKS
) -> Series:
    """Series whose chunks are checked to stay below ``rows_per_chunk`` rows.

    One scan counts the rows of each series and day, summed within tasks first.  Only series
    with a day that is too full are counted again, by millisecond, and each of them gets the
    coarsest unit that fits, so one dense series does not cut all the others finer.  Rows of
    one and the same millisecond cannot be cut; too many of them are an error.
    """
    keys = list(keys)
    unit = F.date_trunc("day", order[0]).alias(CHUNK)
    days = cut_lineage(df.groupBy(*keys, unit).agg(F.count("*").alias("n")))
    per_series = days.groupBy(*keys).agg(F.max("n").alias("largest"), F.sum("n").alias("rows"), F.count("*").alias("chunks"))
    most = per_series.agg(F.max("largest"), F.max("rows"), F.max("chunks")).first()
    deep = max((most[1] or 0) // 8192, most[2] or 0) > many_chunks
    if (most[0] or 0) <= rows_per_chunk:
        return Series(tuple(keys), tuple(order), "day", None, deep)
    full = sized(per_series.filter(F.col("largest") > rows_per_chunk).select(*keys))
    fine = df.join(full, keys, "left_semi").groupBy(*keys, F.date_trunc("millisecond", order[0]).alias("_at"))
    fine = cut_lineage(fine.agg(F.count("*").alias("n")))
    found = None
    for name in FIT_UNITS[1:]:
        chunks = fine.groupBy(*keys, F.date_trunc(name, "_at")).agg(F.sum("n").alias("n"))
        level = chunks.groupBy(*keys).agg(F.max("n").alias("largest"), F.count("*").alias("chunks")).withColumn("_unit", F.lit(name))
        found = level if found is None else found.unionByName(level)
    finest = F.array_position(F.array(*[F.lit(u) for u in FIT_UNITS]), F.col("_unit"))
    chosen = found.filter(F.col("largest") <= rows_per_chunk).groupBy(*keys)
    units = sized(chosen.agg(F.min_by("_unit", finest).alias("_unit"), F.min_by("chunks", finest).alias("chunks")))
    stuck = full.join(units, keys, "left_anti").first()
    if stuck is not None:
        raise ValueError(f"more than {rows_per_chunk} rows of {stuck.asDict()} share one time stamp")
    deep = deep or (units.agg(F.max("chunks")).first()[0] or 0) > many_chunks
    return Series(tuple(keys), tuple(order), "day", units.drop("chunks"), deep)


def series(keys: Sequence[str], order: Sequence[str], chunk: str | int = "day") -> Series:
    return Series(tuple(keys), tuple(order), chunk)


def scan(
    df: DataFrame,
    by: Series,
    *,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    fill: Mapping[str, str] | None = None,
    total: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add neighbour values, forward fills and running totals along each series.

    ``lead``/``lag`` map a new name to the column taken from the next/previous row,
    ``fill`` maps a new name to the column whose last non-null value up to the row is
    wanted, ``total`` maps a new name to the expression summed up to and including the
    row.  One shuffle on ``(series, chunk)`` serves all of them.
    """
    given = (dict(m or {}) for m in (lead, lag, fill, total))
    return _scan(df, by, *given)


def _scan(df: DataFrame, by: Series, lead: dict, lag: dict, fill: dict, total: dict, up_to: int = 0) -> DataFrame:
    """:func:`scan`; fills and totals reach up to the row (0) or to the one before it (-1)."""
    df = by.chunked(df)
    for name, expr in total.items():
        df = df.withColumn(f"_t_{name}", F.coalesce(expr, F.lit(0)))

    w = by.window()
    running = w.rowsBetween(Window.unboundedPreceding, up_to)
    position = F.struct(*by.order)

    inner: dict[str, Column] = {}
    edge_aggs: list[Column] = []
    edge_lead, edge_lag, edge_fill, edge_total = {}, {}, {}, {}
    if lead:
        row = F.struct(*[F.col(c).alias(n) for n, c in lead.items()])
        inner["_lead"] = F.lead(row).over(w)
        edge_aggs.append(F.min_by(row, position).alias("_first"))
        edge_lead["_after"] = "_first"
    if lag:
        row = F.struct(*[F.col(c).alias(n) for n, c in lag.items()])
        inner["_lag"] = F.lag(row).over(w)
        edge_aggs.append(F.max_by(row, position).alias("_last"))
        edge_lag["_before"] = "_last"
    for name, source in fill.items():
        value = F.col(source)
        inner[f"_f_{name}"] = F.last(value, ignorenulls=True).over(running)
        edge_aggs.append(
            F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_e_{name}")
        )
        edge_fill[f"_c_{name}"] = f"_e_{name}"
    for name in total:
        inner[f"_r_{name}"] = F.sum(f"_t_{name}").over(running)
        edge_aggs.append(F.sum(f"_t_{name}").alias(f"_s_{name}"))
        edge_total[f"_p_{name}"] = F.col(f"_s_{name}")

    join_keys = [*by.keys, CHUNK]
    edges = df.groupBy(*join_keys).agg(*edge_aggs)
    carried = [*edge_lead, *edge_lag, *edge_fill, *edge_total]
    if by.deep:
        # the edges are a series themselves
        ordered = edges.withColumnRenamed(CHUNK, CHUNK_ORDER)
        edges = _scan(ordered, by.of_chunks(), edge_lead, edge_lag, edge_fill, edge_total, -1).withColumnRenamed(CHUNK_ORDER, CHUNK)
    else:
        before = by.chunk_window().rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.withColumns(
            {n: F.lead(c).over(by.chunk_window()) for n, c in edge_lead.items()}
            | {n: F.lag(c).over(by.chunk_window()) for n, c in edge_lag.items()}
            | {n: F.last(c, ignorenulls=True).over(before) for n, c in edge_fill.items()}
            | {n: F.sum(c).over(before) for n, c in edge_total.items()}
        )
    out = df.withColumns(inner).join(edges.select(*join_keys, *carried), join_keys, "left")

    result: dict[str, Column] = {}
    if lead:
        row = F.coalesce("_lead", "_after")
        result.update({n: row[n] for n in lead})
    if lag:
        row = F.coalesce("_lag", "_before")
        result.update({n: row[n] for n in lag})
    for name in fill:
        result[name] = F.coalesce(f"_f_{name}", f"_c_{name}")
    for name in total:
        result[name] = F.coalesce(f"_r_{name}", F.lit(0)) + F.coalesce(f"_p_{name}", F.lit(0))
    keep = [c for c in df.columns if c != CHUNK and not c.startswith("_t_")]
    return out.select(*[c for c in keep if c not in result], *[v.alias(k) for k, v in result.items()])


def global_position(df: DataFrame, order: Sequence[str], name: str = ORDINAL) -> DataFrame:
    """1-based position of each row in the order of the whole table.

    Rows are dealt out by ranges of the order, so no task holds more than its share however
    the values cluster; only one count per range is summed up.  Rows equal in ``order`` get
    some order of their own.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = cut_lineage(placed.withColumn("_range", F.shiftright("_id", 33)))
    counts = stored.groupBy("_range").agg(F.count("*").alias("_n"), F.lit(1).alias("_all"))
    before = Window.partitionBy("_all").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized(counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    within = F.col("_id") - F.shiftleft("_range", 33) + 1
    return stored.join(offsets, "_range").withColumn(name, F.col("_offset") + within).drop("_id", "_range", "_offset")


def ordinal(df: DataFrame, by: Series, name: str = ORDINAL) -> DataFrame:
    """1-based position of each row in its series."""
    return scan(df, by, total={name: F.lit(1).cast("bigint")})


def rolling(
    df: DataFrame,
    by: Series,
    before: int,
    after: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    block_rows: int = 8192,
) -> DataFrame:
    """Run row-bounded window expressions over equally sized blocks with a halo.

    ``build`` receives rows with ``_ordinal`` and the window spec of a block; it may look
    ``before`` rows back and ``after`` rows ahead.  Rows near a border are copied into the
    neighbouring block and dropped again, so the result has exactly the input rows.
    The result keeps ``_ordinal`` and ``_block`` for a following :func:`scan` with
    ``chunk="_block"``, which then needs no further shuffle of the rows.
    """
    if max(before, after) >= block_rows:
        raise ValueError("the halo must be smaller than a block")
    place = (F.col(ORDINAL) - 1) % block_rows
    home = F.floor((F.col(ORDINAL) - 1) / block_rows)
    copies = F.array_compact(
        F.array(
            home,
            F.when(place >= block_rows - before, home + 1),
            F.when((place < after) & (home > 0), home - 1),
        )
    )
    rows = (
        ordinal(df, by)
        .withColumn("_home", home)
        .withColumn(BLOCK, F.explode(copies))
    )
    w = Window.partitionBy(*by.keys, BLOCK).orderBy(ORDINAL)
    return build(rows, w).filter(F.col("_home") == F.col(BLOCK)).drop("_home")


def islands(df: DataFrame, by: Series, is_break: Column, name: str = "island") -> DataFrame:
    """Number the stretches between break rows: running count of breaks per series."""
    flag = F.when(F.coalesce(is_break, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
    return scan(df, by, total={name: flag.cast("bigint")})


def runs(
    df: DataFrame,
    by: Series,
    condition: Column,
    aggs: Sequence[Column],
    is_break: Column | None = None,
) -> DataFrame:
    """Collapse maximal runs of rows meeting ``condition`` into one row each.

    A row that breaks a run is one where ``condition`` is false or unknown, unless
    ``is_break`` says otherwise.
    """
    holds = F.coalesce(condition, F.lit(False))
    marked = df.withColumn("_holds", holds)
    breaks = ~F.col("_holds") if is_break is None else is_break
    numbered = islands(marked, by, breaks)
    return numbered.filter("_holds").groupBy(*by.keys, "island").agg(*aggs)
