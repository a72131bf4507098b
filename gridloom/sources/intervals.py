"""Interval CSV files in wide layout, read as long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.core.ordered import series
from gridloom.core.session import sized
from gridloom.functions.scalars import to_number
from gridloom.operators.timeaxis import dedupe_first, split_range, upsample_linear

# Time stamp formats of interval files, with and without offset.
ZONED_FORMATS = ("yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXXX")
LOCAL_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy-MM-dd")


def parse_local_time(text: Column, tz: Column | None = None) -> Column:
    """Text to site wall clock; a stamp with an offset is moved to the site's zone."""
    zoned = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ZONED_FORMATS])
    local = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in LOCAL_FORMATS])
    if tz is not None:
        zoned = F.from_utc_timestamp(zoned, tz)
    return F.coalesce(local, zoned).cast("timestamp_ntz")


def read_wide_csv(spark: SparkSession, path: str | list[str], tz: Column | None = None) -> DataFrame:
    """Rows (file, attribute, ts, value) of CSV files with any set of columns.

    The header of a file is its first line with more than one field whose first field is
    not a time stamp; other such lines (footers, totals) are no data.  Lines and headers are
    matched by file and position, so files of different width need no schema and no pass
    over them from the driver.  Lines are told apart by the offset at which a split of the
    file begins and their order in it.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("no")).alias("line_no"),
        F.col("value").alias("line"),
    )
    return wide_rows(lines, tz)


def wide_rows(lines: DataFrame, tz: Column | None = None) -> DataFrame:
    """Rows of :func:`read_wide_csv` from lines (file, line_no, line)."""
    lines = lines.select("file", "line_no", F.split("line", r',(?=(?:[^"]*"[^"]*")*[^"]*$)').alias("_f"))
    stamped = lines.withColumn("ts", parse_local_time(F.trim(F.col("_f")[0]), tz))
    cells = F.posexplode(F.slice("_f", 2, F.greatest(F.size("_f") - 1, F.lit(0)))).alias("_pos", "_cell")
    heads = stamped.filter(F.col("ts").isNull() & (F.size("_f") > 1)).groupBy("file").agg(F.min_by("_f", "line_no").alias("_f"))
    names = heads.select("file", cells).select("file", "_pos", F.trim(F.regexp_replace("_cell", '"', "")).alias("attribute"))
    values = stamped.filter(F.col("ts").isNotNull()).select("file", "ts", cells)
    return values.join(names, ["file", "_pos"]).select(
        "file", "attribute", "ts", to_number(F.trim("_cell")).alias("value")
    )


def numeric_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Only the numeric columns of a wide table, besides the ones to ``keep``."""
    numeric = (T.NumericType,)
    return df.select(*[f.name for f in df.schema.fields if f.name in keep or isinstance(f.dataType, numeric)])


def in_period(df: DataFrame, start: str, end: str, ts: str = "ts") -> DataFrame:
    """Rows of the half-open range ``[start, end)``; the bounds reach the scan."""
    lower, upper = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return df.filter((F.col(ts) >= lower) & (F.col(ts) < upper))


def common_attributes(rows: DataFrame, file="file", site: Sequence[str] = ()) -> DataFrame:
    """Rows of the attributes that every file of their site has (of all files without ``site``)."""
    site = list(site)
    pairs = rows.select(*site, file, "attribute").distinct()
    one = F.lit(1).alias("_all")
    files = pairs.select(*site, one, file).distinct().groupBy(*site, "_all").agg(F.count("*").alias("_files"))
    has = pairs.groupBy(*site, one, "attribute").agg(F.count("*").alias("_has"))
    shared = sized(has.join(files, [*site, "_all"]).filter(F.col("_has") == F.col("_files")).select(*site, "attribute"))
    return rows.join(shared, [*site, "attribute"], "left_semi")


def load_periods(
    rows: DataFrame, latest: DataFrame, keys: Sequence[str] = ("attribute", "ts"), upsample: bool = False
) -> DataFrame:
    """Several periods as one series.

    ``latest`` holds the file of each period to use.  Only attributes common to all of a
    site's files stay (``keys`` besides attribute and ts name the site); of equal time stamps
    the first file's counts.  With ``upsample`` coarse
    series are interpolated to one minute.
    """
    chosen = rows.join(latest.select("file"), "file", "left_semi")
    site = [k for k in keys if k not in ("attribute", "ts")]
    out = dedupe_first(common_attributes(chosen, site=site), list(keys), ["file"])
    if not upsample:
        return out
    ids = [k for k in keys if k != "ts"]
    fine = upsample_linear(out, series(ids, ["ts"], "month"), ["value"], 60)
    return fine.withColumnRenamed("label", "ts")


def read_interval_table(
    spark: SparkSession, url: str, table: str, ranges: DataFrame, column: str, days: int = 9, **options: str
) -> DataFrame:
    """Database interval rows, one partition per ``days`` long part of the range.

    ``ranges`` is a single row with ``start`` and ``end``; the parts become the
    partition predicates.
    """
    parts = split_range(ranges, days).select("range_start", "range_end").orderBy("range_start").collect()
    predicates = [f"{column} >= '{p.range_start}' AND {column} < '{p.range_end}'" for p in parts]
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(options))
