"""Utility meter files: five layout families turned into hourly energy.

Files arrive as a grid of cells (file, row_no, col_no, text).  What differs between the
sites' files is data: one row of the layout table per site.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, ordinal
from gridloom.core.session import cut_lineage, sized
from gridloom.functions.scalars import (
    add_time,
    floor_time,
    seconds_between,
    short_year_date,
    to_number,
)
from gridloom.operators.timeaxis import (
    beginning_labels,
    hour_ending_to_ts,
    instant_to_local,
    local_to_instant,
    repair_meter_hours,
    shift_rows,
)


@dataclass(frozen=True)
class Layout:
    """How to read one site's meter file.

    ``family``: wide_hours, quarter_labels, long_hours, timestamps or settlement.
    ``marker`` is a cell text found only in the header row.  ``value`` names the value
    column (a fragment, lower case; the first column by position that contains it, or the
    last one with ``last``), ``scale`` converts it to MWh.  ``lead_row`` says that the first
    row lacks its date and time.
    """

    family: str
    marker: str
    day: str
    hour: str = ""
    value: str = ""
    scale: float = 1.0
    day_format: str = "yyyy-MM-dd"
    hour_divisor: int = 1
    pad: int = 0
    drop_last: bool = False
    mean: bool = False
    shift: bool = False
    hour_offset: int = 0
    clock_columns: bool = False
    relabel: bool = False
    last: bool = False
    lead_row: bool = False


# Layouts by kind of file; a site refers to one of these by name.
LAYOUTS = {
    # day rows, hour-ending columns (hour 25 only with energy)
    "wide_hours_mwh": Layout("wide_hours", "Day", "Day"),
    "wide_other_days_mwh": Layout("wide_hours", "ALL OTHER DAYS", "ALL OTHER DAYS"),
    "wide_end_date_mwh": Layout("wide_hours", "End Date", "End Date"),
    "wide_date_kwh": Layout("wide_hours", "Date", "Date", scale=0.001),
    "wide_packed_date_mwh": Layout(
        "wide_hours", "DATE", "DATE", day_format="MMddyy", pad=6, clock_columns=True
    ),
    "wide_named_rows_mwh": Layout("wide_hours", "NAME", "Date"),
    # fifteen-minute interval-ending labels
    "quarter_flowday": Layout("quarter_labels", "Flowday", "Flowday", "Interval", "quantity (mwh)", last=True),
    "quarter_generation": Layout("quarter_labels", "Flowday", "Flowday", "Interval", "gen_mwh_int"),
    "quarter_import": Layout("quarter_labels", "Flowday", "Flowday", "Interval", "rtei_qty", scale=-1.0),
    # one row per day and hour
    "long_packed_kw": Layout(
        "long_hours", "DATE", "DATE", "HOUR", "kw", 0.001, "MMddyy", hour_divisor=100, pad=6
    ),
    "long_trading_kw": Layout("long_hours", "TradingDate", "TradingDate", "TradingHour", "meter_kw", 0.001),
    "long_scheduled_mwh": Layout("long_hours", "CT Date", "CT Date", "CT Hour", "scheduled", shift=True, day_format="M/d/yyyy"),
    "long_kwh": Layout("long_hours", "Hour", "Date", "Hour", "kwh", 0.001, "MM/dd/yyyy"),
    "long_clock_kwh": Layout(
        "long_hours", "DATE", "DATE", "TIME", "kwh.1", 0.001, "MM/dd/yyyy", hour_offset=1, relabel=True, lead_row=True
    ),
    # time stamped rows
    "stamped_mwh": Layout("timestamps", "Timestamp", "Timestamp", value="mwh"),
    "stamped_mw_total": Layout("timestamps", "HourBegin", "HourBegin", value="generation_mw", drop_last=True),
    "stamped_mean_mw": Layout("timestamps", "Timestamp", "Timestamp", value="metermw", mean=True),
    "stamped_quarter_kw": Layout("timestamps", "Timestamp", "Timestamp", value="kw", scale=1 / 4000),
}


def read_grid(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cells (file, row_no, col_no, text) of CSV or tab separated text files.

    A meter file holds a month of one site, so a file is read as one value and cut into
    lines.  Fields are separated by tabs if the file has any, else by commas outside of
    quotes; quotes around a field go, and an empty field is null.  A line break inside
    quotes is not supported.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    comma = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    lines = files.select(
        "file", F.contains("value", F.lit("\t")).alias("_tabs"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("row_no", "_line")
    )
    fields = F.when(F.col("_tabs"), F.split("_line", "\t")).otherwise(F.split("_line", comma))
    cells = lines.where(F.trim("_line") != "").select(
        "file", F.col("row_no").cast("bigint").alias("row_no"), F.posexplode(fields).alias("col_no", "_text")
    )
    bare = F.regexp_replace(F.trim("_text"), '^"(.*)"$', "$1")
    return cells.select("file", "row_no", "col_no", F.nullif(F.replace(bare, F.lit('""'), F.lit('"')), F.lit("")).alias("text"))


def header_rows(cells: DataFrame, marker: str, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Row number of the first row of each file with a cell equal to ``marker``."""
    return cells.filter(F.trim("text") == marker).groupBy(*keys).agg(F.min("row_no").alias("header_row"))


def grid_records(cells: DataFrame, marker: str | Column, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Rows below the header with their fields (col_no, label, text) by position.

    A repeated column name gets the suffixes ``.1``, ``.2`` in order of position.  Header and
    body are grouped by row first, so the cells are shuffled once; files without a header
    give no record (see :func:`unreadable`).
    """
    keys = list(keys)
    is_marker = F.trim("text") == (F.lit(marker) if isinstance(marker, str) else marker)
    rows = cells.groupBy(*keys, "row_no").agg(
        F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("col_no", F.trim("text").alias("text"))))).alias("_cells"),
        F.max(F.coalesce(is_marker, F.lit(False))).alias("_marked"),
    )
    first = F.min_by("_cells", "row_no").alias("_header"), F.min("row_no").alias("header_row")
    labels = rows.filter("_marked").groupBy(*keys).agg(*first)

    def named(x: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice("_header", 1, i), lambda y: y["text"] == x["text"]))
        label = F.when(earlier > 0, F.concat(x["text"], F.lit("."), earlier.cast("string"))).otherwise(x["text"])
        return F.struct(x["col_no"].alias("col_no"), label.alias("label"))

    labels = labels.select(*keys, "header_row", F.transform("_header", named).alias("_labels"))
    body = rows.join(labels, keys).filter(F.col("row_no") > F.col("header_row"))
    by_column = F.map_from_entries(F.col("_labels"))
    fields = F.filter(
        F.transform("_cells", lambda x: F.struct(x["col_no"].alias("col_no"), by_column[x["col_no"]].alias("label"), x["text"].alias("text"))),
        lambda x: x["label"].isNotNull(),
    )
    kept = [c for c in ("layout", "tz") if c in rows.columns and c not in keys]
    return body.select(*keys, *kept, "row_no", fields.alias("fields")).filter(F.size("fields") > 0)


def labelled_table(cells: DataFrame, marker: str, columns: Sequence[str], keys: Sequence[str] = ("file",)) -> DataFrame:
    """The named columns of a sheet below its header row, trimmed, one row per sheet row."""
    records = grid_records(cells, marker, keys)
    return records.select(*keys, "row_no", *[_named(c).alias(c) for c in columns])


def unreadable(cells: DataFrame, marker: str | Column, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Files without a header row, each with the reason."""
    is_marker = F.trim("text") == (F.lit(marker) if isinstance(marker, str) else marker)
    found = cells.groupBy(*keys).agg(F.max(F.coalesce(is_marker, F.lit(False))).alias("_found"))
    return found.filter(~F.col("_found")).select(*keys, F.lit("no header row").alias("error"))


def _heading_start(cells: DataFrame, marker: str, words: Sequence[str], keys: Sequence[str]) -> DataFrame:
    placed = cells.join(header_rows(cells, marker, keys), list(keys))
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(F.lower("text"), F.lit(word))
    heading = (F.col("row_no") == F.col("header_row") - 1) & hit
    return placed.groupBy(*keys).agg(F.min(F.when(heading, F.col("col_no"))).alias("_start"))


def site_columns(cells: DataFrame, marker: str, words: Sequence[str], keys=("file",)) -> DataFrame:
    """Cells of the two label columns and of the block that starts below a site's heading.

    The heading stands in the row above the header; the first column whose heading
    contains one of ``words`` opens the block.  Files without it: see
    :func:`without_heading`.
    """
    start = _heading_start(cells, marker, words, keys).filter("_start IS NOT NULL")
    return cells.join(start, list(keys)).filter(
        (F.col("col_no") < 2) | (F.col("col_no") >= F.col("_start"))
    ).select(*cells.columns)


def without_heading(cells: DataFrame, marker: str, words: Sequence[str], keys=("file",)) -> DataFrame:
    """Files with a header row but no heading with one of ``words`` above it, with the reason."""
    start = _heading_start(cells, marker, words, keys)
    return start.filter("_start IS NULL").select(*keys, F.lit("no site heading").alias("error"))


def _named(label: str) -> Column:
    """Text of the column with this name."""
    return F.get(F.filter("fields", lambda x: x["label"] == label), F.lit(0))["text"]


def _field(layout: Layout) -> Column:
    """Text of the value column, by position."""
    found = F.filter("fields", lambda x: F.contains(F.lower(x["label"]), F.lit(layout.value)))
    return (F.element_at(found, -1) if layout.last else F.get(found, F.lit(0)))["text"]


def _day(layout: Layout) -> Column:
    text = _named(layout.day)
    if layout.pad:
        text = F.lpad(text, layout.pad, "0")
    short = "yy" in layout.day_format and "yyyy" not in layout.day_format
    if short:
        return short_year_date(text, layout.day_format)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(text, F.lit(layout.day_format))),
        F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))),
    )


# Every family gives intervals: (keys, row_no, day, ts_local, nth, in_day, mwh).  ``ts_local``
# is the labelled start, ``nth`` the interval's place in its day from 0 and ``in_day`` the
# number of places that the day has in the file.


def wide_hours(records: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Day rows by hour-ending columns to hourly rows; hour 25 stays only with energy."""
    rows = records.withColumn("day", _day(layout)).filter(F.col("day").isNotNull())
    cells = rows.select(*keys, "row_no", "day", F.explode("fields").alias("_x"))
    name = F.col("_x.label")
    if layout.clock_columns:
        # clock headings: the hour before the colon, midnight closes the day
        hour = F.regexp_extract(name, r"(\d+):\d+", 1).try_cast("int")
        hour = F.when(hour == 0, 24).otherwise(hour)
    else:
        hour = F.regexp_replace(name, "[^0-9]", "").try_cast("int")
    long = cells.filter(name != layout.day).select(
        *keys, "row_no", "day", hour.alias("hour"), (to_number("_x.text") * layout.scale).alias("mwh")
    )
    valid = F.col("hour").between(1, 24) | ((F.col("hour") == 25) & (F.col("mwh") > 0))
    long = long.filter(valid)
    # a row is a day, so its columns are few
    in_row = Window.partitionBy(*keys, "row_no")
    return long.withColumns(
        {
            "ts_local": hour_ending_to_ts("day", F.least("hour", F.lit(24))),
            "nth": F.col("hour") - 1,
            "in_day": F.greatest(F.max("hour").over(in_row), F.lit(24)),
        }
    )


def _in_order(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add each row's place in its day, by its row number; a day of a file has few rows."""
    day = Window.partitionBy(*keys, "day")
    return rows.withColumns(
        {
            "nth": F.row_number().over(day.orderBy("row_no")) - 1,
            "in_day": F.count(F.lit(1)).over(day).cast("int"),
        }
    )


def quarter_labels(records: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Quarter-hour interval-ending labels to quarter hours by their beginning."""
    rows = records.withColumn("day", _day(layout)).filter(F.col("day").isNotNull()).select(
        *keys, "row_no", "day", _named(layout.hour).alias("label"), (to_number(_field(layout)) * layout.scale).alias("mwh"),
    )
    begun = beginning_labels(cut_lineage(rows), Series(tuple(keys), ("row_no",), 10_000), "label")
    hour = F.split("label", ":")[0].try_cast("int")
    stamped = begun.withColumn("ts_local", add_time(F.col("day").cast("timestamp_ntz"), hour, "hour"))
    return _in_order(stamped, keys)


def long_hours(records: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """One row per day and hour; packed hours are divided, clock times count from zero.

    With ``lead_row`` the first row of a file has neither date nor time: it gets the next
    row's date and midnight.
    """
    rows = records.select(*keys, "row_no", _day(layout).alias("day"), _named(layout.hour).alias("_hour"), _field(layout).alias("_value"))
    if layout.lead_row:
        start = rows.groupBy(*keys).agg(
            F.min("row_no").alias("_first"), F.min_by("day", F.when(F.col("day").isNotNull(), F.col("row_no"))).alias("_day")
        )
        lead = (F.col("row_no") == F.col("_first")) & F.col("day").isNull()
        rows = rows.join(start, list(keys)).withColumns(
            {"_hour": F.when(lead, F.lit("00:00")).otherwise(F.col("_hour")), "day": F.when(lead, F.col("_day")).otherwise(F.col("day"))}
        )
    clock = F.split("_hour", ":")[0].try_cast("double")
    hour = (F.floor(clock / layout.hour_divisor) + layout.hour_offset).cast("int")
    rows = rows.select(*keys, "row_no", "day", hour.alias("hour"), (to_number("_value") * layout.scale).alias("mwh"))
    rows = rows.filter(F.col("day").isNotNull() & F.col("hour").between(1, 24))
    if layout.shift or layout.relabel:
        rows = cut_lineage(rows)  # the ordered steps below read the rows twice
    if layout.shift:
        rows = shift_rows(rows, Series(tuple(keys), ("row_no",), 10_000), "mwh")
    stamped = rows.withColumn("ts_local", hour_ending_to_ts("day", "hour"))
    if layout.relabel:
        stamped = relabel_hours(stamped, keys).withColumn("day", F.to_date("ts_local"))
    return _in_order(stamped, keys)


def relabel_hours(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace shifted stamps by consecutive hours where a file has as many rows as hours.

    For files whose values are complete and in order but whose first stamp is wrong.
    """
    span = rows.groupBy(*keys).agg(
        F.min("ts_local").alias("_from"), F.max("ts_local").alias("_to"), F.count("*").alias("_n")
    )
    placed = ordinal(rows, Series(tuple(keys), ("row_no",), 10_000)).join(span, list(keys))
    complete = F.col("_n") == seconds_between("_from", "_to") / 3600
    renamed = F.when(complete, add_time("_from", F.col("_ordinal") - 1, "hour")).otherwise(F.col("ts_local"))
    return placed.withColumn("ts_local", renamed).drop("_from", "_to", "_n", "_ordinal")


def timestamps(records: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Time-stamped rows by their hour; a trailing total row has no readable stamp and drops out."""
    text = _named(layout.day)
    formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")
    stamp = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    rows = records.select(*keys, "row_no", stamp.alias("_ts"), (to_number(_field(layout)) * layout.scale).alias("mwh"))
    rows = rows.filter(F.col("_ts").isNotNull()).withColumns({"ts_local": floor_time("hour", "_ts"), "day": F.to_date("_ts")})
    return _in_order(rows, keys)


FAMILIES = {
    "wide_hours": wide_hours,
    "quarter_labels": quarter_labels,
    "long_hours": long_hours,
    "timestamps": timestamps,
}
INTERVAL = ("row_no", "day", "ts_local", "nth", "in_day", "mwh")


def read_intervals(cells: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Intervals (keys, row_no, day, ts_local, nth, in_day, mwh) of files in one layout."""
    records = grid_records(cells, layout.marker, keys)
    return FAMILIES[layout.family](records, layout, keys).select(*keys, *INTERVAL)


def _energy(layout: Layout) -> Column:
    return F.avg("mwh") if layout.mean else F.coalesce(F.sum("mwh"), F.lit(0.0))


def read_layout(cells: DataFrame, layout: Layout, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Hourly rows (keys, row_no, ts_local, mwh) of files in one layout, by their labels.

    Clock changes need the zone: see :func:`meter_router`.
    """
    rows = read_intervals(cells, layout, keys)
    if layout.family in ("wide_hours", "long_hours"):
        return rows.select(*keys, "row_no", "ts_local", "mwh")
    return rows.groupBy(*keys, "ts_local").agg(_energy(layout).alias("mwh"), F.min("row_no").alias("row_no")).select(
        *keys, "row_no", "ts_local", "mwh"
    )


def place_hours(rows: DataFrame, keys: Sequence[str], tz: str = "tz", mean: str = "mean") -> DataFrame:
    """Intervals to hours (keys, tz, row_no, ts_local, instant, mwh).

    On the days on which the clocks change, intervals count from midnight if the file has
    as many of them as the day is long; then ``instant`` says when the hour begins.  On all
    other days, and where the number doesn't fit, the label counts and ``instant`` is null:
    :func:`repair_meter_hours` places it.  ``mean`` is a column that says whether the
    intervals of an hour are averaged or summed.
    """
    midnight = F.col("day").cast("timestamp_ntz")
    start = local_to_instant(midnight, F.col(tz))
    length = F.timestamp_diff("HOUR", start, local_to_instant(add_time(midnight, 1, "day"), F.col(tz)))
    per_hour = (F.col("in_day") / F.col("_hours")).cast("int")
    counted = (F.col("_hours") != 24) & (F.col("in_day") % F.col("_hours") == 0)
    begin = add_time(F.col("_start"), F.floor(F.col("nth") / per_hour), "hour")
    placed = rows.withColumns({"_start": start, "_hours": length}).withColumn("instant", F.when(counted, begin))
    label = F.coalesce(instant_to_local("instant", tz), F.col("ts_local"))
    # rows of one label stay apart if their family has one row per hour, as in a repeated hour
    single = F.when(F.col("instant").isNull() & F.col("hourly"), F.col("row_no"))
    hours = placed.filter(label.isNotNull()).groupBy(*keys, tz, label.alias("ts_local"), "instant", single.alias("_single"))
    energy = F.when(F.first(mean), F.avg("mwh")).otherwise(F.sum("mwh"))
    return hours.agg(F.coalesce(energy, F.lit(0.0)).alias("mwh"), F.min("row_no").alias("row_no")).drop("_single")


def layout_table(spark: SparkSession) -> DataFrame:
    """Name and header marker of every layout."""
    rows = [(name, x.marker) for name, x in LAYOUTS.items()]
    return spark.createDataFrame(rows, "layout string, marker string")


def routed_cells(cells: DataFrame, routing: DataFrame) -> DataFrame:
    """Cells of routed files with their routing and their layout's header marker."""
    table = routing.join(F.broadcast(layout_table(cells.sparkSession)), "layout")  # one row per layout
    return cells.join(table, "file")


def read_all(cells: DataFrame, routing: DataFrame, keys: Sequence[str] = ("site", "file")) -> DataFrame:
    """Intervals of every routed file: ``keys``, layout, tz if routed, INTERVAL, mean, hourly.

    ``routing`` gives site and layout (and tz) per file.  All files are cut into records in
    one pass, which is stored; layouts only differ in the columns they read from it.
    """
    routed = routed_cells(cells, routing)
    ids = [*keys, *(c for c in ("layout", "tz") if c in routing.columns and c not in keys)]
    records = cut_lineage(grid_records(routed.withColumn("_m", F.col("marker")), F.col("_m"), ids))
    present = {r.layout for r in routing.select("layout").distinct().collect()}
    out = None
    for name in (n for n in LAYOUTS if n in present):
        layout = LAYOUTS[name]
        part = FAMILIES[layout.family](records.filter(F.col("layout") == name), layout, ids)
        hourly = layout.family in ("wide_hours", "long_hours")
        part = part.select(*ids, *INTERVAL, F.lit(layout.mean).alias("mean"), F.lit(hourly).alias("hourly"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no file is routed to a known layout")
    return out


def routing_errors(cells: DataFrame, routing: DataFrame) -> DataFrame:
    """(site, file, error) of routed files that cannot be read: unknown layout, no cells, no header."""
    known = routing.join(F.broadcast(layout_table(cells.sparkSession)), "layout", "left")
    is_marker = F.trim("text") == F.col("marker")
    state = known.join(cells, "file", "left").groupBy("site", "file").agg(
        F.max("marker").alias("_marker"), F.count("row_no").alias("_n"), F.max(F.coalesce(is_marker, F.lit(False))).alias("_found")
    )
    reason = (
        F.when(F.col("_marker").isNull(), "unknown layout").when(F.col("_n") == 0, "no such file").when(~F.col("_found"), "no header row")
    )
    return state.select("site", "file", reason.alias("error")).filter("error IS NOT NULL")


def meter_router(cells: DataFrame, routing: DataFrame) -> DataFrame:
    """Energy of all sites on true local hours: site, tz, instant, ts_local, mwh, error.

    ``routing`` has one row per file: file, site, layout, tz.  Files are read by their
    layout, placed by :func:`place_hours` and repaired for clock changes; hours of a site
    without a row get zero.  A file that cannot be read gives one row with its ``error``
    and no time, so it never vanishes.
    """
    hours = place_hours(read_all(cells, routing), ["site", "file"])
    # rows of several files of a site follow each other by file
    order = F.struct("file", "row_no").alias("row")
    fixed = repair_meter_hours(hours.withColumn("row", order), ["site"], "tz", "row", instant="instant")
    failed = routing_errors(cells, routing)
    return fixed.withColumn("error", F.lit(None).cast("string")).unionByName(failed.select("site", "error"), allowMissingColumns=True)


def settlement(rows: DataFrame, resources: DataFrame) -> DataFrame:
    """Settlement rows to hourly energy per site.

    Only generation rows of hours 1 to 24 count, missing values are zero, repeated rows
    are averaged.  ``resources`` maps resource_id to site; other ids keep their own name.
    """
    kept = rows.filter((F.col("measurement_type") == "GEN") & F.col("interval_id").between(1, 24))
    named = kept.join(resources, "resource_id", "left").withColumn("site", F.coalesce("site", "resource_id"))
    return named.groupBy("site", hour_ending_to_ts("trade_date", "interval_id").alias("ts_local")).agg(
        F.avg(F.coalesce("value", F.lit(0.0))).alias("mwh")
    )


def meter_history(rows: DataFrame, year: int | None = None, month: int | None = None, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Stored hours (keys, day, hour, text) of a year or month as (keys, ts_local, mwh).

    Values that are no numbers become missing; series without any value in the period are
    dropped.  Bounds on the day reach the scan.
    """
    if year is not None:
        first, last = (f"{year:04d}-{month:02d}-01", None) if month else (f"{year:04d}-01-01", f"{year + 1:04d}-01-01")
        end = F.lit(last).cast("date") if last else F.add_months(F.lit(first).cast("date"), 1)
        rows = rows.filter((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") < end))
    elif month is not None:
        rows = rows.filter(F.month("day") == month)
    hours = rows.select(*keys, hour_ending_to_ts("day", "hour").alias("ts_local"), to_number("text").alias("mwh"))
    filled = sized(hours.filter(F.col("mwh").isNotNull()).select(*keys).distinct())
    return hours.join(filled, list(keys), "left_semi")


def meter_table(rows: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Output contract: day, hour ending, MWh with missing energy as zero."""
    return rows.select(
        *keys, F.to_date("ts_local").alias("day"), (F.hour("ts_local") + 1).alias("hour"),
        F.coalesce("mwh", F.lit(0.0)).alias("mwh"),
    )


def monthly_totals(rows: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Energy per month and the number of hours stored more than once."""
    hours = rows.groupBy(*keys, "ts_local").agg(F.sum("mwh").alias("_mwh"), F.count("*").alias("_n"))
    return hours.groupBy(*keys, floor_time("month", "ts_local").alias("month")).agg(
        F.sum("_mwh").alias("mwh"), F.count_if(F.col("_n") > 1).alias("n_repeated_hours")
    )
