"""Spreadsheet XML files with settlement meter rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One row element: cells hold a data element whose text may carry attributes.
ROW_SCHEMA = "Cell array<struct<Data: struct<_VALUE: string, `_ss:Type`: string>>>"


def xml_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (file, cells) of every ``Row`` element, cells as text in order."""
    rows = spark.read.format("xml").option("rowTag", "Row").schema(ROW_SCHEMA).load(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.transform("Cell", lambda c: c["Data"]["_VALUE"]).alias("cells"),
    )


def parse_rows(documents: DataFrame, column: str) -> DataFrame:
    """The same for ``Row`` elements that are already a text column."""
    parsed = F.from_xml(F.col(column), ROW_SCHEMA)
    kept = [c for c in documents.columns if c != column]
    return documents.select(*kept, F.transform(parsed["Cell"], lambda c: c["Data"]["_VALUE"]).alias("cells"))


def records(rows: DataFrame, marker: str, keys: list[str]) -> DataFrame:
    """Rows below the header as maps from column name to text.

    The header is the row of each file that contains ``marker``; rows with another number
    of cells (titles, notes) are left out.
    """
    is_header = F.array_contains("cells", marker)
    headers = rows.filter(is_header).groupBy(*keys).agg(F.first("cells").alias("_names"))
    body = rows.filter(~is_header & (F.size("cells") > 0)).join(headers, keys)
    same = body.filter(F.size("cells") == F.size("_names"))
    unique = F.array_distinct(F.col("_names"))
    named = F.transform(unique, lambda n: F.struct(n, F.get("cells", F.array_position("_names", n).cast("int") - 1)))
    return same.select(*keys, F.map_from_entries(named).alias("fields"))
