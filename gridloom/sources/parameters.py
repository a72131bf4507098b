"""Device parameter text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import quoted


def parameter_rows(lines: DataFrame) -> DataFrame:
    r"""Parameters of text lines (file, line) in either of the two file kinds.

    ``.rec``: ``<param key="name">value``; ``.re2``: ``<param uid="name" value="value"/>``.
    The inverter is the parent folder; the full device key is the quoted text of the
    file's device key line and the device key its part before the colon.
    """
    line = F.trim(F.col("line"))
    named = lines.withColumn("line", line).filter(line != "")
    is_key = F.col("line").contains("device key")
    keys = named.filter(is_key).groupBy("file").agg(F.min(quoted("line", 1)).alias("full_device_key"))
    is_rec = F.split("line", "<")[1].startswith("param key=")
    is_re2 = F.col("line").contains("uid=")
    tail = F.element_at(F.split(F.split("line", "<")[1], '"'), -1)
    rows = named.filter(F.coalesce(is_rec, F.lit(False)) | is_re2).select(
        "file",
        quoted("line", 1).alias("parameter"),
        F.when(is_re2, quoted("line", 3)).otherwise(F.substring(tail, F.lit(2), F.length(tail))).alias("value"),
    )
    folder = F.element_at(F.split("file", "/"), -2)
    return rows.join(keys, "file", "left").select(
        folder.alias("inverter"),
        "full_device_key",
        F.split("full_device_key", ":")[0].alias("device_key"),
        "parameter",
        "value",
    )


def parameter_metadata(files: DataFrame) -> DataFrame:
    """(inverter, metadata) of whole ``.re2`` files (file, text), each pair once.

    The metadata are the lines before the parameter list, trimmed and put together.
    """
    head = F.split("text", r"(?m)^[ \t]*<paramList>[ \t]*\r?$")
    lines = F.filter(F.transform(F.split(head[0], r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = files.filter(F.size(head) > 1).select(
        F.element_at(F.split("file", "/"), -2).alias("inverter"), F.array_join(lines, "").alias("metadata")
    )
    return rows.distinct()


def read_parameter_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Metadata of every ``.re2`` file under ``path``; the files are small and read whole."""
    files = spark.read.text(path, wholetext=True).select(
        F.url_decode(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("text")
    )
    return parameter_metadata(files.filter(F.col("file").endswith(".re2")))


def read_parameters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parameters of every ``.rec`` and ``.re2`` file under ``path``."""
    lines = spark.read.text(path).select(
        F.url_decode(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("line")
    )
    return parameter_rows(lines.filter(F.col("file").rlike(r"\.re[c2]$")))
