"""Spark session for the library and lineage cutting for long plans."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings the semantics depend on; sizing is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "gridloom", master: str | None = None, **conf) -> SparkSession:
    """Return a session carrying the required settings plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For sessions in one process and clusters on which that folder is shared; elsewhere the
    package is deployed with the job (``--py-files``), and an absent folder does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    It has to be shared by all executors, so there is no default.  Programs that run in one
    process, such as tests, name a folder of their own (``use_folder``).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return folder.rstrip("/")


def use_folder(spark: SparkSession, folder: str) -> None:
    """Keep intermediate tables in ``folder`` if the session names none."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)


# Open scopes, innermost last: paths of the tables stored in each.
_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that are stored inside the ``with`` block at its end.

    Results must have been written or collected by then.  Without a scope stored tables stay
    until the folder is cleaned.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder and return a scan of it.

    For results that later steps read several times.  The copy survives lost executors,
    and each reader scans only the columns it needs.  It lives as long as the scope
    (:func:`scratch`) in which it was made.
    """
    path = f"{shared_folder(df.sparkSession)}/gridloom/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """Store a summary table so that the planner knows its true size before a join.

    Joined to a large table it is broadcast if it is below the broadcast threshold and
    shuffled otherwise.  Without the stored size an aggregate counts as large as its
    input, and the large table would be shuffled on a possibly hot key.
    """
    return cut_lineage(df)
