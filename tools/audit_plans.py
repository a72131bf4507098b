"""List plan features that do not scale: cross joins, single partitions, Python stages.

Usage: python tools/audit_plans.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridloom.catalog import all_queries
from gridloom.core.session import build_session, use_folder

FEATURES = {
    "cross join": r"CartesianProduct|BroadcastNestedLoopJoin",
    "single partition": r"SinglePartition",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "window without keys": r"Window \[[^\]]*\], \[[^\]]*ASC",
}


def findings(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [name for name, pattern in FEATURES.items() if re.search(pattern, plan)]


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.001")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_folder(spark, tempfile.mkdtemp(prefix="gridloom-"))
    for name, fn in all_queries().items():
        if opts.names and name not in opts.names:
            continue
        found = findings(fn(spark, opts.sf))
        if found:
            print(name, found)


if __name__ == "__main__":
    main()
