"""Long lists as several rows of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import ORDINAL, global_position
from gridloom.core.session import cut_lineage, sized

#: Items of one part of a list.
PART_ITEMS = 10_000


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which a null key equals a null key."""
    named = right.withColumnsRenamed({k: f"_on{i}" for i, k in enumerate(on)})
    same = [F.col(k).eqNullSafe(F.col(f"_on{i}")) for i, k in enumerate(on)]
    return left.join(named, same).drop(*[f"_on{i}" for i in range(len(on))])


def list_parts(
    items: DataFrame, keys: Sequence[str], item: str, name: str = "items", part_items: int = PART_ITEMS, separator: str = ", "
) -> DataFrame:
    """``keys, part, name``: the items of a group in order of their text, ``part_items`` to a row.

    ``items`` has one row per group and item; null items are left out, and a group with
    nothing else has one empty part.  Where all groups are short each is listed at once.  Else
    places come from range partitions, so no task holds the items of a long group.
    """
    keys = list(keys)
    rows = cut_lineage(items.select(*keys, F.col(item).cast("string").alias("_item")))
    most = rows.groupBy(*keys).agg(F.count("_item").alias("n")).agg(F.max("n")).first()[0] or 0
    listed = F.array_join(F.array_sort(F.collect_list("_item")), separator).alias(name)
    if most <= part_items:
        return rows.groupBy(*keys).agg(listed).select(*keys, F.lit(1).cast("long").alias("part"), name)
    # nulls stand before the items of their group and count as none of them
    placed = global_position(rows, [*keys, "_item"])
    first = F.min(F.when(F.col("_item").isNotNull(), F.col(ORDINAL))).alias("_first")
    found = join_null_safe(placed, sized(placed.groupBy(*keys).agg(first)), keys)
    place = F.when(F.col("_item").isNotNull(), F.floor((F.col(ORDINAL) - F.col("_first")) / part_items))
    # the nulls of a group that has items join its first part, where the list leaves them out
    return found.groupBy(*keys, (F.coalesce(place, F.lit(0)) + 1).alias("part")).agg(listed)
