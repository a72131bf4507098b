"""Text helpers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import sized


def substrings(name: Column | str, lengths: Sequence[int]) -> Column:
    """The distinct substrings of a name that have one of ``lengths``, for lookups by equality.

    Turns "name contains key" into an equi join: a name gives one piece per place and length
    that keys really have (:func:`key_lengths`).
    """
    name = F.col(name) if isinstance(name, str) else name
    pieces = [
        F.when(
            F.length(name) >= n,
            F.transform(F.sequence(F.lit(1), F.length(name) - n + 1), _piece(name, n)),
        ).otherwise(F.array().cast("array<string>"))
        for n in lengths
    ]
    return F.array_distinct(F.concat(*pieces)) if pieces else F.array().cast("array<string>")


def _piece(name: Column, n: int) -> Callable[[Column], Column]:
    return lambda i: F.substring(name, i, F.lit(n))


def key_lengths(keys: DataFrame, key: str) -> list[int]:
    """Lengths of the keys, of which there are no more than the longest key has letters."""
    return sorted(r.n for r in keys.filter(F.length(key) > 0).select(F.length(key).alias("n")).distinct().collect())


def grams(text: Column | str, sizes: Sequence[int]) -> Column:
    """The distinct runs of ``sizes`` characters of a text."""
    return substrings(text, sizes)


def containing(
    names: DataFrame, name: str, keys: DataFrame, key: str, on: Sequence[str] = (), q: int = 3
) -> DataFrame:
    """Rows of both sides (equal in ``on``) whose ``name`` contains the ``key``; no empty or null keys.

    An index of runs of ``q`` characters: a key is looked up by the one of its runs that the
    fewest names have, a shorter key by itself, and then compared with the names that have it.
    Names hand on only runs by which some key is looked up.  The two sides must not share
    column names besides ``on``.
    """
    real = keys.filter(F.length(key) > 0)
    sizes = [n for n in range(1, q + 1) if n == q or n in key_lengths(real, key)]
    by_size = F.coalesce(*[F.when(F.length(key) == n, grams(key, [n])) for n in sizes], grams(key, [q]))
    held = real.select(key, F.explode(by_size).alias("_gram")).distinct()
    wanted = sized(held.select("_gram").distinct())
    spread = names.select(F.explode(grams(name, sizes)).alias("_gram")).join(wanted, "_gram", "left_semi")
    common = sized(spread.groupBy("_gram").agg(F.count("*").alias("_names")))
    # a key with a run that no name has is in none of them
    rated = held.join(common, "_gram", "left").groupBy(key)
    rarest = F.min_by("_gram", F.struct(F.coalesce("_names", F.lit(0)), "_gram")).alias("_gram")
    chosen = rated.agg(rarest, F.min(F.coalesce("_names", F.lit(0))).alias("_names")).filter("_names > 0").drop("_names")
    probed = sized(real.join(chosen, key))
    few = sized(probed.select("_gram").distinct())
    asked = names.withColumn("_gram", F.explode(grams(name, sizes))).join(few, "_gram", "left_semi")
    return asked.join(probed, [*on, "_gram"]).filter(F.contains(F.col(name), F.col(key))).drop("_gram")


def quoted(line: Column | str, position: int) -> Column:
    """The ``position``-th piece of a line split at double quotes."""
    line = F.col(line) if isinstance(line, str) else line
    return F.get(F.split(line, '"'), F.lit(position))
