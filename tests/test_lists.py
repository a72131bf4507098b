import random

from pyspark.sql import functions as F

from gridloom.functions.text import containing
from gridloom.operators import events as ev
from gridloom.operators.lists import list_parts
from tests.helpers import rows


def test_short_lists_have_one_part(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "b"), ("b", None), (None, "q"), (None, None)], "k string, v string")
    assert rows(list_parts(df, ["k"], "v")) == [("a", 1, "b, x"), ("b", 1, ""), (None, 1, "q")]
    assert list_parts(df.limit(0), ["k"], "v").collect() == []


def test_long_lists_are_cut(spark):
    items = [("a", f"{i:03}") for i in range(25)] + [("b", "x"), ("c", None), ("a", None), (None, "n1"), (None, "n2")]
    random.Random(1).shuffle(items)
    df = spark.createDataFrame(items, "k string, v string").repartition(4)
    got = rows(list_parts(df, ["k"], "v", "v", part_items=10))
    want = [("a", p + 1, ", ".join(f"{i:03}" for i in range(10 * p, min(10 * p + 10, 25)))) for p in range(3)]
    assert got == [*want, ("b", 1, "x"), ("c", 1, ""), (None, 1, "n1, n2")]


def test_a_million_holders(spark):
    df = spark.range(1_000_000).select(F.lit("s").alias("site"), F.lit("c").alias("category"), F.col("id").alias("primary_element"), F.lit(1).alias("duration_s"))
    got = ev.category_summary(df).select("part", "n_events", "n_assets", F.length("asset_names").alias("n"), F.substring("asset_names", 1, 1).alias("first"))
    found = got.orderBy("part").collect()
    assert [r.part for r in found] == list(range(1, 101)) and {(r.n_events, r.n_assets) for r in found} == {(10**6, 10**6)}
    assert max(r.n for r in found) < 100_000 and [r["first"] for r in found] == sorted(r["first"] for r in found)


def test_containing_equals_all_pairs(spark):
    rng = random.Random(4)
    word = lambda lo, hi: "".join(rng.choices("abcé ", k=rng.randint(lo, hi)))
    names = [(rng.choice("xy"), word(0, 14)) for _ in range(80)] + [("x", None)]
    keys = [(rng.choice("xy"), word(0, 5)) for _ in range(60)] + [("x", None), ("y", "zzz"), ("x", "zz")]
    a, b = spark.createDataFrame(names, "s string, name string"), spark.createDataFrame(keys, "s string, key string")
    both = [(s, n, k) for s, n in names for t, k in keys if n and k and k in n]
    assert rows(containing(a.drop("s"), "name", b.drop("s"), "key")) == sorted([x[1:] for x in both], key=repr)
    same = [(s, n, k) for s, n in names for t, k in keys if s == t and n and k and k in n]
    assert rows(containing(a, "name", b, "key", ["s"]), "s", "name", "key") == sorted(same, key=repr) and len(same) > 100


def test_names_hand_on_few_runs(spark):
    """Only runs that lead to a key leave a name, not one per place and length."""
    names = spark.range(400).select(F.concat(F.lit("meter readings of station "), F.col("id").cast("string"), F.lit(" for all months.csv")).alias("name"))
    keys = spark.createDataFrame([("station 12",), ("station 399 for",), ("stations",), ("q",)], "key string")
    plan = containing(names, "name", keys, "key")
    assert {(r.name.split()[4], r.key) for r in plan.collect()} == {(str(i), "station 12") for i in [12, *range(120, 130)]} | {("399", "station 399 for")}
