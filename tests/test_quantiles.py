import random

import pytest
from pyspark.sql import functions as F

from gridloom.core import quantiles as qt
from gridloom.core.quantiles import exact_quantiles, value_sketches
from tests.helpers import rows


@pytest.mark.parametrize("seed,rows_to_order", [(1, 1_000_000), (2, 200), (3, 1)])
def test_equals_the_exact_percentile(spark, seed, rows_to_order):
    rng = random.Random(seed)
    data = [("hot", rng.choice([7.0, rng.expovariate(0.01)])) for _ in range(3000)]
    data += [("same", 4.0)] * 50 + [("one", -2.5)] + [("two", 1.0), ("two", 2.0)] + [("gap", None), ("gap", 3.0)]
    data += [("neg", -rng.random()) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, v double")
    qs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = exact_quantiles(df, ["k"], "v", qs, rows_to_order)
    want = df.groupBy("k").agg(
        *[F.expr(f"percentile(v, {q}D)").alias(n) for n, q in qs.items()], F.min("v").alias("lowest"),
        F.max("v").alias("highest"), F.count("v").alias("n_values"),
    )
    assert rows(got, *want.columns) == rows(want)


def test_group_without_values_is_absent(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    assert rows(exact_quantiles(df, ["k"], "v", {"m": 0.5}), "k", "m") == [("b", 1.0)]


def test_a_group_of_two_values_does_not_stop_the_others(spark, monkeypatch):
    rng = random.Random(5)
    data = [("flag", float(rng.random() < 0.5)) for _ in range(4000)] + [("wide", rng.random()) for _ in range(4000)]
    df = spark.createDataFrame(data, "k string, v double")
    within, ordered = qt._within, []

    def counted(rows_, ranges, keys):
        ordered.append({(r.k, r._q): (r._inside, r._lo, r._hi) for r in ranges.collect()})
        return within(rows_, ranges, keys)

    monkeypatch.setattr(qt, "_within", counted)
    got = exact_quantiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9}, 100)
    last = ordered[-1]
    assert all(inside <= 100 for (k, _), (inside, _, _) in last.items() if k == "wide")
    want = df.groupBy("k").agg(F.expr("percentile(v, 0.5D)").alias("p50"), F.expr("percentile(v, 0.9D)").alias("p90"))
    assert rows(got, "k", "p50", "p90") == rows(want)


def test_daily_sketches_give_the_bounds(spark, monkeypatch):
    rng = random.Random(9)
    data = [(k, d, rng.gauss(d, 5.0) if k == "wide" else float(rng.randrange(3))) for k in ("wide", "few") for d in range(20) for _ in range(500)]
    df = spark.createDataFrame([*data, ("gap", 3, None), ("one", 3, 1.5)], "k string, d int, v double")
    early = value_sketches(df.filter("d < 15"), ["k", "d"], "v")
    states = early.unionByName(value_sketches(df.filter("d >= 15"), ["k", "d"], "v"))
    narrow, rounds = qt._narrow, []

    def counted(rows_, ranges, keys, known):
        out = narrow(rows_, ranges, keys, known)
        rounds.append((known is not None, {r.k: r._inside for r in out.collect()}))
        return out

    monkeypatch.setattr(qt, "_narrow", counted)
    got = exact_quantiles(df, ["k"], "v", {"p10": 0.1, "p90": 0.9}, 1000, states)
    want = df.groupBy("k").agg(
        F.expr("percentile(v, 0.1D)").alias("p10"), F.expr("percentile(v, 0.9D)").alias("p90"),
        F.min("v").alias("lowest"), F.max("v").alias("highest"), F.count("v").alias("n_values"),
    ).filter("n_values > 0")
    assert rows(got, *want.columns) == rows(want)
    assert rounds[0][0] and rounds[0][1]["wide"] < 200 and not any(known for known, _ in rounds[1:])


def test_stale_sketches_only_cost_a_round(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([("a", rng.random()) for _ in range(3000)], "k string, v double")
    false = value_sketches(df.withColumn("v", F.col("v") / 10), ["k"], "v")
    own = value_sketches(df, ["k"], "v").drop("sketch").join(false.select("k", "sketch"), "k")
    want = df.groupBy("k").agg(F.expr("percentile(v, 0.7D)").alias("p70"))
    assert rows(exact_quantiles(df, ["k"], "v", {"p70": 0.7}, 100, own), "k", "p70") == rows(want)
