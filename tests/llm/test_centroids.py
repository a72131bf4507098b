import hashlib
import math
import random

import pytest

from gridloom.llm.centroids import CentroidSettings, cluster_vectors

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def by_hand(rows, s):
    """The same with Python numbers, vector by vector."""
    kept = [
        (i, [math.floor(s.scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == s.components and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"{s.salt}{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[: s.clusters]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(s.rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for c, vs in zip(centroids, own, strict=True)]
    final = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = [sum(d for _, k, d in final if k == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, per[k], sum(per), sha[k]) for i, k, d in final]


def got(spark, rows, s, parts=3):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, cluster_vectors(table, s).collect()), key=repr)


@pytest.mark.parametrize("block", [1, 2, 3, 8])
def test_equals_plain_arithmetic(spark, block):
    s = CentroidSettings(clusters=5, rounds=3, components=8, block=block, chunk_rows=32)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(rng.choice([-1, 1]), 0.4) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(7, rows[8][1]), (None, rows[9][1])]  # copies, repeated and null ids
    rows += [(300, None), (301, []), (302, rows[0][1][:-1]), (303, [None] * 8), (304, [math.nan] * 8), (305, [math.inf] * 8)]
    assert got(spark, rows, s) == sorted(by_hand(rows, s), key=repr)


def test_ties_and_empty_clusters(spark):
    s = CentroidSettings(clusters=4, rounds=2, components=2, chunk_rows=8)
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)]
    want = by_hand(rows, s)
    assert len({r[1] for r in want}) < 4
    assert got(spark, rows, s) == sorted(want, key=repr)


def test_few_or_no_vectors(spark):
    s = CentroidSettings(clusters=4, rounds=2, components=2)
    assert got(spark, [(1, [0.5, -0.5])], s) == sorted(by_hand([(1, [0.5, -0.5])], s), key=repr)
    assert got(spark, [(1, None)], s) == [] == got(spark, [], s)


def test_large_components(spark):
    s = CentroidSettings(clusters=2, rounds=2, components=64)
    far = 2.0**27 / 256
    rows = [(1, [far] * 64), (2, [-far] * 64), (3, [far - 1] * 64), (4, [0.0] * 64)]
    assert got(spark, rows, s) == sorted(by_hand(rows, s), key=repr)
    with pytest.raises(Exception, match="beyond 64 bits"):
        got(spark, [*rows, (5, [far * 2] * 64)], s)


def test_float_vectors_of_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    s = CentroidSettings()
    assert sorted(map(tuple, cluster_vectors(table).collect())) == sorted(by_hand(rows, s))
