import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm.graph import components
from gridloom.llm.neardup import NearDupSettings, Shingles, band_keys, drop_near_duplicates, estimate, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Set size and smallest linked id of (id, text) by all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def results(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in words]


def random_rows():
    rng = random.Random(8)
    texts = [None, "", " \n", "a", "A", "b", "a b c d", "A B c D", "a b c d e", "a b c d e f", "é É", "É É"]
    for n in (6, 8, 12, 20, 60, 300):
        for _ in range(12):
            base = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
            texts.append(" ".join(base))
            for _ in range(4):
                other = base[: rng.randint(int(0.8 * n), n)] if rng.random() < 0.5 else edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))
                texts.append(rng.choice([" ", "\n", "  "]).join(other).upper())
    chain = [f"c{k}" for k in range(400)]
    texts += [" ".join(chain[k : k + 100]) for k in range(0, 300, 8)]
    group = [f"g{k}" for k in range(80)]
    texts += [" ".join(edited(rng, group, 0.02)) for _ in range(120)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("settings", [NearDupSettings(), NearDupSettings(rounds=0, block=7, partners=3, broadcast_ids=0), NearDupSettings(rounds=1, partners=2)])
def test_equals_brute_force(spark, settings):
    rows = random_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert results(near_duplicates(df, settings)) == brute(rows)


def test_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert results(near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_estimates_follow_the_jaccard_index():
    rng = random.Random(9)
    pairs = []
    for n in (5, 40, 300, 3000):
        for share in (0.3, 0.6, 0.75, 0.9):
            common = [f"x{rng.random()}" for _ in range(n)]
            cut = int(n * (1 - share) / (1 + share))
            pairs.append((" ".join(common), " ".join(common[cut:] + [f"y{k}" for k in range(cut)])))
    s = Shingles(pa.array([t for p in pairs for t in p]))
    r, n = s.registers(), s.counts()
    got = estimate(r[::2], r[1::2], n[::2], n[1::2])
    for (a, b), value in zip(pairs, got, strict=True):
        x, y = shingles(a), shingles(b)
        assert abs(len(x & y) / len(x | y) - value) < 0.2


def test_sketches_do_not_depend_on_neighbours():
    texts = ["a b c d e f g h", "x", "", "words " * 30, "p q r s t u v w x y z " * 3]
    whole = Shingles(pa.array(texts))
    for k, t in enumerate(texts):
        alone = Shingles(pa.array([t]))
        assert (alone.registers()[0] == whole.registers()[k]).all()
        assert [x[0] for x in alone.set_keys()] == [x[k] for x in whole.set_keys()]
    assert band_keys(whole.registers()[[0, 1]], 40).shape == (2, 40)


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1, 40) if k != 7] + [(5000 + k, 5000) for k in range(50)]
    edges += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    long, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(None, long, 1), (3, long, 2), (3, long, 2), (3, other, 3), (2, long + " end", 4), (5, other, 5), (6, None, 6), (7, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = sorted((repr(r.doc_id), r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == sorted(
        [("None", None, True), ("3", 2, False), ("3", 2, False), ("3", 3, True), ("2", 2, True), ("5", 3, False), ("6", 6, True), ("7", 7, True)]
    )
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[k] for k in (0, 3, 4, 6, 7)]))
    assert near_duplicates(df.limit(0)).collect() == [] and drop_near_duplicates(df.limit(0)).collect() == []


def test_set_keys_and_sets_agree():
    s = Shingles(pa.array(["a b c d e a b c d e f", "a b c d e f a b c d e"]))
    assert [len(x) for x in s.sets()] == [len(shingles("a b c d e a b c d e f")), len(shingles("a b c d e f a b c d e"))]
    assert all((np.diff(x.astype(np.float64)) >= 0).all() for x in s.sets()) or s.bits


def test_thousands_of_rows_with_one_id(spark):
    rng = random.Random(8)
    rows, near = [], []
    for k in range(2000):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        rows += [(7, " ".join(words)), (7, " ".join([*words, "end"]))]
        if k < 40:
            near.append((100 + k if k % 2 else -k - 1, " ".join(["start", *words])))
    df = spark.createDataFrame(rows + near + [(7, rows[0][1])] * 50, "doc_id long, text string")
    got = {}
    for r in near_duplicates(df).collect():
        got.setdefault((r.doc_id, r.component_id, r.kept), []).append(r.n_shingles)
    want = {(7, 7, True): 4000 - 40}
    want |= {(7, -k - 1, False): 2 + 50 * (k == 0) for k in range(0, 40, 2)}
    want |= {(-k - 1, -k - 1, True): 1 for k in range(0, 40, 2)} | {(100 + k, 7, False): 1 for k in range(1, 40, 2)}
    assert {x: len(v) for x, v in got.items()} == want


def test_very_long_texts_are_compared_whole(spark):
    words = [f"w{k * 7919 % 60013}" for k in range(100_000)]
    other = words.copy()
    other[50_000] = "changed"
    far = words[:50_000] + [f"x{k}" for k in range(50_000)]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate([words, other, far])], "doc_id long, text string")
    assert results(near_duplicates(df)) == brute([(r.doc_id, r.text) for r in df.collect()])
