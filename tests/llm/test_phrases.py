import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm.phrases import PhraseSettings, Tiles, collocations, rank_phrases

SCHEMA = "doc_id long, text string, lang string, rank string, n string, id string"


def by_hand(rows, s):
    """Every phrase counted in dictionaries."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, s.longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {x: n for x, n in counts.items() if n >= s.least}
    inside = set()
    for (lang, words), n in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if frequent[lang, words[i : i + k]] <= n:
                    inside.add((lang, words[i : i + k]))
    out = []
    for (lang, words), a in frequent.items():
        if len(words) > 1 and (lang, words) not in inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = frequent[lang, words[:k]], frequent[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            out.append((lang, score, a, " ".join(words), left, right, totals[lang]))
    final = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))[: s.top]
        final += [(lang, k + 1, p, a, left, right, n, score) for k, (_, score, a, p, left, right, n) in enumerate(own)]
    return sorted(final)


def table(spark, rows):
    return spark.createDataFrame([(k, t, lang, "x", "y", "z") for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def some_rows(seed):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "sat", "été", "ÉTÉ", "a", "b", "on", "mat x"]
    stock = ["new york city hall", "once upon a time there", "b b b b b b"]
    rows = []
    for _ in range(120):
        parts = [rng.choice(stock) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randint(1, 8))) for _ in range(6)]
        text = "".join(p + rng.choice([" ", "\t", ". ", ",", "\n", "\x0b", "  ", ";"]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "en"), ("  .,", None), rows[0], rows[0], ("tick tock " * 3000, "en"), ("x" * 50_000, "fr")]


@pytest.mark.parametrize("settings", [
    PhraseSettings(least=8, top=12),
    PhraseSettings(least=8, top=2000, tile=2, dense=1, held_tiles=3, buffer=50),
    PhraseSettings(least=8, top=50, broadcast_entries=0),
    PhraseSettings(least=3, top=50, longest=3, broadcast_entries=20),
], ids=["usual", "small_tiles", "joins", "mixed"])
def test_equals_dictionaries(spark, settings):
    rows = some_rows(settings.top)
    got = sorted(map(tuple, collocations(table(spark, rows), settings).collect()))
    want = by_hand(rows, settings)
    assert got == want
    assert {len(x[2].split(" ")) for x in want} >= {2, 3}


def test_nothing_frequent(spark):
    assert collocations(table(spark, [])).collect() == []
    assert collocations(table(spark, [("a b c", "en"), (None, None)])).collect() == []
    assert collocations(table(spark, [("a. " * 200, "en")])).collect() == []


def test_products_beyond_64_bits(spark):
    big = 10**13
    phrases = [("en", ["x"], 7 * big + 3), ("en", ["y"], 5 * big + 1), ("en", ["x", "y"], 3 * big + 11)]
    phrases = spark.createDataFrame(phrases, "lang string, words array<string>, a long")
    totals = spark.createDataFrame([("en", 90 * big + 7)], "lang string, n long")
    (row,) = rank_phrases(phrases, totals, PhraseSettings()).collect()
    assert row.score == 1000 * (3 * big + 11) * (90 * big + 7) // ((7 * big + 3) * (5 * big + 1))


def test_tiles_count_pairs():
    rng = np.random.default_rng(1)
    left, right = rng.zipf(1.3, 5000) % 1600 + 1, rng.zipf(1.3, 5000) % 1600 + 1
    tiles = Tiles(PhraseSettings(tile=16, dense=20, held_tiles=4, buffer=700))
    batches = [b for k in range(0, 5000, 100) for b in tiles.add(left[k : k + 100], right[k : k + 100])]
    batches += tiles.end()
    got = Counter()
    for b in batches:
        for x, y, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got[x, y] += n
    assert got == Counter(zip(left.tolist(), right.tolist(), strict=True))
    assert tiles.dense


def test_whole_table_of_one_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("lang", F.lit("x"))
    rows = [(r.text, "x") for r in docs.select("text").collect()]
    s = PhraseSettings(least=40)
    assert sorted(map(tuple, collocations(docs, s).collect())) == by_hand(rows, s)
