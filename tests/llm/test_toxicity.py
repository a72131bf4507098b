import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path

from gridloom.llm.encoding import Encoder
from gridloom.llm.logistic import fit
from gridloom.llm.toxicity import ToxicitySettings, backoff, count_bigrams, fold, score_toxicity, text_features

PATHS = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")
SETTINGS = ToxicitySettings(*PATHS)


def auc(score, label):
    rank = np.argsort(np.argsort(score))
    ones = label == 1
    return (rank[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = score_toxicity(docs, labels, SETTINGS)
    # in this table only English documents show what they are labelled for
    english = docs.where("lang = 'en'").select("doc_id")
    rows = got.join(labels, "doc_id").join(english, "doc_id").where("held_out")
    rows = rows.select("doc_id", "score", "predicted", "toxic").toPandas()
    assert (rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5) == 0).all() and len(rows) > 300
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.98
    assert (rows.predicted == rows.toxic).mean() > 0.97


def random_rows():
    rng = random.Random(6)
    rows = []
    for k in range(60):
        words = rng.choices(["the", "cat", "sat", "on", "Mat", "été"], k=rng.randint(1, 30))
        if k % 3 == 0:
            words += rng.choices(["rotten", "fool"], k=3)
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(k % 3 == 0)))
    return rows


def ratio_by_hand(rows, texts):
    """Interpolated Kneser-Ney log-ratios of each text's bigrams, by dictionaries."""
    enc, v = Encoder(*PATHS), SETTINGS.vocabulary

    def pairs(text):
        ids = [v, *enc.encode(text.lower()).tolist()]
        return list(zip(ids, ids[1:], strict=False))

    counts = [Counter(p for _, t, y in rows if y == c for p in pairs(t)) for c in (0, 1)]
    kinds = [Counter(w for _, w in x) for x in counts]
    pooled = Counter(w for _, w in set(counts[0]) | set(counts[1]))

    def prob(c, u, w):
        n1, n2 = (sum(x == k for x in counts[c].values()) for k in (1, 2))
        m1, m2 = (sum(x == k for x in kinds[c].values()) for k in (1, 2))
        d, e = (n1 + 0.5) / (n1 + 2 * n2 + 1), (m1 + 0.5) / (m1 + 2 * m2 + 1)
        shared = (pooled[w] + 0.5) / (sum(pooled.values()) + 0.5 * (v + 1))
        every = sum(kinds[c].values())
        free = 1 - sum(max(x - e, 0) for x in kinds[c].values()) / every
        unigram = max(kinds[c][w] - e, 0) / every + free * shared
        after = {x for (a, x) in counts[c] if a == u}
        total = sum(n for (a, _), n in counts[c].items() if a == u)
        if not total:
            return unigram
        return max(counts[c][u, w] - d, 0) / total + d * len(after) / total * unigram

    return [[math.log(prob(1, u, w)) - math.log(prob(0, u, w)) for u, w in pairs(t)] for t in texts]


@pytest.mark.parametrize("size", [10**6, 7])
def test_log_ratios_equal_dictionaries(spark, size):
    settings = ToxicitySettings(*PATHS, slice_bigrams=size)
    rows = random_rows()
    counts = count_bigrams(spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3), settings)
    texts = ["", "the rotten cat", "mat fool fool", "unseen words entirely", "The"]
    pairs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in text_features(pairs, counts, backoff(counts, settings.vocabulary), settings).collect()}
    for k, want in enumerate(ratio_by_hand(rows, texts)):
        top = sorted((max(x, 0) for x in want), reverse=True)[:4]
        parts = [sum(want), sum(max(x - 2, 0) for x in want), *top, *[0] * (4 - len(top))]
        assert got[k].n == len(want)
        assert [got[k][f"p{j}"] for j in range(6)] == pytest.approx(parts, rel=1e-5, abs=1e-5)


def test_fold_is_the_remainder_of_the_checksum(spark):
    ids = [*range(200), 10**12, -5]
    got = {r.doc_id: r.f for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("f", fold("doc_id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in ids}


def test_nulls_repeats_and_missing_labels(spark):
    rows = [(None, "x y", 1.0), (1, None, 2.0), (1, "", 3.0), (2, "same words", 4.0), (2, "same words", 4.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = score_toxicity(docs, none, SETTINGS).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (77, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in score_toxicity(docs, labels, SETTINGS).collect())
    assert score_toxicity(docs.limit(0), none, SETTINGS).collect() == []


def test_logistic_curve():
    x = np.array([[0.0], [1.0], [2.0], [3.0]])
    model = fit(x, np.array([0, 0, 1, 1.0]))
    assert (np.diff(model.score(x)) > 0).all() and (model.score(x) >= 0.5).tolist() == [False, False, True, True]
    assert fit(x, np.ones(4)).score(x).tolist() == pytest.approx([0.9] * 4)
