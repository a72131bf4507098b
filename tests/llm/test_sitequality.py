import math
import random

import pytest

from gridloom.llm.sitequality import FEATURES, SiteQualitySettings, document_features, site_quality, sites_of


def auc(rows):
    good = [s for s, y in rows if y]
    bad = [s for s, y in rows if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, pages, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages", "labels"))
    got = site_quality(docs, sites_of(docs, pages), labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").select("score", "quality", "kept").collect()
    assert len(rows) > 500 and auc([(r.score, r.quality) for r in rows]) > 0.9
    assert sum(r.kept == bool(r.quality) for r in rows) > 0.9 * len(rows)


def test_sites_shrink_towards_their_hosts(spark):
    """The classifier sees equal texts, so scores differ by site alone."""
    rng = random.Random(3)
    docs, sites, labels = [], [], []
    rates = {("good", "a"): 0.95, ("good", "b"): 0.9, ("bad", "a"): 0.1, ("bad", "b"): 0.4}
    k = 0
    for (host, path), rate in rates.items():
        for _ in range(200):
            docs.append((k, "same text"))
            sites.append((k, host, path))
            if rng.random() < 0.8:
                labels.append((k, int(rng.random() < rate)))
            k += 1
    for host, path in (("bad", "rare"), ("good", "rare"), ("unknown", "x")):
        docs.append((k, "same text"))
        sites.append((k, host, path))
        k += 1
    docs.append((k, "same text"))
    df = site_quality(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(sites, "doc_id long, host string, path string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )
    got = {r.doc_id: r for r in df.collect()}
    mean = lambda a: sum(got[i].path_rate for i in range(a, a + 200)) / 200
    assert mean(0) > 0.88 and mean(200) > 0.82 and mean(400) < 0.2 and 0.3 < mean(600) < 0.5
    rare_bad, rare_good, unknown, none = (got[800 + j] for j in range(4))
    assert rare_bad.n_path == 0 and rare_bad.path_rate == pytest.approx(rare_bad.host_rate) and rare_bad.host_rate < 0.35
    assert rare_good.path_rate > 0.8
    assert unknown.path_rate == pytest.approx(none.path_rate) and unknown.n_host == 0
    assert none.score == pytest.approx(1 / (1 + math.exp(-none.evidence)))


def test_own_label_is_left_out(spark):
    rows = [(k, "text", f"h{k}") for k in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    sites = spark.createDataFrame([(r[0], r[2], None) for r in rows], "doc_id long, host string, path string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    got = site_quality(docs, sites, labels).collect()
    assert all(r.n_host == 0 and r.n_path == 0 for r in got) and len({round(r.path_rate, 9) for r in got}) == 1


def test_features_are_per_text(spark):
    texts = ["", None, "A b! b\nA b! b\nx", "é#$ 12", "w " * 300]
    whole = {r.doc_id: tuple(r) for r in document_features(frame(spark, list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        assert tuple(document_features(frame(spark, [(k, t)])).collect()[0]) == whole[k]
    row = dict(zip(("doc_id", *FEATURES), whole[2], strict=True))
    assert row["dup_lines"] == pytest.approx(1 / 3) and row["distinct"] == pytest.approx(4 / 7)


def frame(spark, rows):
    from gridloom.llm.batches import id_and_text

    return id_and_text(spark.createDataFrame(rows, "doc_id long, text string"))


def test_sites_of(spark):
    docs = spark.createDataFrame([(1, "s1"), (2, None), (3, "s3"), (None, "s")], "doc_id long, source string")
    urls = ["http://h.example.com/en/1?page=2&ref=9", "https://a.example.com/fr/3.html", "http://x.example.com/en/about", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.doc_id: (r.host, r.path) for r in sites_of(docs, pages).collect()}
    assert got == {1: ("h.example.com", "en"), 2: (None, ""), 3: ("a.example.com", "fr")}


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a", 1.0), (1, None, 2.0), (1, None, 2.0)], "doc_id long, text string, score double")
    sites = spark.createDataFrame([(1, "h", "p"), (1, "g", None), (None, "h", "p")], "doc_id long, host string, path string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = site_quality(docs, sites, labels, SiteQualitySettings(threshold=0.6)).collect()
    assert len(got) == 3 and all(r.score == pytest.approx(0.5) and not r.kept for r in got)
    assert site_quality(docs.limit(0), sites.limit(0), labels.limit(0)).collect() == []
