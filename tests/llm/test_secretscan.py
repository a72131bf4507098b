import hashlib
import random
import re
from dataclasses import replace

import numpy as np
import pytest

from gridloom.llm.logistic import fit
from gridloom.llm.secretnet import Example, Flat, Network, calibrated, recall_threshold, train
from gridloom.llm.secretscan import (
    KINDS,
    SecretSettings,
    candidates,
    corpus_findings,
    counted_outputs,
    find_secrets,
    form,
    labelled_findings,
    learn,
    made_findings,
    plain_findings,
    redact_secrets,
    replaced,
)

SMALL = SecretSettings(finding_rows=60, made_rows=400, epochs=3)


def by_rules(text):
    """The rules as they are written down, without shortcuts."""
    names = ("password", "passwd", "secret", "token", "api_?key")
    key = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in names) + ")"
    assign = rf"""{key}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(*m.span(), "assign") for m in re.finditer(assign, text) if len(m[1]) >= 8]
    spans += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def some_texts(seed, n):
    rng = random.Random(seed)
    parts = [
        "password", "PassWd", "api_key", "apikey", "API__KEY", "token", "SECRET", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIAAKIA",
        "ABCDEFGH0123", "abcdef01" * 4, "abcdef01" * 3, "g", "hunter2hunter2", "short", "été", "\n", "x.y/z+1=-", "12345678",
    ]
    return ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n)]


def test_rules_equal_their_definition():
    for text in some_texts(1, 4000):
        assert plain_findings(text) == by_rules(text), text


def test_candidates_are_apart_and_cover_every_value():
    for text in some_texts(2, 2000):
        base = plain_findings(text)
        own = candidates(text, base)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))
        assert all(e <= s2 or e2 <= s for s, e in own for s2, e2, _ in base)
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text):
            value = m[0].strip(".-").lstrip("=")
            if len(value) >= 10 and re.search("[0-9]", value) and not any(s < m.end() and m.start() < e for s, e, _ in base):
                assert any(s < m.end() and m.start() < e for s, e in own), (text, m)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = Network.start(5, width=3, filters=4, hidden=3)
    for p in (net.bias, net.hidden_bias, net.out_bias):
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.1
    for name in ("embed", "filters", "bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    flat, y = Flat([Example("ab= ", "x9Yz!9", " q"), Example("", "hello12", ""), Example("k:", "Zz0é", "\n")]), np.array([1.0, 0, 1])
    _, grads = net.gradients(flat, y)
    for p, g in zip(net.parameters(), grads, strict=True):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p is net.embed:
                at = (int(rng.choice(flat.codes[flat.codes > 0])), at[1])
            was, two = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = was + step
                two.append(net.gradients(flat, y)[0])
            p[at] = was
            assert g[at] == pytest.approx((two[0] - two[1]) / 2e-5, abs=2e-4)


def test_scores_do_not_depend_on_neighbours_or_blocks():
    net = Network.start(1)
    examples = [x for x, _ in made_findings(20, 4)] + [Example("", "a1" * 5000, ""), Example("key=", "z", "")]
    together = net.logits(Flat(examples))
    assert together == pytest.approx([net.logits(Flat([x]))[0] for x in examples], abs=1e-4)
    assert together == pytest.approx(net.logits(Flat(examples), block=97), abs=1e-3)
    assert len(net.logits(Flat([]))) == 0


def test_held_out_findings_and_thresholds():
    rows = made_findings(1200, 7)
    net = train([x for x, _ in rows], np.array([y for _, y in rows], float), 1, 3)
    kept = made_findings(600, 8)
    kinds = [form(x.value) for x, _ in kept]
    detector = calibrated(net, [x for x, _ in kept], np.array([y for _, y in kept], float), kinds, 0.95, 0.0)
    fresh = made_findings(600, 9)
    score, y = detector.scores([x for x, _ in fresh]), np.array([y for _, y in fresh])
    rank = np.argsort(np.argsort(score))
    assert (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum() > 0.99
    above = np.array([s >= detector.thresholds[form(x.value)] for s, (x, _) in zip(score, fresh, strict=True)])
    assert above[y == 1].mean() > 0.9 and above[y == 0].mean() < 0.02
    # calibrated: among findings with such a score, so many are secrets
    for low, high in ((0.0, 0.2), (0.8, 1.01)):
        own = (score >= low) & (score < high)
        assert abs(score[own].mean() - y[own].mean()) < 0.05


def test_recall_threshold():
    score = np.array([0.1, 0.4, 0.4, 0.9])
    assert recall_threshold(score, 0.5) == 0.4 and recall_threshold(score, 1.0) == 0.1
    assert recall_threshold(score[:0], 0.9) == float("inf")


def test_table(spark):
    long = "x " * 200_000 + "token = 'abcdefgh12345678' " + "9" * 100_000
    rows = [(k, t, "m", "n") for k, t in enumerate(some_texts(3, 60))]
    rows += [(900, None, "", ""), (901, "", "", ""), (None, "secret: 0123456789ab", "", ""), (5, rows[5][1], "", ""), (902, long, "", "")]
    rows += [(903, "set client_secret 'ghp_aB3dE5gH7jK9mN1pQ3sT5vX7zA9cE1gH3kL5' here", "", ""), (904, "order 2024-05-17 at 10.0.0.255 was ok", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_hex string").repartition(3)
    got = find_secrets(docs, SMALL).collect()
    assert len(got) == len(rows)
    text_of = {}
    for r in rows:
        text_of.setdefault(r[0], r[1] or "")
    for r in got:
        base = by_rules(text_of[r.doc_id])
        joined = [f"{k}:{s}:{e}" for s, e, k in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[2] == k for x in base) for k in KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [x for x in spans if x in joined] == joined and len(spans) == len(joined) + r.n_added
    made = learn(docs.select("doc_id", "text").limit(0), SecretSettings(made_rows=1500))
    added = {r.doc_id: r.n_added for r in find_secrets(docs, detector=made).collect()}
    assert added[903] == 1 and added[904] == 0 and added[900] == added[901] == 0
    assert find_secrets(docs.limit(0), SMALL).collect() == []


def test_findings_are_a_bounded_sample(spark):
    docs = spark.createDataFrame(list(enumerate(some_texts(3, 60))), "doc_id long, text string")
    few = corpus_findings(docs, SecretSettings(finding_rows=3))
    every = corpus_findings(docs, SecretSettings())
    for label in (0, 1):
        assert sum(y == label for _, y in few) == min(3, sum(y == label for _, y in every)) > 0
    assert all(x in every for x in few)


def test_learning_reads_every_finding(spark):
    docs = spark.createDataFrame(list(enumerate(some_texts(3, 60))), "doc_id long, text string")
    one, other = (learn(docs.repartition(n), replace(SMALL, finding_rows=n)) for n in (1, 4))
    assert one.thresholds == other.thresholds
    for p, q in zip(one.network.parameters(), other.network.parameters(), strict=True):
        assert (p == q).all()
    # a finding more, wherever its hash stands, is learned from
    for k in range(3):
        more = docs.union(spark.createDataFrame([(100, f"see client_key 'Qq{k}Zz0123456789' there")], docs.schema))
        found = labelled_findings(more)
        assert found.count() == labelled_findings(docs).count() + 1
        if found.where("pmod(key, 5) <> 0 and value like 'Qq%'").count():
            again = learn(more, replace(SMALL, finding_rows=1))
            assert any((p != q).any() for p, q in zip(one.network.parameters(), again.network.parameters(), strict=True))


def test_several_learners_learn_as_one(spark):
    made = made_findings(900, 21)
    rows = [(k, f"{x.before} {x.value[::-1]}{x.after} token={x.value}") for k, (x, y) in enumerate(made) if y]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = labelled_findings(docs)
    several = learn(docs, replace(SMALL, learner_rows=200))
    counted = counted_outputs(found, several.network, SMALL).groupBy("label").sum("n").collect()
    assert {r.label: r["sum(n)"] for r in counted} == {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    fresh = made_findings(600, 9)
    score, y = several.scores([x for x, _ in fresh]), np.array([y for _, y in fresh])
    rank = np.argsort(np.argsort(score))
    assert (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum() > 0.9


def test_weights_count_rows():
    score, weight = np.array([0.1, 0.4, 0.6, 0.9]), np.array([1, 3, 2, 2])
    for recall in (0.1, 0.5, 0.75, 0.95, 1.0):
        assert recall_threshold(score, recall, weight) == recall_threshold(np.repeat(score, weight), recall)
    x, y = np.array([[0.0], [1.0], [2.0], [3.0]]), np.array([0.0, 1, 0, 1])
    one, other = fit(x, y, weight=weight), fit(np.repeat(x, weight, axis=0), np.repeat(y, weight))
    assert one.logit(x) == pytest.approx(other.logit(x))


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "a token=abcdefgh1 b", 3), (2, None, 4)], "doc_id long, text string, n int")
    detector = learn(docs.select("doc_id", "text").where("text is not null"), SMALL)
    assert [tuple(r) for r in redact_secrets(docs, detector).orderBy("doc_id").collect()] == [(1, "a [SECRET] b", 3), (2, None, 4)]
    assert replaced("0123456789", [(1, 4, "hex"), (3, 6, "assign"), (8, 9, "hex")]) == "0[SECRET]67[SECRET]9"
