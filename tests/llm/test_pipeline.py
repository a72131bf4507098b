import re

import corpus_pipeline
from public_tokenizers import path
from test_decontam import brute as contaminated
from test_neardup import brute as groups
from test_packing import check_pieces, encoded
from test_pii import brute as identifiers
from test_repetition import brute as measures

KEPT = 6  # place of the verdict in the measures


def by_brute_force(rows, items):
    """Texts by id after each stage, one document at a time."""
    stages = [{i: t for i, t in rows if measures(t)[KEPT]}]
    linked = groups(list(stages[-1].items()))
    stages.append({i: t for i, t in stages[-1].items() if linked[i][2]})
    stages.append({i: t for i, t in stages[-1].items() if not contaminated(t, items)[1]})
    redacted = {}
    for i, t in stages[-1].items():
        out, at = [], 0
        for s, e, kind in identifiers(t):
            if s >= at:
                out += [t[at:s], f"[{kind.upper()}]"]
                at = e
        redacted[i] = "".join(out) + t[at:]
    return [*stages, redacted]


def test_stages_equal_brute_force(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.where("length(text) < 8000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = by_brute_force(rows, [(r.item_id, r.text) for r in bench.collect()])
    sizes = [len(rows), *map(len, want)]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    now = docs
    for (_, stage), expected in zip(corpus_pipeline.STAGES, want, strict=False):
        now = stage(spark, now, sf)
        assert now.columns == docs.columns
        got = {r.doc_id: r for r in now.collect()}
        assert {i: r.text for i, r in got.items()} == expected
        assert all(r.n_chars == len(r.text) for r in got.values())
        now = spark.createDataFrame(list(got.values()), docs.schema)
    assert any(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", t) for t in want[-1].values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    final = list(want[-1].items())
    check_pieces(final, encoded([t for _, t in final], 2), pieces, 1024)
    assert path("byte_bpe_50k.json")


def test_run_packs_what_the_stages_keep(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    ids = {r.doc_id for r in got.collect()}
    assert 0 < len(ids) < spark.read.parquet(f"{sf}/documents.parquet").count()


def test_stages_take_empty_tables_nulls_and_extra_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, kept string"
    odd = spark.createDataFrame([(None, None, None, None, None, "x", None), (1, "", "en", "s", 0, None, "y")] * 2, schema)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and out.count() == 4
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == 4
