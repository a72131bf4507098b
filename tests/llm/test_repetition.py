import random
import re

import pytest

from gridloom.llm.repetition import RepetitionRules, filter_repetition, score_repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=RepetitionRules()):
    """The measures of one text by direct comparison of all pairs of suffixes."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen, windows, least = {}, {}, rules.min_run_words
    for i in range(n - least + 1):
        seen.setdefault(tuple(words[i : i + least]), []).append(i)
    for i in range(n - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeat = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    span, longest = set(), 0
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                best = 0
                for j in at:
                    k = 0
                    while j != i and i + k < n and j + k < n and words[i + k] == words[j + k]:
                        k += 1
                    best = max(best, k)
                span.update(range(i, i + best))
                longest = max(longest, best)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    covered = sum(len(words[i]) for i in span)
    failed = n < rules.min_words or 100 * len(repeat) > rules.max_repeat_words_pct * n
    kept = not failed and 100 * covered <= rules.max_covered_pct * chars and longest <= rules.max_longest_words
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (n, chars, symbols, len(lines) - len(set(lines)), len(repeat), failed, kept, covered, longest)


COLUMNS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "kept", "covered_chars", "longest_repeat_words",
]


def random_texts():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "é", "a " * 400, "x\ny\nx\n \nx", "\x85 a\xa0b", "#*$%&|<> <>"]
    for _ in range(120):
        words = rng.choices(["a", "bé", "ccc", "d漢"], k=rng.randint(0, 60))
        part = words[: rng.randint(0, 30)]
        texts.append(rng.choice([" ", "\n", "  "]).join(words + part + rng.choices("xyz", k=3) + part))
    texts.append(" ".join(str(k % 700) for k in range(3000)))
    return texts


def test_equals_brute_force(spark):
    texts = random_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in score_repetition(df).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("least", [2, 3, 6, 8, 11])
def test_other_shortest_runs_equal_brute_force(spark, least):
    texts, rules = random_texts(), RepetitionRules(min_run_words=least)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in score_repetition(df, rules).collect()}
    assert got == {k: brute(t, rules) for k, t in enumerate(texts)}


def test_short_phrases_fail_by_the_method_alone(spark):
    phrase = "buy this fine lamp now"
    spam = " ".join(f"{phrase} n{k}" for k in range(30))
    twice = " ".join([phrase, *(f"w{k}" for k in range(60)), phrase])
    df = spark.createDataFrame([(1, spam), (2, twice)], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept, r.longest_repeat_words) for r in score_repetition(df).collect()}
    assert got == {1: (False, False, 5), 2: (False, True, 5)}


def test_very_long_text(spark):
    words = [f"w{k * 7919 % 50021}" for k in range(200_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:40_000]))], "doc_id long, text string")
    got = {r.doc_id: (r.n_repeat_words, r.longest_repeat_words, r.kept) for r in score_repetition(df).collect()}
    assert got == {1: (200_000, 200_000 - 50_021, False), 2: (0, 0, True)}


def test_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in score_repetition(docs).collect()}
    want = {r.doc_id: brute(r.text) for r in docs.collect() if len(r.text) < 12000}
    assert len(got) == docs.count() and {k: got[k] for k in want} == want


def test_intervals_join_text_of_one_document_only(spark):
    line = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(1, line), (2, line), (2, line), (None, line)], "doc_id long, text string")
    got = score_repetition(df).collect()
    assert len(got) == 4 and all(r.kept and r.longest_repeat_words == 0 for r in got)


@pytest.mark.parametrize("limit, kept", [(29, False), (30, True)])
def test_longest_repeat_is_limited(spark, limit, kept):
    part, rest = [f"p{k}" for k in range(30)], [f"r{k}" for k in range(200)]
    df = spark.createDataFrame([(1, " ".join(part + rest + part))], "doc_id long, text string")
    row = score_repetition(df, RepetitionRules(max_longest_words=limit)).collect()[0]
    assert (row.longest_repeat_words, row.base_failed, row.kept) == (30, False, kept)


def test_filter_keeps_whole_rows_and_extra_columns(spark):
    good = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame(
        [(1, good, 7, True), (1, good, None, None), (2, "a b", 7, None), (None, good, 1, None), (3, None, 1, None)],
        "doc_id long, text string, n_words int, kept boolean",
    )
    out = filter_repetition(df)
    assert out.schema == df.schema
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.where("text like 'w0%'").collect()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert score_repetition(df).collect() == [] and filter_repetition(df).collect() == []
