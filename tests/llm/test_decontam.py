import random
import re

from gridloom.llm.decontam import drop_contaminated, match_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        k = min(10, len(other))
        for i in range(len(other) - k + 1 if k else 0):
            for j in range(len(own) - k + 1):
                if own[j : j + k] == other[i : i + k]:
                    hit.update(range(j, j + k))
                    found.add(str(item) if item is not None else "null")
    return len(own), sorted(hit), sorted(found)


def random_case():
    rng = random.Random(11)
    vocab = ["a", "B", "c3", "é", "漢", "the", "x-y", "don't"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(25)]
    items += [(100, None), (101, "  "), (None, "null item " * 6), (3, items[3][1]), (7, "The B c3 the B c3 THE B, c3. the b")]
    texts = [None, "", " ", "é", "\x00"]
    for _ in range(150):
        text = rng.choices(vocab, k=rng.randint(0, 60))
        if rng.random() < 0.5:
            text += (rng.choice(items)[1] or "").split()[rng.randint(0, 3) :]
        texts.append(rng.choice([" ", "\n", ", "]).join(text + rng.choices(vocab, k=rng.randint(0, 5))))
    return items, texts


def test_equals_brute_force(spark):
    items, texts = random_case()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {k: brute(t, items) for k, t in enumerate(texts)}
    for block in (20_000, 4):
        got = match_benchmark(df, bench, block_items=block).collect()
        assert {r.doc_id: (r.n_words, r.hit, r.exact) for r in got} == want and len(got) == len(texts)


def test_documents_table(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {r.doc_id: (r.n_words, r.hit, r.exact) for r in match_benchmark(docs, bench).collect()}
    rows = [r for r in docs.collect() if len(r.text) < 3000]
    assert {r.doc_id: got[r.doc_id] for r in rows} == {r.doc_id: brute(r.text, items) for r in rows}
    assert any(x[1] for x in got.values())


def test_near_matches(spark):
    passage = [f"w{k}" for k in range(30)]
    changed = passage.copy()
    for k in (3, 12, 13, 21, 22):
        changed[k] = "other"
    moved = passage[5:9] + ["inserted"] + passage[9:13] + passage[14:16]
    rows = [(1, " ".join(changed)), (2, " ".join(moved)), (3, "w1 w2 w3 w4 w5"), (4, " ".join(passage))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([("p", " ".join(passage))], "item_id string, text string")
    got = {r.doc_id: r for r in match_benchmark(df, bench).collect()}
    assert [(got[k].near, got[k].exact) for k in (1, 2, 3, 4)] == [(["p"], []), (["p"], []), ([], []), ([], ["p"])]


def brute_near(texts, items, slop=2, least=8):
    """Items near in each text: every place of every window, around its three rarest words."""
    own = [words(t) for t in texts]
    in_texts = {}
    for w in own:
        for t in set(w):
            in_texts[t] = in_texts.get(t, 0) + 1
    out = [set() for _ in texts]
    for item, other in items:
        other = words(other)
        k = min(10, len(other))
        for i in range(len(other) - k + 1 if k else 0):
            window = other[i : i + k]
            anchors = sorted(range(k), key=lambda o: (in_texts.get(window[o], 0), o))[:3]
            for d, w in enumerate(own):
                for start in {p - o for o in anchors for p in range(len(w)) if w[p] == window[o] and p - o >= -slop}:
                    there = sum(window[o] in w[max(start + o - slop, 0) : max(start + o + slop + 1, 0)] for o in range(k))
                    if 10 * there >= least * k:
                        out[d].add(str(item) if item is not None else "null")
    return out


def test_near_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"v{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([0, 2, 5, 9, 10, 14, 30])))) for k in range(30)]
    texts = [None, "", "v1"]
    for _ in range(120):
        text = rng.choices(vocab, k=rng.randint(0, 40))
        part = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            if part:
                part[rng.randrange(len(part))] = rng.choice([*vocab, "two words"])
        texts.append(" ".join(text[: rng.randint(0, 20)] + part + text[20:]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    near = brute_near(texts, items)
    want = {k: sorted(near[k] - set(brute(t, items)[2])) for k, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 20
    for block in (20_000, 4):
        got = match_benchmark(df, bench, block_items=block).collect()
        assert {r.doc_id: r.near for r in got} == want


def test_very_long_text_is_matched_to_its_end(spark):
    passage = " ".join(f"p{k}" for k in range(10))
    text = " ".join(f"w{k % 977}" for k in range(300_000)) + " " + passage
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", passage)], "item_id string, text string")
    assert [(r.n_words, r.hit[0], len(r.hit), r.exact) for r in match_benchmark(df, bench).collect()] == [(300_010, 300_000, 10, ["i"])]


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    rows = [(None, passage, 1), (1, "clean text", 2), (1, "clean text", 2), (1, passage, 3), (2, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hit int")
    bench = spark.createDataFrame([(1, passage, 5)], "item_id long, text string, doc_id int")
    assert sorted(len(r.hit) for r in match_benchmark(df, bench).collect()) == [0, 0, 0, 12, 12]
    kept = drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, rows[1:3] + rows[4:]))
    assert match_benchmark(df.limit(0), bench).collect() == []
    assert [r.n_words for r in match_benchmark(df, bench.limit(0)).orderBy("n_words").collect()] == [0, 2, 2, 12, 12]
    assert drop_contaminated(df, bench.limit(0)).count() == 5
