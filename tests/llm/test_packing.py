import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from gridloom.llm.binpack import SegmentTree, Slots, best_fit_decreasing, lower_bound, pack_histogram, reduce_dominated
from gridloom.llm.packing import PackSettings, pack_documents, packed_matrix, write_packed

JSON, RANKS = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")


def encoded(texts, end_id):
    tok = Tokenizer.from_file(JSON)
    return [e.ids + [end_id] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def optimum(items, capacity):
    """Fewest bins, by trying everything."""
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[k] <= capacity and bins[b] not in bins[:b]:
                go(k + 1, bins[:b] + [bins[b] + items[k]] + bins[b + 1 :])
        go(k + 1, bins + [items[k]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 13, 20])
    items = sorted((rng.randint(1 + capacity // 6, capacity) for _ in range(rng.randint(1, 11))), reverse=True)
    left = dict(Counter(items))
    fixed = reduce_dominated(left, capacity)
    assert all(sum(p) <= capacity for p, _ in fixed.bins)
    rest = [s for s, n in left.items() for _ in range(n)]
    assert Counter(rest) + Counter(s for p, n in fixed.bins for s in p * n) == Counter(items)
    best = optimum(items, capacity)
    assert fixed.total + optimum(sorted(rest, reverse=True), capacity) == best
    assert lower_bound(Counter(items), capacity) <= best <= pack_histogram(Counter(items), capacity).total


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_equals_item_by_item(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 50, 100])
    sizes = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 400)))
    bins = []
    for s in sorted(sizes.elements(), reverse=True):
        fits = [b for b in bins if sum(b) + s <= capacity]
        target = max(fits, key=sum) if fits else None
        if target is None:
            bins.append(target := [])
        target.append(s)
    got = best_fit_decreasing(dict(sizes), capacity)
    assert got.total == len(bins)
    assert Counter(sum(p) for p, n in got.bins for _ in range(n)) == Counter(map(sum, bins))


def test_segment_tree():
    tree = SegmentTree(9)
    for k in (3, 7, 9):
        tree.set(k, True)
    tree.set(7, False)
    assert [tree.at_least(k) for k in range(10)] == [3, 3, 3, 3, 9, 9, 9, 9, 9, 9]
    tree.set(9, False)
    assert tree.at_least(4) is None


def test_slots_fill_bins_without_gaps():
    sizes = {5: 7, 3: 11, 2: 20, 10: 2, 7: 5}
    packing = pack_histogram(dict(sizes), 10)
    places = defaultdict(list)
    for s, n in sizes.items():
        for b, at in zip(*Slots(packing).find(np.full(n, s), np.arange(n)), strict=True):
            places[b].append((at, s))
    assert len(places) == packing.total
    for items in places.values():
        end = 0
        for at, s in sorted(items):
            assert at == end
            end += s
        assert end <= 10


def texts_and_frame(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "γάμμα", "漢字", "don't", "\n", "<|endoftext|>", "x" * 40]
    texts = [None, "", " ", "word " * 3000, "<|endoftext|>", "a\x1cb\x85c\xa0d"]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 260))) for _ in range(150)] + ["same text"] * 40
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(None, "no id", 2), (7, texts[7], 3)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, piece int").repartition(5)


def check_pieces(rows, ids, got, capacity):
    """Pieces put the ids together again, and sequences have neither gaps nor too many ids."""
    want = Counter()
    for row, own in zip(rows, ids, strict=True):
        start = 0
        for k in range(-(-len(own) // capacity)):
            end = len(own) - capacity * (-(-len(own) // capacity) - 1 - k)
            crc = zlib.crc32(np.array(own[start:end], "<u4").tobytes())
            want[row[0], k, start, end - start, crc] += 1
            start = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        end = 0
        for at, size in sorted(items):
            assert at == end
            end += size
        assert end <= capacity
    return len(places)


def test_pack_documents(spark):
    rows, df = texts_and_frame(spark)
    ids = encoded([r[1] for r in rows], 2)
    got = pack_documents(df, PackSettings(JSON, RANKS, capacity=128)).collect()
    n = check_pieces(rows, ids, got, 128)
    assert n <= 1.02 * lower_bound(Counter(r.length for r in got), 128) + 1


def test_pack_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = pack_documents(docs, PackSettings(JSON, RANKS)).collect()
    check_pieces(rows, encoded([r[1] for r in rows], 2), got, 1024)


def test_matrix_round_trip(spark, tmp_path):
    rows, df = texts_and_frame(spark)
    ids = encoded([r[1] for r in rows], 50256)
    settings = PackSettings(JSON, RANKS, capacity=128, end_id=50256, width=2)
    write_packed(df, settings, str(tmp_path / "packed"), pad_id=9)
    back = defaultdict(list)
    for r in spark.read.parquet(str(tmp_path / "packed")).collect():
        line = np.frombuffer(r.input_ids, "<u2")
        assert len(line) == 128 and (line[r.n_tokens :] == 9).all()
        assert r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens and r.n_segments == len(r.pieces)
        for k, doc in enumerate(r.doc_ids):
            back[doc, r.first_positions[k], r.pieces[k]].append(line[r.cu_seqlens[k] : r.cu_seqlens[k + 1]].tolist())
    texts = defaultdict(list)
    for (doc, _, _), parts in sorted(back.items(), key=lambda x: (x[0][0] is not None, x[0])):
        texts[doc] += parts[0] if doc != 7 else parts[0]
    assert {k: v for k, v in texts.items()} == {r[0]: i for r, i in zip(rows, ids, strict=True)}
    assert len(back[7, 0, 0]) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    settings = PackSettings(JSON, RANKS)
    assert pack_documents(df, settings).collect() == [] and packed_matrix(df, settings).collect() == []
