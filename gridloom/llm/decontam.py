"""Benchmark decontamination by a positional inverted index of the documents.

The index is partitioned by document: each of its rows holds the postings (term, positions)
of one document, so a frequent term's list is spread over all tasks and lists are
intersected without a shuffle.  Only terms of the benchmark have postings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import ALNUM, Words, bounded_batches, chunks, id_and_text, utf8

WINDOW = 10
#: Items matched at once; more are matched in blocks, so what is broadcast stays bounded.
BLOCK_ITEMS = 20_000

#: Rarest terms of a window around which its other words are looked for.
NEAR_ANCHORS = 3

INDEX = "row_key long, doc_id long, n_words long, terms binary, sizes binary, positions binary"


def item_terms(items: list[str | None]) -> list[np.ndarray]:
    """Hashes of each item's words in order."""
    w = Words(pa.array([t or "" for t in items], pa.large_string()), ALNUM)
    return np.split(w.hashes(lower=True), w.first[1:-1]) if items else []


def _packed(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Lists of 32-bit numbers, cut at ``at``, as binary values."""
    data, ends = pa.py_buffer(values.astype("<i4").tobytes()), pa.py_buffer((4 * at).astype("<i4").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, ends, data])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of binary lists end to end, and how many each list has."""
    data, at = utf8(column)
    return data.view("<i4").astype(np.int64) if len(data) else np.zeros(0, np.int64), np.diff(at) // 4


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Postings of the terms in ``vocabulary`` (sorted hashes), one row per document.

    ``terms`` are places in the vocabulary, ``sizes`` the number of each one's positions; all
    lists are little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        # most words are no terms of the benchmark: a bit table tells before the binary search
        bits = max(16, min(26, int(len(vocab)).bit_length() + 5))
        maybe = np.zeros(1 << bits, dtype=bool)
        maybe[vocab >> np.uint64(64 - bits)] = True
        for batch in batches:
            for part in chunks(batch):
                w = Words(part.column(1), ALNUM)
                hashes = w.hashes(lower=True)
                at = np.flatnonzero(maybe[hashes >> np.uint64(64 - bits)])
                term = np.searchsorted(vocab, hashes[at])
                known = vocab[np.minimum(term, len(vocab) - 1)] == hashes[at] if len(vocab) else np.zeros(len(at), bool)
                at, term = at[known], term[known]
                doc = w.doc[at]
                order = np.lexsort((at, term, doc))
                at, term, doc = at[order], term[order], doc[order]
                fresh = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])][: len(at)])
                n = part.num_rows
                list_at = np.searchsorted(doc[fresh], np.arange(n + 1))
                post_at = np.searchsorted(doc, np.arange(n + 1))
                sizes = np.diff(np.r_[fresh, len(at)])
                columns = [part.column(2), part.column(0), pa.array(w.counts()), _packed(term[fresh], list_at)]
                columns += [_packed(sizes, list_at), _packed(at - w.first[doc], post_at)]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in INDEX.split(", ")])

    bounded_batches(spark)
    return docs.mapInArrow(run, INDEX)


@dataclass
class Phrases:
    """Windows of a block of items: ``terms`` row by row, each with the order of its terms by rarity."""

    items: list[str]
    item: np.ndarray = field(default=None)
    length: np.ndarray = field(default=None)
    terms: np.ndarray = field(default=None)
    by_rarity: np.ndarray = field(default=None)

    @classmethod
    def of(cls, items: list[str], words: list[np.ndarray], vocabulary: np.ndarray, frequency: np.ndarray) -> Phrases:
        item, length, terms = [], [], []
        for k, own in enumerate(words):
            size = min(WINDOW, len(own))
            if size:
                own = np.searchsorted(vocabulary, own)
                for s in range(len(own) - size + 1):
                    item.append(k)
                    length.append(size)
                    terms.append(np.r_[own[s : s + size], np.full(WINDOW - size, -1)])
        out = cls(items, np.array(item, np.int64), np.array(length, np.int64), np.array(terms, np.int64).reshape(-1, WINDOW))
        rarity = np.where(out.terms < 0, np.iinfo(np.int64).max, frequency[np.maximum(out.terms, 0)]) if len(item) else out.terms
        out.by_rarity = np.argsort(rarity, axis=1, kind="stable")
        return out

    def anchors(self, most: int) -> np.ndarray:
        """(term, window, offset there, place by rarity) of each window's ``most`` rarest terms, by term."""
        rows = np.repeat(np.arange(len(self.item)), most)
        rarity = np.tile(np.arange(most), len(self.item))
        keep = rarity < self.length[rows]
        rows, rarity = rows[keep], rarity[keep]
        offset = self.by_rarity[rows, rarity]
        out = np.stack([self.terms[rows, offset], rows, offset, rarity])
        return out[:, np.argsort(out[0], kind="stable")]


MATCH = "row_key long, doc_id long, n_words long, hit array<int>, exact array<string>, near array<string>"


class Matcher:
    """Intersects offset-adjusted postings, from the rarest term of each window on."""

    def __init__(self, phrases: Phrases, slop: int, near_terms: int):
        self.p, self.slop, self.near_terms = phrases, slop, near_terms
        self.term, self.window, self.offset, self.rarity = phrases.anchors(NEAR_ANCHORS)

    def match(self, n_words: np.ndarray, doc: np.ndarray, term: np.ndarray, position: np.ndarray):
        """(hit positions' doc and position, exact (doc, item), near (doc, item)) of postings."""
        p = self.p
        base = np.r_[0, np.cumsum(n_words)]
        lo, hi = np.searchsorted(self.term, term), np.searchsorted(self.term, term, side="right")
        times = hi - lo
        post = np.repeat(np.arange(len(term)), times)
        own = np.arange(len(post)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
        window, start, rarity = self.window[own], position[post] - self.offset[own], self.rarity[own]
        at = doc[post]
        inside = (start >= -self.slop) & (start < n_words[at])
        window, start, at, rarity = window[inside], start[inside], at[inside], rarity[inside]
        # the postings of all terms by place: a list's entry at start + offset is looked up directly
        place = np.full(base[-1] + 1, -1, np.int64)
        place[base[doc] + position] = term

        def has(window, start, at, k, shift=0):
            """Whether the window's k-th word stands at its place, moved by ``shift``."""
            to = start + k + shift
            ok = (to >= 0) & (to < n_words[at])
            return ok & (place[np.where(ok, base[at] + to, -1)] == p.terms[window, k]) & (p.terms[window, k] >= 0)

        live = np.arange(len(window))
        fits = (rarity == 0) & (start >= 0) & (start + p.length[window] <= n_words[at])
        live = live[fits]
        for r in range(1, WINDOW):
            if not len(live):
                break
            k = p.by_rarity[window[live], r]
            live = live[(k >= p.length[window[live]]) | has(window[live], start[live], at[live], k)]
        exact = np.zeros(len(window), dtype=bool)
        exact[live] = True
        rest = np.flatnonzero(~exact)
        found = np.zeros(len(rest), np.int64)
        for k in range(WINDOW):
            any_ = np.zeros(len(rest), dtype=bool)
            for shift in range(-self.slop, self.slop + 1):
                any_ |= has(window[rest], start[rest], at[rest], np.full(len(rest), k), shift)
            found += any_
        # a short item needs the same share of its words, rounded up
        near = rest[found * WINDOW >= self.near_terms * p.length[window[rest]]]
        pair = lambda x: np.unique(np.stack([at[x], p.item[window[x]]]), axis=1)
        delta = np.zeros(base[-1] + 1, np.int64)
        np.add.at(delta, base[at[live]] + start[live], 1)
        np.add.at(delta, base[at[live]] + start[live] + p.length[window[live]], -1)
        hit = np.flatnonzero(np.cumsum(delta)[:-1] > 0)
        hit_doc = np.searchsorted(base, hit, side="right") - 1
        return (hit_doc, hit - base[hit_doc]), pair(live), pair(near)


def _lists(count: int, doc: np.ndarray, values: pa.Array) -> pa.ListArray:
    at = np.searchsorted(doc, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)


def find_matches(index: DataFrame, phrases: Phrases, *, slop: int, near_terms: int) -> DataFrame:
    """For each indexed document, hit positions and the items matched exactly or nearly."""
    shared = index.sparkSession.sparkContext.broadcast(Matcher(phrases, slop, near_terms))
    names = pa.array(phrases.items, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            words = whole.column("n_words").to_numpy()
            step = np.cumsum(np.maximum(words, 1)) // 500_000  # documents of so many words at once
            for value in np.unique(step):
                first, last = np.searchsorted(step, [value, value + 1])
                b = whole.slice(first, last - first)
                n_words, n = b.column("n_words").to_numpy(), b.num_rows
                term = np.repeat(_unpacked(b.column("terms"))[0], _unpacked(b.column("sizes"))[0])
                position, per_doc = _unpacked(b.column("positions"))
                hit, exact, near = shared.value.match(n_words, np.repeat(np.arange(n), per_doc), term, position)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row_key"), b.column("doc_id"), b.column("n_words")]
                    + [_lists(n, hit[0], pa.array(hit[1].astype(np.int32)))]
                    + [_lists(n, x[0], names.take(pa.array(x[1]))) for x in (exact, near)],
                    names=[x.split()[0] for x in MATCH.split(", ")],
                )

    return index.mapInArrow(run, MATCH)


def term_frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """Documents that have each term; tasks count before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for b in batches:
            total += np.bincount(_unpacked(b.column(0))[0], minlength=terms)[:terms]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    counts = index.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, np.int64)
    for r in counts.collect():  # bounded by the terms of a block of items
        out[r.term] = r.n
    return out


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    slop: int = 2,
    near_terms: int = 8,
    block_items: int = BLOCK_ITEMS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Exact phrase and proximity matches of benchmark items in every document.

    Words are runs of a-z, 0-9 and characters beyond ASCII, A-Z read as a-z.  A window is 10
    consecutive words of an item; an item with fewer is one window.  One row per row of
    ``docs``: ``doc_id, n_words, hit`` (positions of words inside an occurrence of a window),
    ``exact`` (items with an occurring window) and ``near``: items of which at least
    ``near_terms`` of a window's 10 words (of a shorter item the same share) stand within
    ``slop`` of their places around one of its three rarest words, unless the item matches
    exactly.

    Items are matched in blocks of ``block_items`` against all documents, so terms and
    windows on the driver and in broadcasts are bounded.  Null texts and items have no words;
    an item without words never matches; a null item id reads as "null".  Rows with null or
    repeated ids count for themselves; repeated item ids count once.
    """
    pairs = id_and_text(docs, id_col, text_col)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    blocks = max(1, math.ceil(items.count() / block_items))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    pairs = pairs.withColumn("row_key", F.monotonically_increasing_id())
    if blocks > 1:  # the keys must stay what they are from block to block
        pairs = cut_lineage(pairs)
    done = None
    for k in range(blocks):
        rows = sorted(map(tuple, items.where(F.col("block") == k).select("item_id", F.coalesce("text", F.lit(""))).collect()))
        words = item_terms([t for _, t in rows])
        vocabulary = np.unique(np.concatenate(words)) if rows else np.zeros(0, np.uint64)
        index = cut_lineage(build_index(pairs, vocabulary))
        phrases = Phrases.of([i for i, _ in rows], words, vocabulary, term_frequencies(index, len(vocabulary)))
        found = find_matches(index, phrases, slop=slop, near_terms=near_terms)
        done = found if done is None else done.unionByName(found)
    if blocks > 1:  # one row per block for each document
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("hit", "exact", "near")]
        done = done.groupBy("row_key").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("n_words").alias("n_words"), *lists)
    merged = {c: F.array_sort(F.array_distinct(c)) for c in ("hit", "exact", "near")}
    done = done.select("doc_id", "n_words", *(e.alias(c) for c, e in merged.items()))
    return done.withColumn("near", F.array_except("near", "exact"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, broadcast_texts: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` without any word inside a benchmark window, with all their columns.

    A text alone decides, so what goes is matched by a 64-bit hash of the text; null or
    repeated ids do no harm.
    """
    text_key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    found = match_benchmark(docs.select(text_key.alias("_key"), "text"), benchmark, id_col="_key")
    dirty = cut_lineage(found.where(F.size("hit") > 0).select(F.col("doc_id").alias("_key")).distinct())
    few = dirty.count() <= broadcast_texts
    return docs.join(F.broadcast(dirty) if few else dirty, text_key == dirty["_key"], "left_anti")
