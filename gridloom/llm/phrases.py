"""Phrase collocations, counted in tiles of frequency-ranked ids.

Words get ids by falling frequency, so the pairs that matter lie in few tiles of the square of
ids.  Tasks count well-filled tiles by ``bincount`` at direct addresses and the others as sorted
coordinates.  Frequent pairs are ranked again and become the left sides of the next level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.ordered import global_position
from gridloom.core.session import cut_lineage
from gridloom.llm.batches import _LOWER, U64, Words, bounded_batches, chunks, mix


@dataclass(frozen=True)
class PhraseSettings:
    #: words of a phrase, at most
    longest: int = 5
    #: occurrences of a phrase, at least
    least: int = 100
    #: phrases of each language in the result
    top: int = 2000
    #: side of a tile, and pairs of a tile in the buffer that make it worth a dense array
    tile: int = 512
    dense: int = 8192
    #: dense arrays that a task holds, and pairs that it gathers before it counts them
    held_tiles: int = 16
    buffer: int = 1_000_000
    #: entries up to which a dictionary of words or pairs is broadcast; larger ones are joined
    broadcast_entries: int = 2_000_000


#: Ends of pieces and, besides them, of words.
BREAKS = ".,;:!?\n\x0b\x0c\r"
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in BREAKS]] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False
#: Ids of a stored row, beyond which it ends at the next gap, and bytes of text of one numpy step.
ROW_IDS, STEP_BYTES = 1024, 1_500_000
CODE = 2**31
RUNS = "ids array<int>, phrase array<int>"


def texts_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


class Pieces(Words):
    """Words of a chunk of (lang, text), each under a key of its own in each language."""

    def __init__(self, part: pa.RecordBatch):
        super().__init__(part.column(1), _INSIDE)
        langs = part.column(0).dictionary_encode()
        seeds = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs.dictionary.to_pylist()]
        self.lang = langs.indices.to_numpy()
        self.key = mix(self.hashes(lower=True) ^ np.array(seeds, np.uint64)[self.lang][self.doc])

    def after_gap(self) -> np.ndarray:
        """Whether a word begins a piece."""
        seen = np.r_[0, np.cumsum(_BREAK[self.data])][self.start]
        return np.r_[True, (seen[1:] != seen[:-1]) | (self.doc[1:] != self.doc[:-1])][: len(seen)]

    def strings(self, which: np.ndarray) -> pa.Array:
        """The lower-cased words at ``which``."""
        start, size = self.start[which], self.end[which] - self.start[which]
        at = np.r_[0, np.cumsum(size)]
        source = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
        offsets = pa.py_buffer(at.astype(np.int32).tobytes())
        return pa.StringArray.from_buffers(len(which), offsets, pa.py_buffer(_LOWER[self.data[source]].tobytes()))


def count_words(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words; tasks add up the words of each step first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=STEP_BYTES):
                words = Pieces(part)
                _, first, n = np.unique(words.key, return_index=True, return_counts=True)
                langs = part.column(0).take(pa.array(words.doc[first]))
                yield pa.RecordBatch.from_arrays([langs, words.strings(first), pa.array(n)], names=["lang", "word", "n"])

    rows = texts.mapInArrow(run, "lang string, word string, n long")
    return cut_lineage(rows.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def ranked(counts: DataFrame, *ties: str) -> DataFrame:
    """Rows with ``n`` and their ``id`` from 1 by falling ``n``."""
    placed = global_position(counts.withColumn("_less", -F.col("n")), ["_less", *ties], "id").drop("_less")
    return cut_lineage(placed.withColumn("id", F.col("id").cast("int")))


# ----------------------------------------------------------------------------- ids of words


def word_keys(words: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys of the ranked words in order, and their ids; None if two words share a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "word"):
                yield pa.RecordBatch.from_arrays([pa.array(Pieces(part).key.view(np.int64)), part.column(2)], names=["key", "id"])

    table = words.select("lang", "word", "id").mapInArrow(run, "key long, id int").toArrow()
    key, ids = table["key"].to_numpy().view(np.uint64), table["id"].to_numpy()
    order = np.argsort(key)
    key, ids = key[order], ids[order]
    return None if (key[1:] == key[:-1]).any() else (key, ids)


def found(keys: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The id of each wanted key, 0 if it has none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int32)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, ids[at], 0).astype(np.int32)


def stretches(ids: np.ndarray, phrase: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What phrases of ``size`` words cover, with one 0 behind each stretch."""
    covered = phrase > 0
    for k in range(1, size):
        covered[k:] |= phrase[: max(len(phrase) - k, 0)] > 0
    kept = covered.copy()
    kept[1:] |= covered[:-1]
    return np.where(covered, ids, 0)[kept], np.where(covered, phrase, 0)[kept]


def _run_rows(ids: np.ndarray, phrase: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``ROW_IDS`` ids or little more; each ends with a 0."""
    if not len(ids):
        return
    ends = np.flatnonzero(ids == 0) + 1
    cut, at = [0], 0
    while at < len(ids):
        at = int(ends[min(np.searchsorted(ends, at + ROW_IDS), len(ends) - 1)])
        cut.append(at)
    offsets = pa.array(np.array(cut, np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, phrase)]
    yield pa.RecordBatch.from_arrays(lists, names=["ids", "phrase"])


def word_runs(texts: DataFrame, words: DataFrame, settings: PhraseSettings) -> DataFrame:
    """Ids of frequent words in text order with a 0 wherever a run of them ends."""
    spark = texts.sparkSession
    lookup = word_keys(words) if words.count() <= settings.broadcast_entries else None
    if lookup is None:
        return cut_lineage(_word_runs_by_join(texts, words))
    shared = spark.sparkContext.broadcast(lookup)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=STEP_BYTES):
                pieces = Pieces(part)
                if len(pieces.key):
                    own, gap = found(*shared.value, pieces.key), pieces.after_gap()
                    place = np.arange(len(own)) + np.cumsum(gap) - 1
                    ids = np.zeros(place[-1] + 2, np.int32)
                    ids[place] = own
                    yield from _run_rows(*stretches(ids, ids, 1))

    return cut_lineage(texts.mapInArrow(run, RUNS))


def _word_runs_by_join(texts: DataFrame, words: DataFrame) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = cut_lineage(texts.select("lang", F.split(lower, r"[.,;:!?\n\x0b\x0c\r]").alias("pieces")).withColumn("row", F.monotonically_increasing_id()))
    flat = rows.select("row", "lang", F.posexplode("pieces").alias("piece", "part"))
    flat = flat.select("row", "lang", "piece", F.posexplode(F.split("part", r"[\x20\t]+")).alias("at", "word"))
    flat = flat.where("word <> ''").join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    return _joined_rows(flat, F.coalesce("id", F.lit(0)), F.coalesce("id", F.lit(0)), "piece", "at")


def _joined_rows(flat: DataFrame, ids: Column, phrase: Column, *order: str) -> DataFrame:
    """One row again for each ``row``; a change of all but the last of ``order`` is a gap."""
    entry = F.struct(*order, ids.alias("i"), phrase.alias("p"))
    rows = flat.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    last = F.element_at("e", -1)
    with_gaps = F.expr(
        "flatten(transform(e, (x, k) -> "
        + (f"if(k > 0 and x.{order[0]} <> e[greatest(k - 1, 0)].{order[0]}, array(struct(0 as i, 0 as p), struct(x.i, x.p)), array(struct(x.i, x.p)))" if len(order) > 1 else "array(struct(x.i, x.p))")
        + "))"
    )
    rows = rows.where(last.isNotNull()).select(F.concat(with_gaps, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("p")))).alias("e"))
    return rows.select(F.col("e.i").alias("ids"), F.col("e.p").alias("phrase"))


# ----------------------------------------------------------------------------- pairs in tiles


class Tiles:
    """Counts of pairs of ids: full tiles in dense arrays, other pairs as sorted coordinates."""

    def __init__(self, settings: PhraseSettings):
        self.s, self.dense, self.held, self.parts = settings, {}, 0, []

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((left, right))
        self.held += len(left)
        if self.held >= self.s.buffer:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        side = self.s.tile
        left, right = (np.concatenate(x).astype(np.int64) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        tile, own, n = np.unique(left // side * CODE + right // side, return_inverse=True, return_counts=True)
        rest = np.ones(len(left), dtype=bool)
        for k in np.argsort(-n):
            name = int(tile[k])
            if n[k] < self.s.dense or (name not in self.dense and len(self.dense) >= self.s.held_tiles):
                continue
            inside = np.flatnonzero(own == k)
            counts = np.bincount(left[inside] % side * side + right[inside] % side, minlength=side * side)
            self.dense[name] = self.dense[name] + counts if name in self.dense else counts
            rest[inside] = False
        key, n = np.unique(left[rest] * CODE + right[rest], return_counts=True)
        yield _pairs(key // CODE, key % CODE, n)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.flush()
        side = self.s.tile
        for name, counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield _pairs(name // CODE * side + at // side, name % CODE * side + at % side, counts[at])


def _pairs(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["left", "right", "n"])


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 1))


def _continued(phrase: np.ndarray) -> np.ndarray:
    """Places where frequent phrases begin both here and at the next word."""
    return np.flatnonzero((phrase[:-1] > 0) & (phrase[1:] > 0))


def count_pairs(runs: DataFrame, size: int, settings: PhraseSettings) -> DataFrame:
    """Frequent phrases of ``size`` words as ``left`` (all but the last), ``right`` and ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(settings)
        for batch in batches:
            ids, phrase = _flat(batch)
            at = _continued(phrase)
            yield from tiles.add(phrase[at], ids[at + size - 1])
        yield from tiles.end()

    counts = runs.mapInArrow(run, "left int, right int, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))
    return ranked(counts.where(F.col("n") >= settings.least), "left", "right")


def longer_runs(runs: DataFrame, pairs: DataFrame, size: int, settings: PhraseSettings) -> DataFrame:
    """The same texts with the ids of phrases of ``size`` words, cut down to what these cover."""
    spark = runs.sparkSession
    if pairs.count() > settings.broadcast_entries:
        rows = cut_lineage(runs.withColumn("row", F.monotonically_increasing_id()))
        flat = rows.select("row", "ids", "phrase", F.posexplode("ids").alias("at", "id"))
        left, after = (F.get("phrase", F.col("at") + k) for k in (0, 1))
        right = F.when((left > 0) & (after > 0), F.get("ids", F.col("at") + size - 1))
        flat = flat.select("row", "at", "id", left.alias("left"), right.alias("right"))
        flat = flat.join(pairs.select("left", "right", F.col("id").alias("pair")), ["left", "right"], "left")
        return cut_lineage(_joined_rows(flat, F.col("id"), F.coalesce("pair", F.lit(0)), "at"))
    table = pairs.select("left", "right", "id").toArrow()
    key = table["left"].to_numpy().astype(np.int64) * CODE + table["right"].to_numpy()
    order = np.argsort(key)
    shared = spark.sparkContext.broadcast((key[order], table["id"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, phrase = _flat(batch)
            at = _continued(phrase)
            new = np.zeros(len(ids), np.int32)
            new[at] = found(*shared.value, phrase[at].astype(np.int64) * CODE + ids[at + size - 1])
            yield from _run_rows(*stretches(ids, new, size))

    return cut_lineage(runs.mapInArrow(run, RUNS))


# ----------------------------------------------------------------------------- scores


def frequent_phrases(texts: DataFrame, counts: DataFrame, settings: PhraseSettings) -> DataFrame:
    """``lang, words, a`` of all phrases with ``least`` occurrences, single words included."""
    words = ranked(counts.where(F.col("n") >= settings.least), "lang", "word")
    level = words.select("id", "lang", F.array("word").alias("words"), F.col("n").alias("a"))
    last = words.select(F.col("id").alias("right"), F.col("word").alias("next"))
    out, runs = level, None
    for size in range(2, settings.longest + 1):
        if words.isEmpty():
            break
        runs = word_runs(texts, words, settings) if runs is None else longer_runs(runs, pairs, size - 1, settings)
        pairs = count_pairs(runs, size, settings)
        if pairs.isEmpty():
            break
        before = level.select(F.col("id").alias("left"), "lang", "words")
        level = pairs.join(before, "left").join(last, "right")
        level = cut_lineage(level.select("id", "lang", F.concat("words", F.array("next")).alias("words"), F.col("n").alias("a")))
        out = out.unionByName(level)
    return out.drop("id")


def rank_phrases(phrases: DataFrame, totals: DataFrame, settings: PhraseSettings) -> DataFrame:
    """The result rows: weakest cuts, phrases without an equally frequent longer one, ranks."""
    every = cut_lineage(phrases.withColumn("phrase", F.array_join("words", " ")))
    size = F.size("words")
    longer = every.where(size > 1)
    parts = F.array(*(F.array_join(F.slice("words", k, size - 1), " ") for k in (F.lit(1), F.lit(2))))
    # a longer phrase is never more frequent, so one that is as frequent is so at each step of growth
    covered = longer.where(size > 2).select("lang", "a", F.explode(parts).alias("phrase")).distinct()
    left = longer.join(covered, ["lang", "phrase", "a"], "left_anti").join(totals, "lang")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = left.select("lang", "phrase", "a", "n", "words", cut)
    cuts = cuts.select(
        "lang", "phrase", "a", "n", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    part = every.select("lang", "phrase", "a")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    score = F.expr("(1000 * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("w")
    scored = cut_lineage(cuts.groupBy("lang", "phrase", "a", "n").agg(weakest).select("lang", "phrase", "a", "n", "w.l", "w.r", "w.score"))
    # a language's best are the best of the best of its shares, so no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = max(1, int((scored.count() / settings.top) ** 0.5))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    best = scored.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    best = best.where(F.col("rank") <= settings.top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= settings.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, settings: PhraseSettings = PhraseSettings(), *, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the strongest phrases of each language.

    A phrase has 2 to ``longest`` words of one piece of text and ``least`` occurrences.  Its
    score is that of its weakest cut, 1000 a n / (l r) rounded down in exact arithmetic.  A
    phrase inside a longer one with as many occurrences is left out.  Ids, tiles and levels
    carry the language with the word, so all languages are counted at once.

    A null text has no words, a null language reads ``und`` (together with texts that say so).
    Repeated rows count as often as they occur.  Ties in score and count go by the phrase in
    byte order.  A text of any length is read whole and must fit in a task; one without breaks
    is one run.  An empty table, or one without a frequent phrase, gives no rows.  Other columns
    are not read.  In tasks, words are told apart by 64-bit keys.
    """
    bounded_batches(docs.sparkSession)
    texts = texts_of(docs, text_col, lang_col)
    counts = count_words(texts)
    totals = cut_lineage(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    return rank_phrases(frequent_phrases(texts, counts, settings), totals, settings)
