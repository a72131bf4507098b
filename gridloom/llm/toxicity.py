"""Toxicity by class-conditional Kneser-Ney models of subword bigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import bounded_batches, chunks, id_and_text
from gridloom.llm.encoding import encoder
from gridloom.llm.logistic import Logistic, fit


@dataclass(frozen=True)
class ToxicitySettings:
    path: str
    ranks: str | None = None
    vocabulary: int = 50_257
    #: bigrams broadcast at once; a larger model is applied in slices, each over all documents
    slice_bigrams: int = 4_000_000
    #: labelled ids of the calibration fold that fit the final logistic curve, at most
    calibration_rows: int = 50_000
    #: label rows up to which the labels are broadcast
    broadcast_labels: int = 1_000_000


#: Log-ratio of a token beyond which it counts as excess, and how many of the largest are looked at.
EXCESS, PEAKS = 2.0, 4
FEATURES = ("mean", "root", "size", "excess", "peak")


def fold(column) -> F.Column:
    """crc32 of the id as text, modulo 5: 0 is held out, 4 calibrates, the others train."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)), F.lit(-1))


def bigrams(ids: np.ndarray, vocabulary: int) -> np.ndarray:
    """Each token after the one before it (or the start) as one number."""
    before = np.r_[vocabulary, ids[:-1]].astype(np.int64)[: len(ids)]
    return before * (vocabulary + 1) + ids.astype(np.int64)


def _encoded(part: pa.RecordBatch, settings: ToxicitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of all texts of a chunk, lower-cased, and the number in each."""
    encode = encoder(settings.path, settings.ranks).encode
    own = [bigrams(encode(t.lower()), settings.vocabulary) for t in part.column(1).to_pylist()]
    return np.concatenate(own) if own else np.zeros(0, np.int64), np.array([len(x) for x in own], np.int64)


def count_bigrams(labelled: DataFrame, settings: ToxicitySettings) -> DataFrame:
    """(key, ordinary, toxic): tokens of each bigram in texts of either class.

    Tasks add up their own counts first; every labelled row counts.
    """

    def flush(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros((len(key), 2), np.int64)
        np.add.at(total, place, np.concatenate(counts))
        return key, total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out(key, total):
            columns = [pa.array(key), pa.array(total[:, 0].copy()), pa.array(total[:, 1].copy())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "ordinary", "toxic"])

        for batch in batches:
            for part in chunks(batch):
                own, n = _encoded(part, settings)
                label = np.repeat(part.column(2).to_numpy(), n)
                for c in (0, 1):
                    key, times = np.unique(own[label == c], return_counts=True)
                    two = np.zeros((len(key), 2), np.int64)
                    two[:, c] = times
                    keys.append(key)
                    counts.append(two)
                    held += len(key)
                if held > 2_000_000:
                    key, total = flush(keys, counts)
                    keys, counts, held = [key], [total], len(key)
                    if held > 1_000_000:
                        yield out(key, total)
                        keys, counts, held = [], [], 0
        if keys:
            yield out(*flush(keys, counts))

    bounded_batches(labelled.sparkSession)
    rows = labelled.mapInArrow(run, "key long, ordinary long, toxic long")
    return cut_lineage(rows.groupBy("key").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))


@dataclass
class Backoff:
    """What is bounded by the vocabulary, for the ordinary (0) and the toxic (1) class."""

    vocabulary: int
    discount: np.ndarray  # of each class
    total: np.ndarray  # (class, token): tokens after this one
    left_over: np.ndarray  # (class, token): weight of the lower order after this one
    unigram: np.ndarray  # (class, token): probability by continuations, smoothed by both classes'


def backoff(counts: DataFrame, vocabulary: int) -> Backoff:
    """Kneser-Ney levels by grouped aggregation of the bigram table.

    A class's unigrams count the tokens that one follows in that class, and back off to the
    same counts over both classes, and these to a uniform share.
    """
    size = vocabulary + 1
    first = F.expr(f"key div {size}").alias("token")
    last = F.expr(f"key % {size}").alias("token")
    kinds = [F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).alias(f"{c}_kinds") for c in ("ordinary", "toxic")]
    sums = [F.sum(c).alias(c) for c in ("ordinary", "toxic")]
    total, after, before, pooled = np.zeros((2, size)), np.zeros((2, size)), np.zeros((2, size)), np.zeros(size)
    for r in counts.groupBy(first).agg(*sums, *kinds).collect():  # at most one row per vocabulary entry
        total[:, r.token], after[:, r.token] = (r.ordinary, r.toxic), (r.ordinary_kinds, r.toxic_kinds)
    for r in counts.groupBy(last).agg(*kinds, F.count(F.lit(1)).alias("n")).collect():
        before[:, r.token], pooled[r.token] = (r.ordinary_kinds, r.toxic_kinds), r.n
    few = counts.agg(*(F.sum(F.when(F.col(c) == k, 1).otherwise(0)) for c in ("ordinary", "toxic") for k in (1, 2))).first()
    few = np.array([x or 0 for x in few], float).reshape(2, 2)
    discount = (few[:, 0] + 0.5) / (few[:, 0] + 2 * few[:, 1] + 1)
    shared = (pooled + 0.5) / (pooled.sum() + 0.5 * size)
    unigram, left_over = np.empty((2, size)), np.empty((2, size))
    for c in (0, 1):
        ones, twos = (before[c] == 1).sum(), (before[c] == 2).sum()
        lower = (ones + 0.5) / (ones + 2 * twos + 1)
        all_ = max(before[c].sum(), 1)
        free = 1 - np.maximum(before[c] - lower, 0).sum() / all_
        unigram[c] = np.maximum(before[c] - lower, 0) / all_ + free * shared
        left_over[c] = np.where(total[c] > 0, discount[c] * after[c] / np.maximum(total[c], 1), 1)
    return Backoff(vocabulary, discount, total, left_over, unigram)


class Ratios:
    """Log-ratios of both classes for bigrams whose key falls into one slice."""

    def __init__(self, levels: Backoff, key: np.ndarray, counts: np.ndarray):
        order = np.argsort(key)
        self.levels, self.key, self.counts = levels, key[order], counts[order]

    def __call__(self, key: np.ndarray) -> np.ndarray:
        m, size = self.levels, self.levels.vocabulary + 1
        u, w = key // size, key % size
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        seen = self.key[at] == key if len(self.key) else np.zeros(len(key), dtype=bool)
        logs = []
        for c in (0, 1):
            n = np.where(seen, self.counts[at, c], 0) if len(self.key) else np.zeros(len(key))
            p = np.maximum(n - m.discount[c], 0) / np.maximum(m.total[c][u], 1) + m.left_over[c][u] * m.unigram[c][w]
            logs.append(np.log(p))
        return logs[1] - logs[0]


def _parts(ratio: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum, excess and largest values of each text's log-ratios."""
    out = np.zeros((len(sizes), 2 + PEAKS))
    ends = np.cumsum(sizes)
    for k, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)):
        own = ratio[a:b]
        out[k, 0], out[k, 1] = own.sum(), np.maximum(own - EXCESS, 0).sum()
        top = np.sort(np.partition(own, -PEAKS)[-PEAKS:] if len(own) > PEAKS else own)[::-1]
        out[k, 2 : 2 + len(top)] = np.maximum(top, 0)
    return out


def _features(parts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = np.maximum(sizes, 1)
    columns = [parts[:, 0] / n, parts[:, 0] / np.sqrt(n), np.log1p(sizes), parts[:, 1] / np.sqrt(n), parts[:, 2:].sum(axis=1)]
    return np.stack(columns, axis=1)


def text_features(pairs: DataFrame, counts: DataFrame, levels: Backoff, settings: ToxicitySettings) -> DataFrame:
    """``doc_id`` and the features of each row: length-normalised log-ratios of the two models.

    The bigram table goes to the workers in slices of bounded size, by the key's remainder.
    With one slice a single pass does; with more, rows get a key, every slice adds its share,
    and the shares of a row are put together.
    """
    spark = pairs.sparkSession
    slices = max(1, -(-counts.count() // settings.slice_bigrams))
    bounded_batches(spark)
    names = [f"p{k}" for k in range(2 + PEAKS)]
    if slices > 1:
        pairs = cut_lineage(pairs.withColumn("row_key", F.monotonically_increasing_id()))
    passes = []
    for k in range(slices):
        rows = counts.where(F.col("key") % slices == k).toPandas() if slices > 1 else counts.toPandas()
        model = Ratios(levels, rows["key"].to_numpy(np.int64), rows[["ordinary", "toxic"]].to_numpy(np.float32))
        shared = spark.sparkContext.broadcast(model)
        extra = ["row_key"] if slices > 1 else []

        def run(batches, shared=shared, k=k, extra=extra):
            for batch in batches:
                for part in chunks(batch):
                    key, sizes = _encoded(part, settings)
                    ratio = shared.value(key)
                    if slices > 1:
                        mine = key % slices == k
                        parts = _parts(ratio[mine], np.diff(np.r_[0, np.cumsum(mine)][np.r_[0, np.cumsum(sizes)]]))
                    else:
                        parts = _parts(ratio, sizes)
                    columns = [part.column(0), *(part.column(c) for c in extra), pa.array(sizes), *map(pa.array, parts.T.copy())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *extra, "n", *names])

        schema = "doc_id long, " + "row_key long, " * len(extra) + "n long, " + ", ".join(f"{c} double" for c in names)
        passes.append(pairs.mapInArrow(run, schema))
    if slices == 1:
        return passes[0]
    rows = passes[0]
    for p in passes[1:]:
        rows = rows.union(p)
    peaks = F.slice(F.sort_array(F.flatten(F.collect_list(F.array(*names[2:]))), asc=False), 1, PEAKS).alias("peaks")
    rows = rows.groupBy("row_key").agg(
        F.any_value("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.sum("p0").alias("p0"), F.sum("p1").alias("p1"), peaks
    )
    return rows.select("doc_id", "n", "p0", "p1", *(F.col("peaks")[k].alias(f"p{2 + k}") for k in range(PEAKS)))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the mean log-ratio of each row of ``docs``.

    Labelled texts whose id falls into folds 1 to 3 give the counts of two interpolated
    Kneser-Ney bigram models over subwords, one for toxic and one for ordinary texts, with
    shared backoff counts.  A text is judged by its log-likelihoods under both, normalised by
    its length; fold 4 calibrates the score by a logistic curve on a bounded sample.  Fold 0
    is held out.

    A null or empty text gets the score of no tokens.  A null id is in no fold: it is scored
    but never learned from, like a null label.  An id with several labels counts as toxic if
    one says so.  Rows that repeat an id are scored one by one.  Without labels of both
    classes every score is the share of toxic ones (0.5 if there are none).
    """
    pairs = id_and_text(docs, id_col, text_col)
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = cut_lineage(marks.agg(F.max(F.col("toxic").cast("int")).alias("label")).withColumn("fold", fold("doc_id")).where("fold > 0"))
    few = marks.count() <= settings.broadcast_labels
    labelled = pairs.join(F.broadcast(marks) if few else marks, "doc_id")
    counts = count_bigrams(labelled.where("fold < 4").select("doc_id", "text", "label"), settings)
    levels = backoff(counts, settings.vocabulary)
    chosen = marks.where("fold = 4").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.calibration_rows)
    sample = pairs.join(F.broadcast(cut_lineage(chosen.select("doc_id"))), "doc_id")
    known = text_features(sample, counts, levels, settings).join(marks, "doc_id").select("n", *_columns(), "label").toPandas()
    x = _features(known[_columns()].to_numpy(float), known["n"].to_numpy(float))
    curve: Logistic = fit(x, known["label"].to_numpy(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = np.stack([b.column(c).to_numpy() for c in _columns()], axis=1)
            x = _features(parts, b.column("n").to_numpy().astype(float))
            columns = [b.column("doc_id"), pa.array(curve.score(x)), pa.array(x[:, 0])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "mean_log_ratio"])

    scored = text_features(pairs, counts, levels, settings).mapInArrow(run, "doc_id long, score double, mean_log_ratio double")
    return scored.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "mean_log_ratio"
    )


def _columns() -> list[str]:
    return [f"p{k}" for k in range(2 + PEAKS)]
