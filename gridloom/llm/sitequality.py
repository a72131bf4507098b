"""Document quality by a classifier combined with hierarchical empirical Bayes over sites."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import SPACE, Words, id_and_text, map_texts, per_text
from gridloom.llm.logistic import Logistic, fit
from gridloom.llm.repetition import duplicate_lines, repeated_spans
from gridloom.llm.toxicity import fold


@dataclass(frozen=True)
class SiteQualitySettings:
    #: labelled ids that fit the document classifier, at most (the site counts take all)
    classifier_rows: int = 50_000
    threshold: float = 0.5
    #: bounds of a prior's weight in labelled documents, where the moments say nothing
    least_weight: float = 1.0
    most_weight: float = 1000.0


FEATURES = (
    "log_words", "log_chars", "word_length", "symbols", "digits", "capitals", "marks", "repeated", "dup_lines", "distinct",
    "line_words", "non_ascii",
)
_CLASS = np.zeros((256, 4), dtype=np.int64)
_CLASS[[ord(c) for c in "#*$%&|<>"], 0] = 1
_CLASS[48:58, 1] = 1
_CLASS[65:91, 2] = 1
_CLASS[[ord(c) for c in "!?.,;:()[]{}\"'=_~^`\\/@+-"], 3] = 1


def measure(part: pa.RecordBatch) -> pa.RecordBatch:
    """The features of each text of a chunk."""
    texts = part.column(1)
    w = Words(texts, ~SPACE)
    n, hashes = w.counts(), w.hashes()
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(_CLASS[w.data], axis=0)])
    kinds = sums[w.at[1:]] - sums[w.at[:-1]]
    points = np.r_[0, np.cumsum((w.data & 0xC0) != 0x80)]
    chars = points[w.at[1:]] - points[w.at[:-1]]
    size = np.diff(w.at)
    pos, longest, _ = repeated_spans(hashes, w.doc)
    delta = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(delta, pos, 1)
    np.add.at(delta, pos + longest, -1)
    repeated = per_text(n, np.cumsum(delta)[: len(hashes)] > 0)
    order = np.lexsort((hashes, w.doc))
    own, doc = hashes[order], w.doc[order]
    first = np.r_[True, (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])][: len(own)]
    distinct = np.bincount(doc[first], minlength=len(n))
    lines = np.zeros(len(n), np.int64)
    many = np.flatnonzero(pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False))
    lines[many] = duplicate_lines(texts.take(pa.array(many)).to_pylist())
    breaks = np.r_[0, np.cumsum(w.data == 10)]
    breaks = breaks[w.at[1:]] - breaks[w.at[:-1]] + 1
    share = lambda x, y: x / np.maximum(y, 1)
    columns = [np.log1p(n), np.log1p(chars), np.minimum(share(chars, n), 50), *(share(kinds[:, k], chars) for k in range(4))]
    columns += [share(repeated, n), share(lines, breaks), share(distinct, n), np.log1p(share(n, breaks)), share(size - chars, chars)]
    arrays = [part.column(0), *(pa.array(np.asarray(c, np.float64)) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *FEATURES])


def document_features(pairs: DataFrame) -> DataFrame:
    return map_texts(pairs, measure, "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES))


def evidence(features: DataFrame, marks: DataFrame, settings: SiteQualitySettings) -> DataFrame:
    """``doc_id, evidence``: the classifier's log-odds of each row of stored features."""
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.classifier_rows)
    known = features.join(F.broadcast(cut_lineage(chosen.select("doc_id", "label"))), "doc_id").toPandas()
    curve: Logistic = fit(known[list(FEATURES)].to_numpy(float), known["label"].to_numpy(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(curve.logit(x))], names=["doc_id", "evidence"])

    return features.mapInArrow(run, "doc_id long, evidence double")


def _weight(groups: DataFrame, prior: Column, settings: SiteQualitySettings) -> float:
    """Weight of a beta prior in documents, by the moments of its groups' shares.

    With shares ``good / n`` about ``prior`` and Pearson's statistic ``Q`` over groups of two
    or more, ``Q`` exceeds its expectation by what the groups really differ.
    """
    m = F.least(F.greatest(prior, F.lit(0.001)), F.lit(0.999))
    off = F.col("good") - F.col("n") * m
    row = groups.where("n >= 2").agg(
        F.sum(off * off / (F.col("n") * m * (1 - m))).alias("q"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") - 1).alias("free")
    ).first()
    if not row.k:
        return settings.least_weight
    between = (row.q - row.k) / row.free  # correlation of two documents of one group
    if between <= 1 / (1 + settings.most_weight):
        return settings.most_weight
    return float(min(settings.most_weight, max(settings.least_weight, 1 / min(between, 0.999) - 1)))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def site_quality(
    docs: DataFrame,
    sites: DataFrame,
    labels: DataFrame,
    settings: SiteQualitySettings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Quality of every row of ``docs`` from its text and its site.

    ``sites`` gives ``doc_id, host, path``, ``labels`` ``doc_id, quality``; labels of fold 0
    (the id's checksum modulo 5) are held out.  The share of good documents of a host is
    shrunk to the global one, that of a path to its host's: beta priors whose weights come
    from the moments of all hosts and of all paths.  A document's own label is left out of
    its site's counts.  The site's log-odds beyond the global ones are added to those of a
    classifier of the text, fitted on a bounded sample of labelled rows.

    One row per row of ``docs``: ``doc_id, held_out, evidence, n_host, host_rate, n_path,
    path_rate, score, kept``.  A document without a site, or a null id, has the global rate;
    of several sites of an id the least one counts.  A null text is empty.  Without labels
    every score is 0.5.  Null labels, hosts and paths are passed over (a null path is "").
    """
    settings = settings or SiteQualitySettings()
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = cut_lineage(marks.agg(F.max(F.col("quality").cast("int")).alias("label")).where(fold("doc_id") > 0))
    site = sites.where("doc_id is not null and host is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    site = site.agg(F.min(F.struct("host", F.coalesce("path", F.lit("")).alias("path"))).alias("s")).select("doc_id", "s.*")
    placed = cut_lineage(site.join(marks, "doc_id", "left"))
    features = cut_lineage(document_features(id_and_text(docs, id_col, text_col)))

    whole = marks.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).first()
    rate = ((whole.good or 0) + 0.5) / (whole.n + 1)
    counted = placed.where("label is not null")
    paths = cut_lineage(counted.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")))
    hosts = cut_lineage(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    host_weight = _weight(hosts, F.lit(rate), settings)
    shrunk = (F.col("good") + host_weight * rate) / (F.col("n") + host_weight)
    host_rates = hosts.select("host", F.col("n").alias("n_host"), F.col("good").alias("good_host"), shrunk.alias("prior"))
    path_weight = _weight(paths.join(host_rates, "host"), F.col("prior"), settings)

    table = paths.withColumnsRenamed({"n": "n_path", "good": "good_path"}).join(host_rates.drop("prior"), "host")
    table = cut_lineage(table)
    # a site without labels on its path still has its host
    rows = placed.join(table.drop("n_host", "good_host"), ["host", "path"], "left").join(host_rates.drop("prior"), "host", "left")
    own, good = F.when(F.col("label").isNotNull(), 1).otherwise(0), F.coalesce("label", F.lit(0))
    less = lambda c, x: F.coalesce(c, F.lit(0)) - x
    rows = rows.select(
        "doc_id", less("n_host", own).alias("n_host"), less("good_host", good).alias("good_host"),
        less("n_path", own).alias("n_path"), less("good_path", good).alias("good_path"),
    )
    rows = rows.withColumn("host_rate", (F.col("good_host") + host_weight * rate) / (F.col("n_host") + host_weight))
    rows = rows.withColumn("path_rate", (F.col("good_path") + path_weight * F.col("host_rate")) / (F.col("n_path") + path_weight))
    rows = cut_lineage(rows.select("doc_id", "n_host", "host_rate", "n_path", "path_rate"))

    out = evidence(features, marks, settings).join(rows, "doc_id", "left")
    for name, none in (("n_host", 0), ("n_path", 0), ("host_rate", rate), ("path_rate", rate)):
        out = out.withColumn(name, F.coalesce(name, F.lit(none)))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_rate")) - _logit(F.lit(rate)))))
    out = out.withColumn("score", score).withColumn("held_out", fold("doc_id") == 0)
    return out.select(
        "doc_id", "held_out", "evidence", "n_host", "host_rate", "n_path", "path_rate", "score",
        (F.col("score") >= settings.threshold).alias("kept"),
    )


def sites_of(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``doc_id, host, path`` of documents: from the page whose address ends in their id.

    Documents without a page have their source as host and no path.
    """
    url = F.col("url")
    page = pages.select(
        F.regexp_extract(url, r"^\w+://[^/?#]+/[^?#]*?([0-9]{1,18})(?:\.\w+)?/?(?:[?#].*)?$", 1).alias("id"),
        F.regexp_extract(url, r"^\w+://([^/?#]+)", 1).alias("host"),
        F.regexp_extract(url, r"^\w+://[^/?#]+/([^/?#]*)/", 1).alias("path"),
    )
    page = page.where("id <> ''").select(F.col("id").cast("long").alias("doc_id"), "host", "path")
    page = page.groupBy("doc_id").agg(F.min(F.struct("host", "path")).alias("s"))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "source").join(page, "doc_id", "left")
    host = F.coalesce("s.host", F.concat(F.lit("source:"), F.col("source")))
    return rows.select("doc_id", host.alias("host"), F.coalesce("s.path", F.lit("")).alias("path"))
