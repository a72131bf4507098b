"""Near-duplicate documents by HyperMinHash sketches and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import SPACE, U64, Words, bounded_batches, chunks, id_and_text, mix
from gridloom.llm.graph import components

SHINGLE = 5
BUCKETS, MANTISSA = 256, 10
ROWS = 4  # registers in a band: 64 bits


@dataclass(frozen=True)
class NearDupSettings:
    """Link at ``100 * intersection >= percent * union``.

    With ``bands`` bands of four registers a pair at 75 % shares none with a probability of
    3e-7; ``slack`` standard errors below the threshold, the estimate turns a pair down.
    ``rounds`` of best pivots run before all remaining pairs across components are taken.
    """

    percent: int = 75
    bands: int = 40
    slack: float = 5.0
    rounds: int = 2
    #: node ids that may be broadcast to pick texts; beyond it the join shuffles
    broadcast_ids: int = 1_000_000
    #: partners of one node that a verifying task reads together
    partners: int = 64
    #: texts that are compared among each other at once
    block: int = 512


class Shingles:
    """Distinct shingles of each text of a chunk, in order within the text."""

    def __init__(self, texts: pa.Array):
        w = Words(texts, SPACE_OUT)
        hashes = w.hashes(lower=True)
        at, shingle = w.windows(hashes, SHINGLE)
        doc, counts = w.doc[at], w.counts()
        few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(few):  # a short text is one shingle, its whole sequence
            whole = np.zeros(len(few), np.uint64)
            for k in range(SHINGLE - 1):
                has = counts[few] > k
                whole[has] = mix(whole[has] + hashes[w.first[few[has]] + k] + U64(k + 1))
            doc, shingle = np.r_[doc, few], np.r_[shingle, whole]
        self.n = len(texts)
        self.bits = max(0, int(self.n - 1).bit_length())
        key = shingle >> U64(self.bits)
        if self.bits:
            key |= doc.astype(np.uint64) << U64(64 - self.bits)
        order = np.argsort(key)
        key, shingle, doc = key[order], shingle[order], doc[order]
        fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])][: len(key)]
        self.key, self.shingle, self.doc = key[fresh], shingle[fresh], doc[fresh]
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def set_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that are equal for equal sets: sums of two independent hashes."""
        out = []
        for salt in (U64(0x51ED270B7A1F39CD), U64(0xA3EC647659359ACD)):
            total = np.zeros(len(self.shingle) + 1, np.uint64)
            np.cumsum(mix(self.shingle ^ salt), out=total[1:])
            out.append((total[self.first[1:]] - total[self.first[:-1]]).view(np.int64))
        return out[0], out[1]

    def registers(self) -> np.ndarray:
        """HyperMinHash: for each bucket the least hash, as leading zeros and mantissa bits; 0 if empty."""
        out = np.zeros((self.n, BUCKETS), np.uint16)
        if len(self.key):
            # keys are in order, so a bucket's least hash comes first
            bucket = self.key >> U64(64 - self.bits - 8)
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            value = (self.key[at] << U64(self.bits + 8)) | U64(1)
            fraction, exponent = np.frexp(value.astype(np.float64))
            zeros = np.minimum(64 - exponent, 62).astype(np.int64)
            mantissa = np.floor((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
            out[self.doc[at], (bucket[at] & U64(BUCKETS - 1)).astype(np.int64)] = (zeros << MANTISSA) + mantissa + 1
        return out

    def sets(self) -> list[np.ndarray]:
        return np.split(np.sort(self.shingle) if self.n == 1 else self.shingle, self.first[1:-1])


SPACE_OUT = ~SPACE
#: For each bucket, the order in which others lend it their register if it is empty.
_LENDERS = np.argsort(mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64)).reshape(BUCKETS, BUCKETS), axis=1)


def densified(registers: np.ndarray) -> np.ndarray:
    """Registers with empty ones lent by others, so small sets have full bands too."""
    out = registers.copy()
    row, bucket = np.nonzero((out == 0) & (registers.any(axis=1))[:, None])
    for k in range(BUCKETS):
        if not len(row):
            break
        lent = registers[row, _LENDERS[bucket, k]]
        out[row, bucket] = lent
        row, bucket = row[lent == 0], bucket[lent == 0]
    return out


def band_keys(registers: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key of each band: four registers and the band's number, mixed."""
    full = densified(registers)[:, : bands * ROWS].astype(np.uint64).reshape(len(registers), bands, ROWS)
    key = full[:, :, 0]
    for k in range(1, ROWS):
        key = (key << U64(16)) | full[:, :, k]
    return mix(mix(key) + np.arange(bands, dtype=np.uint64) * U64(0xD1B54A32D192ED03)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs of sketches, without the registers that agree by chance."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    large, small = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    ratio = large / np.maximum(small, 1)
    # expected accidental agreements of registers (the sketch's published approximation)
    chance = 0.169919487159739 * BUCKETS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    accidental = chance * np.minimum(1, small / BUCKETS) * (1 - equal / np.maximum(used, 1))
    return (equal - accidental) / np.maximum(used, 1)


SKETCH = "doc_id long, row_key long, text_key long, n_shingles long, set_a long, set_b long, registers binary"


def _least_estimate(used: np.ndarray, settings: NearDupSettings) -> np.ndarray:
    """What a link's estimate over so many registers may come down to by chance."""
    least = settings.percent / 100
    return least - settings.slack * np.sqrt(least * (1 - least) / np.maximum(used, 1))


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, set key and registers of every row of (doc_id, text, row_key, text_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                s = Shingles(part.column(1))
                raw = s.registers().astype("<u2")
                columns = [pa.array(s.counts()), *map(pa.array, s.set_keys()), pa.array([r.tobytes() for r in raw], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), *columns], names=[x.split()[0] for x in SKETCH.split(", ")]
                )

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, SKETCH)


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def band_rows(nodes: DataFrame, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = band_keys(_registers(b.column(1)), bands)
                node = np.repeat(b.column(0).to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "registers").mapInArrow(run, "key long, node long")


def estimated(pairs: DataFrame, nodes: DataFrame, settings: NearDupSettings) -> DataFrame:
    """Pairs (a, b) whose estimate may belong to a link, with it."""
    side = lambda x: nodes.select(
        F.col("node").alias(x), F.col("registers").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ra, rb = _registers(b.column("ra")), _registers(b.column("rb"))
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            got = estimate(ra, rb, na, nb)
            used = ((ra > 0) | (rb > 0)).sum(axis=1)
            ok = got >= _least_estimate(used, settings)
            ok &= 100 * np.minimum(na, nb) >= settings.percent * np.maximum(na, nb)
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok)), pa.array(got[ok])], names=["a", "b", "est"]
            )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, est double")


def verified(pairs: DataFrame, texts: DataFrame, settings: NearDupSettings) -> DataFrame:
    """Pairs (a, b) that are links by their full sets of shingles.

    A node with many partners is read by several tasks, each with a block of them, so no
    task depends on the number of partners.
    """
    block, percent = settings.partners, settings.percent
    wide = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    wide = cut_lineage(wide)
    own = texts.join(wide, texts["node"] == wide["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text"
    )
    other = pairs.join(wide, "a").join(texts.withColumnRenamed("node", "b"), "b")
    other = other.select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("part"), "b", "text")
    # the node's own text comes first: its b is null
    rows = own.union(other).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, None
        for batch in batches:
            for part in chunks(batch):
                found = []
                sets = Shingles(part.column(3)).sets()
                for a, b, own_set in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), sets, strict=True):
                    if b is None:
                        at, mine = a, own_set
                    elif at == a:
                        shared = len(np.intersect1d(mine, own_set, assume_unique=True))
                        if 100 * shared >= percent * (len(mine) + len(own_set) - shared):
                            found.append((a, b))
                columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def node_texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, settings: NearDupSettings) -> DataFrame:
    """The text of each wanted node, by the id, text hash and set key of its document.

    The hash keeps rows that repeat an id with other texts apart, so the rows read are those
    of the wanted texts however often an id comes; rows of one id and one text merge.
    """
    picked = nodes.join(wanted, "node", "left_semi").select("node", "doc_id", "text_key", "set_a", "set_b")
    picked = cut_lineage(picked)
    n = picked.count()
    few = n <= settings.broadcast_ids
    rows = docs.join(F.broadcast(picked) if few else picked, ["doc_id", "text_key"]).select("node", "text", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in chunks(batch):
                a, b = Shingles(part.column(1)).set_keys()
                same = (part.column(2).to_numpy() == a) & (part.column(3).to_numpy() == b)
                node = part.column(0).to_pylist()
                for i in np.flatnonzero(same).tolist():
                    same[i] = node[i] not in seen
                    seen.add(node[i])
                yield part.select(["node", "text"]).filter(pa.array(same))

    texts = cut_lineage(rows.mapInArrow(run, "node long, text string"))
    return texts if texts.count() == n else cut_lineage(texts.dropDuplicates(["node"]))


def links_across(labelled: DataFrame, texts: DataFrame, settings: NearDupSettings) -> DataFrame:
    """Links between components in buckets that have more than one (key, node, c).

    The texts of such a bucket meet in one task, or in one task for each two blocks of a
    large bucket.  There, pairs of different components are compared by their sketches in
    the first band they share, and then by their sets, best estimates first; a link found
    merges two components, so what is confirmed grows with the nodes and not with the pairs.
    """
    block, bands, percent = settings.block, settings.bands, settings.percent
    size = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    open_ = size.where("low <> high").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = labelled.join(open_, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = cut_lineage(rows.select("key", "node", "c", "own", "blocks", other))
    part = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    rows = rows.select("key", part.alias("part"), "own", "node", "c")
    rows = rows.join(texts, "node").select("key", "part", "own", "node", "c", "text")
    rows = rows.repartition("key", "part").sortWithinPartitions("key", "part", "node")

    def compare(key, alike, own, node, c, keys, registers, sizes, sets) -> Iterator[tuple[int, int]]:
        """Links in one group, at most one for each two components that it brings together."""
        band = int(np.argmax(keys[0] == key))
        c = c.copy()
        for i in range(len(node) - 1):
            rest = np.arange(i + 1, len(node))
            rest = rest[(c[rest] != c[i]) & (alike | (own[rest] != own[i]))]
            rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
            rest = rest[np.argmax(keys[rest] == keys[i], axis=1) == band]
            if not len(rest):
                continue
            got = estimate(registers[rest], np.broadcast_to(registers[i], (len(rest), BUCKETS)), sizes[rest], sizes[i])
            used = ((registers[rest] > 0) | (registers[i] > 0)).sum(axis=1)
            ok = got >= _least_estimate(used, settings)
            for j in rest[ok][np.argsort(-got[ok], kind="stable")].tolist():
                if c[j] != c[i]:
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                        yield int(node[i]), int(node[j])
                        c[c == c[j]] = c[i]

    def groups(b: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        at = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)], axis=1)
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(axis=1)]) if len(at) else []
        keys, registers, sizes, sets = [], [], [], []
        for part in chunks(b):
            s = Shingles(part.column(5))
            registers.append(s.registers())
            keys.append(band_keys(registers[-1], bands))
            sizes.append(s.counts())
            sets += s.sets()
        if len(at):
            keys, registers, sizes = np.concatenate(keys), np.concatenate(registers), np.concatenate(sizes)
            own, node, c = (b.column(k).to_numpy() for k in (2, 3, 4))
            for s, e in zip(first, [*first[1:], len(at)], strict=True):
                # a group of one block compares within it, one of two blocks between them
                alike = own[s] == own[s:e].max() == own[s:e].min()
                found += compare(at[s, 0], alike, own[s:e], node[s:e], c[s:e], keys[s:e], registers[s:e], sizes[s:e], sets[s:e])
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            at = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)], axis=1)
            last = np.flatnonzero((at != at[-1]).any(axis=1)) if len(at) else []
            cut = int(last[-1]) + 1 if len(last) else 0
            yield groups(b.slice(0, cut))
            held = b.slice(cut)
        if held is not None:
            yield groups(held)

    return rows.mapInArrow(run, "a long, b long").distinct()


def link_nodes(docs: DataFrame, nodes: DataFrame, settings: NearDupSettings) -> DataFrame:
    """``node, component`` of nodes with a link (node is a class of equal sets).

    In each round a node is compared with the best of its buckets' pivots in other
    components; what is confirmed merges.  At last the buckets that still have more than one
    component are searched whole, so no link between components is missed.
    """
    rows = band_rows(nodes, settings.bands)
    # stored, so that the join can split a hot bucket
    shared = cut_lineage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    buckets = cut_lineage(rows.join(shared, "key"))
    texts = node_texts(docs, nodes, buckets.select("node").distinct(), settings)
    links, labels = None, None
    for k in range(settings.rounds + 1):
        if labels is None:
            labelled = buckets.withColumn("c", F.col("node"))
        else:
            known = labels.select("node", F.col("component").alias("c"))
            labelled = cut_lineage(buckets.join(known, "node", "left").withColumn("c", F.coalesce("c", "node")))
        if k < settings.rounds:
            # two pivots of different components in each bucket; which ones changes by round
            order = F.struct(F.xxhash64("c", F.lit(k)).alias("h"), "c", F.xxhash64("node", F.lit(k)).alias("g"), "node")
            pivot = labelled.groupBy("key").agg(F.min(order).alias("low"), F.max(order).alias("high"))
            pivot = pivot.where("low.c <> high.c")
            met = labelled.join(pivot, "key").select(
                "node", F.when(F.col("c") == F.col("low.c"), F.col("high.node")).otherwise(F.col("low.node")).alias("pivot")
            )
            met = met.groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
            best = Window.partitionBy("node").orderBy(F.desc("n"), "pivot")
            pairs = met.withColumn("r", F.row_number().over(best)).where("r <= 3").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
            close = estimated(pairs, nodes, settings)
            top = close.groupBy("b").agg(F.max(F.struct("est", "a")).alias("x"))
            pairs = cut_lineage(top.select(F.col("x.a").alias("a"), "b"))
            found = cut_lineage(verified(pairs, texts, settings))
        else:
            found = cut_lineage(links_across(labelled, texts, settings))
        links = found if links is None else links.union(found)
        labels = components(links)
    return labels


def near_duplicates(
    docs: DataFrame, settings: NearDupSettings | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of documents linked by nearly equal sets of 5-word shingles.

    One row per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest id that
    links lead to, its own included) and ``kept`` (whether that is its own id).

    Words are runs of other characters than ASCII white space, with A-Z read as a-z; fewer
    than five words are one shingle; without words a set is empty and linked with nothing.
    Rows with equal sets form one class, so copies are never compared.  Classes that share a
    band of HyperMinHash registers are compared by their sketches first and then by their
    full sets.

    A row with a null id is linked with nothing: null ``component_id``, kept.  Rows that
    repeat an id are rows of their own and may fall into different groups if their texts
    differ; equal ones are all kept or all dropped.  Other columns are not read.
    """
    rows = _grouped(id_and_text(docs, id_col, text_col), settings or NearDupSettings())
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(pairs: DataFrame, settings: NearDupSettings) -> DataFrame:
    keyed = pairs.withColumn("row_key", F.monotonically_increasing_id()).withColumn("text_key", F.xxhash64("text"))
    stored = cut_lineage(sketches(keyed))
    usable = stored.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("row_key", "doc_id", "text_key")).alias("x"), F.min("doc_id").alias("least_id")
    )
    classes = classes.select(
        "set_a", "set_b", "n_shingles", F.col("x.row_key").alias("node"), "x.doc_id", "x.text_key", "least_id"
    )
    classes = cut_lineage(classes)
    nodes = stored.select("row_key", "registers").join(classes, F.col("row_key") == F.col("node"))
    nodes = cut_lineage(nodes.select("node", "doc_id", "text_key", "n_shingles", "set_a", "set_b", "registers"))
    labels = link_nodes(keyed.drop("row_key"), nodes, settings)
    ids = cut_lineage(classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # stored, so that the join can split a hot component
    least = cut_lineage(ids.groupBy("component").agg(F.min("least_id").alias("component_id")))
    ids = cut_lineage(ids.join(least, "component").select("set_a", "set_b", "n_shingles", "component_id"))
    rows = stored.select("doc_id", "text_key", "set_a", "set_b", "n_shingles")
    rows = rows.join(ids, ["set_a", "set_b", "n_shingles"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    rows = rows.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, settings: NearDupSettings | None = None) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Each group keeps the document with its smallest id; rows that repeat that id and text all
    stay.  What goes is matched by id and text, so rows of one id with other texts are safe.
    """
    settings = settings or NearDupSettings()
    dropped = cut_lineage(_grouped(id_and_text(docs), settings).where("not kept").select("doc_id", "text_key").distinct())
    few = dropped.count() <= settings.broadcast_ids
    dropped = dropped.select(F.col("doc_id").alias("_id"), "text_key")
    same = (docs["doc_id"] == dropped["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dropped["text_key"])
    return docs.join(F.broadcast(dropped) if few else dropped, same, "left_anti")
