"""Clustering around centroids over dictionary-encoded subvectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import bounded_batches


@dataclass(frozen=True)
class CentroidSettings:
    clusters: int = 40
    rounds: int = 5
    components: int = 64
    #: a component x becomes floor(scale * x)
    scale: int = 256
    #: vectors with the smallest sha256 of this and their id are the first centroids
    salt: str = "2:"
    #: components of a subvector
    block: int = 2
    #: vectors that share their dictionaries, at most (codes are 16 bits wide)
    chunk_rows: int = 16_384


#: Components up to this size keep squared distances of 64 components within 64 bits.
LARGEST = 2**27
STORED = "ids array<long>, codes binary, entries array<int>, subvectors binary"
TOTALS = "place int, total long"


def dictionary(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a block of columns, and for each row which one it is."""
    code = np.zeros(len(block), np.int64)
    for column in block.T:
        values, own = np.unique(column, return_inverse=True)
        _, first, code = np.unique(code * len(values) + own, return_index=True, return_inverse=True)
    return block[first], code


class Chunk:
    """Vectors as one code for each block of components, with the subvectors behind the codes."""

    def __init__(self, codes: list[np.ndarray], subvectors: list[np.ndarray]):
        self.codes, self.subvectors = codes, subvectors

    @classmethod
    def of(cls, vectors: np.ndarray, block: int) -> Chunk:
        found = [dictionary(vectors[:, k : k + block]) for k in range(0, vectors.shape[1], block)]
        return cls([code for _, code in found], [rows for rows, _ in found])

    def stored(self) -> tuple[bytes, list[int], bytes]:
        codes = np.stack(self.codes).astype("<u2").tobytes()
        rows = b"".join(x.astype("<i4").tobytes() for x in self.subvectors)
        return codes, [len(x) for x in self.subvectors], rows

    @classmethod
    def read(cls, codes: bytes, entries: list[int], rows: bytes, settings: CentroidSettings) -> Chunk:
        widths = [min(settings.block, settings.components - k) for k in range(0, settings.components, settings.block)]
        every = np.frombuffer(codes, "<u2").reshape(len(entries), -1)
        flat, ends = np.frombuffer(rows, "<i4").astype(np.int64), np.cumsum(np.multiply(entries, widths))
        parts = [x.reshape(-1, w) for x, w in zip(np.split(flat, ends[:-1]), widths, strict=True)]
        return cls(list(every), parts)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector (the first of equal ones) and its squared distance.

        Each distinct subvector meets each centroid once; a vector adds up what its codes name.
        """
        total = np.zeros((len(self.codes[0]), len(centroids)), np.int64)
        at = 0
        for code, rows in zip(self.codes, self.subvectors, strict=True):
            part = np.zeros((len(rows), len(centroids)), np.int64)
            for k in range(rows.shape[1]):
                part += (rows[:, k, None] - centroids[None, :, at + k]) ** 2
            total += part[code]
            at += rows.shape[1]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Componentwise sums of each cluster, from how often it has each code."""
        parts = []
        for code, rows in zip(self.codes, self.subvectors, strict=True):
            times = np.bincount(cluster * len(rows) + code, minlength=clusters * len(rows)).reshape(clusters, len(rows))
            parts.append(times @ rows)
        return np.concatenate(parts, axis=1)


def whole_steps(flat: np.ndarray, settings: CentroidSettings) -> np.ndarray:
    steps = np.floor(settings.scale * flat)
    if len(steps) and np.abs(steps).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // settings.scale} has squared distances beyond 64 bits")
    return steps.astype(np.int64).reshape(-1, settings.components)


def usable(vectors: DataFrame, settings: CentroidSettings, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows with the right number of components, all finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("vector") == settings.components) & finite)


def encode(vectors: DataFrame, settings: CentroidSettings) -> DataFrame:
    """The vectors in chunks, each with the dictionaries of its blocks; stored once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, steps, held = [], [], 0

        def out(ids: list, steps: list) -> pa.RecordBatch:
            ids, every = pa.concat_arrays(ids), np.concatenate(steps)
            rows = []
            for a in range(0, len(every), settings.chunk_rows):
                own = every[a : a + settings.chunk_rows]
                rows.append((ids[a : a + len(own)].to_pylist(), *Chunk.of(own, settings.block).stored()))
            types = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["ids", "codes", "entries", "subvectors"])

        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0))
                steps.append(whole_steps(batch.column(1).flatten().to_numpy(zero_copy_only=False), settings))
                held += batch.num_rows
            if held >= settings.chunk_rows:
                yield out(ids, steps)
                ids, steps, held = [], [], 0
        if held:
            yield out(ids, steps)

    bounded_batches(vectors.sparkSession)
    return cut_lineage(vectors.mapInArrow(run, STORED))


def _chunks(batches: Iterator[pa.RecordBatch], settings: CentroidSettings) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids, codes, entries, rows = (batch.column(c)[k] for c in range(4))
            yield ids.values, Chunk.read(codes.as_py(), entries.as_py(), rows.as_py(), settings)


def first_centroids(vectors: DataFrame, settings: CentroidSettings) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(settings.salt), F.col("vec_id").cast("string")), 256).alias("order")
    rows = vectors.where("vec_id is not null").select(order, "vector").orderBy("order", "vector").limit(settings.clusters)
    return whole_steps(np.array([r.vector for r in rows.collect()], float).ravel(), settings)


def moved(chunks: DataFrame, centroids: np.ndarray, settings: CentroidSettings) -> np.ndarray:
    """Each centroid's vectors averaged (rounded down); a centroid without vectors stays.

    Tasks hand over one row for each centroid and component, and one for each centroid's count.
    """
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = np.zeros((k, width + 1), np.int64), 0
        for _, chunk in _chunks(batches, settings):
            cluster, _ = chunk.nearest(centroids)
            own = np.bincount(cluster, minlength=k)
            if most + len(cluster) > 2**35:  # 2**35 components of LARGEST are as much as 64 bits hold
                yield _totals(total)
                total, most = np.zeros((k, width + 1), np.int64), 0
            total += np.c_[chunk.sums(cluster, k), own]
            most += len(cluster)
        yield _totals(total)

    rows = chunks.mapInArrow(run, TOTALS).groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    every = {r.place: int(r.total) for r in rows.collect()}  # clusters x (components + 1) numbers
    out = centroids.copy()
    for c in range(k):
        if n := every.get(c * (width + 1) + width, 0):
            out[c] = [every.get(c * (width + 1) + d, 0) // n for d in range(width)]
    return out


def _totals(total: np.ndarray) -> pa.RecordBatch:
    flat = total.ravel()
    place = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(flat[place])], names=["place", "total"])


def cluster_vectors(
    vectors: DataFrame,
    settings: CentroidSettings = CentroidSettings(),
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector.

    Components become whole steps of 1 / ``scale``.  Vectors are stored once as codes into
    dictionaries of distinct subvectors, one dictionary for each block of components and chunk
    of vectors; a round sends the centroids to the tasks and gets sums back, so nothing that
    grows with the table passes through the driver.  All arithmetic is on whole numbers.

    A null vector, one with another number of components, or one with a null, NaN or infinite
    component is left out.  A null id is clustered but starts no centroid.  Rows that repeat an
    id are vectors of their own (equal hashes: the smaller vector first).  With fewer vectors
    than clusters there are as many centroids as vectors with an id; without any the result is
    empty.  A component beyond 2**27 steps is an error, as its squares leave 64 bits.  Other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, settings, id_col, vector_col)
    centroids = first_centroids(rows, settings)
    schema = "vec_id long, cluster int, distance long"
    if len(centroids):
        chunks = encode(rows, settings)
        for _ in range(settings.rounds):
            centroids = moved(chunks, centroids, settings)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, chunk in _chunks(batches, settings):
                cluster, distance = chunk.nearest(centroids)
                columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

        found = chunks.mapInArrow(run, schema)
    else:
        found = spark.createDataFrame([], schema)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    inertia = {r.cluster: int(r.total) for r in sums.collect()}  # one number per cluster
    text = [",".join(map(str, c)) for c in centroids.tolist()]
    of_cluster = spark.createDataFrame(
        [(c, n, sum(inertia.values()), hashlib.sha256(text[c].encode()).hexdigest()) for c, n in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", *of_cluster.columns[1:])
