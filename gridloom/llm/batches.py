"""Arrow batches of texts as numpy arrays: words, hashes, chunks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.core.session import let_workers_import

#: Bytes of text that one numpy step handles at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1_000_000
#: Rows of an Arrow batch, so that long texts do not add up to a huge batch.
BATCH_ROWS = 1000

U64 = np.uint64
_MIX1, _MIX2, _STEP = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection), so that all bits depend on all bits."""
    x = x + _STEP
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64) * U64(7919)) | U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | U64(1)
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 2**64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of words for benchmark matching: a-z, A-Z, 0-9 and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts; the setting only changes batch sizes.

    Python workers get to import this package as the driver does.
    """
    let_workers_import(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators read, under fixed names; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each begins (one more than texts)."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``most`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    _, at = utf8(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64; those for ordinary chunks are kept."""
    own = _tables.get(base)
    if own is None or len(own) < n:
        own = np.full(max(n, CHUNK_BYTES), base, np.uint64)
        own[0] = 1
        np.cumprod(own, out=own)
        if n <= CHUNK_BYTES:
            _tables[base] = own
    return own[:n]


class Words:
    """Words of a chunk of texts: byte ``start`` and ``end``, and the text (``doc``) of each."""

    def __init__(self, column: pa.Array, inside: np.ndarray):
        self.data, self.at = utf8(column)
        n = len(self.data)
        word = inside[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.at] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = word[:-1]
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(self.at, self.start, side="right") - 1
        #: words before each text, one more than texts
        self.first = np.searchsorted(self.start, self.at)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` reads A-Z as a-z."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.multiply(_BYTE[_LOWER[self.data] if lower else self.data], _powers(_BASE, n), out=sums[1:])
        np.cumsum(sums, out=sums)
        back = _powers(_BASE_INV, n)[self.start]
        return mix((sums[self.end] - sums[self.start]) * back + (self.end - self.start).astype(np.uint64))

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``size`` words within a text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = hashes[:n] * _ODD[0]
        for k in range(1, size):
            out += hashes[k : k + n] * _ODD[k]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, mix(out[at])


def per_text(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per word) for each text with ``counts`` words."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def map_texts(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to chunks of bounded size of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield fn(part)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)
