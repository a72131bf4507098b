"""Packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import bounded_batches, chunks, id_and_text
from gridloom.llm.binpack import Slots, pack_histogram
from gridloom.llm.encoding import encoder


@dataclass(frozen=True)
class PackSettings:
    """``path`` and ``ranks`` name one vocabulary in the two libraries' formats."""

    path: str
    ranks: str | None = None
    capacity: int = 1024
    end_id: int = 2
    #: bytes of an id in stored rows
    width: int = 4


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, settings: PackSettings, keep_ids: bool) -> DataFrame:
    """Encode each text, append ``end_id`` and cut what is longer than a sequence.

    The first piece of a cut document takes the remainder.  ``part`` and ``nth`` number the
    pieces of each length within their task; they are only meaningful once stored.
    """
    most, store = settings.capacity, np.dtype(f"<u{settings.width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(settings.path, settings.ranks).encode
        seen, task = np.zeros(most + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for part in chunks(batch):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(encode(text), np.uint32(settings.end_id)).astype("<u4")
                    start, k = 0, 0
                    while start < len(ids):
                        size = (len(ids) - start - 1) % most + 1
                        cut = ids[start : start + size]
                        row = (doc, k, start, size, zlib.crc32(cut), cut.astype(store).tobytes() if keep_ids else b"")
                        rows.append(row)
                        start, k = start + size, k + 1
                doc, k, start, size, crc, raw = zip(*rows, strict=True)
                length = np.array(size, np.int64)
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - first
                nth += seen[length]
                seen += np.bincount(length, minlength=most + 1)
                out = [pa.array(doc, pa.int64()), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length)]
                out += [pa.array(crc, pa.int64()), pa.array(np.full(len(length), task, np.int32)), pa.array(nth)]
                yield pa.RecordBatch.from_arrays(
                    out + [pa.array(raw, pa.binary())] * keep_ids,
                    names=[x.split()[0] for x in PIECE.split(", ")] + ["ids"] * keep_ids,
                )

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, PIECE + ", ids binary" * keep_ids)


def place(stored: DataFrame, capacity: int, *, reduce: bool) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces.

    Only the histogram of lengths, at most ``capacity`` rows, goes to the driver, and the
    plan that comes back is bounded by the capacity too.  A piece finds its slot by its rank
    among pieces of its length: pieces of that length in earlier tasks, plus its own number.
    """
    spark = stored.sparkSession
    counts = stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cut_lineage(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    histogram = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(Slots(pack_histogram(histogram, capacity, reduce=reduce)))
    ranked = stored.join(before.drop("n"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    names = [c for c in stored.columns if c not in ("part", "nth")]
    schema = stored.select(names).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = slots.value.find(size, rank)
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.select(*names, "rank").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, settings: PackSettings, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack every text into as few sequences as dominance reduction and best fit can.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    Sequences are filled from offset 0 without gaps.  A null or empty text is the end id
    alone.  Rows with a null or repeated id are documents of their own.  Other columns of
    ``docs`` are not read; an empty table gives no rows.  Documents are encoded once; the
    stored pieces carry no ids.
    """
    stored = cut_lineage(pieces(id_and_text(docs, id_col, text_col), settings, keep_ids=False))
    return place(stored, settings.capacity, reduce=True)


MATRIX = (
    "sequence_id long, n_tokens int, n_segments int, input_ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, first_positions array<long>, doc_ids array<long>, pieces array<int>"
)


def packed_matrix(
    docs: DataFrame, settings: PackSettings, *, pad_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Packed id matrix: one row of ``capacity`` ids per sequence, by best-fit-decreasing.

    The fullest sequence with room is found by a segment tree over residual capacities.
    ``input_ids`` has the little-endian ids, ``width`` bytes each, padded with ``pad_id``;
    ``cu_seqlens`` the cumulative segment lengths from 0 to ``n_tokens``; ``position_resets``
    the offsets where positions begin anew, and ``first_positions`` the place of a segment's
    first id in its document (above 0 for the later pieces of a cut one), so documents can be
    put together again without loss.  Nulls, empty and repeated rows as in
    ``pack_documents``.
    """
    stored = cut_lineage(pieces(id_and_text(docs, id_col, text_col), settings, keep_ids=True))
    placed = place(stored, settings.capacity, reduce=False)
    pad = np.full(settings.capacity, pad_id, f"<u{settings.width}").tobytes()

    def row(sequence: int, parts: list[dict]) -> tuple:
        ends = np.cumsum([0] + [p["length"] for p in parts]).tolist()
        ids = b"".join(p["ids"] for p in parts)
        columns = [[p[c] for p in parts] for c in ("start", "doc_id", "piece")]
        return (sequence, ends[-1], len(parts), ids + pad[len(ids) :], ends, ends[:-1], *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict] = []
        done: list[tuple] = []
        for batch in batches:
            for p in batch.to_pylist():
                if parts and p["sequence_id"] != parts[0]["sequence_id"]:
                    done.append(row(parts[0]["sequence_id"], parts))
                    parts = []
                parts.append(p)
            yield table(done)
            done = []
        yield table([row(parts[0]["sequence_id"], parts)] if parts else [])

    return placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(run, MATRIX)


_TYPES = pa.schema(
    [
        ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()), ("input_ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
        ("first_positions", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
    ]
)


def table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES.types, strict=True)], schema=_TYPES)


def write_packed(docs: DataFrame, settings: PackSettings, folder: str, *, pad_id: int = 0) -> None:
    """Write the packed matrix as Parquet with binary rows."""
    packed_matrix(docs, settings, pad_id=pad_id).write.parquet(folder)
