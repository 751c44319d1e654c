"""Packing along a space-filling curve.

A document's ids are hashed into a vector, projected to a few dimensions and
keyed by their place on a Hilbert curve; a range sort brings neighbours
together and each range is packed in order into sequences.  Documents are cut
where a sequence is full; the rest of a range, shorter than a sequence, is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import shared_path, workers_import_package

DIMS, BITS = 4, 15          # 60-bit keys
_PASSED_ON = 4 << 20        # bytes of ids a task holds before it passes them on
_BUCKETS = 1024             # of the hashed document vector
_COUNTED = 256              # documents whose vectors are counted together


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(n, dims) integers below 2**bits -> their places on the Hilbert curve.

    Skilling, "Programming the Hilbert curve" (2004): undo the excess work of
    each bit level, Gray-encode, and interleave the bits."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= np.where(high, 0, swap) if i else 0
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[dims - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(7).choice([-1.0, 1.0], size=(_BUCKETS, DIMS))


def coordinates(ids: np.ndarray, sizes: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Places of documents, laid end to end in `ids`, in the unit cube, as integers below 2**BITS."""
    buckets = ids.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(20) & np.uint32(_BUCKETS - 1)
    flat, ends = np.empty((len(sizes), DIMS)), np.cumsum(sizes)
    for a in range(0, len(sizes), _COUNTED):
        b = min(a + _COUNTED, len(sizes))
        start = ends[a] - sizes[a]
        cells = buckets[start:ends[b - 1]] + np.repeat(np.arange(b - a) * _BUCKETS, sizes[a:b])
        counts = np.bincount(cells, minlength=(b - a) * _BUCKETS).reshape(b - a, _BUCKETS)
        flat[a:b] = np.sqrt(counts) @ projection
    flat /= np.sqrt(np.maximum(sizes, 1))[:, None]      # the length of a vector of roots of counts
    return np.minimum((0.5 + 0.5 * np.tanh(flat)) * (1 << BITS), (1 << BITS) - 1).astype(np.int64)


def _with_end(found: list[np.ndarray], end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of documents end to end, each with the end id, and their numbers."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ids = np.concatenate([x for doc in found for x in (doc, end)])
    return ids, sizes


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str,
            memory: dict | None = None) -> DataFrame:
    """(doc_id, width, ids, curve, tie): ids with the end id as raw integers, the curve key, and a
    checksum that orders documents of one key and id."""
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, projection = bpe.encoder(path, **(memory or {})), _projection()
        end = np.array([end_id], enc.dtype)

        def rows(doc_ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
            ids, sizes = _with_end(found, end)
            places = np.concatenate([[0], np.cumsum(sizes)]) * enc.width
            raw = memoryview(ids).cast("B")
            return pa.RecordBatch.from_pydict({
                "doc_id": doc_ids, "width": np.full(len(sizes), enc.width, np.int32),
                "ids": pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(places), pa.py_buffer(raw)]).cast(pa.binary()),
                "curve": hilbert_key(coordinates(ids, sizes, projection)),
                "tie": np.array([zlib.crc32(raw[a:b]) for a, b in zip(places, places[1:])], np.int64)})
        for batch in batches:
            found, size, at = [], 0, 0
            for i, ids in enumerate(enc.batch(batch.column("text"))):
                found.append(ids)
                size += ids.nbytes
                if size > _PASSED_ON or i + 1 == batch.num_rows:
                    yield rows(batch.column("doc_id").slice(at, len(found)), found)
                    found, size, at = [], 0, i + 1
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text")).mapInArrow(
        encode, "doc_id long, width int, ids binary, curve long, tie long")


class _Packer:
    """Lays runs of ids into sequences of `capacity`; holds at most one open sequence."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.open, self.fill, self.out = [], 0, []

    def add(self, doc_id, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            take = min(self.capacity - self.fill, len(ids) - at)
            self.open.append((doc_id, at, ids[at:at + take], len(ids)))
            self.fill += take
            at += take
            if self.fill == self.capacity:
                self._flush(self.capacity)

    def _flush(self, size: int) -> None:
        """Emit the first `size` ids of the open runs as one sequence."""
        offset = 0
        while offset < size:
            doc_id, start, ids, total = self.open.pop(0)
            if len(ids) > size - offset:
                cut = size - offset
                self.open.insert(0, (doc_id, start + cut, ids[cut:], total))
                ids = ids[:cut]
            self.out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), total,
                             self.sequence, offset))
            offset += len(ids)
        self.fill -= size
        self.sequence += 1

    def close(self) -> None:
        while self.fill:
            self._flush(1 << (self.fill.bit_length() - 1))

    def taken(self) -> list:
        out, self.out = self.out, []
        return out


PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = 2048,
         id_col: str = "doc_id", text_col: str = "text", memory: dict | None = None) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece.  Sequences hold
    `capacity` ids, but for the last ones of a range, which hold smaller powers
    of two; their ids are unique, not consecutive.  A null or empty text is its
    end id alone; null and repeated ids keep their rows.  Other columns are not
    read.  An empty table gives an empty table.  `memory` sets what an encoding
    worker holds (see `bpe.Encoder`); the result is the same."""
    spark = docs.sparkSession
    workers_import_package(spark)
    path = path or bpe.default_path()
    rows = encoded(docs, path, end_id, id_col, text_col, memory)
    folder = shared_path(spark, "packing-ids")
    rows.write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    order = ["curve", "doc_id", "tie"]
    along = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)

    def lay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)
        names = [c.split()[0] for c in PIECE.split(", ")]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)
        for batch in batches:
            for doc_id, width, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "width", "ids"))):
                packer.add(doc_id, np.frombuffer(raw, f"<u{width}"))
            yield batch_of(packer.taken())
        packer.close()
        yield batch_of(packer.taken())
    return along.mapInArrow(lay, PIECE)
