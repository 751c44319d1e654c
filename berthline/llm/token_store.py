"""Token ids in binary shards with a minimal perfect hash index.

Files below one folder (any store pyarrow can write):

    ids/shard-00000.ids    raw little-endian ids of all documents, nothing else
    ids/shard-00000.dir    directory: count, then per document key, null flag, length
    index/bucket-00000.mph levels of hash bits, then per slot fingerprint, shard, offset, length

Documents lie in ascending key order.  Keys are spread over index buckets by
hash; in its bucket a key finds its slot through the perfect hash and is
refused unless the slot's stored fingerprint is its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import bpe
from .common import shared_path, workers_import_package, written

GAMMA = 2.0                 # bits per key of a hash level
BUCKET_KEYS = 200_000       # keys of an index bucket, about
_FINGERPRINT_SEED = 0xF1
_BUCKET_SEED = 0xB5
_COPY = 1 << 22             # bytes read from a shard at a time
_BLOCK = 1 << 22            # ids of a shard that one task reads


# ---------------------------------------------------------------- files
def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """`uri` as Spark names it, with a scheme; a bare path is one of this machine (tests)."""
    if "://" not in uri:
        uri = f"file://{uri.removeprefix('file:')}"
    return pafs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, parts: Iterable[bytes]) -> None:
    """Write a file under a name of its own and publish it by one rename: a task that
    is lost, or runs twice, leaves no half file under the final name."""
    store, base = _open(uri)
    store.create_dir(base, recursive=True)
    draft = f"{base}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, f"{base}/{name}")


def _get(uri: str, name: str) -> bytes:
    store, base = _open(uri)
    with store.open_input_file(f"{base}/{name}") as f:
        return f.read()


# ---------------------------------------------------------------- minimal perfect hash
def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 of uint64 keys."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64(((seed + 1) * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def as_keys(ids) -> np.ndarray:
    return np.asarray(ids, np.int64).view(np.uint64)


class PerfectHash:
    """Maps n distinct keys one to one to 0..n-1: at each level a key takes the bit it
    alone hashes to, the others go on to the next level; the slot is the rank of
    the bit (Limasset et al., "Fast and scalable minimal perfect hashing", 2017)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.starts = np.cumsum([0, *map(len, levels)])
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(counts)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            bits = 64 * max(1, int(np.ceil(GAMMA * len(left) / 64)))
            at = (mix(left, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; keys that were not built in get any slot, or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            at = (mix(keys[todo], level) % np.uint64(64 * len(words))).astype(np.int64)
            word, bit = self.starts[level] + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.ranks[word] + np.bitwise_count(below).astype(np.int64))[hit]
            todo = todo[~hit]
        return out


SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, _FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")


def index_bytes(ids, shard, offset, length) -> list[bytes]:
    keys = as_keys(ids)
    hashed = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    at = hashed.slots(keys)
    for name, values in (("fingerprint", fingerprints(keys)), ("shard", shard), ("offset", offset), ("length", length)):
        slots[name][at] = values
    return [struct.pack("<II", len(hashed.levels), len(keys)),
            np.array([len(x) for x in hashed.levels], "<u4").tobytes(),
            *[x.tobytes() for x in hashed.levels], slots.tobytes()]


class Index:
    """One index bucket, read from its bytes."""

    def __init__(self, raw: bytes):
        n_levels, n = struct.unpack_from("<II", raw)
        sizes = np.frombuffer(raw, "<u4", n_levels, 8)
        at, levels = 8 + 4 * n_levels, []
        for size in sizes:
            levels.append(np.frombuffer(raw, "<u8", size, at))
            at += 8 * int(size)
        self.hashed, self.table = PerfectHash(levels), np.frombuffer(raw, SLOT, n, at)

    def find(self, ids) -> tuple[np.ndarray, np.ndarray]:
        """(found, entries): entries of unknown ids are zero."""
        keys = as_keys(ids)
        slots = self.hashed.slots(keys)
        if not len(self.table):
            return np.zeros(len(keys), bool), np.zeros(len(keys), SLOT)
        entries = self.table[np.maximum(slots, 0)]
        found = (slots >= 0) & (entries["fingerprint"] == fingerprints(keys))
        entries[~found] = 0
        return found, entries


# ---------------------------------------------------------------- writing
PLACED = "doc_id long, shard int, offset long, n_tokens long, width int"


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode `docs` into shards below `folder` in ascending id order (nulls first);
    -> one row a document: doc_id, shard, offset in the shard, n_tokens, width.

    A null or empty text is its end id alone.  Null and repeated ids keep their
    rows.  Rows that agree in id and text are spread by row number, so that no
    range holds them all.  An empty table writes no shard."""
    workers_import_package(docs.sparkSession)
    path = path or bpe.default_path()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)

    def write_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name, enc = f"shard-{shard:05d}", bpe.encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        store, base = _open(f"{folder}/ids")
        keys, sizes, at, out, draft = [], [], 0, None, f"{base}/.{name}-{uuid.uuid4().hex}"
        for batch in batches:
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(draft)
            first, lengths = at, []
            for found in enc.batch(batch.column("text")):
                raw = found.tobytes() + end
                out.write(raw)
                lengths.append(len(raw) // enc.width)
                at += lengths[-1]
            ids = batch.column("doc_id")
            keys.append(ids)
            sizes.extend(lengths)
            n = len(lengths)
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "shard": pa.array([shard] * n, pa.int32()),
                "offset": pa.array(first + np.cumsum([0, *lengths[:-1]]), pa.int64()) if n else pa.array([], pa.int64()),
                "n_tokens": pa.array(lengths, pa.int64()), "width": pa.array([enc.width] * n, pa.int32())})
        if out is not None:
            out.close()
            store.move(draft, f"{base}/{name}.ids")
            known = pa.chunked_array(keys, pa.int64())
            _put(f"{folder}/ids", f"{name}.dir", [
                struct.pack("<II", enc.width, len(sizes)),
                known.fill_null(0).to_numpy().astype("<i8").tobytes(),
                known.is_null().to_numpy().astype("u1").tobytes(), np.array(sizes, "<u4").tobytes()])
    return written(ranged.mapInArrow(write_shard, PLACED), "token-places")


def _bucket(n: int):
    return F.pmod(F.xxhash64(F.lit(_BUCKET_SEED), "doc_id"), F.lit(n)).cast("int")


def build_index(placed: DataFrame, folder: str) -> DataFrame:
    """Write the index buckets of all keys; -> (bucket, n_keys), one row a bucket.
    A repeated key leads to its first copy; null keys have no entry."""
    n = 1 + placed.count() // BUCKET_KEYS
    first = placed.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("shard", "offset", "n_tokens")).alias("at")).select("doc_id", "at.*", _bucket(n).alias("bucket"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        _put(f"{folder}/index", f"bucket-{bucket:05d}.mph", index_bytes(
            group["doc_id"], group["shard"], group["offset"], group["n_tokens"]))
        return pd.DataFrame({"bucket": [bucket], "n_keys": [len(group)]})
    return written(first.groupBy("bucket").applyInPandas(build, "bucket int, n_keys long"), "token-index"), n


# ---------------------------------------------------------------- reading
def look_up(keys: DataFrame, folder: str, n_buckets: int) -> DataFrame:
    """`keys(doc_id, ...)` -> the same rows with at_shard, at_offset, at_length from the
    index (null: no such key).  One shuffle by bucket; each bucket is read once a task."""
    rows = keys.withColumn("__bucket", F.coalesce(_bucket(n_buckets), F.lit(0)))
    rows = rows.repartition("__bucket", F.pmod(F.xxhash64("doc_id"), F.lit(64))).sortWithinPartitions("__bucket")
    schema = StructType.fromJson(keys.schema.jsonValue()).add("at_shard", "integer").add("at_offset", "long").add(
        "at_length", "long")
    names = keys.columns

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for batch in batches:
            buckets = batch.column("__bucket").to_numpy()
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            found, entries = np.zeros(len(ids), bool), np.zeros(len(ids), SLOT)
            for bucket in np.unique(buckets):
                here = np.flatnonzero((buckets == bucket) & ~null)
                if not len(here):
                    continue
                if bucket != held:
                    held, index = bucket, Index(_get(f"{folder}/index", f"bucket-{bucket:05d}.mph"))
                found[here], entries[here] = index.find(ids[here])
            own = [batch.column(c) for c in names]
            at = [pa.array(entries[c].astype(np.int64), t, mask=~found)
                  for c, t in (("shard", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*own, *at], [*names, "at_shard", "at_offset", "at_length"])
    return rows.mapInArrow(find, schema)


STORED = "doc_id long, shard int, offset long, start long, n_tokens long, ids_crc32 long"


def shard_starts(placed: DataFrame) -> DataFrame:
    """(shard, start): ids of all shards before; one row a shard."""
    shards = placed.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written(shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")), "token-shards")


def checksums(places: DataFrame, folder: str) -> DataFrame:
    """`places(shard, offset, n_tokens, ...)` -> the same rows with ids_crc32 of the ids that stand
    there.  Rows are dealt by block of the shard and read in file order, some at a time."""
    rows = places.withColumn("__block", F.floor(F.col("offset") / _BLOCK)).repartition("shard", "__block") \
        .sortWithinPartitions("shard", "offset").drop("__block")
    schema = StructType.fromJson(places.schema.jsonValue()).add("ids_crc32", "long")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(f"{folder}/ids")
        held, f, width, low, raw = None, None, 0, 0, b""

        def part(at: int, size: int) -> memoryview:
            """Bytes [at, at + size) of the open shard, from what was read last or by a new read."""
            nonlocal low, raw
            if at < low or at + size > low + len(raw):
                low, raw = at, f.read_at(max(size, _COPY), at)
                if len(raw) < size:
                    raise OSError(f"shard {held} ends early")
            return memoryview(raw)[at - low:at - low + size]
        for batch in batches:
            sums = []
            for shard, offset, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "n_tokens"))):
                if shard != held:
                    held, low, raw = shard, 0, b""
                    f = store.open_input_file(f"{base}/shard-{shard:05d}.ids")
                    with store.open_input_file(f"{base}/shard-{shard:05d}.dir") as head:
                        width, = struct.unpack("<I", head.read(4))
                crc, at, left = 0, offset * width, n * width
                while left:
                    size = min(left, _COPY)
                    crc = zlib.crc32(np.frombuffer(part(at, size), f"<u{width}").astype("<u4"), crc)
                    at, left = at + size, left - size
                sums.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], [*batch.schema.names, "ids_crc32"])
    return rows.mapInArrow(read, schema)


def read_all(placed: DataFrame, folder: str) -> DataFrame:
    """Every document from the shard files, in file order within a shard: doc_id, shard,
    offset, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = shard_starts(placed)
    n = max(1, shards.count())

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist()):
                name = f"shard-{shard:05d}"
                raw = _get(f"{folder}/ids", f"{name}.dir")
                width, count = struct.unpack_from("<II", raw)
                keys = np.frombuffer(raw, "<i8", count, 8)
                null = np.frombuffer(raw, "u1", count, 8 + 8 * count).astype(bool)
                sizes = np.frombuffer(raw, "<u4", count, 8 + 9 * count).astype(np.int64)
                offsets = np.cumsum(sizes) - sizes
                store, base = _open(f"{folder}/ids")
                sums = np.zeros(count, np.int64)
                with store.open_input_stream(f"{base}/{name}.ids", buffer_size=_COPY) as f:
                    for i, size in enumerate(sizes):
                        left, crc = int(size) * width, 0
                        while left:
                            part = f.read(min(left, _COPY))
                            if not part:
                                raise OSError(f"{name}.ids ends early")
                            crc = zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes(), crc)
                            left -= len(part)
                        sums[i] = crc
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(keys, pa.int64(), mask=null), "shard": pa.array([shard] * count, pa.int32()),
                    "offset": offsets, "start": start + offsets, "n_tokens": sizes, "ids_crc32": sums})
    return shards.repartition(n, "shard").mapInArrow(read, STORED)


def read_keys(keys: DataFrame, folder: str, n_buckets: int) -> DataFrame:
    """Keyed access: `keys(doc_id)` -> (doc_id, ids) for the keys the index knows.  The width of an
    id is the shard's own."""
    at = look_up(keys.select("doc_id"), folder, n_buckets).where("at_shard is not null")
    at = at.repartition("at_shard", F.floor(F.col("at_offset") / (1 << 22))).sortWithinPartitions("at_shard", "at_offset")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(f"{folder}/ids")
        for batch in batches:
            out, held, f = [], None, None
            for shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("at_shard", "at_offset", "at_length"))):
                if shard != held:
                    held, f = shard, store.open_input_file(f"{base}/shard-{shard:05d}.ids")
                    with store.open_input_file(f"{base}/shard-{shard:05d}.dir") as head:
                        width, = struct.unpack("<I", head.read(4))
                out.append(np.frombuffer(f.read_at(length * width, offset * width), f"<u{width}").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return at.mapInArrow(read, "doc_id long, ids array<int>")


def store(docs: DataFrame, path: str | None = None, end_id: int = 2, folder: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards and index, look every key up, and read the ids back from where the index leads:
    doc_id, start, n_tokens, ids_crc32, shard, offset, indexed (the index gives place
    and length of this document, or of the first copy of its id; null ids: false).

    The index knows the first copy of an id; other copies and null ids are read from
    their own places.  A wrong entry gives wrong columns here."""
    folder = folder or shared_path(docs.sparkSession, "token-store")
    placed = write(docs, folder, path, end_id, id_col, text_col)
    _, n_buckets = build_index(placed, folder)
    own = F.struct(F.col("shard").alias("at_shard"), F.col("offset").alias("at_offset"), F.col("n_tokens").alias("at_length"))
    entry = F.struct("at_shard", "at_offset", "at_length")
    first = placed.where("doc_id is not null").groupBy("doc_id").agg(F.min(own).alias("first"))
    found = look_up(placed.select("doc_id", "shard", "offset", "n_tokens"), folder, n_buckets).join(first, "doc_id", "left")
    known = F.col("at_shard").isNotNull() & F.coalesce(own == F.col("first"), F.lit(False))
    place = F.when(known, entry).otherwise(own)
    found = found.select("doc_id", place["at_shard"].alias("shard"), place["at_offset"].alias("offset"),
                         place["at_length"].alias("n_tokens"), F.coalesce(entry == F.col("first"), F.lit(False)).alias("indexed"))
    read = checksums(found, folder).join(shard_starts(placed), "shard")
    return read.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset",
                       "indexed")
