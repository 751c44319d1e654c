"""Tables of updates: a base of current rows and the batches since, merged on read.

A streaming aggregation in update mode writes every batch's changed rows in a
folder of its own.  After COMPACT_EVERY batches the writer merges base and
batches into a new base and names it the current version, together with the
last batch it holds, by a numbered file that must not exist yet.  A reader takes
the base named last and the batches after it: a bounded number of folders
however many batches ran, and a whole table also while a compaction runs, for
nothing it reads is changed.

    <path>/batch=<id>/              changed rows of one batch
    <path>/_base/<id>/              all current rows up to a batch
    <path>/_versions/<number>       "<last batch> <base folder>"
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks

COMPACT_EVERY = 16          # batches a reader merges, at most (more only while a compaction runs)


def _version(spark: SparkSession, path: str) -> tuple[int, int, str | None]:
    """(number, last batch in the base, base folder) of the version published last."""
    number = max(sinks._versions(spark, path), default=0)
    if not number:
        return 0, -1, None
    last, base = sinks._read_text(spark, f"{path}/_versions/{number:08d}").split(" ", 1)
    return number, int(last), base


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = [st.getPath().getName() for st in sinks._fs(spark, path).listStatus(sinks._hpath(spark, path))]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def _merged(spark: SparkSession, path: str, keys: list[str], fmt: str, last: int, base: str | None,
            upto: int | None = None) -> DataFrame:
    deltas = [b for b in _batches(spark, path) if b > last and (upto is None or b <= upto)]
    parts = [spark.read.format(fmt).load(base).withColumn("batch", F.lit(-1).cast("long"))] if base else []
    if deltas:
        found = spark.read.option("basePath", path).format(fmt).load([f"{path}/batch={b}" for b in deltas])
        parts.append(found.withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        raise FileNotFoundError(f"no batch has been written to {path}")
    updates = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rows), "batch").alias("_row")).select(
        *keys, "_row.*").select(*[c for c in updates.columns if c != "batch"])


def latest(spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet") -> DataFrame:
    """The current rows: of each key, the row of the last batch."""
    _, last, base = _version(spark, path)
    return _merged(spark, path, keys, fmt, last, base)


def compact(spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet", upto: int | None = None) -> bool:
    """Merge base and batches (up to `upto`) into a new base.  False if there is nothing to
    merge, or another compaction was published first, which then counts."""
    number, last, base = _version(spark, path)
    through = max((b for b in _batches(spark, path) if b > last and (upto is None or b <= upto)), default=None)
    if through is None:
        return False
    own = f"{path}/_base/{uuid.uuid4().hex[:16]}"
    _merged(spark, path, keys, fmt, last, base, through).write.format(fmt).save(own)
    pointer, text = f"{path}/_versions/{number + 1:08d}", f"{through} {own}"
    sinks._publish(spark, pointer, text)
    return sinks._read_text(spark, pointer) == text


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the batch folders that the last `keep` versions' bases hold, all of them; readers that
    started before those versions must be done.  Returns the number of folders deleted."""
    numbers = sorted(sinks._versions(spark, path))[-keep:]
    if len(numbers) < keep:
        return 0
    oldest = int(sinks._read_text(spark, f"{path}/_versions/{numbers[0]:08d}").split(" ", 1)[0])
    gone = [b for b in _batches(spark, path) if b <= oldest]
    for b in gone:
        sinks._fs(spark, path).delete(sinks._hpath(spark, f"{path}/batch={b}"), True)
    return len(gone)


def batch_writer(path: str, fmt: str = "parquet", keys: list[str] | None = None, compact_every: int = COMPACT_EVERY):
    """foreachBatch sink: each batch in a folder of its own, so a batch that runs again replaces
    itself; with `keys`, compacts after every `compact_every` batches.  A batch that runs
    again after its compaction writes the same rows and is read from the base."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")
        if keys and sum(b > _version(spark, path)[1] for b in _batches(spark, path)) >= compact_every:
            compact(spark, path, keys, fmt, batch_id)
    return write
