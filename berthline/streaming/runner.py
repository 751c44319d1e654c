"""Structured Streaming: watermarks, sinks, bounded replays and state flushing.

Production: silver/gold run as continuous (or scheduled `availableNow`) queries
over Kafka / table streams; watermarks advance with real time, so outer-join and
window state drains by itself.

Bounded replays (tests, backfills, the registered `stream_*` queries) stage
input files in event-time order, one `availableNow` run per stage from a single
checkpoint, and finish with one far-future sentinel row per input: the sentinel
moves the watermark past every real row, the join/window state is emitted, and
the sentinel rows themselves are filtered out of the result.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from .progress import totals
from .updated import batch_writer

SENTINEL_ID = "__flush__"
SENTINEL_TS = "2200-01-01 00:00:00"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def watermarked(df: DataFrame, col: str, delay: str) -> DataFrame:
    return df.withWatermark(col, delay)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for stateful queries, with the caller's settings: RocksDB state (off-heap,
    spills to local disk, checkpointed to the shared folder) and, if given, its own
    number of state partitions.  A query fixes that number at its first start (it is
    stored in the checkpoint), so it is the caller's to choose; other queries of
    the caller's session keep their settings."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k) and own.conf.get(k, None) != v:
            own.conf.set(k, v)
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = own.conf.get(key, None)
    if not cur or "HDFSBackedStateStoreProvider" in cur:
        own.conf.set(key, ROCKSDB)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def run_available_now(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append",
                      fmt: str = "parquet", name: str | None = None, keys: list[str] | None = None) -> list[dict]:
    """Process everything available now, then stop; returns [the run's totals] (see
    `progress.Totals`), to be added up over runs.

    append: rows go to `path` as files (the file sink is exactly-once via its
    metadata log).  update: changed rows go to `path` batch by batch (see `updated`), and
    with `keys` are compacted."""
    seen = totals(df.sparkSession)
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if mode == "update":
        q = w.outputMode("update").foreachBatch(batch_writer(path, fmt, keys)).start()
    else:
        q = w.outputMode(mode).format(fmt).start(path)
    q.awaitTermination()
    return [seen.of(q)]


def dropped_by_watermark(runs: list[dict]) -> int:
    return sum(r["dropped"] for r in runs)


class Replay:
    """A bounded, ordered replay of batch tables through streaming queries."""

    def __init__(self, spark: SparkSession, label: str, state_partitions: int | None = None):
        """`state_partitions`: by default the cluster's cores, for a replay opens every
        state store in each of its few batches."""
        self.spark = spark
        self.session = stream_session(spark, state_partitions or spark.sparkContext.defaultParallelism)
        self.root = os.path.join(checkpoint_root(spark), "berthline-streams",
                                 f"{label}-{uuid.uuid4().hex[:12]}")
        self.inputs: dict[str, tuple[T.StructType, str]] = {}

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _mkdirs(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)

    def source(self, name: str, schema: T.StructType, ts_col: str) -> DataFrame:
        self.inputs[name] = (schema, ts_col)
        self._mkdirs(self.path("in", name))
        # No maxFilesPerTrigger: each stage is one micro-batch, so the arrival order
        # is exactly the staging order (files of one stage share a write time).
        return self.session.readStream.schema(schema).parquet(self.path("in", name))

    def stage(self, name: str, df: DataFrame) -> None:
        """Append rows to an input (they arrive with the next run)."""
        df.write.mode("append").parquet(self.path("in", name))

    def stage_sentinels(self) -> None:
        flush(self.spark, {self.path("in", n): v for n, v in self.inputs.items()})



def flush(spark: SparkSession, inputs: dict) -> None:
    """Append one far-future sentinel row to each file-stream input
    ({path: (schema, event-time column)}).  Every text column (ids, keys)
    holds the sentinel text, so the row survives key filters that Catalyst may
    push below the watermark, matches nothing but other sentinels, and is
    removed by id afterwards (`without_sentinels`).  Run the query twice after
    flushing: the sentinel batch moves the watermark, the next run evicts."""
    for path, (schema, ts_col) in inputs.items():
        def value(f):
            if f.name == ts_col:
                return F.to_timestamp(F.lit(SENTINEL_TS))
            if isinstance(f.dataType, T.StringType):
                return F.lit(SENTINEL_ID)
            return F.lit(None)
        spark.range(1).select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields]) \
            .write.mode("append").parquet(path)


def time_chunks(df: DataFrame, ts_col: str, bounds: list[str]) -> list[DataFrame]:
    """Split a table at fixed timestamps into arrival stages (in time order);
    rows with NULL time arrive with the first stage."""
    t = F.col(ts_col)
    ts = [F.to_timestamp(F.lit(b)) for b in bounds]
    out = []
    for i in range(len(bounds) + 1):
        if not bounds:
            cond = F.lit(True)
        elif i == 0:
            cond = t.isNull() | (t < ts[0])
        elif i == len(bounds):
            cond = t >= ts[-1]
        else:
            cond = (t >= ts[i - 1]) & (t < ts[i])
        out.append(df.where(cond))
    return out


def without_sentinels(df: DataFrame, *id_cols: str) -> DataFrame:
    for c in id_cols:
        df = df.where(F.col(c).isNull() | (F.col(c) != SENTINEL_ID))
    return df
