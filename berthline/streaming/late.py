"""Late rows kept: a side output beside a watermark, and the merge that corrects with it.

A stateful query drops rows older than its watermark without a trace.  Here the
stream is split before it: every batch is judged by the watermark that the
batches before it have left (largest event time seen, less the delay, as the
query itself judges), rows on time go on, late ones to a table of their own.
The watermark is recorded with the batch, so a batch that runs again is split as
before and replaces its own output.

    <path>/on_time/batch=<id>/      rows on time, and rows without a time
    <path>/late/batch=<id>/         rows behind the watermark
    <path>/_watermark/<id>          largest event time up to a batch, in microseconds
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket
from ..sources import sinks

_NONE = "none"


def _seen(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Largest event time of the batches before `batch_id` (batch numbers have no holes)."""
    at = f"{path}/_watermark/{batch_id - 1}"
    if batch_id == 0 or not sinks._exists(spark, at):
        return None
    text = sinks._read_text(spark, at)
    return None if text == _NONE else int(text)


def splitter(path: str, ts: str, delay: str, window_seconds: int | None = None):
    """foreachBatch sink that splits rows by the watermark `delay` (an interval) behind `ts`: a row is
    late if it lies before it, or with `window_seconds` if its whole window does, as for
    a windowed aggregate."""
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _seen(spark, path, batch_id)
        late: Column = F.lit(False)
        if before is not None:
            mark = F.unix_micros(F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {delay}"))
            late = F.unix_micros(F.col(ts)) < mark
            if window_seconds:
                late = (time_bucket(ts, window_seconds * 1_000_000) + 1) * window_seconds * 1_000_000 <= mark
            late = F.coalesce(late, F.lit(False))
        # written once with its verdict, then parted: the input is read a single time
        batch.withColumn("_late", late).write.mode("overwrite").parquet(f"{path}/_split/batch={batch_id}")
        rows = spark.read.schema(batch.schema.add("_late", "boolean")).parquet(f"{path}/_split/batch={batch_id}")
        for part, flag in (("on_time", F.lit(False)), ("late", F.lit(True))):
            rows.where(F.col("_late") == flag).drop("_late").write.mode("overwrite").parquet(f"{path}/{part}/batch={batch_id}")
        top = rows.agg(F.unix_micros(F.max(ts))).first()[0]
        known = [x for x in (before, top) if x is not None]
        sinks._publish(spark, f"{path}/_watermark/{batch_id}", str(max(known)) if known else _NONE)
    return split


def rows(spark: SparkSession, path: str, part: str, schema) -> DataFrame:
    """Rows of one side (`on_time` or `late`) over all batches."""
    return spark.read.schema(schema).parquet(f"{path}/{part}/batch=*")


def hourly_vehicles(gate: DataFrame, ts: str, name: str) -> DataFrame:
    """(terminal_id, window, name): vehicles per terminal and hour."""
    return gate.where(F.col(ts).isNotNull()).groupBy("terminal_id", F.window(ts, "1 hour").alias("window")).agg(
        F.count(F.lit(1)).alias(name))


def corrected(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Hourly counts as the stream left them, what came late, and both together: (terminal_id,
    window, vehicles_on_time, vehicles_late, vehicles_in).  Both sides are already counted, so the
    join sees one row a terminal-hour."""
    a, b = on_time.alias("a"), late.alias("b")
    same = F.col("a.terminal_id").eqNullSafe(F.col("b.terminal_id")) & (F.col("a.window") == F.col("b.window"))
    n = [F.coalesce(F.col(c), F.lit(0)) for c in ("vehicles_on_time", "vehicles_late")]
    return a.join(b, same, "full").select(
        F.when(F.col("a.window").isNotNull(), F.col("a.terminal_id")).otherwise(F.col("b.terminal_id")).alias("terminal_id"),
        F.coalesce("a.window", "b.window").alias("window"), n[0].alias("vehicles_on_time"), n[1].alias("vehicles_late"),
        (n[0] + n[1]).alias("vehicles_in"))
