"""Offset ledger: which offsets of every topic partition have been kept, as intervals.

Kafka numbers the records of a partition without holes, so what was kept, lost or
delivered twice shows in the offsets alone.  Intervals are found by gaps and
islands, first within blocks of offsets (a partition may hold a third of all
rows), then over the blocks' few intervals.  Ledgers of batches are stored as
they come and united on read, so no run scans rows that an earlier one has
seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 1_000_000           # offsets of a block
AT = ["topic", "partition"]
INTERVALS = "topic string, partition int, first_offset long, last_offset long, n_rows long"


def intervals(bronze: DataFrame, block: int = BLOCK) -> DataFrame:
    """`bronze(topic, partition, offset)` -> INTERVALS: unbroken runs of offsets and the rows they hold,
    repeated deliveries counted.  Rows without an offset are not counted."""
    known = bronze.where("offset IS NOT NULL").groupBy(*AT, "offset").agg(F.count("*").alias("n"))
    known = known.withColumn("_block", F.floor(F.col("offset") / block))
    line = Window.partitionBy(*AT, "_block").orderBy("offset")
    runs = known.withColumn("_run", F.col("offset") - F.row_number().over(line)).groupBy(*AT, "_block", "_run").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum("n").alias("n_rows"))
    return united(runs)


def united(ledgers: DataFrame) -> DataFrame:
    """Intervals that touch or overlap -> one, n_rows added up.  Works on intervals, not on rows."""
    line = Window.partitionBy(*AT).orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_offset") > reached + 1, F.lit(True)).cast("int")
    marked = ledgers.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(line))
    return marked.groupBy(*AT, "_island").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
        F.sum("n_rows").cast("long").alias("n_rows")).drop("_island")


def gaps(ledger: DataFrame) -> DataFrame:
    """(topic, partition, first_offset, last_offset, n_offsets) of offsets that lie between kept
    intervals: lost, or not yet delivered.  What is missing before the first interval shows
    against `startingOffsets=earliest` only, so it is not a gap."""
    line = Window.partitionBy(*AT).orderBy("first_offset")
    before = ledger.withColumn("_before", F.lag("last_offset").over(line)).where(F.col("_before").isNotNull())
    return before.select(*AT, (F.col("_before") + 1).alias("first_offset"), (F.col("first_offset") - 1).alias("last_offset"),
                         (F.col("first_offset") - F.col("_before") - 1).alias("n_offsets"))


def redelivered(ledger: DataFrame) -> DataFrame:
    """(topic, partition, first_offset, last_offset, n_offsets): intervals that hold more rows than
    offsets, and how many more."""
    extra = F.col("n_rows") - (F.col("last_offset") - F.col("first_offset") + 1)
    return ledger.select(*AT, "first_offset", "last_offset", extra.alias("n_offsets")).where("n_offsets > 0")


def duplicates(bronze: DataFrame) -> DataFrame:
    """(topic, partition, offset, copies) of the offsets kept more than once, row by row."""
    return bronze.where("offset IS NOT NULL").groupBy(*AT, "offset").agg(
        F.count("*").alias("copies")).where("copies > 1")


def ledger_writer(path: str, block: int = BLOCK):
    """foreachBatch sink: every batch's intervals in a folder of its own, so a batch that runs again
    replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        intervals(batch, block).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def stored_ledger(spark: SparkSession, path: str) -> DataFrame:
    """INTERVALS over all batches that `ledger_writer` has stored."""
    return united(spark.read.schema(INTERVALS).parquet(f"{path}/batch=*"))


def report(bronze: DataFrame, block: int = BLOCK) -> DataFrame:
    """(kind, topic, partition, first_offset, last_offset, n_offsets): kept intervals, gaps between
    them, and every offset that was delivered again (n_offsets: how often)."""
    kept = intervals(bronze, block)
    cols = ["topic", "partition", "first_offset", "last_offset", "n_offsets"]
    held = kept.withColumn("n_offsets", F.col("last_offset") - F.col("first_offset") + 1)
    again = duplicates(bronze).select(*AT, F.col("offset").alias("first_offset"), F.col("offset").alias("last_offset"),
                                      (F.col("copies") - 1).alias("n_offsets"))
    parts = [d.select(F.lit(kind).alias("kind"), *cols) for kind, d in (("kept", held), ("gap", gaps(kept)), ("again", again))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
