"""Table sinks: overwrite (materialized view), clustered layout, dated JSON landing.

Writes go through Spark's commit protocol: a lost executor's task is re-run and
only committed files become visible, so jobs survive executor loss.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

TASK_BYTES = 2_000_000      # parquet per shuffle task: tens of MB once decoded
LANDED_ROWS = 50_000        # documents per landed JSON file: a compressed file is read by one task
# Microsecond timestamps in JSON (the writer's default keeps milliseconds only).
LANDING_SPREAD = 4          # tasks a topic-day of one batch is written by, at most
JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def clustered(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Clustered layout without Delta: range-partition on the cluster keys and
    sort within files, so parquet min/max statistics prune scans on them.

    `repartitionByRange` samples the keys to pick boundaries (no driver
    collect of data), so a hot key leading the list still spreads over files
    by the following keys.  Without `partitions` the range count follows
    `spark.sql.shuffle.partitions` (sized to the data, coalesced by AQE), so file
    size tracks data size rather than the number of cores."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, path: str, keys: list[str], *,
                    partitions: int | None = None, fmt: str = "parquet") -> None:
    clustered(df, keys, partitions).write.mode("overwrite").format(fmt).save(path)


_BUILD_LOCK = threading.RLock()      # a table may be built from another


def cached_table(spark: SparkSession, name: str, key: str, build) -> DataFrame:
    """Write `build()` once per `key` and read it back: a lineage cut that survives
    executor loss (unlike localCheckpoint)."""
    return spark.read.parquet(cached_path(spark, name, key, build))


def cached_path(spark: SparkSession, name: str, key: str, build) -> str:
    """Folder of `build()`, written once per `key` as parquet under the shared
    checkpoint folder.

    Each builder writes a folder of its own and publishes it by creating a small
    pointer file that must not exist yet.  Readers follow the pointer, so they see
    a whole table or none; of concurrent builders the first to publish counts.
    Nothing is renamed (on object stores a rename copies the table)."""
    safe = hashlib.sha256(key.encode()).hexdigest()[:32]
    folder = f"{checkpoint_root(spark)}/berthline-tables/{safe}/{name}"
    pointer = f"{folder}/_current"
    with _BUILD_LOCK:
        if not _exists(spark, pointer):
            own = f"{folder}/table-{uuid.uuid4().hex[:12]}"
            build().write.parquet(own)
            _publish(spark, pointer, own)
    return _read_text(spark, pointer)


def _hpath(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _hpath(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_hpath(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_hpath(spark, path))


def _publish(spark: SparkSession, pointer: str, target: str) -> None:
    """Create the pointer file; if another builder was first, its table stays."""
    try:
        out = _fs(spark, pointer).create(_hpath(spark, pointer), False)
    except Py4JJavaError:
        if _exists(spark, pointer):
            return
        raise
    out.write(bytearray(target.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    """A small file's text.  A pointer is empty for the moment between its creation and
    its close, which is waited for."""
    for _ in range(100):
        stream = _fs(spark, path).open(_hpath(spark, path))
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text:
            return text
        time.sleep(0.1)
    raise RuntimeError(f"{path} is empty: its writer was lost; delete it to build the table again")


def fingerprint(spark: SparkSession, path: str) -> str:
    """Identity of an input: path, length and modification time of every file below
    `path`, so a cached derivation is rebuilt when any of them changes, comes or
    goes.  One listing on the driver, as Spark's own file index makes."""
    files = _fs(spark, path).listFiles(_hpath(spark, path), True)
    found = []
    while files.hasNext():
        st = files.next()
        found.append(f"{st.getPath().toString()} {st.getLen()} {st.getModificationTime()}")
    return f"{path} {hashlib.sha256(chr(10).join(sorted(found)).encode()).hexdigest()}"


def task_count(spark: SparkSession, *paths: str) -> int:
    """Tasks for a shuffle of what lies at `paths`: one per TASK_BYTES of (compressed) files,
    the cores at least.  A task's share of a table stays the same however large the table is."""
    size = sum(_fs(spark, p).getContentSummary(_hpath(spark, p)).getLength() for p in paths)
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def publish_version(spark: SparkSession, folder: str, df: DataFrame, keys: list[str] | None = None) -> str:
    """Materialized view semantics: recompute the whole table (in clustered layout with
    `keys`) beside the version in use, then name it the current one by a numbered file
    that must not exist yet.  Readers see the old version or the new, whole."""
    own = f"{folder}/version-{uuid.uuid4().hex[:12]}"
    (clustered(df, keys) if keys else df).write.parquet(own)
    number = 1 + max(_versions(spark, folder), default=0)
    while _exists(spark, f"{folder}/_versions/{number:08d}"):
        number += 1
    _publish(spark, f"{folder}/_versions/{number:08d}", own)
    return own


def _versions(spark: SparkSession, folder: str) -> list[int]:
    at = f"{folder}/_versions"
    if not _exists(spark, at):
        return []
    return [int(st.getPath().getName()) for st in _fs(spark, at).listStatus(_hpath(spark, at))
            if st.getPath().getName().isdigit()]


def current_version(spark: SparkSession, folder: str) -> str:
    """Folder of the version published last."""
    found = _versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no version of {folder} has been published")
    return _read_text(spark, f"{folder}/_versions/{max(found):08d}")


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new folder under the shared checkpoint root (never reused or cleared)."""
    return os.path.join(checkpoint_root(spark), "berthline-sinks", *parts, uuid.uuid4().hex[:12])


def land_raw_stream(bronze: DataFrame, path: str, checkpoint: str) -> list:
    """Topic -> object-store landing (what a managed sink connector does): each
    Kafka record as one JSON line, folders topic=<t>/date=<d>, exactly-once via
    the file sink's commit log; returns [the run's totals].  Rows of a batch are
    dealt by (topic, date) and a spread of the offsets first, so a batch writes few
    files a folder and a hot topic-day is still written by several tasks."""
    from ..streaming.progress import totals
    seen = totals(bronze.sparkSession)
    rows = bronze.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType",
        F.to_date("timestamp").alias("date"))
    spread = F.pmod(F.col("offset").bitwiseXOR(F.col("partition")), F.lit(LANDING_SPREAD))
    rows = rows.repartition("topic", "date", spread)
    q = (rows.writeStream.format("json").partitionBy("topic", "date")
         .option("timestampFormat", JSON_TS)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .outputMode("append").start(path))
    q.awaitTermination()
    return [seen.of(q)]


def land_dated_json(df: DataFrame, path: str, date_col: str, label_col: str | None = None) -> None:
    """Daily landing layout  <path>/year=YYYY/month=MM/day=DD[/<label>=...]/part-*.json.

    The source writes one object per day and process type under
    bronze/<api>/YYYY/MM/DD/<label>/; Spark's partitioned writer keeps that
    hierarchy (as key=value folders) and writes gzip files in parallel, after a range
    shuffle on (day, label, row hash).  Range boundaries come from a sample, so small days share one task (about one
    file per folder instead of one per task) while a day holding a third of all
    rows is cut into many ranges by the row hash and written by many tasks."""
    d = F.col(date_col)
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    # Ranges follow the size of the data (AQE joins small ones): about one file a folder,
    # more only where a folder spans ranges.
    parts = ["year", "month", "day"] + ([label_col] if label_col else [])
    out = (df.withColumn("year", F.date_format(d, "yyyy"))
           .withColumn("month", F.date_format(d, "MM"))
           .withColumn("day", F.date_format(d, "dd"))
           .repartitionByRange(*parts, h)
           .drop(date_col))
    out.write.mode("overwrite").option("timestampFormat", JSON_TS).option("compression", "gzip") \
        .option("maxRecordsPerFile", LANDED_ROWS).partitionBy(*parts).json(path)


def land_schedule(schedule: DataFrame, root: str) -> str:
    """Vessel-schedule landing  <root>/vessel_schedule_api/YYYY/MM/DD/<run time>/part-*.json,
    the run's whole schedule under the day and the time (UTC) it was taken.  Returns the folder."""
    now = dt.datetime.now(dt.timezone.utc)
    folder = f"{root.rstrip('/')}/vessel_schedule_api/{now:%Y/%m/%d}/schedule_{now:%H%M%S_%f}"
    schedule.write.option("timestampFormat", JSON_TS).json(folder)
    return folder
