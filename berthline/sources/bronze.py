"""Bronze sources: Kafka topics (or Kafka-shaped files/tables), unchanged rows.

Connection and security options (bootstrap servers, SASL/SSL, credentials) are
passed by the caller; nothing secret lives in code.  Where no Kafka connector
is on the classpath, the same row shape can be replayed from files or tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Source options every topic reader sets.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_bronze(spark: SparkSession, topics: str | list[str], *, fmt: str = "kafka",
                path: str | None = None, options: dict | None = None,
                streaming: bool = True) -> DataFrame:
    """Raw Kafka-shaped rows (key, value, topic, partition, offset, timestamp,
    timestampType) of one or several topics.

    fmt="kafka": `subscribe` to the topics (options carry the connection);
    fmt="parquet"/"json"/"table": replay rows of the same shape from `path`
    (a table name for "table"), filtered to the topics."""
    topics = [topics] if isinstance(topics, str) else list(topics)
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        opts = {**KAFKA_DEFAULTS, **(options or {}), "subscribe": ",".join(topics)}
        return reader.format("kafka").options(**opts).load()
    if fmt == "table":
        df = reader.table(path)
    else:
        df = reader.format(fmt).schema(schemas.KAFKA_ROW).options(**(options or {})).load(path)
    return df.where(F.col("topic").isin(*topics))


def route(bronze: DataFrame, routes: dict[str, str]) -> DataFrame:
    """Multi-topic stream -> rows tagged with their target table (topic -> table),
    the broker rule `SELECT * FROM "/crane/events"` per topic.  Unknown topics
    are tagged NULL rather than dropped."""
    m = F.create_map(*[F.lit(x) for kv in routes.items() for x in kv])
    return bronze.withColumn("target_table", m[F.col("topic")])


def branch(bronze: DataFrame, topic: str) -> DataFrame:
    """One table's share of a multi-topic stream (a pushed-down topic filter)."""
    return bronze.where(F.col("topic") == topic)


ROUTES = {schemas.TOPIC_CRANE: "crane_events_bronze",
          schemas.TOPIC_GATE_IN: "gate_in_events_bronze",
          schemas.TOPIC_GATE_OUT: "gate_out_events_bronze"}


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifest JSON documents (one pretty-printed object per file) with the fixed
    manifest schema; missing fields are NULL, unknown ones ignored."""
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)


def read_existing_manifests(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Manifest documents from every path that exists (e.g. the import and the
    export landing), missing ones skipped; None when none exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    present = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            present.append(p)
    if not present:
        return None
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(present)
