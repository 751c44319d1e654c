"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings the gold tables depend on: `to_date`/`hour` follow the
# session time zone, so it is pinned to UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Spark 4.1.2 takes a union of a shuffled table with its own rows for partitioned by the
    # table's keys and groups it without a shuffle, which loses rows.
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(master: str | None = None, app: str = "berthline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the defaults above.  Master and shuffle partitions belong to the
    cluster (spark-submit, spark-defaults): they are set only when asked for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: its application id plus the session object
    (object ids alone can be reused after a session is stopped)."""
    return (spark.sparkContext.applicationId, id(spark))


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone (runtime setting) so dates and hours are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_LOCAL_ROOTS: dict = {}


def is_local(spark: SparkSession) -> bool:
    """One JVM: driver and executors share a machine and its folders."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from the cluster's `spark.checkpoint.dir`.  Where it is unset, a local
    master (tests) gets a private scratch folder, once per context; a cluster
    gets an error, for executors would not see the driver's folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOTS:
        local = tempfile.mkdtemp(prefix="berthline-ckpt-")
        spark.sparkContext.setCheckpointDir(local)
        _LOCAL_ROOTS[key] = local
    return _LOCAL_ROOTS[key]
