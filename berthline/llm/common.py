"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver found it (a cluster
    ships it with --py-files instead; an unknown folder on the path does no harm)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(":")
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = ":".join([PACKAGE_ROOT, *filter(None, known)])


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the cluster's shared folder (spark.checkpoint.dir), with the scheme that
    Spark resolves it to, so that readers outside Spark open the same folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/berthline/{name}-{uuid.uuid4().hex}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of `df`: write it as Parquet into the shared folder and read
    it back.  Lost executors then cost a re-read, not a recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus
