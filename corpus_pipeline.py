"""Training-corpus pipeline over `documents`: quality rules, quality classifier, SimHash
near-duplicates, packing.

Each of STAGES is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next
stage's docs.  All but the last return the columns of `documents`.

Null ids: a decision is joined to its document by id and text hash, nulls
matching nulls, so such documents are judged like any other.  Equal rows get
equal decisions.  An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from berthline.llm import hilbert_packing, quality_ranker, quality_rules, simhash_ball
from berthline.llm.common import fold, table, written


def _text_hash() -> Column:
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or lie far out for their language and source, go."""
    judged = quality_rules.judge(docs.withColumn("text_hash", _text_hash()), carry=("text_hash",))
    kept = judged.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]) & (_text_hash() == kept["kept_hash"]), "left_semi")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker scores below its threshold go.  It learns from
    the labelled documents of the whole table, but for the held-out fold."""
    learn = ~F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    ranker = quality_ranker.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return docs.where(quality_ranker.score_column(ranker, docs["text"]) >= 0.5)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: 3-word shingles, at most 2 differing bits."""
    return simhash_ball.deduplicate(docs, shingle=3, max_distance=2)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed along the curve into sequences of at most 2048 ids.  Workers that ran
    the stages before hold less, beside an executor heap that has grown."""
    return hilbert_packing.pack(docs, end_id=1, capacity=2048, memory={"remembered": 300_000, "group": 4 << 20})


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]

# The ranker's fit and the packing have no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage's result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
