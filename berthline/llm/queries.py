"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Each query applies its operator with production parameters to the whole table
and derives the columns it reports from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hilbert_packing, hnsw, html_blocks, importance_resampling, lanczos_whitening, license_scan, pareto_mix,
               quality_ranker, quality_rules, sentencepiece_viterbi, simhash_ball, token_store, toxicity)
from .common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the robust-distance verdict of all documents."""
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "distance2")


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and texts of all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


ORACLE_SQL["op2_license_scan"] = license_scan.oracle_sql()


def _held_out(modulus: int, remainder: int):
    return F.coalesce(fold(F.col("doc_id"), modulus) == remainder, F.lit(False))


@query("op3_quality_ranker")
def op3_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise quality scores of all documents; fold 1 of 3 is held out."""
    held_out = _held_out(3, 1)
    found = quality_ranker.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op4_sentencepiece_viterbi")
def op4_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, decoded again."""
    found = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_bytes", "score",
                        F.xxhash64("ids").alias("ids_hash"),
                        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


@query("op5_token_store")
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as binary ids with an index, and read back."""
    found = token_store.store(table(spark, sf_dir, "documents"), end_id=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "indexed")


@query("op6_html_blocks")
def op6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@query("op7_hilbert_packing")
def op7_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return hilbert_packing.pack(table(spark, sf_dir, "documents"), end_id=1, capacity=2048)


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most 2 differing bits."""
    found = simhash_ball.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", simhash_ball.hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; fold 0 of 5 is held out."""
    held_out = _held_out(5, 0)
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op10_hnsw")
def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose id is divisible by 20."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op11_pareto_mix")
def op11_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighted 5, 2, 1 in turn."""
    found = pareto_mix.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), total_percent=150, most=2)
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op11_pareto_mix"] = pareto_mix.oracle_sql()


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents, drawn by how much they look like the benchmark's texts."""
    found = importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                           percent=25, min_words=20, seed=7)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_lanczos_whitening")
def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along their 16 leading components, scaled to unit variance."""
    return lanczos_whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)
