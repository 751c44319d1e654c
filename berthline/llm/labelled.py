"""Labelled documents for the two classifiers: bounded samples, and all of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _known(labels: DataFrame, label_col: str, learn: Column, id_col: str) -> DataFrame:
    """(doc_id, label) of the labels that may be learned from, one row an id."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    return known.where("doc_id is not null and label in (0, 1)").where(learn).groupBy("doc_id").agg(
        F.min("label").alias("label"))


def _with_text(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return texts.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, text) of all labelled documents that `labelled_sample` picks from."""
    return _with_text(docs, _known(labels, label_col, learn, id_col), id_col, text_col)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """((doc_id, label, text) of at most `max_rows` labelled documents, label counts).

    `learn` says of an id (column `doc_id`) whether its label may be learned
    from.  The rows are those with the smallest id hash of either label, half
    each; the counts are over all labels that may be learned from.  Null ids
    and labels are left out; of a repeated id the smallest label and text count."""
    known = _known(labels, label_col, learn, id_col)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pick = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
            for y in (0, 1)]
    # at most max_rows narrow rows: safe to broadcast
    sample = F.broadcast(pick[0].unionByName(pick[1]))
    return _with_text(docs, sample, id_col, text_col), counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
