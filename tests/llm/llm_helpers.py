"""Plain-Python counterparts and odd rows for the tests of the training-data operators."""

from __future__ import annotations

import re

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"

# Null text, empty, blank, one word, ties, repeated rows, null id, a very long text.
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, "word", "en", None, 4),
    (5, "same words here and here", "en", "a", 24), (6, "same words here and here", "en", "a", 24),
    (6, "same words here and here", "en", "a", 24), (None, "no id at all", "fr", "b", 12),
    (None, "no id at all", "fr", "b", 12), (7, "é ñ 字 🙂 MIT License", "de", "b", 18),
    (8, "long " * 20000 + "end", "en", "a", 100003), (6, "another text under id six", "en", "a", 25),
]


def odd(spark, extra=True):
    """The odd rows, with columns whose names clash with those the operators use."""
    df = spark.createDataFrame(ODD, DOC)
    if not extra:
        return df
    from pyspark.sql import functions as F
    clash = ["key", "grp", "fp", "node", "score", "label", "ids", "bucket", "shard", "kept", "found", "x y", "__w"]
    return df.withColumns({c: F.lit("clash") for c in clash})


def empty(spark, schema=DOC):
    return spark.createDataFrame([], schema)


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
