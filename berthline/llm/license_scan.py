"""Licence scans by diagonal voting.

Rolling word k-gram hashes of every text are joined to the positions of the
same k-grams in licence templates.  Each match votes for a diagonal (place in
the text less place in the template); neighbouring diagonals, which inserted
and missing words make, are merged as far as a span may stretch, and a merged
span counts once enough of its template's k-grams stand in it.  DataFrame
functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = "[\\x00-/:-`\\{-\\x7f]+"       # what words are split at, after lower-casing A-Z
MAX_GRAMS = 60                          # k-grams of a template: they are bits of a long


@dataclass(frozen=True)
class Template:
    """`min_share` of the k-grams must be found; a phrase needs all on one diagonal."""
    name: str
    label: str
    text: str
    k: int = 3
    min_share: float = 0.6
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[0-9a-z]+", self.text.lower())

    @property
    def n_grams(self) -> int:
        return len(self.words) - self.k + 1


# The phrases with their labels, and passages of public licence texts.
TEMPLATES = (
    Template("mit license", "mit", "mit license", 2, 1.0, True),
    Template("apache license", "apache", "apache license", 2, 1.0, True),
    Template("general public license", "gpl", "general public license", 3, 1.0, True),
    Template("apache 2 notice", "apache-2.0", "apache license version 2.0", 3, 0.9),
    Template("gpl 2 notice", "gpl-2.0", "gnu general public license version 2", 3, 0.9),
    Template("gpl 3 notice", "gpl-3.0", "gnu general public license version 3", 3, 0.9),
    Template("lgpl notice", "lgpl", "gnu lesser general public license", 3, 0.9),
    Template("agpl notice", "agpl", "gnu affero general public license", 3, 0.9),
    Template("mpl 2 notice", "mpl-2.0", "mozilla public license version 2.0", 3, 0.9),
    Template("cc by nc notice", "cc-by-nc-4.0", "licensed under cc by-nc 4.0", 3, 0.9),
    Template("cc by sa notice", "cc-by-sa-4.0", "licensed under cc by-sa 4.0", 3, 0.9),
    Template("cc by notice", "cc-by-4.0", "licensed under cc by 4.0", 3, 0.9),
    Template("mit text", "mit",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
             "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
             "and/or sell copies of the Software"),
    Template("bsd text", "bsd",
             "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met: Redistributions of source code must retain the above "
             "copyright notice, this list of conditions and the following disclaimer"),
    Template("isc text", "isc",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
             "copies"),
    Template("apache text", "apache-2.0",
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at"),
    Template("gpl text", "gpl",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation"),
    Template("unlicense text", "unlicense",
             "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
             "modify, publish, use, compile, sell, or distribute this software"),
)
MAX_GAP = 2                 # words by which a span may stretch, whatever its length
STRETCH = 0.25              # and for each word of its template
_UNIT = 1_000_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


def _gram_hash(words: str | Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)])


def template_index(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, tpos, gram): one row a k-gram of a template."""
    for t in templates:
        if not 1 <= t.n_grams <= MAX_GRAMS:
            raise ValueError(f"template {t.name!r} needs 1 to {MAX_GRAMS} word {t.k}-grams; cut it into several")
    rows = [(n, i, t.k, t.words) for n, t in enumerate(templates) for i in range(t.n_grams)]
    index = spark.createDataFrame(rows, "template int, tpos int, k int, words array<string>")
    gram = F.lit(None).cast("long")
    for k in sorted({t.k for t in templates}):
        gram = F.when(F.col("k") == k, _gram_hash("words", F.col("tpos"), k)).otherwise(gram)
    return index.select("template", "tpos", gram.alias("gram"))


def template_table(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    return spark.createDataFrame(
        [(n, t.label, t.phrase, t.k, t.n_grams, len(t.words), float(t.min_share)) for n, t in enumerate(templates)],
        "template int, label string, phrase boolean, k int, n_grams int, n_words int, min_share double")


def votes(docs: DataFrame, keys: list[str], templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """`docs(keys, text)` -> (keys, template, diagonal, found, first, last): the k-grams of
    the template found on a diagonal, as bits, and the places of the first and
    last.  Bits are the same however often a row is repeated."""
    spark = docs.sparkSession
    # broadcast: at most MAX_GRAMS rows a template, and templates are a parameter of the job
    index = F.broadcast(template_index(spark, templates))
    words = docs.select(*keys, word_array(F.col("text")).alias("w"))
    n = F.size("w")

    def grams_of(k: int) -> Column:
        places = F.sequence(F.lit(0), n - k)
        return F.when(n >= k, F.transform(places, lambda i: F.struct(
            i.alias("pos"), _gram_hash("w", i, k).alias("gram"))))
    grams = [grams_of(k) for k in sorted({t.k for t in templates})]
    empty = F.array().cast("array<struct<pos:int,gram:bigint>>")
    flat = words.select(*keys, F.explode(F.concat(*[F.coalesce(g, empty) for g in grams])).alias("g"))
    hits = flat.select(*keys, "g.pos", "g.gram").join(index, "gram")
    return hits.groupBy(*keys, "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tpos"))).alias("found"),
        F.min("pos").alias("first"), F.max("pos").alias("last"))


def merged(voted: DataFrame, keys: list[str], templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """For every diagonal the span that begins with it: (keys, template, label, n_grams,
    min_share, diagonal, place, first_word, last_word, share).  A span takes in the diagonals
    above its own by no more than it may stretch, so its k-grams stand in the text
    within that many words of their order and distance in the template."""
    known = voted.join(F.broadcast(template_table(voted.sparkSession, templates)), "template").where("not phrase")
    # `place` makes one stretch _UNIT long: the half keeps whole diagonals clear of its ends
    stretch = F.floor(F.col("n_words") * STRETCH) + MAX_GAP + 0.5
    placed = known.withColumn("place", F.col("diagonal") * F.floor(_UNIT / stretch))
    reach = Window.partitionBy(*keys, "template").orderBy("place").rangeBetween(0, _UNIT)
    return placed.select(
        *keys, "template", "label", "n_grams", "min_share", "diagonal", "place", F.min("first").over(reach).alias("first_word"),
        (F.max("last").over(reach) + F.col("k") - 1).alias("last_word"),
        (F.bit_count(F.bit_or("found").over(reach)) / F.col("n_grams")).alias("share"))


def spans(voted: DataFrame, keys: list[str], templates: tuple[Template, ...] = TEMPLATES,
          below: bool = False) -> DataFrame:
    """Verified spans: (keys, template, label, phrase, first_word, last_word, share); of spans that
    overlap by their diagonals the best.  `below` adds spans under their template's
    share, which prove nothing (label null)."""
    known = voted.join(F.broadcast(template_table(voted.sparkSession, templates)), "template")
    phrases = known.where("phrase and bit_count(found) = n_grams").select(
        *keys, "template", "label", "phrase", F.col("diagonal").alias("first_word"),
        (F.col("diagonal") + F.col("n_words") - 1).alias("last_word"), F.lit(1.0).alias("share"))
    near = Window.partitionBy(*keys, "template").orderBy("place").rangeBetween(-_UNIT, _UNIT)
    best = F.max(F.struct("share", -F.col("diagonal"))).over(near) == F.struct("share", -F.col("diagonal"))
    enough = F.col("share") >= F.col("min_share")
    found = merged(voted, keys, templates).withColumn("best", best).where("best")
    return phrases.unionByName((found if below else found.where(enough)).select(
        *keys, "template", F.when(enough, F.col("label")).alias("label"), F.lit(False).alias("phrase"),
        "first_word", "last_word", "share"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base (places of phrases), first_word and
    last_word (smallest and largest start of these, from 0; else null), base_labels
    (of phrases), labels (of all spans; both distinct, sorted, comma-joined, empty if
    none), score (greatest share of a template found, also below what its label takes;
    0 if none).

    A null text is empty.  Null and repeated ids keep their rows: results belong
    to an id and text, and equal rows get equal results.  Other columns are
    not read.  An empty table gives an empty table."""
    text = F.col(f"`{text_col}`")
    picked = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
                         F.coalesce(text, F.lit("")).alias("text"))
    keys = ["doc_id", "text_hash"]
    # written: phrases and merged spans both read the votes, the texts are cut up once
    found = spans(written(votes(picked, keys, templates), "license-votes"), keys, templates, below=True)
    per_doc = found.groupBy(*keys).agg(
        F.count(F.when(F.col("phrase"), 1)).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first_word"))).cast("long").alias("last_word"),
        # sets of labels: no larger than the list of templates
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    counted = picked.select(*keys, F.size(word_array(F.col("text"))).cast("long").alias("n_words")).alias("d")
    per_doc = per_doc.alias("f")
    both = counted.join(per_doc, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                        & (F.col("d.text_hash") == F.col("f.text_hash")), "left")
    return both.select("d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                       "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                       F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same result in DuckDB SQL, from the words themselves."""
    rows = ", ".join(f"({n}, '{t.label}', {str(t.phrase).lower()}, {t.k}, {t.n_grams}, {len(t.words)}, {t.min_share}, "
                     f"string_split('{' '.join(t.words)}', ' '))" for n, t in enumerate(templates))
    return f"""
WITH tpl(template, label, phrase, k, n_grams, n_words, min_share, words) AS (VALUES {rows}),
grams AS (SELECT template, i AS tpos, k, array_to_string(words[i + 1 : i + k], ' ') AS gram
          FROM tpl, unnest(range(n_grams)) AS r(i)),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(len(w))) AS pos FROM docs),
doc_grams AS (SELECT doc_id, pos, 2 AS k, w[pos + 1] || ' ' || w[pos + 2] AS gram FROM places WHERE pos + 2 <= len(w)
              UNION ALL
              SELECT doc_id, pos, 3, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] FROM places
              WHERE pos + 3 <= len(w)),
hits AS (SELECT DISTINCT doc_id, template, pos, tpos, pos - tpos AS diagonal FROM doc_grams JOIN grams USING (k, gram)),
base AS (SELECT doc_id, template, diagonal FROM hits JOIN tpl USING (template) WHERE phrase
         GROUP BY doc_id, template, diagonal, n_grams HAVING count(DISTINCT tpos) = n_grams),
lines AS (SELECT DISTINCT doc_id, template, diagonal FROM hits JOIN tpl USING (template) WHERE NOT phrase),
reached AS (SELECT l.doc_id, l.template, count(DISTINCT h.tpos) / n_grams AS share
            FROM lines l JOIN tpl USING (template) JOIN hits h ON h.doc_id = l.doc_id AND h.template = l.template
             AND h.diagonal BETWEEN l.diagonal AND l.diagonal + 2 + len(words) // 4
            GROUP BY l.doc_id, l.template, l.diagonal, n_grams),
merged AS (SELECT doc_id, CASE WHEN share >= min_share THEN label END AS label, share FROM reached JOIN tpl USING (template)),
found AS (SELECT doc_id, label, diagonal, 1.0::DOUBLE AS share FROM base JOIN tpl USING (template)
          UNION ALL SELECT doc_id, label, NULL, share FROM merged),
per_doc AS (SELECT doc_id, count(diagonal) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (diagonal IS NOT NULL) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN per_doc USING (doc_id)"""
