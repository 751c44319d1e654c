import duckdb
from llm_helpers import ODD, SF, empty, odd

from berthline.llm import license_scan as L
from berthline.llm.common import table

MIT = next(t for t in L.TEMPLATES if t.name == "mit text").text


def scan(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in L.scan(df).collect()}


def test_against_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(L.oracle_sql())
    names = [d[0] for d in cur.description]
    got = [tuple(r[n] for n in names) for r in L.scan(table(spark, SF, "documents")).collect()]
    assert sorted(got) == sorted(cur.fetchall())
    assert sum(r[names.index("n_base")] for r in got) > 10


def test_phrases_and_places(spark):
    got = scan(spark, "The MIT-License. mit  license; MIT x License", "General\nPublic License general public",
               "mitlicense Apache2 license", "ÉMIT license K", None)
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (2, 1, 3, "mit")
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (1, 0, 0, "gpl")
    assert got[2].n_base == 0 and got[2].first_word is None and got[2].labels == ""
    assert got[3].n_base == 0 and got[3].n_words == 3
    assert (got[4].n_words, got[4].n_base, got[4].labels, got[4].score) == (0, 0, "", 0.0)


def test_long_text_with_words_put_in_and_left_out(spark):
    w = MIT.split()
    changed = " ".join(["intro", *w[:20], "quite", *w[20:40], *w[41:], "outro"])
    scattered = " ".join(x for i in range(0, len(w) - 3, 3) for x in (*w[i:i + 3], *["filler"] * 12))
    got = scan(spark, changed, " ".join(w[:10]), scattered, "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0")
    assert got[0].labels == "mit" and 0.6 <= got[0].score < 1 and got[0].n_base == 0
    assert got[1].labels == "" and got[2].labels == ""
    assert got[3].labels == "cc-by-nc-4.0" and got[4].labels == "cc-by-sa-4.0"


def test_odd_rows(spark):
    got = L.scan(odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ODD)
    seven = next(r for r in got if r.doc_id == 7)
    assert (seven.n_words, seven.n_base, seven.first_word) == (6, 1, 4)
    assert len(set(r for r in got if r.doc_id == 6 and r.n_words == 5)) == 1


def test_hot_passage_in_every_row(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "'released under the mit license ' AS text").union(
        spark.sql("SELECT 1000L, repeat('mit license ', 4000)"))
    got = {r.doc_id: r.n_base for r in L.scan(df).collect()}
    assert got[1000] == 4000 and all(got[i] == 1 for i in range(500))


def test_empty_table(spark):
    assert L.scan(empty(spark)).collect() == []


def test_words_put_in_or_left_out_anywhere(spark):
    """Up to ten words more or fewer at any one place keep the licence; the score says how much stands."""
    for template in (t for t in L.TEMPLATES if len(t.words) >= 30):
        n = len(template.words)
        rows = []
        for at in range(0, n + 1):
            rows += [(f"in {at} {k}", " ".join(["x"] * 7 + template.words[:at] + ["new"] * k + template.words[at:] + ["y"]))
                     for k in (1, 3, 9)]
            rows += [(f"out {at} {k}", " ".join(["x"] * 7 + template.words[:at] + template.words[at + k:] + ["y"])) for k in (1, 3)]
        docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
        for r in L.scan(docs).collect():
            assert template.label in r.labels.split(","), (template.name, rows[r.doc_id][0])
            assert r.score >= (len(template.words) - 2 - 2 - 3) / template.n_grams - 1e-9


def test_score_below_the_bar(spark):
    words = next(t for t in L.TEMPLATES if t.name == "mit text").words
    docs = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[:20] + ["z"] * 40 + words[20:40])),
                                  (3, " ".join(reversed(words)))], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    # 18 of 47 three-word runs; far apart pieces are not added up
    assert got[1].score == got[2].score == 18 / 47 and got[1].labels == got[2].labels == "" and got[3].score < 0.1
