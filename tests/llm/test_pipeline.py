import corpus_pipeline as C
from llm_helpers import SF, SF_SMALL, empty, odd
from test_hilbert_packing import check
from test_quality_rules import plain_judge
from test_simhash_ball import plain_components, plain_fingerprint

from berthline.llm import quality_rules
from berthline.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_plain_python(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = sorted((r.doc_id, r.text, r.lang, r.source) for r in docs.collect())
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}

    ruled = written(C.quality_rules_stage(spark, docs, SF_SMALL), "test")
    assert ruled.columns == COLUMNS
    conf = quality_rules.Settings()
    _, failed, d2 = plain_judge(rows, conf)
    want = {r[0] for i, r in enumerate(rows) if not failed[i] and d2[i] <= conf.cutoff}
    assert {r.doc_id for r in ruled.collect()} == want

    # judged on all documents, where the rules have not yet taken the worst
    classed = written(C.quality_classifier_stage(spark, docs, SF_SMALL), "test")
    kept = {r.doc_id for r in classed.collect()}
    assert classed.columns == COLUMNS
    assert sum((i in kept) != (y == 1) for i, y in labels.items()) <= 0.03 * len(labels)
    classed = written(C.quality_classifier_stage(spark, ruled, SF_SMALL), "test")
    assert {r.doc_id for r in classed.collect()} == want & kept

    single = written(C.near_duplicates_stage(spark, classed, SF_SMALL), "test")
    assert single.columns == COLUMNS
    left = [r for r in rows if r[0] in want & kept]
    classes = plain_components([plain_fingerprint(r[1]) for r in left], 2)
    low = {}
    for r, c in zip(left, classes):
        low[c] = min(low.get(c, r[0]), r[0])
    assert {r.doc_id for r in single.collect()} == set(low.values())

    packed = C.packing_stage(spark, single, SF_SMALL).collect()
    check(packed, [(r[0], r[1]) for r in left if r[0] in set(low.values())])


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "packing"]
    got = C.run(spark, SF).collect()
    assert got and len({r.doc_id for r in got}) > 700


def test_odd_rows_and_empty_table(spark):
    df = odd(spark, extra=False)
    long = " ".join(f"term{i}" for i in range(90))
    more = spark.createDataFrame([(None, long, "en", "a", 1), (None, long, "en", "a", 1), (30, long + " x", None, None, None),
                                  (31, long, "en", "a", None)], df.schema)
    docs = df.unionByName(more)
    kept = C.quality_rules_stage(spark, docs, SF_SMALL)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["30", "31", "None", "None"]
    for _, stage in C.STAGES:
        assert stage(spark, empty(spark), SF_SMALL).collect() == []
        stage(spark, docs, SF_SMALL).collect()
