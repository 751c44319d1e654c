import numpy as np
from llm_helpers import ODD, SF, SF_SMALL, empty, odd
from pyspark.sql import functions as F

from berthline.llm import queries
from berthline.llm import quality_ranker as R
from berthline.llm.common import table



def every():
    return F.lit(True)


def auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()


def test_held_out_accuracy(spark):
    got = queries.REGISTRY["op3_quality_ranker"](spark, SF).join(table(spark, SF, "labels"), "doc_id").toPandas()
    for part in (got[got.held_out], got[~got.held_out]):
        assert auc(part.score.to_numpy(), part.quality.to_numpy()) > 0.99
        assert (part.predicted == part.quality).mean() > 0.97


def test_held_out_labels_do_not_matter(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    turned = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (sorted(map(tuple, R.rank(docs, x, learn).collect())) for x in (labels, turned))
    assert a == b


def test_pairwise_fit_orders_and_thresholds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    label = (x[:, 0] - 0.5 * x[:, 1] > -0.8).astype(int)
    counts = {0: int((label == 0).sum()), 1: int((label == 1).sum())}
    ranker = R.fit(x, label, counts)
    assert auc(ranker.worth(x), label) > 0.99
    assert abs((ranker.score(x) < 0.5).mean() - counts[0] / 400) < 0.01
    # the quantile follows the share over all labelled rows, not the sample's
    few = np.r_[np.flatnonzero(label == 0), np.flatnonzero(label == 1)[:counts[0]]]
    again = R.fit(x[few], label[few], counts)
    assert abs(again.threshold - ranker.threshold) < 0.5 * np.std(ranker.worth(x))


def test_threshold_covers_all_labelled_documents(spark):
    """However few rows the fit may use, the quantile is that of all labelled documents."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ranker = R.train(docs, labels, every(), max_rows=20)
    rows = docs.join(labels, "doc_id").select("text", "quality").collect()
    worth = ranker.worth(np.array([R.features(r.text) for r in rows]))
    share = sum(r.quality == 0 for r in rows) / len(rows)
    assert len(rows) > 20
    assert ranker.threshold == R.quantile_threshold(worth, np.ones(len(rows)), share)
    got = R.rank(docs.join(labels, "doc_id", "left_semi"), labels, every(), max_rows=20).collect()
    assert sum(r.predicted == 0 for r in got) == sum(r.quality == 0 for r in rows)


def test_distributed_threshold(spark):
    rng = np.random.default_rng(3)
    for worth in (rng.normal(size=500), np.r_[np.zeros(300), rng.normal(size=40) * 1e-9, 1e6], np.zeros(9), np.array([1., 2.])):
        df = spark.createDataFrame([(float(x),) for x in worth], "worth double")
        for share in (0.0, 0.3, 0.5, 1.0):
            assert R.distributed_threshold(df, share) == R.quantile_threshold(worth, np.ones(len(worth)), share)


def test_one_label_or_none(spark):
    docs = odd(spark)
    for rows, want in (([(4, 1)], 1), ([(4, 0)], 0), ([], 0)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        got = R.rank(docs, labels, every()).collect()
        assert len(got) == len(ODD) and {r.predicted for r in got} == {want}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (8, 0), (5, 1), (None, 1), (4, None), (99, 0)], "doc_id long, quality int")
    got = R.rank(odd(spark), labels, every()).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert R.rank(empty(spark), labels, every()).collect() == []
