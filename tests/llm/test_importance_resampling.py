import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from llm_helpers import SF_SMALL, empty, odd

from berthline.llm import importance_resampling as R
from berthline.llm import queries
from berthline.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_buckets(text, runs=2, buckets=10000):
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def plain_resample(docs, target, percent=25):
    """docs: (doc_id, text) -> doc_id -> (n_features, weight, score, rank), by sorting all."""
    corpus, wanted = Counter(), Counter()
    for _, t in docs:
        corpus.update(plain_buckets(t))
    for t in target:
        wanted.update(plain_buckets(t))
    S, T = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (S + 10000) / ((corpus[b] + 1) * (T + 10000)))) for b in range(10000)]
    out, able = {}, []
    for doc_id, t in docs:
        at = plain_buckets(t)
        weight = sum(gain[b] for b in at) // len(at) if at else 0
        h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [len(at), weight, score, None]
        if len(plain_words(t)) >= 20:
            able.append((-score, doc_id))
    for rank, (_, doc_id) in enumerate(sorted(able)[:percent * len(able) // 100], 1):
        out[doc_id][3] = rank
    return out


def test_query_by_sorting_all(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    want = plain_resample(docs, [r.text for r in table(spark, SF_SMALL, "benchmark").collect()])
    got = queries.REGISTRY["op12_importance_resampling"](spark, SF_SMALL).collect()
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == want and len(got) == len(docs)
    assert sum(r["rank"] is not None for r in got) > 20


def test_features_of_parts(monkeypatch):
    texts = [None, "", " .,", "One", "One two", "É字 two  three\n\x80x a-b C3 " * 40, "w" * 300 + " end", "a b c a b c"]
    for cut in (1, 7, 1 << 20):
        monkeypatch.setattr(R, "_CUT", cut)
        for runs in (1, 2, 3):
            for text in texts:
                got = list(R.features(text, R._Words(), runs=runs))
                assert sorted(b for _, at in got for b in at) == sorted(plain_buckets(text, runs)), (text, cut, runs)
                assert sum(n for n, _ in got) == len(plain_words(text))


def test_weighted_median():
    assert R.weighted_median(np.array([5, 1, 9]), np.array([1, 1, 1])) == 5
    assert R.weighted_median(np.array([5, 1, 9]), np.array([1, 1, 10])) == 9
    assert R.weighted_median(np.array([5, 1]), np.array([1, 1])) == 1


def test_cutoff_by_sorting(spark):
    rng = random.Random(3)
    for keys in ([rng.randrange(-10 ** 12, 10 ** 12) for _ in range(3000)], [rng.randrange(4) for _ in range(500)] + [9] * 300):
        df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
        for wanted in (1, len(keys) // 4, len(keys)):
            assert R.cutoff(df, wanted) == sorted(keys)[wanted - 1]
        assert R.cutoff(df, 0) is None and R.cutoff(df, len(keys) + 1) is None


def test_ties_and_repeated_rows(spark):
    """Equal rows: as many as fit are drawn, with ranks of their own."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 10 + [(None, text)] * 6 + [(2, text + " more")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = R.resample(docs, docs.limit(0), percent=60).collect()
    assert len(got) == 20 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 13))
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in drawn] == sorted((r.score for r in got), reverse=True)[:12]


def test_odd_rows(spark):
    docs = odd(spark)
    got = R.resample(docs, odd(spark)).collect()
    assert len(got) == 12 and sum(r.n_features == 0 and r.weight == 0 for r in got) == 3
    assert R.resample(empty(spark), docs).count() == 0
    assert all(r["rank"] is None for r in R.resample(docs.where("doc_id = 4"), docs).collect())
