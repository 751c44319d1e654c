import math
from collections import Counter

import numpy as np
import pytest
from llm_helpers import ODD, SF, empty, odd, words

from berthline.llm import quality_rules as Q
from berthline.llm.common import table


def plain_counts(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
            len(lines) - len(set(lines)), len(covered))


def plain_judge(rows, conf):
    """rows: (id, text, lang, source) -> {row: (base_failed, distance2)} with numpy."""
    counts = [plain_counts(r[1]) for r in rows]
    failed = [c[0] < conf.min_words or 100 * c[5] > conf.max_repeat_percent * c[0] for c in counts]
    x = np.array([[math.log1p(n), math.log(max(ch, 1) / max(n, 1)) if n else 0, (s / max(ch, 1)) ** .5,
                   (dl / max(nl, 1)) ** .5, (r / max(n, 1)) ** .5] for n, ch, s, nl, dl, r in counts])
    keys = [(r[2], r[3]) for r in rows]
    size = Counter(k for k, f in zip(keys, failed) if not f)
    pooled = Counter()
    for k, n in size.items():
        if n < conf.min_group:
            pooled[k[0]] += n
    group = [k if size[k] >= conf.min_group else (k[0], "*") if pooled[k[0]] >= conf.min_group else "*" for k in keys]
    floors = np.diag(np.array(list(Q.FLOORS.values())) ** 2)
    d2 = lambda z, m, c: np.einsum("ni,ij,nj->n", z - m, np.linalg.inv(c + floors), z - m)
    out = {}
    for g in set(group):
        at = [i for i in range(len(rows)) if group[i] == g and not failed[i]]
        if not at:
            continue
        z = x[at]
        n = len(z)
        s = np.sort(z, axis=0)
        q = [s[max(0, math.ceil(p * n) - 1)] for p in (.25, .5, .75)]
        scale = np.maximum((q[2] - q[0]) / 1.349, np.array(list(Q.FLOORS.values())))
        t = np.tanh((z - q[1]) / scale)
        cov = np.cov(t.T, bias=True).reshape(5, 5)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        corr = .95 * cov / np.outer(sd, sd)
        np.fill_diagonal(corr, 1)
        best = None
        for c in (np.diag(scale ** 2), corr * np.outer(scale, scale)):
            m = q[1]
            for _ in range(conf.steps):
                b = np.floor(np.log(d2(z, m, c) + 1e-12) * conf.bins_per_e)
                limit = np.sort(b)[math.ceil(n * conf.share) - 1]
                inner = z[b <= limit]
                m, c = inner.mean(axis=0), np.cov(inner.T, bias=True).reshape(5, 5) * Q.consistency(conf.share)
            det = np.linalg.slogdet(c + floors)[1]
            if best is None or det < best[0] - 1e-9:
                best = (det, m, c)
        inner = z[d2(z, best[1], best[2]) <= Q.chi2_quantile(conf.reweight, 5)]
        m, c = inner.mean(axis=0), np.cov(inner.T, bias=True).reshape(5, 5) * Q.consistency(conf.reweight)
        out.update(zip(at, d2(z, m, c)))
    return counts, failed, out


def test_chi_square_functions():
    assert Q.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert Q.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)


def test_against_numpy_on_a_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    conf = Q.Settings(min_group=20)
    counts, failed, d2 = plain_judge(rows, conf)
    got = {r.doc_id: r for r in Q.judge(docs, conf).collect()}
    assert len(got) == len(rows)
    for i, (row, c) in enumerate(zip(rows, counts)):
        r = got[row[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (c[0], c[1], c[2], c[4], c[5])
        assert r.base_failed == failed[i]
        assert (r.distance2 is None) == failed[i]
        if not failed[i]:
            assert r.distance2 == pytest.approx(d2[i], rel=1e-6, abs=1e-9)
            assert r.kept == (r.distance2 <= conf.cutoff)
        else:
            assert not r.kept


def test_labels_agree(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    for r in Q.judge(table(spark, SF, "documents")).collect():
        if not r.base_failed and r.doc_id in labels:
            assert r.kept == (labels[r.doc_id] == 1)


def test_odd_rows(spark):
    got = Q.judge(odd(spark)).collect()
    assert sorted(((r.doc_id, r.n_words) for r in got), key=str) == sorted(
        ((r[0], len(words(r[1]))) for r in ODD), key=str)
    assert all(r.base_failed and not r.kept for r in got)


def test_copies_and_constant_groups(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    junk = " ".join(f"%%w{i}&&" for i in range(80))
    rows = [(i, clean, "en", "hot", 0) for i in range(90)] + [(100 + i, junk, "en", "hot", 0) for i in range(10)] + [
        (200, clean + " more words", None, None, 0)]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, "
                                                                         "source string, n int")).collect()}
    assert all(got[i] for i in range(90)) and not any(got[100 + i] for i in range(10)) and got[200]


def without_repeated_triples(letters):
    out, seen = [letters[0]] * 2, set()
    while True:
        after = [c for c in reversed(letters) if (*out[-2:], c) not in seen]
        if not after:
            return out
        seen.add((*out[-2:], after[0]))
        out.append(after[0])


@pytest.mark.parametrize("name, outlier", [
    ("ln_words", " ".join(f"v{i:04d}" for i in range(8000))),
    ("ln_word_length", " ".join(f"v{i:04d}" * 4 for i in range(120))),
    ("root_symbols", " ".join(f"#{i:04d}" for i in range(120))),
    # five lines in an order without a repeated window of three
    ("root_dup_lines", "\n".join(without_repeated_triples("abcde"))),
    ("root_repeats", " ".join([f"v{i:04d}" for i in range(61)] + [f"u{i:04d}" for i in range(29)] * 2)),
])
def test_each_statistic_alone_rejects(spark, name, outlier):
    """The bound of any estimate: a group that agrees in all statistics, so only floors count."""
    plain = [" ".join(f"{chr(97 + i % 26)}{j:04d}" for j in range(120 + i % 3)) for i in range(90)]
    if name == "root_dup_lines":
        plain = ["\n".join(chr(200 + j) for j in range(124 + i % 3)) for i in range(90)]
    rows = [(i, t, "en", "a") for i, t in enumerate([*plain, outlier])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.judge(docs).collect()}
    assert all(got[i].kept for i in range(90))
    assert not got[90].base_failed and not got[90].kept
    # and it is this statistic that rejects: at the floor it reaches beyond the cutoff by itself
    x = dict(zip(Q.STATS, Q.base_counts(docs).where("doc_id = 90").select(*Q._statistics()).first()))
    y = dict(zip(Q.STATS, Q.base_counts(docs).where("doc_id = 1").select(*Q._statistics()).first()))
    far = {s: ((x[s] - y[s]) / Q.FLOORS[s]) ** 2 for s in Q.STATS}
    assert far[name] > Q.Settings().cutoff > 3 * sum(far[s] for s in Q.STATS if s != name)


def test_repeated_lines_and_words_reject_together(spark):
    """Every line repeated and 45 % of the words: nothing else in the source repeats anything."""
    plain = ["\n".join(f"a{j} b{j} c{j} d{j}" for j in range(30 + i % 5)) for i in range(90)]
    half = [f"a{j} b{j}" for j in range(33)]
    outlier = "\n".join(half * 2) + "\n" + " ".join(f"p{j}" for j in range(20))
    rows = [(i, t, "en", "a") for i, t in enumerate([*plain, outlier])]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(90)) and not got[90]


def test_empty_table(spark):
    assert Q.judge(empty(spark)).collect() == []
