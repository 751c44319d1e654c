import hashlib
import math

import pytest
from llm_helpers import SF_SMALL, empty, odd, words

from berthline.llm import pareto_mix as M
from berthline.llm import queries
from berthline.llm.common import table


def plain_targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    """sizes: source -> words.  The excess is reshared until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * percent / 100, set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > most * sizes[s]]
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= set(full)
        if not full:
            out.update({s: share * weight[s] for s in open_})
            break
    return out


def plain_mix(rows, seed=11, most=2):
    """rows: (doc_id, text, source) -> taken words of each, document by document."""
    size = [len(words(t)) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, size):
        total[s] = total.get(s, 0) + n
    target, taken = plain_targets(total), [0] * len(rows)
    low = low_of
    for s in total:
        own = [i for i in range(len(rows)) if rows[i][2] == s and size[i]]
        factor, capped = None, 0
        for g in sorted({low(size[i]) for i in own}, reverse=True):    # largest classes stop first
            below = [i for i in own if low(size[i]) <= g]
            c = (target[s] - most * sum(size[i] for i in own if low(size[i]) > g)) / sum(
                math.sqrt(low(size[i])) * size[i] for i in below)
            if c * math.sqrt(g) <= most:
                factor = c
                break
        copies = {i: most if factor is None else min(most, factor * math.sqrt(low(size[i]))) for i in own}
        rest = target[s] - sum(math.floor(copies[i]) * size[i] for i in own)
        line = []
        for i in own:
            taken[i] = math.floor(copies[i]) * size[i]
            p = copies[i] - math.floor(copies[i])
            doc_id, text, _ = rows[i]
            digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
            u = (int(digest[:13], 16) + 0.5) / 2 ** 52
            if p > 0:
                line.append((math.log(u / (1 - u)) - math.log(p / (1 - p)), i))
        line.sort()
        for at, (_, i) in enumerate(line):
            if size[i] >= rest:
                gap, _, i = min((abs(size[i] - rest), r, i) for r, i in line[at:])
                if gap < rest:
                    taken[i] += size[i]
                break
            taken[i] += size[i]
            rest -= size[i]
    return size, total, target, taken


def test_query_by_putting_every_document_in_line(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SF_SMALL, "documents").collect()]
    size, total, target, taken = plain_mix(rows)
    got = {r.doc_id: r for r in queries.REGISTRY["op11_pareto_mix"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for (doc_id, _, source), n, t in zip(rows, size, taken):
        r = got[doc_id]
        assert (r["size"], r.source_size, r.taken) == (n, total[source], t) and r.taken <= 2 * n
        assert r.target == pytest.approx(target[source], rel=1e-12)
    assert abs(sum(taken) - 1.5 * sum(size)) < 0.02 * sum(size)


def test_targets_reshare_the_excess(spark):
    sizes = {"b": 10, "a": 1000, "B": 300, None: 40, "ü": 500}
    rows = spark.createDataFrame([(s, M_key(s), n) for s, n in sizes.items()], "source string, key string, size long")
    got = {r.key: r.target for r in M.targets(rows, (5, 2, 1), 150, 2).collect()}
    want = plain_targets(sizes)
    assert got == {M_key(s): pytest.approx(t) for s, t in want.items()}
    assert want["b"] == 20 and sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def M_key(source):
    return "" if source is None else "=" + source


def test_inclusion_follows_the_probabilities(spark):
    """Documents of a size are drawn about as often as their inclusion probability says."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', int(20 + id % 60)) AS text", "'s' AS source")
    drawn = [0] * 60
    for r in M.mix(docs, (1,), 50, 1).collect():
        drawn[r.doc_id % 60] += r.copies
    g = [math.sqrt(low_of(20 + i)) for i in range(60)]
    factor = sum(20 + i for i in range(60)) / 2 / sum(x * (20 + i) for i, x in enumerate(g))
    for part in (range(0, 20), range(20, 40), range(40, 60)):
        assert sum(drawn[i] for i in part) == pytest.approx(sum(100 * factor * g[i] for i in part), rel=0.08)


def low_of(n):
    """Smallest size of n's class, a quarter of an octave."""
    octave = n.bit_length() - 1
    return (1 << octave) * ((4 * n) >> octave) / 4


def test_other_partitions_and_reruns_agree(spark):
    docs = table(spark, SF_SMALL, "documents")
    first = M.mix(docs).orderBy("doc_id").collect()
    assert first == M.mix(docs.repartition(7)).orderBy("doc_id").collect()


def test_odd_rows(spark):
    got = M.mix(odd(spark)).collect()
    assert len(got) == 12
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    # of the three rows of id 6, two are equal
    six = sorted(r.taken for r in got if r.doc_id == 6)
    assert len(six) == 3 and six[1] in (six[0], six[2]) and sum(r["size"] == 0 for r in got) == 3
    assert M.mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in M.mix(blank).collect()] == [(0, 0.0, 0)] * 2
