import numpy as np
from llm_helpers import empty
from pyspark.sql import functions as F

from berthline.llm import hnsw as H
from berthline.llm import queries
from berthline.llm.common import table

VEC = "vec_id long, embedding array<float>"


def plain(ids, x, queries, k):
    out = {}
    for i in queries:
        q = x[ids == i][0]
        score = (x * q).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), score[j]) for j in order]
    return out


def got_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    for rows in out.values():
        assert sorted(rows) == list(range(1, len(rows) + 1))
    return {q: [rows[i] for i in sorted(rows)] for q, rows in out.items()}


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    vectors = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], float)
    want = plain(ids, x, ids[ids % 20 == 0], 20)
    got = got_of(queries.REGISTRY["op10_hnsw"](spark, sf))
    assert got.keys() == want.keys()
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    place = {int(i): v for i, v in zip(ids, x)}
    for q, rows in got.items():
        assert len(rows) == 20
        for (a, s), (b, t) in zip(rows, rows[1:]):
            assert s > t or s == t and a < b
        assert all(abs((place[q] * place[a]).sum() - s) < 1e-12 for a, s in rows)


def test_several_shards_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6))
    x[100:260] = x[100]                         # a large group of copies
    x[300:] *= rng.uniform(0.1, 5, (100, 1))    # not of one length
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    x = np.array([r[1] for r in rows])
    want = plain(np.arange(400), x, range(0, 400, 20), 20)
    got = got_of(H.nearest(spark.createDataFrame(rows, VEC), F.col("vec_id") % 20 == 0, 20, H.Settings(shard_rows=90)))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.95 * 20 * len(want)
    assert [a for a, _ in got[120]] == [a for a, _ in want[120]]


def test_few_rows_give_all(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (5, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [-1.0, 0.0])]
    got = got_of(H.nearest(spark.createDataFrame(rows, VEC), F.col("vec_id") % 20 == 0))
    assert got == {0: [(5, 1.0), (6, 1.0), (20, 0.0), (7, -1.0)], 20: [(5, 1.0), (6, 1.0), (0, 0.0), (7, 0.0)]}
    assert got_of(H.nearest(spark.createDataFrame([(0, [1.0])], VEC))) == {}


def test_graphs_of_any_size():
    """From one node (also alone on a layer) on, every node is found."""
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 17, 65, 200):
        for start in range(0, 40, 8):
            x = rng.normal(size=(n, 4))
            graph = H.Graph.build(np.arange(start, start + n), x, H.Settings())
            found = graph.search(x, 40)
            best = [graph.best(q, -1, nodes, 1)[0][0] - start for q, nodes in zip(x, found)]
            assert (np.array(best) == (x @ x.T).argmax(axis=1)).mean() > 0.95


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], "c"), (1, None, "c"), (2, [], "c"), (3, [0.0, -0.0], "c"), (4, [nan, 1.0], "c"),
            (5, [1.0, None], "c"), (6, [inf, 1.0], "c"), (None, [1.0, 1.0], "c"), (8, [1.0, 1.0, 1.0], "c"),
            (9, [2.0, 1.0], "c"), (20, [1.0, 2.0], "c"), (20, [1.0, 2.0], "c"), (40, [3.0, 3.0, 3.0], "c")]
    df = spark.createDataFrame(rows, VEC + ", shard string").withColumns({c: F.lit(1) for c in ("dim", "v", "score", "rank")})
    got = got_of(H.nearest(df, F.col("vec_id") % 20 == 0))
    assert got == {0: [(20, 5.0), (20, 5.0), (9, 4.0)], 20: [(0, 5.0), (9, 4.0)], 40: [(8, 9.0)]}
    assert H.nearest(empty(spark, VEC)).collect() == []


def test_bytes_hold_the_graph():
    x = np.random.default_rng(1).normal(size=(300, 8))
    graph = H.Graph.build(np.arange(300), x, H.Settings())
    again = H.Graph.from_bytes(b"".join(graph.to_bytes()))
    assert (graph.search(x[:20], 40) == again.search(x[:20], 40)).all()
    other = np.random.default_rng(0).permutation(300)
    assert b"".join(H.Graph.build(other, x[other], H.Settings()).to_bytes()) == b"".join(graph.to_bytes())
