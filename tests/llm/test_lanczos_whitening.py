import math

import numpy as np
import pytest
from llm_helpers import SF_SMALL

from berthline.llm import lanczos_whitening as L
from berthline.llm import queries
from berthline.llm.common import table

VECTORS = "vec_id long, embedding array<float>"


def plain(rows):
    """rows: (vec_id, vector) -> n, x by id, eigenvalues, eigenvectors, of the covariance written out."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    centred = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / len(fit))
    return len(fit), x, e[::-1], u[:, ::-1], fit.mean(axis=0)


def test_query_against_the_covariance_written_out(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, x, e, u, mean = plain(rows)
    got = queries.REGISTRY["op13_lanczos_whitening"](spark, SF_SMALL).toPandas()
    assert len(got) == 16 * len(rows) and (got.n == n).all() and got.identity_error.max() < 1e-9
    sums = [sum(col) for col in zip(*set(map(tuple, x.values())))]
    by_id = {i: g.sort_values("component") for i, g in got.groupby("vec_id")}
    sign = None
    for i, v in x.items():
        g = by_id[i]
        assert set(g.deviation) == {sum((n * c - s) ** 2 for c, s in zip(v, sums))}
        want = (np.array(v) - mean) @ u[:, :16] / np.sqrt(e[:16])
        here = g.whitened.to_numpy()
        if sign is None:
            sign = np.sign(want * here)
        assert here * sign == pytest.approx(want, abs=1e-7)
    assert by_id[rows[0][0]].explained.to_numpy() == pytest.approx(e[:16] / e.sum(), rel=1e-9)


def matrix(x):
    return lambda w: ((x @ w) @ x, float((x @ w) @ (x @ w)))


def test_bidiagonalisation_of_many_spectra():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(400, 120)))[0]
    spectra = {"flat": np.ones(120), "twice": np.r_[5, 5, 5, np.linspace(4, 1, 17), np.full(100, .01)],
               "steep": np.logspace(0, -6, 120), "few": np.r_[np.linspace(3, 1, 5), np.zeros(115)]}
    turn = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    for name, s in spectra.items():
        x = q * s @ turn
        v, got = L.bidiagonalise(matrix(x), 120, 400, 16)
        want = s[s > 0][:16]
        assert got == pytest.approx(want, rel=1e-8), name
        assert np.abs(v.T @ v - np.eye(len(want))).max() < 1e-12 and np.abs(x.T @ (x @ v) - v * want ** 2).max() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.5, -2.0]), (None, [0.25, 7.0]), (4, None), (5, []),
            (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [3.0]), (10, [3.0, 1.0, 2.0]), (11, [3.0, 1.0, 9.0])]
    df = spark.createDataFrame(rows, VECTORS)
    for c in ("x", "dim", "n", "one", "component", "v"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    got = L.whiten(df).collect()
    ids = [r.vec_id for r in got]
    # two dimensions: three distinct vectors; one: a single vector varies along nothing; three: along one line
    assert sorted(i for i in ids if i is not None) == [1, 1, 1, 1, 2, 2, 3, 3, 10, 11] and ids.count(None) == 2
    assert {r.n for r in got if r.vec_id in (1, 2, 3, None)} == {3} and {r.n for r in got if r.vec_id in (10, 11)} == {2}
    plane = [r for r in got if r.n == 3]
    assert sum({(r.component): r.explained for r in plane}.values()) == pytest.approx(1) and plane[0].identity_error < 1e-9
    assert sorted(round(abs(r.whitened), 9) for r in got if r.n == 2) == [1.0, 1.0]
    assert L.whiten(spark.createDataFrame([], VECTORS)).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [3e7]), (2, [-3e7]), (3, [0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in L.whiten(df).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None
