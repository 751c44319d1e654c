import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from berthline.operators.asof import asof_latest

BASE = dt.datetime(2024, 1, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400)), max_size=12))
def test_asof_equals_brute_force(spark, left, right):
    """Latest right time at or before each left time, across day buckets."""
    lrows = [(i, k, BASE + dt.timedelta(hours=h)) for i, (k, h) in enumerate(left)]
    rrows = [(k, BASE + dt.timedelta(hours=h)) for k, h in right]
    ldf = spark.createDataFrame(lrows, "lid int, k string, lt timestamp")
    rdf = spark.createDataFrame(rrows, "k string, rt timestamp")
    out = asof_latest(ldf, rdf, key="k", left_ts="lt", right_ts="rt", values=[], prefix="")
    got = sorted((r.lid, r.rt) for r in out.collect())
    want = []
    for i, k, t in lrows:
        c = [rt for rk, rt in rrows if k is not None and rk == k and rt <= t]
        want.append((i, max(c) if c else None))
    assert got == sorted(want)
