import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from berthline.operators import flows
from berthline.operators.interval_join import interval_join
from helpers import silver_rows

G = "2024-01-01T10:00:00"


def _gate(spark, rows):
    return silver_rows(spark, "gate_in", [dict(container_number=f"C{r[0]}", **{
        "event_id": r[2], "container_id": r[0], "gate_in_timestamp": r[1], "terminal_id": "T"})
        for r in rows])


def _crane(spark, rows):
    return silver_rows(spark, "crane", [{"event_id": r[2], "container_id": r[0],
                                         "crane_timestamp": r[1], "crane_operation": r[3],
                                         "cycle_time_sec": 100} for r in rows])


def test_export_flow_edges(spark):
    gate = _gate(spark, [("A", G, "g1"), ("B", G, "g2"), ("C", G, "g3"), ("D", G, "g4"),
                         (None, G, "g5"), ("F", None, "g6")])
    crane = _crane(spark, [
        ("A", G, "c1", "LOAD"),                              # at gate-in exactly
        ("B", "2024-01-02T10:00:00", "c2", "LOAD"),           # +24 h exactly
        ("C", "2024-01-02T10:00:00.000001", "c3", "LOAD"),    # +24 h 1 us: no match
        ("C", "2024-01-01T09:59:59", "c4", "LOAD"),           # before gate-in: no match
        ("D", "2024-01-01T11:00:00", "c5", "LOAD"),           # two matches fan out
        ("D", "2024-01-01T12:00:00", "c6", "DISCHARGE"),
        (None, G, "c7", "LOAD"),
    ])
    out = {(r.gate_in_event_id, r.crane_event_id): r for r in
           flows.export_flow(gate, crane, processing_time=False).collect()}
    assert set(out) == {("g1", "c1"), ("g2", "c2"), ("g3", None), ("g4", "c5"), ("g4", "c6"),
                        ("g5", None), ("g6", None)}
    assert out[("g1", "c1")].yard_dwell_time_hours == 0.0
    assert out[("g2", "c2")].yard_dwell_time_hours == 24.0
    assert out[("g2", "c2")].dwell_time_category == "DELAYED"
    assert out[("g3", None)].container_status == "IN_YARD"
    assert out[("g3", None)].dwell_time_category == "CRITICAL"
    assert out[("g6", None)].container_status == "UNKNOWN"
    assert out[("g4", "c5")].container_status == "LOADED_TO_VESSEL"
    only_load = flows.export_flow(gate, crane, operation="LOAD", processing_time=False)
    assert only_load.where(F.col("gate_in_event_id") == "g4").count() == 1


def test_import_flow_direction(spark):
    gate = silver_rows(spark, "gate_out", [
        {"event_id": "o1", "container_id": "A", "gate_out_timestamp": "2024-01-02T09:00:00"},
        {"event_id": "o2", "container_id": "B", "gate_out_timestamp": "2024-01-01T09:00:00"}])
    crane = _crane(spark, [("A", G, "c1", "DISCHARGE"), ("B", G, "c2", "DISCHARGE")])
    out = {r.gate_out_event_id: r for r in flows.import_flow(gate, crane, processing_time=False).collect()}
    assert out["o1"].crane_event_id == "c1" and out["o1"].yard_dwell_time_hours == 23.0
    assert out["o1"].container_status == "DISCHARGE_FROM_VESSEL"
    assert out["o2"].crane_event_id is None and out["o2"].container_status == "IN_YARD"


BASE = dt.datetime(2024, 1, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 200)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 200)), max_size=12),
       st.integers(-30, 30), st.integers(0, 60), st.sampled_from([None, 7, 25]))
def test_interval_join_equals_brute_force(spark, left, right, lo, width, bucket):
    """Property: the bucketed join equals a nested-loop left join."""
    hi = lo + width
    lrows = [(i, k, BASE + dt.timedelta(hours=h)) for i, (k, h) in enumerate(left)]
    rrows = [(i, k, BASE + dt.timedelta(hours=h)) for i, (k, h) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "lid int, k string, lt timestamp")
    rdf = spark.createDataFrame(rrows, "rid int, k string, rt timestamp")
    j = interval_join(ldf, rdf, keys=["k"], left_ts="lt", right_ts="rt",
                      lower_seconds=lo * 3600, upper_seconds=hi * 3600,
                      bucket_seconds=None if bucket is None else bucket * 3600)
    got = sorted((r[0], r[1]) for r in j.select("l.lid", "r.rid").collect())
    want = []
    for li, lk, lt in lrows:
        m = [ri for ri, rk, rt in rrows if lk is not None and lk == rk
             and lt + dt.timedelta(hours=lo) <= rt <= lt + dt.timedelta(hours=hi)]
        want += [(li, ri) for ri in m] or [(li, None)]
    assert got == sorted(want, key=lambda x: (x[0], -1 if x[1] is None else x[1]))


def test_every_gate_row_kept(spark):
    random.seed(7)
    gate = _gate(spark, [(str(random.randint(0, 5)), f"2024-01-0{random.randint(1, 3)}T0{random.randint(0, 9)}:00:00",
                          f"g{i}") for i in range(40)])
    crane = _crane(spark, [(str(random.randint(0, 5)), f"2024-01-0{random.randint(1, 3)}T0{random.randint(0, 9)}:00:00",
                            f"c{i}", "LOAD") for i in range(40)])
    out = flows.export_flow(gate, crane, processing_time=False)
    assert out.select("gate_in_event_id").distinct().count() == 40


def test_a_stream_keeps_two_copies_of_a_crane_row(spark, tmp_path):
    """Buckets of a stream are as wide as the interval: state holds each right row twice."""
    from berthline.operators.interval_join import interval_join
    t = spark.sql("SELECT 'c' AS k, timestamp'2024-01-01 05:00:00' AS t")
    t.write.parquet(str(tmp_path / "t"))
    left = spark.readStream.schema(t.schema).parquet(str(tmp_path / "t")).withWatermark("t", "2 hours")
    right = left.select("k", F.col("t").alias("u"))
    got = interval_join(left, right, keys=["k"], left_ts="t", right_ts="u", lower_seconds=0, upper_seconds=24 * 3600)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert str(24 * 3600 * 1_000_000) in plan and str(3 * 3600 * 1_000_000) not in plan
