"""Plan-shape checks and the driver contract, on sf0.001."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from berthline.plans import catalog
from oracle_check import check

SF = "/root/testdata/sf0.001"
STREAMING = {"stream_export_flow", "stream_import_flow", "stream_gate_traffic",
             "stream_crane_performance", "stream_anomaly_summary", "late_data_dropped",
             "raw_landing", "manifest_landing_counts", "clustered_export_flow"}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "yard_dwell_time_hours" in df.columns


def test_every_query_has_oracle():
    assert set(catalog.REGISTRY) <= set(E.oracle_sql()) and set(catalog.REGISTRY) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.REGISTRY) - STREAMING))
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(catalog.REGISTRY[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_filter_pushed_to_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = E.queries()["gold_anomaly_summary"](spark, SF)
    plan = _plan(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(anomali_type)]" in plan
    assert "ReadSchema: struct<crane_timestamp:timestamp,crane_id:string,terminal_id:string," \
           "cycle_time_sec:bigint,load_cell_kg:bigint,anomali_type:string>" in plan


def test_oracle_matches_small(spark):
    keys = sorted(set(catalog.REGISTRY) - STREAMING)
    res = check(spark, SF, keys, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "match"}
    assert not bad, bad


def _exchanges(spark, df) -> int:
    """Hash and range exchanges of the plan without adaptive changes or broadcasts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = _plan(df.select("*")).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return sum(" Exchange " in x and ("hashpartitioning" in x or "rangepartitioning" in x) for x in lines)


def test_shuffles_of_the_larger_plans(spark):
    limits = {"vessel_schedule": 2, "yard_log": 4, "yard_operation_counts": 0, "manifest_summary": 1}
    for name, most in limits.items():
        assert _exchanges(spark, catalog.REGISTRY[name](spark, SF)) <= most, name


def test_counts_without_a_join(spark):
    assert "Join" not in _plan(catalog.REGISTRY["yard_operation_counts"](spark, SF))


def test_chronological_order(spark):
    """Rows come in time order over partitions and within them."""
    df = catalog.REGISTRY["events_chronological"](spark, SF).select(
        "crane_timestamp", "event_id", F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = [(r.p, r.crane_timestamp, r.event_id) for r in df.collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len({p for p, *_ in rows}) > 1
    assert rows == sorted(rows)


def test_entry_works_without_the_optional_part():
    """Without the training-data subpackage and its pipeline the other queries stay."""
    import subprocess
    import sys
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'berthline.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'gold_export_flow' in e.queries() and 'pipeline' not in e.queries()\n"
            "assert not [q for q in e.queries() if q.startswith('op')] and set(e.oracle_sql()) == set(e.queries())\n")
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
