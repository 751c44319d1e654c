import uuid

import pytest
from pyspark.sql import functions as F

from berthline import schemas
from berthline.operators import gold, silver
from berthline.sources import bronze, testdata
from berthline.streaming import pipeline as sp
from berthline.streaming.progress import run_totals


def _sources(spark, landing):
    return {kind: bronze.read_bronze(spark, topic, fmt="parquet", path=landing) for kind, topic in sp.KINDS.items()}


@pytest.mark.parametrize("named", [True, False])
def test_medallion_streams_end_to_end(spark, tmp_path, named):
    """Kafka-shaped rows -> bronze -> silver -> gold -> published, by name and by folder."""
    database = f"streams_{uuid.uuid4().hex[:8]}" if named else None
    events = testdata.read_table(spark, "/root/testdata/sf0.001", "events")
    landing = str(tmp_path / "kafka")
    testdata.all_topics_bronze(events).write.parquet(landing)
    root = str(tmp_path / "tables")
    sp.await_all(sp.bronze_streams(spark, _sources(spark, landing), root, database=database))
    kept = spark.read.parquet(f"{root}/gate_in_events_bronze")
    assert kept.schema == schemas.KAFKA_ROW and kept.count() == testdata.gate_bronze(events, "in").count()
    sp.await_all(sp.silver_streams(spark, sp.bronze_sources(spark, root, database=database), root, database=database))
    batch_crane = silver.crane_silver(testdata.crane_bronze(events), processing_time=False)
    streamed = spark.read.table(f"{database}.crane_events_silver") if named else \
        spark.read.parquet(f"{root}/crane_events_silver")
    assert streamed.count() == batch_crane.count()

    metrics = sp.await_all(sp.gold_streams(spark, root, database=database, state_partitions=2), root)
    perf = sp.gold_table(spark, root, "gold_crane_performance").drop("gold_processed_at")
    want = gold.crane_performance(batch_crane, processing_time=False)
    assert sorted(map(tuple, perf.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # Flow rows already emitted are final (the unmatched tail waits for the watermark).
    ex = sp.gold_table(spark, root, sp.EXPORT)
    assert ex.where(F.col("crane_event_id").isNotNull()).count() > 0
    published = sp.publish_gold(spark, root, database=database)
    # every check of every table counts every row
    rows = {t: sp.gold_table(spark, root, t).count() for t in sp.CHECKS}
    rows[sp.DAILY] = sp.published(spark, root, sp.DAILY).count()
    assert set(metrics) == set(sp.CHECKS) and set(published) == set(rows)
    for counts in (metrics, published):
        for table, m in counts.items():
            checks = {k.rsplit("__", 1)[0] for k in m}
            assert checks and rows[table] > 0
            for c in checks:
                assert sum(m[f"{c}__{x}"] for x in ("passed", "failed", "null")) == rows[table], (table, m)
    for table in sp.CHECKS:
        assert sp.published(spark, root, table).count() == rows[table]
    if named:
        assert spark.read.table(f"{database}.gold_terminal_daily_summary").count() == rows[sp.DAILY]


def test_expectations_of_a_run_in_many_batches(spark, tmp_path):
    """One file a batch: counts are of all batches, not of the last."""
    events = testdata.read_table(spark, "/root/testdata/sf0.001", "events")
    landing, root = str(tmp_path / "kafka"), str(tmp_path / "tables")
    testdata.crane_bronze(events).repartition(5).write.parquet(landing)
    reader = spark.readStream.schema(schemas.KAFKA_ROW).option("maxFilesPerTrigger", 1)
    queries = sp.silver_streams(spark, {"crane": reader.parquet(landing)}, root)
    sp.await_all(queries)
    seen = run_totals(queries["crane_events_silver"])
    n = testdata.crane_bronze(events).count()
    assert seen["batches"] >= 5 and seen["rows"] == n
    assert spark.read.parquet(f"{root}/crane_events_silver").count() == n


def test_silver_dedupe_redeliveries(spark, tmp_path):
    events = testdata.read_table(spark, "/root/testdata/sf0.001", "events")
    landing = str(tmp_path / "kafka")
    b = testdata.gate_bronze(events, "in")
    b.unionByName(b).write.parquet(landing)            # every record delivered twice
    root = str(tmp_path / "tables")
    src = {"gate_in": bronze.read_bronze(spark, schemas.TOPIC_GATE_IN, fmt="parquet", path=landing)}
    sp.await_all(sp.silver_streams(spark, src, root, dedupe=True))
    out = spark.read.parquet(f"{root}/gate_in_events_silver")
    assert out.count() == b.count() == out.select("event_id").distinct().count()


def test_restart_from_checkpoint_writes_nothing_twice(spark, tmp_path):
    """Re-running from the same checkpoints (a restart) adds no rows."""
    from berthline.sources import sinks
    events = testdata.read_table(spark, "/root/testdata/sf0.001", "events")
    landing = str(tmp_path / "kafka")
    testdata.all_topics_bronze(events).write.parquet(landing)
    # raw landing sink
    raw = bronze.read_bronze(spark, list(bronze.ROUTES), fmt="parquet", path=landing)
    out, ck = str(tmp_path / "raw"), str(tmp_path / "raw_ck")
    sinks.land_raw_stream(raw, out, ck)
    first = spark.read.json(out).count()
    sinks.land_raw_stream(raw, out, ck)
    assert spark.read.json(out).count() == first == 1000
    # silver and gold streams
    root = str(tmp_path / "tables")
    src = {"crane": bronze.read_bronze(spark, schemas.TOPIC_CRANE, fmt="parquet", path=landing),
           "gate_in": bronze.read_bronze(spark, schemas.TOPIC_GATE_IN, fmt="parquet", path=landing),
           "gate_out": bronze.read_bronze(spark, schemas.TOPIC_GATE_OUT, fmt="parquet", path=landing)}
    for _ in range(2):
        sp.await_all(sp.silver_streams(spark, src, root))
        sp.await_all(sp.gold_streams(spark, root), root)
    assert spark.read.parquet(f"{root}/crane_events_silver").count() == \
        testdata.crane_bronze(events).count()
    ex = spark.read.parquet(f"{root}/gold_container_export_flow_streaming")
    assert ex.count() == ex.dropDuplicates(["gate_in_event_id", "crane_event_id"]).count()
