import os

from pyspark.sql import functions as F

from berthline import schemas
from berthline.sources import bronze, sinks, testdata


def _events(spark):
    return testdata.read_table(spark, "/root/testdata/sf0.001", "events")


def test_route_and_branch(spark):
    b = testdata.all_topics_bronze(_events(spark))
    routed = bronze.route(b, bronze.ROUTES)
    got = {r.topic: r.target_table for r in routed.select("topic", "target_table").distinct().collect()}
    assert got == {"crane_events": "crane_events_bronze", "gate_in_events": "gate_in_events_bronze",
                   "gate_out_events": "gate_out_events_bronze"}
    assert bronze.branch(b, "crane_events").count() == testdata.crane_bronze(_events(spark)).count()


def test_read_bronze_replay_from_files(spark, tmp_path):
    path = str(tmp_path / "kafka")
    testdata.all_topics_bronze(_events(spark)).write.parquet(path)
    df = bronze.read_bronze(spark, ["gate_in_events", "gate_out_events"], fmt="parquet",
                            path=path, streaming=False)
    assert df.schema == schemas.KAFKA_ROW
    assert {r.topic for r in df.select("topic").distinct().collect()} == \
        {"gate_in_events", "gate_out_events"}


def test_write_clustered_sorted_files(spark, tmp_path):
    df = spark.range(0, 1000).select((F.col("id") % 7).cast("string").alias("k"), "id")
    path = str(tmp_path / "c")
    sinks.write_clustered(df, path, ["k", "id"], partitions=3)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    # each file holds a contiguous key range
    ranges = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"),
                                                              F.max("k").alias("hi")).collect()
    ranges = sorted((r.lo, r.hi) for r in ranges)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_dated_landing_layout(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-02", "import"), ("b", "2024-01-02", "export"),
                                ("c", "2025-12-31", "import")], "id string, d string, label string") \
        .withColumn("d", F.to_date("d"))
    path = str(tmp_path / "landing")
    sinks.land_dated_json(df, path, "d", "label")
    assert os.path.isdir(os.path.join(path, "year=2024", "month=01", "day=02", "label=import"))
    assert os.path.isdir(os.path.join(path, "year=2025", "month=12", "day=31", "label=import"))
    assert spark.read.json(path).count() == 3


def test_materialize_pipeline(spark, tmp_path, monkeypatch):
    from berthline.plans import pipeline
    p = pipeline.from_testdata(spark, "/root/testdata/sf0.001", processing_time=True)
    plans = {}
    write = pipeline.sinks.clustered
    monkeypatch.setattr(pipeline.sinks, "clustered", lambda df, keys: plans.setdefault(
        tuple(keys) + (len(plans),), df) and write(df, keys))
    metrics = pipeline.materialize(p, str(tmp_path / "tables"), register=True)
    # gold reads written silver: nothing is parsed again
    assert len(plans) == 6
    for df in plans.values():
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert spark.read.table("gold_crane_performance").count() > 0
    assert spark.read.table("crane_events_bronze").schema == schemas.KAFKA_ROW
    assert set(metrics) == {"gold_container_export_flow_streaming",
                            "gold_container_import_flow_streaming", "gold_crane_performance",
                            "gold_anomaly_summary", "gold_terminal_daily_summary",
                            "gold_gate_hourly_traffic"}
    for table, m in metrics.items():
        n = spark.read.parquet(str(tmp_path / "tables" / table)).count()
        for check in {k.rsplit("__", 1)[0] for k in m}:
            assert n and sum(m[f"{check}__{x}"] for x in ("passed", "failed", "null")) == n
    daily = spark.read.parquet(str(tmp_path / "tables" / "gold_terminal_daily_summary"))
    assert daily.count() > 0 and "gold_processed_at" in daily.columns


def test_cached_table_builds_once(spark):
    import uuid
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    key = f"test-{uuid.uuid4().hex}"
    a = sinks.cached_table(spark, "t", key, build)
    b = sinks.cached_table(spark, "t", key, build)
    assert a.count() == b.count() == 5 and len(calls) == 1


def test_cli_batch_from_kafka_shaped_files(spark, tmp_path):
    from berthline.__main__ import main
    landing = str(tmp_path / "kafka")
    testdata.all_topics_bronze(_events(spark)).write.parquet(landing)
    out = str(tmp_path / "tables")
    assert main(["batch", "--bronze", landing, "--out", out]) == 0
    assert spark.read.parquet(f"{out}/gold_container_export_flow_streaming").count() == 317
    assert spark.read.parquet(f"{out}/gold_terminal_daily_summary").count() > 0


def test_route_keeps_unknown_topics(spark):
    rows = spark.createDataFrame([("crane_events",), ("other_topic",)], "topic string")
    got = {r.topic: r.target_table for r in bronze.route(rows, bronze.ROUTES).collect()}
    assert got == {"crane_events": "crane_events_bronze", "other_topic": None}


def test_fingerprint_sees_every_file(spark, tmp_path):
    """A file added to, changed in or taken from a partition folder is another input."""
    path = str(tmp_path / "t")
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    first = sinks.fingerprint(spark, path)
    assert sinks.fingerprint(spark, path) == first
    spark.range(4, 6).write.mode("append").parquet(f"{path}/p=1")
    assert sinks.fingerprint(spark, path) != first


def test_new_rows_of_a_folder_input_reach_silver(spark, tmp_path):
    from berthline.plans import pipeline
    d = str(tmp_path / "sf")
    events = _events(spark)
    half = events.where("event_id % 2 = 0").withColumn("day", F.to_date("ts"))
    half.write.partitionBy("day").parquet(f"{d}/events.parquet")
    before = pipeline.silver_from_testdata(spark, d).crane.count()
    rest = events.where("event_id % 2 = 1").withColumn("day", F.to_date("ts"))
    rest.write.mode("append").partitionBy("day").parquet(f"{d}/events.parquet")
    after = pipeline.silver_from_testdata(spark, d).crane.count()
    whole = events.where("event_type IN ('click', 'purchase', 'error')").count()
    assert before < after == whole


def test_versions_are_published_whole(spark, tmp_path):
    folder = str(tmp_path / "v")
    for n in (3, 5):
        sinks.publish_version(spark, folder, spark.range(n), ["id"])
        assert spark.read.parquet(sinks.current_version(spark, folder)).count() == n
    import pytest
    with pytest.raises(FileNotFoundError):
        sinks.current_version(spark, str(tmp_path / "none"))


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    import pytest
    from types import SimpleNamespace

    from berthline import session

    class Conf:
        def get(self, key, default=None):
            return default
    context = SimpleNamespace(master="yarn", getConf=Conf, applicationId="app")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(conf=Conf(), sparkContext=context))


def test_long_manifests_are_cut_into_pages(spark):
    """A third of all lines in one order: no array beyond the page size, nothing lost."""
    orders = testdata.read_table(spark, "/root/testdata/sf0.001", "orders").limit(40)
    key = orders.orderBy("o_orderkey").first().o_orderkey
    lines = testdata.read_table(spark, "/root/testdata/sf0.001", "lineitem").join(
        orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    many = spark.range(700).crossJoin(lines.where(F.col("l_orderkey") == key).limit(1)).drop("id")
    docs = testdata.manifest_documents(orders, lines.unionByName(many), page_size=50)
    sizes = docs.select("vessel_id", F.size("containers").alias("n")).collect()
    assert max(r.n for r in sizes) <= 50
    from berthline.operators import manifest
    total = {r.vessel_id: r.containers for r in manifest.manifest_summary(docs).where("dimension = 'total'").collect()}
    want = {str(r.l_orderkey): r.n for r in
            lines.unionByName(many).groupBy("l_orderkey").agg(F.count("*").alias("n")).collect()}
    assert {k: v for k, v in total.items() if v} == want and len(total) == 40


def test_schedule_landing(spark, tmp_path):
    from berthline.operators import manifest
    docs = testdata.manifest_documents(testdata.read_table(spark, "/root/testdata/sf0.001", "orders").limit(5),
                                       testdata.read_table(spark, "/root/testdata/sf0.001", "lineitem"))
    folder = sinks.land_schedule(manifest.vessel_schedule(docs), str(tmp_path))
    assert "/vessel_schedule_api/20" in folder
    back = spark.read.json(folder)
    assert back.count() == 5 and "containers_summary" in back.columns


def test_kafka_options_reach_the_reader():
    """Defaults of every topic reader, the caller's security options, and the subscription."""
    seen = {}

    class Reader:
        def format(self, fmt):
            seen["format"] = fmt
            return self

        def options(self, **options):
            seen["options"] = options
            return self

        def load(self):
            return "stream"

    class Session:
        readStream = Reader()
    security = {"kafka.bootstrap.servers": "h:9092", "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
                "kafka.ssl.endpoint.identification.algorithm": "https"}
    assert bronze.read_bronze(Session(), ["a", "b"], options=security) == "stream"
    assert seen["format"] == "kafka"
    assert seen["options"] == {"startingOffsets": "earliest", "failOnDataLoss": "false", **security, "subscribe": "a,b"}
    # the caller's choice beats a default, not the topics
    bronze.read_bronze(Session(), "a", options={"startingOffsets": "latest", "subscribe": "x"})
    assert seen["options"] == {"startingOffsets": "latest", "failOnDataLoss": "false", "subscribe": "a"}


def test_lines_are_shuffled_once_as_columns(spark):
    """Containers are built after the shuffle by order; long orders alone are numbered; lines
    of no order and of the NULL key give nothing."""
    orders = testdata.read_table(spark, "/root/testdata/sf0.001", "orders").limit(30).cache()
    lines = testdata.read_table(spark, "/root/testdata/sf0.001", "lineitem")
    lines = lines.unionByName(lines.limit(3).withColumn("l_orderkey", F.lit(None).cast("long")))
    docs = testdata.manifest_documents(orders, lines, partitions=9)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert ", 9), REPARTITION_BY_NUM" in plan
    want = {str(r.o_orderkey): r.n for r in orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy(
        "o_orderkey").agg(F.count("l_orderkey").alias("n")).collect()}
    assert {r.vessel_id: len(r.containers) for r in docs.collect()} == want


def test_bronze_is_dealt_to_all_cores(spark, tmp_path):
    """One file of events is one split of the scan; bronze is written by every core."""
    import shutil

    from berthline.plans import pipeline
    shutil.copy("/root/testdata/sf0.001/events.parquet", tmp_path / "events.parquet")
    path = pipeline.bronze_path(spark, str(tmp_path), "crane")
    assert len([f for f in os.listdir(path.removeprefix("file://").removeprefix("file:")) if f.startswith("part-")]) > 1
