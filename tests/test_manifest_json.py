"""Containers taken from manifest JSON held as VARIANT."""
import json

from berthline import schemas
from berthline.operators import manifest


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_the_typed_scan(spark, tmp_path):
    docs = [{"vessel_id": "V1", "eta": 1700000000, "voyage": "1", "containers": [
                {"container_id": "a", "container_size": "20", "more": 1}, {"container_id": None}, {}]},
            {"vessel_id": "V2", "containers": []}, {"vessel_id": "V3", "extra": {"x": [1]}}, {"vessel_id": "V4", "containers": None},
            {"vessel_id": "V5", "etd": None, "containers": [{"container_id": str(i)} for i in range(3000)]}]
    lines = [json.dumps(d) for d in docs]
    path = str(tmp_path / "landed")
    spark.createDataFrame([(x,) for x in [*lines, "{no json", ""]], "value string").write.text(path)
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "typed"))
    typed = spark.read.schema(schemas.MANIFEST).json(str(tmp_path / "typed"))
    for keep in (True, False):
        want = manifest.manifest_containers(typed, keep)
        got = manifest.manifest_containers_json(spark.read.text(path), keep)
        assert got.columns == want.columns and got.dtypes == want.dtypes and _rows(got) == _rows(want)
    # as a file stream
    q = manifest.manifest_containers_json(spark.readStream.text(path)).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    assert _rows(spark.read.parquet(str(tmp_path / "out"))) == _rows(manifest.manifest_containers(typed))


def test_landed_json_is_compressed(spark, tmp_path):
    """The dated landing writes gzip files that read back whole."""
    import glob

    from pyspark.sql import functions as F

    from berthline.sources import sinks
    df = spark.range(50).select(F.col("id").cast("string").alias("id"), F.to_date(F.lit("2024-01-02")).alias("d"))
    path = str(tmp_path / "landing")
    sinks.land_dated_json(df, path, "d")
    files = glob.glob(f"{path}/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
    assert sorted(int(r.id) for r in spark.read.schema("id string").json(path).collect()) == list(range(50))


def test_task_count_follows_the_input(spark, tmp_path, monkeypatch):
    from berthline.sources import sinks
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert sinks.task_count(spark, str(tmp_path / "t")) == cores
    monkeypatch.setattr(sinks, "TASK_BYTES", 100)
    assert sinks.task_count(spark, str(tmp_path / "t")) > cores


def _documents(spark, n):
    c = [{"container_size": "20", "container_type": "D", "status_code": "F"}, {"container_size": None}]
    return spark.createDataFrame([{"vessel_id": str(i % n), "eta": None, "containers": c} for i in range(2 * n)], schemas.MANIFEST)


def test_summary_combines_no_wide_rows_before_the_shuffle(spark):
    """One shuffle, of one row a document, into the partitions asked for; pages of a call are summed."""
    import contextlib
    import io
    docs = _documents(spark, 5)
    for df in (manifest.manifest_summary(docs, 7), manifest.vessel_schedule(docs, partitions=7)):
        with contextlib.redirect_stdout(io.StringIO()) as said:
            df.explain()
        plan = said.getvalue()
        assert plan.count("Exchange") == 1 and ", 7), REPARTITION_BY_NUM" in plan
        assert "Aggregate" not in plan.split("Exchange")[1]
    got = {(r.vessel_id, r.dimension, r.value): r.containers for r in manifest.manifest_summary(docs, 7).collect()}
    assert got[("0", "total", "all")] == 4 and got[("0", "by_size", "unknown")] == 2 and len(got) == 5 * 7
