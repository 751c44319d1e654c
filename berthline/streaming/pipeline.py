"""The medallion pipeline as long-running Structured Streaming queries.

    Kafka topics       --bronze_streams-->  <root>/<kind>_events_bronze
    bronze tables      --silver_streams-->  <root>/<kind>_events_silver
    silver tables      --gold_streams-->    <root>/gold_* tables
    gold tables        --publish_gold-->    <root>/published/gold_* (clustered, kept up), daily view

With `database`, every streamed table is named in the catalog and the next layer
reads it by name; without, tables are folders below `root`.

Each query has its own checkpoint under <root>/_checkpoints, so a restart (or a
lost executor) resumes exactly where it stopped; the parquet file sink commits
through its metadata log, and downstream file streams read that log, so every
row reaches the next layer exactly once.  Triggers: `{"processingTime": "1
minute"}` for continuous operation, `{"availableNow": True}` for scheduled
catch-up runs (run a layer to completion before the next).

Expectations are warn-only, as in the source.  They are attached with `observe`
and summed over all micro-batches by a listener; for the two tables that are
updated in place they are counted over the current rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import flows, gold, quality, silver
from ..sources import bronze, clustered, sinks
from .daily_view import DailyView, Refresh
from .progress import run_totals, totals
from .runner import stream_session
from .updated import batch_writer, latest

KINDS = {"crane": schemas.TOPIC_CRANE, "gate_in": schemas.TOPIC_GATE_IN, "gate_out": schemas.TOPIC_GATE_OUT}
SILVER_TABLES = {kind: f"{kind}_events_silver" for kind in KINDS}
BRONZE_TABLES = {kind: f"{kind}_events_bronze" for kind in KINDS}
FLOW_WATERMARK = "2 hours"
TRAFFIC_WATERMARK = "1 hour"
EXPORT, IMPORT = "gold_container_export_flow_streaming", "gold_container_import_flow_streaming"
# Streamed gold tables: their checks, and for tables of updates their keys.
CHECKS = {EXPORT: "gold_container_export_flow", IMPORT: "gold_container_import_flow",
          "gold_crane_performance": "gold_crane_performance", "gold_anomaly_summary": "gold_anomaly_summary",
          "gold_gate_hourly_traffic": "gold_gate_hourly_traffic"}
UPDATED = {"gold_crane_performance": gold.PERFORMANCE_KEYS, "gold_anomaly_summary": gold.ANOMALY_KEYS}
# Cluster keys of the source pipeline.
CLUSTER_KEYS = {EXPORT: ["terminal_id", "container_number"], IMPORT: ["terminal_id", "container_number"],
                "gold_crane_performance": ["crane_id", "operation_date"],
                "gold_anomaly_summary": ["crane_id", "anomali_type"],
                "gold_gate_hourly_traffic": ["terminal_id", "gate_id"]}
DAILY = "gold_terminal_daily_summary"
DAILY_KEYS = ["terminal_id", "date"]


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _checkpoint(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_checkpoints/{table}"


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _start(df: DataFrame, root: str, table: str, trigger: dict, database: str | None) -> StreamingQuery:
    """Append `df` to a table of files, named in the catalog if there is a database."""
    totals(df.sparkSession)
    sinks.make_folder(df.sparkSession, _path(root, table))     # the next layer may start before the first batch
    w = (df.writeStream.format("parquet").outputMode("append").queryName(table)
         .option("checkpointLocation", _checkpoint(root, table)).trigger(**trigger))
    if not database:
        return w.start(_path(root, table))
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    return w.option("path", _path(root, table)).toTable(_name(database, table))


def _stream(spark: SparkSession, root: str, table: str, schema, database: str | None) -> DataFrame:
    """A streamed table as the next layer's input: by name, or by folder."""
    if database:
        return spark.readStream.table(_name(database, table))
    return spark.readStream.schema(schema).parquet(_path(root, table))


def bronze_streams(spark: SparkSession, sources: dict[str, DataFrame], root: str, *, trigger: dict | None = None,
                   database: str | None = None) -> dict[str, StreamingQuery]:
    """Keep every topic as it came ({"crane": streaming Kafka-shaped frame, ...}), so that
    silver can be built again after the topics have forgotten."""
    columns = [f.name for f in schemas.KAFKA_ROW.fields]
    return {BRONZE_TABLES[kind]: _start(df.select(*columns), root, BRONZE_TABLES[kind],
                                        trigger or {"availableNow": True}, database)
            for kind, df in sources.items()}


def bronze_sources(spark: SparkSession, root: str, kinds=tuple(KINDS), database: str | None = None) -> dict[str, DataFrame]:
    """The bronze tables as streams for `silver_streams`."""
    return {kind: bronze.branch(_stream(spark, root, BRONZE_TABLES[kind], schemas.KAFKA_ROW, database), KINDS[kind])
            for kind in kinds}


def silver_schema(spark: SparkSession, kind: str):
    empty = spark.createDataFrame([], schemas.KAFKA_ROW)
    return silver.to_silver(empty, silver.SPECS[kind]).schema


def silver_streams(spark: SparkSession, sources: dict[str, DataFrame], root: str, *,
                   trigger: dict | None = None, dedupe: bool = False,
                   database: str | None = None) -> dict[str, StreamingQuery]:
    """Start bronze -> silver for each kind in `sources` ({"crane": df, ...},
    streaming Kafka-shaped frames).  `dedupe` drops Kafka redeliveries (same
    event_id) within the flow watermark; the source keeps them."""
    out = {}
    for kind, b in sources.items():
        spec = silver.SPECS[kind]
        df = silver.to_silver(b, spec)
        if dedupe:
            df = df.withWatermark(spec.ts_name, FLOW_WATERMARK) \
                .dropDuplicatesWithinWatermark(["event_id"])
        table = SILVER_TABLES[kind]
        out[table] = _start(df, root, table, trigger or {"availableNow": True}, database)
    return out


def gold_streams(spark: SparkSession, root: str, *, trigger: dict | None = None, database: str | None = None,
                 state_partitions: int | None = None, salts: int = 1) -> dict[str, StreamingQuery]:
    """Start the five streaming gold tables over the silver tables under `root`.

    `state_partitions` and `salts` (copies of the crane side that split hot containers)
    are fixed by the first start.  The daily summary is a batch view over their
    output (`publish_gold`)."""
    own = stream_session(spark, state_partitions)
    trigger = trigger or {"availableNow": True}
    crane, gin, gout = (_stream(own, root, SILVER_TABLES[k], silver_schema(spark, k), database) for k in KINDS)

    def observed(df: DataFrame, table: str) -> DataFrame:
        aggs = [c for n, p in quality.EXPECTATIONS[CHECKS[table]].items() for c in quality.counts(n, p)]
        return df.observe(table, *aggs)

    def updated(df: DataFrame, table: str) -> StreamingQuery:
        # No watermark on these aggregations (as in the source): changed rows only are
        # written, batch by batch; the table is the last row of each key.
        totals(own)
        return (df.writeStream.option("checkpointLocation", _checkpoint(root, table)).trigger(**trigger)
                .queryName(table).outputMode("update").foreachBatch(
                    batch_writer(_path(root, table), keys=UPDATED[table])).start())

    gate_in = gin.withWatermark("gate_in_timestamp", FLOW_WATERMARK)
    gate_out = gout.withWatermark("gate_out_timestamp", FLOW_WATERMARK)
    moves = crane.withWatermark("crane_timestamp", FLOW_WATERMARK)
    traffic = gold.gate_hourly_traffic(gin.withWatermark("gate_in_timestamp", TRAFFIC_WATERMARK),
                                       gout.withWatermark("gate_out_timestamp", TRAFFIC_WATERMARK))
    append = {EXPORT: flows.export_flow(gate_in, moves, salts=salts),
              IMPORT: flows.import_flow(gate_out, moves, salts=salts),
              "gold_gate_hourly_traffic": traffic}
    out = {t: _start(observed(df, t), root, t, trigger, database) for t, df in append.items()}
    out["gold_crane_performance"] = updated(gold.crane_performance(crane), "gold_crane_performance")
    out["gold_anomaly_summary"] = updated(gold.anomaly_summary(crane), "gold_anomaly_summary")
    return out


def gold_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows a streamed gold table holds now."""
    path = _path(root, table)
    return latest(spark, path, UPDATED[table]) if table in UPDATED else spark.read.parquet(path)


def _counted(table: str, df: DataFrame) -> dict:
    checks = quality.EXPECTATIONS[CHECKS.get(table, table)]
    return df.agg(*[c for n, p in checks.items() for c in quality.counts(n, p)]).first().asDict()


def await_all(queries: dict[str, StreamingQuery], root: str | None = None) -> dict[str, dict]:
    """Wait for (availableNow) queries; {table: expectation counts over all batches}.  Tables
    of updates are counted over their current rows, for which `root` is needed."""
    out = {}
    for name, q in queries.items():
        q.awaitTermination()
        spark = SparkSession.getActiveSession()
        if name in UPDATED:
            out[name] = _counted(name, gold_table(spark, root, name)) if root else {}
        else:
            out[name] = run_totals(q)["observed"].get(name, {})
    return out


def daily_summary_view(spark: SparkSession, root: str) -> DataFrame:
    """gold_terminal_daily_summary over the streamed tables."""
    return gold.terminal_daily_summary(gold_table(spark, root, EXPORT), gold_table(spark, root, IMPORT),
                                       spark.read.parquet(_path(root, SILVER_TABLES["crane"])))


def refresh_daily(spark: SparkSession, root: str, processing_time: bool = True) -> Refresh:
    """Bring the kept-up daily view below <root>/published in line with the streamed tables:
    only (terminal, date) keys that new rows touch are computed again."""
    return daily_view(spark, root).refresh(
        {"export": (gold_table(spark, root, EXPORT), "gate_in_timestamp"),
         "import": (gold_table(spark, root, IMPORT), "gate_out_timestamp"),
         "crane": (spark.read.parquet(_path(root, SILVER_TABLES["crane"])), "crane_timestamp")}, processing_time)


def daily_view(spark: SparkSession, root: str) -> DailyView:
    return DailyView(spark, _path(root, f"published/{DAILY}"))


def publish_gold(spark: SparkSession, root: str, *, database: str | None = None,
                 file_rows: int = clustered.FILE_ROWS) -> dict[str, dict]:
    """Batch step after (or between) streaming runs: bring the clustered gold tables and the
    daily view below <root>/published in line with the streamed ones.

    Appended tables take their new files' rows, tables of updates their current rows;
    either way only the clustered files that hold the keys are rewritten (see
    `sources.clustered`), and only touched dates of the daily view (see
    `daily_view`).  With `database`, views named <table>_published, and the daily
    summary by its own name, show the versions.  Returns {table: expectation counts}."""
    out = {}
    for table, keys in CLUSTER_KEYS.items():
        kept_up = clustered.ClusteredTable(spark, _path(root, f"published/{table}"))
        streamed = gold_table(spark, root, table)
        if table in UPDATED:
            if kept_up.version:     # rows that differ from the published ones, processing time apart
                same = [c for c in streamed.columns if c != "gold_processed_at"]
                changed = streamed.select(*same).exceptAll(kept_up.read().select(*same)).select(*UPDATED[table]).distinct()
                on = reduce(lambda a, b: a & b, [streamed[k].eqNullSafe(changed[k]) for k in UPDATED[table]])
                streamed = streamed.join(changed, on, "left_semi")
            kept_up.merge(streamed, keys=keys, replace=UPDATED[table], file_rows=file_rows)
        else:
            files = sorted(set(streamed.inputFiles()) - kept_up.inputs())
            rows = spark.read.schema(streamed.schema).parquet(*files) if files else streamed.limit(0)
            kept_up.merge(rows, keys=keys, file_rows=file_rows, inputs=files)
        out[table] = _counted(table, published(spark, root, table))
    refresh_daily(spark, root)
    out[DAILY] = _counted(DAILY, published(spark, root, DAILY))
    if database:
        for table in [*CLUSTER_KEYS, DAILY]:
            name_published(spark, root, table, database)
    return out


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The version of a gold table published last."""
    if table == DAILY:
        return daily_view(spark, root).read()
    return clustered.ClusteredTable(spark, _path(root, f"published/{table}")).read()


def name_published(spark: SparkSession, root: str, table: str, database: str) -> None:
    """Name the version published last in the catalog, as a view of its files."""
    base = _path(root, f"published/{table}")
    files = daily_view(spark, root).days().values() if table == DAILY else clustered.ClusteredTable(spark, base).files()
    below = ",".join(sorted(f"data/{f.rsplit('/data/', 1)[1]}" for f in files))
    name = _name(database, table if table == DAILY else f"{table}_published")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{base}/{{{below}}}`")
