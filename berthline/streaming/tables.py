"""Streaming twins of the gold tables, run as bounded replays over silver.

Same operator bodies as batch (`operators.flows`, `operators.gold`); only
the watermarks and the sinks differ:

* flows: 2 h watermarks on both inputs, stream-stream left outer interval join
  (append mode; unmatched rows leave when the watermark passes);
* gate traffic: 1 h watermarks, windowed aggregates, full outer join of the
  two aggregates (chained stateful operators, append mode);
* crane performance / anomaly summary: aggregations without watermark, in update
  mode; every batch adds its changed rows, the table is each key's last row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flows, gold
from . import late as side
from .runner import (Replay, dropped_by_watermark, run_available_now, time_chunks,
                     without_sentinels)
from .updated import latest

FLOW_WATERMARK = "2 hours"
TRAFFIC_WATERMARK = "1 hour"


def _replay(spark: SparkSession, label: str, tables: dict, build, *, bounds: list[str],
            mode: str = "append", flush: bool = True):
    """Stage every table chunk by chunk (in time order), run the query once per
    stage from one checkpoint, optionally flush with sentinels; return
    (result path reader, progress list, replay)."""
    rp = Replay(spark, label)
    streams = {name: rp.source(name, df.schema, ts) for name, (df, ts) in tables.items()}
    query = build(streams)
    chunks = {name: time_chunks(df, ts, bounds) for name, (df, ts) in tables.items()}
    out, ck = rp.path("out"), rp.path("checkpoint")
    progress = []
    for i in range(len(bounds) + 1):
        for name in tables:
            rp.stage(name, chunks[name][i])
        progress += run_available_now(query, out, ck, mode=mode)
    if flush:
        rp.stage_sentinels()
        progress += run_available_now(query, out, ck, mode=mode)
        # The sentinel batch moves the watermark; the next run's no-data batch evicts.
        progress += run_available_now(query, out, ck, mode=mode)
    return (out if mode == "update" else spark.read.parquet(out)), progress, rp


def stream_export_flow(spark, gate_in: DataFrame, crane: DataFrame, bounds: list[str]) -> DataFrame:
    def build(s):
        return flows.export_flow(s["gate_in"].withWatermark("gate_in_timestamp", FLOW_WATERMARK),
                                 s["crane"].withWatermark("crane_timestamp", FLOW_WATERMARK),
                                 processing_time=False)
    df, _, _ = _replay(spark, "export-flow", {"gate_in": (gate_in, "gate_in_timestamp"),
                                              "crane": (crane, "crane_timestamp")},
                       build, bounds=bounds)
    return without_sentinels(df, "gate_in_event_id")


def stream_import_flow(spark, gate_out: DataFrame, crane: DataFrame, bounds: list[str]) -> DataFrame:
    def build(s):
        return flows.import_flow(s["gate_out"].withWatermark("gate_out_timestamp", FLOW_WATERMARK),
                                 s["crane"].withWatermark("crane_timestamp", FLOW_WATERMARK),
                                 processing_time=False)
    df, _, _ = _replay(spark, "import-flow", {"gate_out": (gate_out, "gate_out_timestamp"),
                                              "crane": (crane, "crane_timestamp")},
                       build, bounds=bounds)
    return without_sentinels(df, "gate_out_event_id")


def stream_gate_traffic(spark, gate_in: DataFrame, gate_out: DataFrame,
                        bounds: list[str]) -> DataFrame:
    def build(s):
        return gold.gate_hourly_traffic(
            s["gate_in"].withWatermark("gate_in_timestamp", TRAFFIC_WATERMARK),
            s["gate_out"].withWatermark("gate_out_timestamp", TRAFFIC_WATERMARK),
            processing_time=False)
    df, _, _ = _replay(spark, "gate-traffic", {"gate_in": (gate_in, "gate_in_timestamp"),
                                               "gate_out": (gate_out, "gate_out_timestamp")},
                       build, bounds=bounds)
    return without_sentinels(df, "terminal_id")


def stream_crane_performance(spark, crane: DataFrame, bounds: list[str]) -> DataFrame:
    out, _, _ = _replay(spark, "crane-performance", {"crane": (crane, "crane_timestamp")},
                        lambda s: gold.crane_performance(s["crane"], processing_time=False),
                        bounds=bounds, mode="update", flush=False)
    return latest(spark, out, gold.PERFORMANCE_KEYS)


def stream_anomaly_summary(spark, crane: DataFrame, bounds: list[str]) -> DataFrame:
    out, _, _ = _replay(spark, "anomaly-summary", {"crane": (crane, "crane_timestamp")},
                        lambda s: gold.anomaly_summary(s["crane"], processing_time=False),
                        bounds=bounds, mode="update", flush=False)
    return latest(spark, out, gold.ANOMALY_KEYS)


def late_gate_traffic(spark, gate_in: DataFrame, late: F.Column, mid: str,
                      watermark: str = TRAFFIC_WATERMARK) -> tuple[DataFrame, int]:
    """Hourly gate-in counts per terminal when the rows matching `late` (all
    before `mid`) arrive only after everything from `mid` on.  Returns the kept
    counts and the number of rows the watermark dropped.

    Arrival: (1) rows before `mid` except the late ones, (2) rows from `mid` on,
    (3) the late rows, (4) a flush sentinel.  A row is judged by the watermark
    of the previous batch, so every late row is dropped.  The returned count is
    Spark's `numRowsDroppedByWatermark`, which counts rows reaching the state
    operator -- after partial aggregation -- so it is a lower bound on the
    dropped events."""
    rp = Replay(spark, "late-data")
    ts = "gate_in_timestamp"
    src = rp.source("gate_in", gate_in.schema, ts).withWatermark(ts, watermark)
    q = src.groupBy("terminal_id", F.window(ts, "1 hour").alias("window")) \
        .agg(F.count(F.lit(1)).alias("vehicles_in"))
    out, ck = rp.path("out"), rp.path("checkpoint")
    before = F.col(ts) < F.to_timestamp(F.lit(mid))
    stages = [gate_in.where(before & ~late), gate_in.where(~before), gate_in.where(before & late)]
    progress = []
    for st in stages:
        rp.stage("gate_in", st)
        progress += run_available_now(q, out, ck)
    rp.stage_sentinels()
    progress += run_available_now(q, out, ck)
    progress += run_available_now(q, out, ck)
    return without_sentinels(spark.read.parquet(out), "terminal_id"), \
        dropped_by_watermark(progress)


def late_rows_kept(spark, gate_in: DataFrame, late: F.Column, mid: str, watermark: str = TRAFFIC_WATERMARK) -> DataFrame:
    """The arrival of `late_gate_traffic`, with the late rows kept in a side table and merged
    into the hourly counts (`streaming.late`)."""
    rp = Replay(spark, "late-kept")
    ts = "gate_in_timestamp"
    src, out = rp.source("gate_in", gate_in.schema, ts), rp.path("out")
    before = F.col(ts) < F.to_timestamp(F.lit(mid))
    for st in (gate_in.where(before & ~late), gate_in.where(~before), gate_in.where(before & late)):
        rp.stage("gate_in", st)
        query = src.writeStream.option("checkpointLocation", rp.path("checkpoint")).trigger(availableNow=True)
        query.foreachBatch(side.splitter(out, ts, watermark, 3600)).start().awaitTermination()
    counts = [side.hourly_vehicles(side.rows(spark, out, part, gate_in.schema), ts, f"vehicles_{part}") for part in ("on_time", "late")]
    return side.corrected(*counts)
