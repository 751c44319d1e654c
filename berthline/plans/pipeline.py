"""The medallion pipeline as one object: bronze in, silver and gold out.

The source declares its tables with decorators and lets the pipeline
runtime infer the order from table names.  Here each table is a lazily built
DataFrame derived from its inputs; Catalyst sees one plan per requested table,
prunes every silver column a gold table does not read and pushes filters down.
`materialize` writes tables in dependency order (see `sources.sinks`).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import flows, gold, quality, silver
from ..session import session_key
from ..sources import bronze, sinks, testdata


class TerminalPipeline:
    def __init__(self, crane_bronze: DataFrame, gate_in_bronze: DataFrame,
                 gate_out_bronze: DataFrame, *, processing_time: bool = True,
                 max_dwell_hours: int = 24, flow_operation: bool = False):
        self.settings = {"processing_time": processing_time, "max_dwell_hours": max_dwell_hours,
                         "flow_operation": flow_operation}
        self.crane_bronze = crane_bronze
        self.gate_in_bronze = gate_in_bronze
        self.gate_out_bronze = gate_out_bronze
        self.processing_time = processing_time
        self.max_dwell_hours = max_dwell_hours
        # The source matches any crane event; True restricts export flows to LOAD
        # and import flows to DISCHARGE.
        self.flow_operation = flow_operation

    @classmethod
    def from_silver(cls, crane: DataFrame, gate_in: DataFrame, gate_out: DataFrame,
                    **kw) -> "TerminalPipeline":
        """Gold over already written silver tables (the normal production case)."""
        p = cls(None, None, None, **kw)
        p.__dict__.update(crane=crane, gate_in=gate_in, gate_out=gate_out)
        return p

    # ---- silver
    @cached_property
    def crane(self) -> DataFrame:
        return silver.crane_silver(self.crane_bronze, self.processing_time)

    @cached_property
    def gate_in(self) -> DataFrame:
        return silver.gate_in_silver(self.gate_in_bronze, self.processing_time)

    @cached_property
    def gate_out(self) -> DataFrame:
        return silver.gate_out_silver(self.gate_out_bronze, self.processing_time)

    # ---- gold
    @cached_property
    def export_flow(self) -> DataFrame:
        return flows.export_flow(self.gate_in, self.crane, max_dwell_hours=self.max_dwell_hours,
                                 operation="LOAD" if self.flow_operation else None,
                                 processing_time=self.processing_time)

    @cached_property
    def import_flow(self) -> DataFrame:
        return flows.import_flow(self.gate_out, self.crane, max_dwell_hours=self.max_dwell_hours,
                                 operation="DISCHARGE" if self.flow_operation else None,
                                 processing_time=self.processing_time)

    @cached_property
    def crane_performance(self) -> DataFrame:
        return gold.crane_performance(self.crane, self.processing_time)

    @cached_property
    def anomaly_summary(self) -> DataFrame:
        return gold.anomaly_summary(self.crane, self.processing_time)

    @cached_property
    def terminal_daily_summary(self) -> DataFrame:
        return gold.terminal_daily_summary(self.export_flow, self.import_flow, self.crane,
                                           self.processing_time)

    @cached_property
    def gate_hourly_traffic(self) -> DataFrame:
        return gold.gate_hourly_traffic(self.gate_in, self.gate_out,
                                        processing_time=self.processing_time)


# Bumped when the written layout of the stand-in bronze or silver tables changes.
LAYOUT = "v4"
_TOPIC_OF = {"crane": schemas.TOPIC_CRANE, "gate_in": schemas.TOPIC_GATE_IN, "gate_out": schemas.TOPIC_GATE_OUT}


def bronze_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Folder of a stand-in bronze table, written once per input: what the Kafka
    reader would have kept of the topic."""
    key = sinks.fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet") + LAYOUT

    def build() -> DataFrame:
        events = testdata.read_table(spark, sf_dir, "events")
        # A file of millions of events is one split of the scan, and JSON is slow to write: dealt anew.
        events = events.repartition(sinks.task_count(spark, f"{sf_dir.rstrip('/')}/events.parquet"), *events.columns)
        return testdata.crane_bronze(events) if kind == "crane" else \
            testdata.gate_bronze(events, kind.removeprefix("gate_"))
    return sinks.cached_path(spark, f"{kind}_events_bronze", key, build)


def bronze_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return bronze.read_bronze(spark, _TOPIC_OF[kind], fmt="parquet", path=bronze_path(spark, sf_dir, kind),
                              streaming=False)


def from_testdata(spark: SparkSession, sf_dir: str, **kw) -> TerminalPipeline:
    return TerminalPipeline(*(bronze_table(spark, sf_dir, kind) for kind in _TOPIC_OF), **kw)


_SILVER: dict = {}


def silver_from_testdata(spark: SparkSession, sf_dir: str, **kw) -> TerminalPipeline:
    """Bronze -> silver written once per input (as the streaming silver tables
    are in production), gold computed over the silver parquet tables.  The
    written tables are immutable, so their DataFrames are reused per session."""
    key = sinks.fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet") + LAYOUT
    memo = (session_key(spark), key)
    if memo not in _SILVER:
        raw = []

        def build(name):
            if not raw:
                raw.append(from_testdata(spark, sf_dir, processing_time=True))
            return getattr(raw[0], name)
        _SILVER[memo] = {name: sinks.cached_table(spark, f"silver_{name}", key,
                                                  lambda n=name: build(n))
                         for name in ("crane", "gate_in", "gate_out")}
    t = _SILVER[memo]
    return TerminalPipeline.from_silver(t["crane"], t["gate_in"], t["gate_out"], **kw)


# Table names and cluster keys of the source pipeline.
TABLE_LAYOUT = {
    "crane_events_bronze": ("crane_bronze", None),
    "gate_in_events_bronze": ("gate_in_bronze", None),
    "gate_out_events_bronze": ("gate_out_bronze", None),
    "crane_events_silver": ("crane", None),
    "gate_in_events_silver": ("gate_in", None),
    "gate_out_events_silver": ("gate_out", None),
    "gold_container_export_flow_streaming": ("export_flow", ["terminal_id", "container_number"]),
    "gold_container_import_flow_streaming": ("import_flow", ["terminal_id", "container_number"]),
    "gold_crane_performance": ("crane_performance", ["crane_id", "operation_date"]),
    "gold_anomaly_summary": ("anomaly_summary", ["crane_id", "anomali_type"]),
    "gold_terminal_daily_summary": ("terminal_daily_summary", ["terminal_id", "date"]),
    "gold_gate_hourly_traffic": ("gate_hourly_traffic", ["terminal_id", "gate_id"]),
}
_EXPECT_NAMES = {"gold_container_export_flow_streaming": "gold_container_export_flow",
                 "gold_container_import_flow_streaming": "gold_container_import_flow"}


def register_table(spark: SparkSession, name: str, path: str, database: str | None = None) -> None:
    """Name a written table in the session catalog (external: dropping the name
    keeps the files), so jobs can `spark.read.table(name)` / `readStream.table`."""
    full = f"`{database}`.`{name}`" if database else f"`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")


def materialize(p: TerminalPipeline, root: str, *, register: bool = False,
                database: str | None = None) -> dict:
    """Batch run of the whole pipeline: write every table under `root` in dependency
    order, each from the written tables before it: bronze, silver parsed once from
    the written bronze, gold over the written silver in its clustered layout, and the
    daily view over the written gold flows.  The warn-only expectations are
    counted while the rows are written; with `register`, each table is also named
    in the catalog.  Returns {table: {expectation counts}}."""
    spark = (p.crane if p.crane_bronze is None else p.crane_bronze).sparkSession
    written, metrics, now = {}, {}, p
    for table, (attr, keys) in TABLE_LAYOUT.items():
        path = f"{root.rstrip('/')}/{table}"
        if attr.endswith("_bronze") and p.crane_bronze is None:
            continue
        if attr == "crane" and p.crane_bronze is not None:
            now = TerminalPipeline(*(written[f"{k}_events_bronze"] for k in _TOPIC_OF), **p.settings)
        if attr == "export_flow":
            now = TerminalPipeline.from_silver(*(written[f"{k}_events_silver"] for k in _TOPIC_OF), **p.settings)
        if table == "gold_terminal_daily_summary":
            df = gold.terminal_daily_summary(
                written["gold_container_export_flow_streaming"],
                written["gold_container_import_flow_streaming"],
                written["crane_events_silver"], p.processing_time)
        else:
            df = getattr(now, attr)
        if keys:
            df = sinks.clustered(df, keys)
        # Observed above the range shuffle, so the boundary-sampling job of
        # repartitionByRange does not count rows a second time.
        checks = quality.EXPECTATIONS.get(_EXPECT_NAMES.get(table, table))
        obs = None
        if checks:
            df, obs = quality.expect(df, checks, name=table)
        df.write.mode("overwrite").parquet(path)
        if obs is not None:
            metrics[table] = obs.get
        if register:
            register_table(spark, table, path, database)
        written[table] = spark.read.parquet(path)
    return metrics
