"""Container export / import flows with yard dwell time (left outer interval joins).

export: gate-in  LEFT JOIN crane ON container AND crane_ts    IN [gate_in_ts, gate_in_ts + 24h]
import: gate-out LEFT JOIN crane ON container AND gate_out_ts IN [crane_ts,  crane_ts  + 24h]

As in the source, the crane operation is not part of the match (any crane
event of the container in range matches, several matches fan out into several
rows); `operation=` adds that filter when wanted.  The same body serves batch
and streaming (the streaming runner adds the watermarks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .interval_join import interval_join

HOUR = 3600


def _flow(gate: DataFrame, crane: DataFrame, *, gate_ts: str, prefix: str,
          matched_label: str, lower: int, upper: int, export: bool,
          operation: str | None, processing_time: bool, bucket_seconds: int | None,
          null_category: str, salts: int) -> DataFrame:
    gate = gate.select("container_number", "container_id", "container_size", "container_type",
                       "seal_number", "terminal_id", "event_id", gate_ts, "gate_id",
                       "truck_plate_no", "do_number", "gross_weight_kg", "nett_weight_kg",
                       "gate_status")
    crane = crane.select(F.col("container_id"), F.col("event_id"), F.col("crane_timestamp"),
                         F.col("crane_id"), F.col("crane_operation"), F.col("cycle_time_sec"),
                         F.col("load_cell_kg"), F.col("anomali_type"))
    flt = (F.col("crane_operation") == operation) if operation else None
    j = interval_join(gate, crane, keys=["container_id"], left_ts=gate_ts,
                      right_ts="crane_timestamp", lower_seconds=lower, upper_seconds=upper,
                      how="left", bucket_seconds=bucket_seconds, salts=salts, left_alias="g",
                      right_alias="c", right_filter=flt)
    g, c = (lambda n: F.col(f"g.{n}")), (lambda n: F.col(f"c.{n}"))
    start, end = (g(gate_ts), c("crane_timestamp")) if export else (c("crane_timestamp"), g(gate_ts))
    dwell = rules.dwell_hours(start, end)
    cols = [
        g("container_number"), g("container_id"), g("container_size"), g("container_type"),
        g("seal_number"), g("terminal_id"),
        g("event_id").alias(f"{prefix}_event_id"), g(gate_ts),
        g("gate_id").alias(f"{prefix}_gate_id"), g("truck_plate_no").alias(f"{prefix}_truck"),
        g("do_number"), g("gross_weight_kg").alias(f"{prefix}_gross_weight"),
        g("nett_weight_kg").alias(f"{prefix}_nett_weight"),
        g("gate_status").alias(f"{prefix}_status"),
        c("event_id").alias("crane_event_id"), c("crane_timestamp"), c("crane_id"),
        c("crane_operation"), c("cycle_time_sec"), c("load_cell_kg").alias("crane_load_kg"),
        c("anomali_type").alias("crane_anomaly"),
        dwell.alias("yard_dwell_time_hours"),
        rules.container_status(c("crane_timestamp"), g(gate_ts), matched_label)
        .alias("container_status"),
    ]
    if processing_time:
        cols.append(F.current_timestamp().alias("gold_processed_at"))
    # One projection (the rounded dwell is shared by codegen's subexpression
    # elimination); the category comes last, as in the source table.
    cols.append(rules.dwell_category(dwell, null_category=null_category).alias("dwell_time_category"))
    return j.select(*cols)


def export_flow(gate_in: DataFrame, crane: DataFrame, *, max_dwell_hours: int = 24,
                operation: str | None = None, processing_time: bool = True,
                bucket_seconds: int | None = None, null_category: str = "CRITICAL",
                salts: int = 1) -> DataFrame:
    """gold_container_export_flow: gate-in rows kept; crane LOAD expected later."""
    return _flow(gate_in, crane, gate_ts="gate_in_timestamp", prefix="gate_in",
                 matched_label="LOADED_TO_VESSEL", lower=0, upper=max_dwell_hours * HOUR,
                 export=True, operation=operation, processing_time=processing_time,
                 bucket_seconds=bucket_seconds, null_category=null_category, salts=salts)


def import_flow(gate_out: DataFrame, crane: DataFrame, *, max_dwell_hours: int = 24,
                operation: str | None = None, processing_time: bool = True,
                bucket_seconds: int | None = None, null_category: str = "CRITICAL",
                salts: int = 1) -> DataFrame:
    """gold_container_import_flow: gate-out rows kept; crane DISCHARGE expected earlier."""
    return _flow(gate_out, crane, gate_ts="gate_out_timestamp", prefix="gate_out",
                 matched_label="DISCHARGE_FROM_VESSEL", lower=-max_dwell_hours * HOUR, upper=0,
                 export=False, operation=operation, processing_time=processing_time,
                 bucket_seconds=bucket_seconds, null_category=null_category, salts=salts)
