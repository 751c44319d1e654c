"""Silver: parse Kafka-shaped bronze rows into typed, flattened event tables.

One generic parse (bytes -> text -> `from_json` with a fixed schema -> ISO
timestamp) and three flattening specs.  Stateless, so the same function
serves batch and streaming; Catalyst prunes the JSON fields a caller does
not select.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


@dataclass(frozen=True)
class SilverSpec:
    schema: T.StructType
    ts_name: str
    # (output name, payload path) in output order; "@ts" marks the parsed time.
    columns: tuple
    with_silver_timestamp: bool


CRANE = SilverSpec(
    schemas.CRANE_EVENT, "crane_timestamp",
    (("crane_timestamp", "@ts"), ("event_id", "event_id"), ("crane_id", "crane_id"),
     ("terminal_id", "terminal_id"), ("crane_operation", "operation"),
     ("spreader_height_m", "spreader_height_m"), ("trolley_position_m", "trolley_position_m"),
     ("hoist_speed_mps", "hoist_speed_mps"), ("cycle_time_sec", "cycle_time_sec"),
     ("load_cell_kg", "load_cell_kg"), ("spreader_locked", "spreader_locked"),
     ("gps_lat", "gps_lat"), ("gps_lng", "gps_lng"), ("anomali_type", "anomali_type"),
     ("ocr_container_no", "ocr.container_no"),
     ("ocr_confidence_score", "ocr.confidence_score"), ("ocr_status", "ocr.status"),
     ("container_id", "container_ref.container_id"),
     ("container_number", "container_ref.container_number"),
     ("container_type", "container_ref.container_type"),
     ("container_type_name", "container_ref.container_type_name"),
     ("container_size", "container_ref.container_size"),
     ("container_category", "container_ref.container_category"),
     ("seal_number", "container_ref.seal_number")),
    with_silver_timestamp=False,
)


def _gate_columns(ts_name: str) -> tuple:
    return (
        ("event_id", "event_id"), (ts_name, "@ts"), ("gate_id", "gate_id"),
        ("terminal_id", "terminal_id"), ("direction", "direction"),
        ("truck_plate_no", "truck.plate_no"), ("truck_rfid_tag", "truck.rfid_tag"),
        ("truck_rfid_success", "truck.rfid_read_success"), ("driver_id", "truck.driver_id"),
        ("do_number", "truck.do_number"), ("ocr_container_no", "ocr.container_no"),
        ("ocr_confidence_score", "ocr.confidence_score"), ("ocr_status", "ocr.status"),
        ("gross_weight_kg", "weight.gross_weight_kg"),
        ("tare_weight_kg", "weight.tare_weight_kg"),
        ("nett_weight_kg", "weight.nett_weight_kg"),
        ("container_id", "container_ref.container_id"),
        ("container_number", "container_ref.container_number"),
        ("container_type", "container_ref.container_type"),
        ("container_type_name", "container_ref.container_type_name"),
        ("container_size", "container_ref.container_size"),
        ("container_category", "container_ref.container_category"),
        ("seal_number", "container_ref.seal_number"),
        ("gate_status", "status"), ("anomali_type", "anomali_type"),
    )


GATE_IN = SilverSpec(schemas.GATE_EVENT, "gate_in_timestamp",
                     _gate_columns("gate_in_timestamp"), with_silver_timestamp=True)
GATE_OUT = SilverSpec(schemas.GATE_EVENT, "gate_out_timestamp",
                      _gate_columns("gate_out_timestamp"), with_silver_timestamp=True)

SPECS = {"crane": CRANE, "gate_in": GATE_IN, "gate_out": GATE_OUT}


def parse_payload(bronze: DataFrame, schema: T.StructType) -> DataFrame:
    """bytes -> text -> struct.  PERMISSIVE: malformed JSON gives a struct of
    NULLs (row kept), a NULL value gives a NULL struct."""
    return bronze.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("topic"),
    )


def event_time(text: Column) -> Column:
    """ISO-8601 text with offset -> TIMESTAMP; unparsable text -> NULL (not an error)."""
    return F.try_to_timestamp(text)


def to_silver(bronze: DataFrame, spec: SilverSpec, processing_time: bool = True) -> DataFrame:
    parsed = parse_payload(bronze, spec.schema)
    cols = []
    for out, path in spec.columns:
        if path == "@ts":
            cols.append(event_time(F.col("data.timestamp")).alias(out))
        else:
            cols.append(F.col(f"data.{path}").alias(out))
    cols += [F.col("kafka_timestamp"), F.col("topic")]
    if spec.with_silver_timestamp and processing_time:
        cols.append(F.current_timestamp().alias("silver_timestamp"))
    return parsed.select(*cols)


def crane_silver(bronze: DataFrame, processing_time: bool = True) -> DataFrame:
    return to_silver(bronze, CRANE, processing_time)


def gate_in_silver(bronze: DataFrame, processing_time: bool = True) -> DataFrame:
    return to_silver(bronze, GATE_IN, processing_time)


def gate_out_silver(bronze: DataFrame, processing_time: bool = True) -> DataFrame:
    return to_silver(bronze, GATE_OUT, processing_time)


def parse_errors(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Per-topic parse quality: rows, NULL payloads, malformed payloads (all
    fields NULL), and unparsable or missing event times."""
    parsed = parse_payload(bronze, spec.schema)
    names = [f.name for f in spec.schema.fields]
    all_null = F.lit(True)
    for n in names:
        all_null = all_null & F.col(f"data.{n}").isNull()
    bad_ts = F.col("data.timestamp").isNotNull() & event_time(F.col("data.timestamp")).isNull()
    return parsed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("data").isNull()).alias("null_payloads"),
        F.count_if(F.col("data").isNotNull() & all_null).alias("malformed_payloads"),
        F.count_if(bad_ts).alias("bad_timestamps"),
        F.count_if(F.col("data.timestamp").isNull()).alias("missing_timestamps"),
        F.count_if(F.col("data.event_id").isNull()).alias("missing_event_ids"),
    )
