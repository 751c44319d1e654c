"""Wire schemas of the event payloads, applied with `from_json` (schema on read).

Fixed values: field names, order and types must equal the producers' payloads,
including the misspelled `anomali_type`.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


OCR = _struct(("container_no", S), ("confidence_score", D), ("status", S))

CONTAINER_REF = _struct(
    ("container_id", S), ("container_number", S), ("container_type", S),
    ("container_type_name", S), ("container_size", S), ("container_category", S),
    ("seal_number", S),
)

CRANE_EVENT = _struct(
    ("event_id", S), ("timestamp", S), ("crane_id", S), ("terminal_id", S),
    ("operation", S), ("spreader_height_m", D), ("trolley_position_m", D),
    ("hoist_speed_mps", D), ("cycle_time_sec", L), ("load_cell_kg", L),
    ("spreader_locked", B), ("gps_lat", D), ("gps_lng", D), ("anomali_type", S),
    ("ocr", OCR), ("container_ref", CONTAINER_REF),
)

TRUCK = _struct(("plate_no", S), ("rfid_tag", S), ("rfid_read_success", B),
                ("driver_id", S), ("do_number", S))

WEIGHT = _struct(("gross_weight_kg", I), ("tare_weight_kg", I), ("nett_weight_kg", I))

# Gate-in and gate-out share one payload schema.
GATE_EVENT = _struct(
    ("event_id", S), ("timestamp", S), ("gate_id", S), ("terminal_id", S),
    ("direction", S), ("truck", TRUCK), ("ocr", OCR), ("weight", WEIGHT),
    ("container_ref", CONTAINER_REF), ("status", S), ("anomali_type", S),
)

# Kafka source row shape.
KAFKA_ROW = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", S, True),
    T.StructField("partition", I, True),
    T.StructField("offset", L, True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", I, True),
])

MANIFEST_CONTAINER = _struct(
    ("container_id", S), ("container_number", S), ("container_type", S),
    ("container_type_name", S), ("container_size", S), ("container_category", S),
    ("seal_number", S), ("status_code", S),
)

MANIFEST = T.StructType(
    [T.StructField(n, S, True) for n in (
        "vessel_id", "vessel_name", "imo_number", "call_sign", "mmsi_number", "voyage",
        "process_type", "transport_mode", "terminal_code", "customs_office_code",
        "captain_name")]
    + [T.StructField("eta", L, True), T.StructField("etd", L, True),
       T.StructField("containers", T.ArrayType(MANIFEST_CONTAINER, True), True)]
)

# Topic names of the three event streams.
TOPIC_CRANE = "crane_events"
TOPIC_GATE_IN = "gate_in_events"
TOPIC_GATE_OUT = "gate_out_events"
