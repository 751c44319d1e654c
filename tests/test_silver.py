import json

from pyspark.sql import functions as F

from berthline import schemas
from berthline.operators import silver


def _bronze(spark, values, topic="gate_in_events"):
    rows = [(None if v is None else bytearray(v.encode()), topic) for v in values]
    return spark.createDataFrame(rows, "value binary, topic string") \
        .withColumn("timestamp", F.current_timestamp())


GOOD = {"event_id": "G1", "timestamp": "2024-01-01T10:00:00.123456+07:00", "gate_id": "GATE-01",
        "terminal_id": "T1", "direction": "IN",
        "truck": {"plate_no": "W-1", "rfid_tag": "R", "rfid_read_success": True,
                  "driver_id": "D", "do_number": "DO-1"},
        "ocr": {"container_no": "C1", "confidence_score": 0.97, "status": "SUCCESS"},
        "weight": {"gross_weight_kg": 30000, "tare_weight_kg": 20000, "nett_weight_kg": 10000},
        "container_ref": {"container_id": "1", "container_number": "C1"},
        "status": "APPROVED", "anomali_type": None, "extra_field": 5}


def test_gate_silver_parses_and_flattens(spark):
    df = silver.gate_in_silver(_bronze(spark, [json.dumps(GOOD)]), processing_time=False)
    r = df.collect()[0]
    assert [c for c, _ in silver.GATE_IN.columns] + ["kafka_timestamp", "topic"] == df.columns
    assert r.event_id == "G1" and r.truck_plate_no == "W-1" and r.gross_weight_kg == 30000
    assert r.gate_status == "APPROVED" and r.anomali_type is None
    # offset +07:00 -> 03:00:00.123456 UTC
    assert r.gate_in_timestamp.isoformat() == "2024-01-01T03:00:00.123456"


def test_permissive_parse_edge_rows(spark):
    bad_ts = dict(GOOD, timestamp="not a time")
    quoted = dict(GOOD, weight={"gross_weight_kg": "30000", "tare_weight_kg": 1.5,
                                "nett_weight_kg": 3000000000})
    no_struct = {k: v for k, v in GOOD.items() if k != "truck"}
    values = ["{not json", None, json.dumps(bad_ts), json.dumps(quoted), json.dumps(no_struct)]
    rows = silver.gate_in_silver(_bronze(spark, values), processing_time=False).collect()
    assert len(rows) == 5                                   # no row is dropped
    malformed, null_value, bad, q, ns = rows
    assert all(malformed[c] is None for c in ("event_id", "gate_id", "gate_in_timestamp"))
    assert null_value.event_id is None
    assert bad.event_id == "G1" and bad.gate_in_timestamp is None
    assert q.gross_weight_kg is None and q.tare_weight_kg is None and q.nett_weight_kg is None
    assert ns.truck_plate_no is None and ns.event_id == "G1"


def test_parse_errors_counts(spark):
    values = ["{not json", None, json.dumps(dict(GOOD, timestamp="x")), json.dumps(GOOD)]
    r = silver.parse_errors(_bronze(spark, values), silver.GATE_IN).collect()[0]
    assert (r.rows, r.null_payloads, r.malformed_payloads, r.bad_timestamps) == (4, 1, 1, 1)


def test_crane_schema_field_names_fixed():
    assert "anomali_type" in schemas.CRANE_EVENT.fieldNames()
    assert schemas.CRANE_EVENT["cycle_time_sec"].dataType.simpleString() == "bigint"
    assert schemas.GATE_EVENT["weight"].dataType["gross_weight_kg"].dataType.simpleString() == "int"
