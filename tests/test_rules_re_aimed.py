from berthline.operators import anomalies, manifest, yard
from helpers import silver_rows


def test_crane_anomaly_rules(spark):
    rows = [
        {"event_id": "w0", "container_type": "8", "load_cell_kg": 9999, "hoist_speed_mps": 1.0},
        {"event_id": "w1", "container_type": "8", "load_cell_kg": 10000, "hoist_speed_mps": 1.0},
        {"event_id": "w2", "container_type": "9", "load_cell_kg": 30001, "hoist_speed_mps": 1.0},
        {"event_id": "s", "container_type": "1", "load_cell_kg": 6000, "hoist_speed_mps": 2.5,
         "anomali_type": "SPEED_EXTREME"},
        {"event_id": "two", "container_type": "1", "load_cell_kg": 99999, "hoist_speed_mps": 3.0,
         "ocr_container_no": "", "ocr_confidence_score": 0.0, "ocr_status": "FAILED"},
        {"event_id": "f", "container_type": "1", "load_cell_kg": 6000, "hoist_speed_mps": 1.0,
         "ocr_container_no": "", "ocr_confidence_score": 0.42, "ocr_status": "FAILED"},
    ]
    out = sorted((r.event_id, r.detected_rule) for r in
                 anomalies.crane_anomalies(silver_rows(spark, "crane", rows)).collect())
    assert out == [("s", "SPEED_EXTREME"), ("two", "MISSING_OCR"), ("two", "SPEED_EXTREME"),
                   ("two", "WEIGHT_EXTREME"), ("w0", "WEIGHT_EXTREME"), ("w2", "WEIGHT_EXTREME")]


def test_gate_anomaly_rules(spark):
    base = {"container_number": "C1", "ocr_container_no": "C1", "do_number": "DO",
            "truck_rfid_tag": "R1", "truck_rfid_success": True, "gross_weight_kg": 30000}
    rows = [dict(base, event_id="rf", truck_rfid_success=False, truck_rfid_tag=""),
            dict(base, event_id="misread", truck_rfid_success=False),        # tag kept
            dict(base, event_id="ocr", ocr_container_no="MSCU1234567"),
            dict(base, event_id="blank_ocr", ocr_container_no=""),
            dict(base, event_id="w", gross_weight_kg=-100),
            dict(base, event_id="do", do_number="")]
    out = sorted((r.event_id, r.detected_rule) for r in
                 anomalies.gate_anomalies(silver_rows(spark, "gate_in", rows)).collect())
    assert out == [("do", "MISSING_DO"), ("ocr", "OCR_MISMATCH"), ("rf", "RFID_FAILED"),
                   ("w", "WEIGHT_EXTREME")]


def test_yard_log_latest_gate_in(spark):
    crane = silver_rows(spark, "crane", [
        {"event_id": "L", "container_id": "A", "container_number": "CA", "crane_operation": "LOAD",
         "crane_timestamp": "2024-01-05T10:00:00", "ocr_container_no": "CA"},
        {"event_id": "D", "container_id": "B", "container_number": "CB",
         "crane_operation": "DISCHARGE", "crane_timestamp": "2024-01-05T10:00:00",
         "ocr_container_no": "CB"},
        {"event_id": "F", "container_id": "A", "crane_operation": "LOAD",
         "crane_timestamp": "2024-01-05T11:00:00", "ocr_container_no": ""}])      # OCR failed
    gin = silver_rows(spark, "gate_in", [
        {"event_id": "g1", "container_id": "A", "gate_in_timestamp": "2024-01-01T08:00:00"},
        {"event_id": "g2", "container_id": "A", "gate_in_timestamp": "2024-01-03T08:00:00"},
        {"event_id": "g3", "container_id": "A", "gate_in_timestamp": "2024-01-06T08:00:00"}])
    y = {r.crane_event_id: r for r in yard.yard_log(crane, gin).collect()}
    assert set(y) == {"L", "D"}
    assert str(y["L"].gate_in_timestamp) == "2024-01-03 08:00:00"
    assert y["D"].gate_in_timestamp is None and y["L"].container_ref.container_number == "CA"
    c = yard.operation_counts(yard.yard_log(crane, gin)).collect()[0]
    assert (c.total_discharge, c.total_load) == (1, 1)


def test_manifest_summary_and_schedule(spark, tmp_path):
    import json
    docs = [
        {"vessel_id": "V1", "process_type": "01", "transport_mode": "01", "eta": 1704067200,
         "etd": 0, "voyage": "0123S",
         "containers": [{"container_id": "1", "container_size": "20", "container_type": "1",
                         "status_code": "F"},
                        {"container_id": "2", "container_size": "40", "container_type": "1"}]},
        {"vessel_id": "V2", "process_type": "02", "transport_mode": "07", "containers": []},
    ]
    for i, d in enumerate(docs):
        (tmp_path / f"m{i}.json").write_text(json.dumps(d, indent=2))
    from berthline.sources import bronze
    m = bronze.read_manifests(spark, str(tmp_path))
    s = {(r.vessel_id, r.dimension, r.value): r.containers
         for r in manifest.manifest_summary(m).collect()}
    assert s[("V1", "total", "all")] == 2 and s[("V2", "total", "all")] == 0
    assert s[("V1", "by_status", "unknown")] == 1 and s[("V1", "by_size", "40")] == 1
    assert not any(k[0] == "V2" and k[1] != "total" for k in s)
    sched = {r.vessel_id: r for r in manifest.vessel_schedule(m).collect()}
    v1 = sched["V1"]
    assert v1.process_type_desc == "IMPORT" and v1.voyage_number == "0123S"
    assert v1.schedule.eta == "2024-01-01T00:00:00+00:00" and v1.schedule.etd is None
    assert v1.containers_summary.total == 2 and v1.containers_summary.by_type == {"1": 2}
    assert sched["V2"].transport_mode_desc == "UNKNOWN" and sched["V2"].containers_summary.total == 0
    assert sched["V2"].schedule.eta is None
    import pytest
    with pytest.raises(ValueError):
        manifest.vessel_schedule_by_type(manifest.vessel_schedule(m), "03")
    assert manifest.vessel_schedule_by_type(manifest.vessel_schedule(m), "02").count() == 1


def test_schedule_skips_missing_manifest(spark, tmp_path):
    import json
    from berthline.sources import bronze
    (tmp_path / "import").mkdir()
    (tmp_path / "import" / "m.json").write_text(json.dumps(
        {"vessel_id": "V1", "process_type": "01", "containers": [{"container_id": "1"}]}, indent=2))
    m = bronze.read_existing_manifests(spark, [str(tmp_path / "import"), str(tmp_path / "export")])
    s = manifest.vessel_schedule(m)
    assert s.count() == 1 and s.collect()[0].containers_summary.total == 1
    assert bronze.read_existing_manifests(spark, [str(tmp_path / "none")]) is None


def test_schedule_grain_is_the_whole_header(spark):
    """Voyages of one vessel, and manifests without a process type, stay apart; unknown types stay."""
    from berthline import schemas
    c = [("1", "n", "t", "T", "20", "FULL", "s", "F")] * 8

    def doc(vessel, voyage, process, n, eta=1704067200):
        return (vessel, "MV", "imo", "call", "mmsi", voyage, process, "01", "term", "office", "captain", eta, 0,
                None if n is None else c[:n])
    rows = [doc("V1", "001N", "01", 3), doc("V1", "002N", "01", 5), doc("V1", "001N", None, 2),
            doc("V2", "001N", "07", 1), doc("V3", None, "02", None), doc("V1", "001N", "01", 4)]
    docs = spark.createDataFrame(rows, schemas.MANIFEST)
    s = manifest.vessel_schedule(docs)
    got = {(r.vessel_id, r.voyage_number, r.process_type): r for r in s.collect()}
    assert len(got) == 5 == s.count()
    total = {k: r.containers_summary.total for k, r in got.items()}
    assert total == {("V1", "001N", "01"): 7, ("V1", "002N", "01"): 5, ("V1", "001N", None): 2,
                     ("V2", "001N", "07"): 1, ("V3", None, "02"): 0}
    assert got[("V1", "001N", "01")].containers_summary.by_type == {"t": 7}
    assert got[("V3", None, "02")].containers_summary.by_size == {}
    assert got[("V2", "001N", "07")].process_type_desc == "UNKNOWN"
    counts = {(r.process_type, r.all_types): r.total for r in manifest.schedule_total(s).collect()}
    assert counts == {(None, True): 5, ("01", False): 2, ("02", False): 1, ("07", False): 1, (None, False): 1}
