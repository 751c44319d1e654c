"""Anomaly rules and OCR quality, re-derived from the measurements.

The producers inject anomalies and label them in `anomali_type`; these rules
detect them from the values themselves, one output row per (event, rule), so a
row breaking two rules appears twice and the declared label can be checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules

# Load-cell range (kg) per container type code; other codes use the default.
CONTAINER_WEIGHT_KG = {
    "1": (5000, 30480),   # Dry
    "2": (5000, 30480),   # Tunnel Type
    "3": (5000, 28000),   # Open Top
    "4": (4000, 25000),   # Flat Rack
    "5": (8000, 34000),   # Reefer
    "6": (5000, 30000),   # Barge
    "7": (5000, 30000),   # Bulk
    "8": (10000, 26000),  # ISO Tank
}
DEFAULT_WEIGHT_KG = (5000, 30000)
# Normal hoist speed (m/s).
HOIST_SPEED_MPS = (0.5, 1.2)
# Gross weights the weighbridge reports when it fails.
GROSS_WEIGHT_FAULTS = (0, 99999, -100)


def _range_lookup(code: Column, ranges: dict, idx: int, default: int) -> Column:
    """Lookup in a literal map: a fixed, tiny table evaluated in codegen (no join)."""
    m = F.create_map(*[x for k, v in ranges.items() for x in (F.lit(k), F.lit(v[idx]))])
    return F.coalesce(m[code], F.lit(default))


def _explode_rules(df: DataFrame, flags: list[tuple[str, Column]], keep: list) -> DataFrame:
    arr = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in flags]),
                   lambda x: x.isNotNull())
    return df.select(*keep, F.explode(arr).alias("detected_rule")) \
        .withColumn("matches_declared", F.col("detected_rule") == F.col("anomali_type"))


def crane_anomalies(crane: DataFrame, ranges: dict | None = None,
                    default: tuple = DEFAULT_WEIGHT_KG) -> DataFrame:
    """`ranges`: container type code -> (min kg, max kg); the fleet's table by default."""
    ranges = ranges or CONTAINER_WEIGHT_KG
    lo = _range_lookup(F.col("container_type"), ranges, 0, default[0])
    hi = _range_lookup(F.col("container_type"), ranges, 1, default[1])
    load, speed = F.col("load_cell_kg"), F.col("hoist_speed_mps")
    flags = [
        ("WEIGHT_EXTREME", (load < lo) | (load > hi)),
        ("SPEED_EXTREME", (speed < HOIST_SPEED_MPS[0]) | (speed > HOIST_SPEED_MPS[1])),
        ("MISSING_OCR", (F.coalesce(F.col("ocr_container_no"), F.lit("")) == "")
         & (F.col("ocr_confidence_score") == 0.0) & (F.col("ocr_status") == "FAILED")),
    ]
    keep = ["event_id", "crane_id", "terminal_id", "crane_timestamp", "container_id",
            "container_type", "load_cell_kg", "hoist_speed_mps", "anomali_type"]
    return _explode_rules(crane, flags, keep)


def gate_anomalies(gate: DataFrame, ts: str = "gate_in_timestamp") -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    flags = [
        # A plain misread keeps the tag; a failed reader returns none.
        ("RFID_FAILED", (F.col("truck_rfid_success") == F.lit(False)) & blank("truck_rfid_tag")),
        ("OCR_MISMATCH", ~blank("ocr_container_no")
         & (F.col("ocr_container_no") != F.col("container_number"))),
        ("WEIGHT_EXTREME", F.col("gross_weight_kg").isin(*GROSS_WEIGHT_FAULTS)),
        ("MISSING_DO", blank("do_number")),
    ]
    keep = ["event_id", "gate_id", "terminal_id", F.col(ts).alias("gate_timestamp"),
            "direction", "container_id", "truck_plate_no", "anomali_type"]
    return _explode_rules(gate, flags, keep)


def ocr_quality(df: DataFrame, source: str) -> DataFrame:
    """OCR status distribution with the confidence range per status and the rows
    whose status disagrees with their confidence band."""
    band = rules.ocr_band("ocr_confidence_score", "ocr_container_no")
    return df.groupBy(F.lit(source).alias("source"), "ocr_status").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("ocr_confidence_score").alias("min_confidence"),
        F.max("ocr_confidence_score").alias("max_confidence"),
        F.count_if(F.coalesce(F.col("ocr_container_no"), F.lit("")) == "").alias("blank_numbers"),
        F.count_if(band != F.col("ocr_status")).alias("band_mismatches"),
    )
