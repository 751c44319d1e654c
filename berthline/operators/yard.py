"""Yard log, work orders, chronological log, operation counts, weight checks.

The source builds these in a simulator script (a Python list sorted in
memory); here they are table jobs over the silver events and manifests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import asof_latest
from .interval_join import interval_join

CONTAINER_REF_FIELDS = ("container_id", "container_number", "container_type",
                        "container_type_name", "container_size", "container_category",
                        "seal_number")


def moves(crane: DataFrame) -> DataFrame:
    """Crane moves with a readable OCR number (blank = OCR failed, skipped),
    DISCHARGE and LOAD."""
    read = crane.where((F.coalesce(F.col("ocr_container_no"), F.lit("")) != "")
                       & F.col("crane_operation").isin("DISCHARGE", "LOAD"))
    return read.select(
        "container_number", "container_id", F.col("crane_operation").alias("operation"),
        F.col("event_id").alias("crane_event_id"), "crane_id", "crane_timestamp",
        "load_cell_kg", F.struct(*CONTAINER_REF_FIELDS).alias("container_ref"))


def yard_log(crane: DataFrame, gate_in: DataFrame) -> DataFrame:
    """Crane moves; for LOAD the gate-in time is the container's latest gate-in at or
    before the crane event (the source invents one 1-4 h earlier)."""
    log = moves(crane)
    gin = gate_in.select("container_id", "gate_in_timestamp")
    loads = asof_latest(log.where(F.col("operation") == "LOAD"), gin, key="container_id",
                        left_ts="crane_timestamp", right_ts="gate_in_timestamp", values=[],
                        prefix="")
    discharges = log.where(F.col("operation") == "DISCHARGE") \
        .withColumn("gate_in_timestamp", F.lit(None).cast("timestamp"))
    cols = ["container_number", "container_id", "operation", "crane_event_id", "crane_id",
            "crane_timestamp", "gate_in_timestamp", "load_cell_kg", "container_ref"]
    return discharges.select(*cols).unionByName(loads.select(*cols))


def operation_counts(yard: DataFrame) -> DataFrame:
    """Totals of DISCHARGE and LOAD moves (one row); `moves` or a yard log."""
    return yard.agg(F.count_if(F.col("operation") == "DISCHARGE").alias("total_discharge"),
                    F.count_if(F.col("operation") == "LOAD").alias("total_load"))


def chronological(events: DataFrame, ts: str = "crane_timestamp",
                  tie: str = "event_id") -> DataFrame:
    """Events in time order: a global sort (range-partitioned by sampled
    boundaries, then sorted per partition), no single-task collect."""
    return events.orderBy(F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last())


def work_orders(imports: DataFrame, exports: DataFrame) -> DataFrame:
    """Import containers are discharged from the vessel, export containers loaded."""
    return (imports.withColumn("operation", F.lit("DISCHARGE"))
            .unionByName(exports.withColumn("operation", F.lit("LOAD"))))


def reconcile_weights(gate: DataFrame, crane: DataFrame, *, gate_ts: str = "gate_in_timestamp",
                      tolerance: int = 150, window_hours: int = 24) -> DataFrame:
    """Weighbridge vs crane load cell for each gate event and each crane move of
    the same container within `window_hours` after it (the export-flow match):
    gross must equal tare + nett, and nett must lie within +-tolerance kg of
    the crane's load."""
    g = gate.select("event_id", "container_id", "terminal_id", gate_ts, "gross_weight_kg",
                    "tare_weight_kg", "nett_weight_kg")
    c = crane.select("event_id", "container_id", "crane_timestamp", "load_cell_kg")
    j = interval_join(g, c, keys=["container_id"], left_ts=gate_ts, right_ts="crane_timestamp",
                      lower_seconds=0, upper_seconds=window_hours * 3600, how="inner",
                      left_alias="g", right_alias="c")
    nett, gross, tare = F.col("g.nett_weight_kg"), F.col("g.gross_weight_kg"), F.col("g.tare_weight_kg")
    dev = nett.cast("long") - F.col("c.load_cell_kg")
    return j.select(
        F.col("g.event_id").alias("gate_event_id"), F.col("c.event_id").alias("crane_event_id"),
        F.col("g.container_id").alias("container_id"), F.col("g.terminal_id").alias("terminal_id"),
        gross.alias("gross_weight_kg"), tare.alias("tare_weight_kg"), nett.alias("nett_weight_kg"),
        F.col("c.load_cell_kg").alias("crane_load_kg"),
        (gross.cast("long") == tare.cast("long") + nett.cast("long")).alias("gross_consistent"),
        dev.alias("nett_minus_load_kg"),
        (F.abs(dev) <= tolerance).alias("within_tolerance"),
    )
