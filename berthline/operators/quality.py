"""Expectations: warn-only row checks (rows are never dropped).

`expect` attaches an `Observation` (counts gathered while the data flows
through whatever action or stream writes it, batch or streaming);
`expectation_counts` is the same as a distributed aggregate for reports.
Each predicate yields three counts: passed, failed and NULL (a predicate over
NULL input is neither; the source does not say how it treats NULL, so no
policy is baked in).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# The pipeline's expectations per gold table.
EXPECTATIONS = {
    "gold_container_export_flow": {
        "valid_container_number": "container_number IS NOT NULL",
        "valid_dwell_time": "yard_dwell_time_hours >= 0 OR yard_dwell_time_hours IS NULL",
        "valid_operation": "crane_operation IN ('LOAD', 'DISCHARGE')",
    },
    "gold_container_import_flow": {
        "valid_container_number": "container_number IS NOT NULL",
        "valid_dwell_time": "yard_dwell_time_hours >= 0 OR yard_dwell_time_hours IS NULL",
        "valid_operation": "crane_operation IN ('LOAD', 'DISCHARGE')",
    },
    "gold_crane_performance": {
        "valid_crane_id": "crane_id IS NOT NULL",
        "valid_total_moves": "total_moves > 0",
    },
    "gold_anomaly_summary": {
        "valid_anomaly_type": "anomali_type IS NOT NULL",
    },
    "gold_terminal_daily_summary": {
        "valid_terminal": "terminal_id IS NOT NULL",
        "valid_date": "date IS NOT NULL",
    },
    "gold_gate_hourly_traffic": {
        "valid_gate": "gate_id IS NOT NULL",
    },
}


def counts(name: str, predicate: str):
    p = F.expr(f"({predicate})")
    return [F.count_if(p).alias(f"{name}__passed"),
            F.count_if(~p).alias(f"{name}__failed"),
            F.count_if(p.isNull()).alias(f"{name}__null")]


def expect(df: DataFrame, checks: dict[str, str], name: str = "expectations"):
    """Return (df with an observation attached, Observation).  Read the counts
    with `obs.get` after an action / streaming batch has run."""
    obs = Observation(name)
    aggs = [c for n, p in checks.items() for c in counts(n, p)]
    return df.observe(obs, *aggs), obs


def expectation_counts(table: str, df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """One row per expectation: table, expectation, passed, failed, null_result."""
    aggs = [c for n, p in checks.items() for c in counts(n, p)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__passed`, `{n}__failed`, `{n}__null`" for n in checks)
    return wide.selectExpr(
        f"'{table}' AS table_name",
        f"stack({len(checks)}, {stack}) AS (expectation, passed, failed, null_result)")
