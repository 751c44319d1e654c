"""Time buckets in exact integer arithmetic (shared by the join operators)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_bucket(ts_name: str, width_us: int, shift_us: int = 0) -> Column:
    """floor((epoch_us(ts) - shift) / width) as BIGINT; NULL time -> NULL."""
    x = f"(unix_micros(`{ts_name}`) - {shift_us})"
    return F.expr(f"({x} - pmod({x}, {width_us})) div {width_us}")
