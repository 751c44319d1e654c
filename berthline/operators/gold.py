"""Gold aggregates: crane performance, anomaly summary, daily terminal KPIs,
hourly gate traffic.  Plain DataFrame aggregations: Spark plans each as a
partial (map-side) + final hash aggregate, so a hot crane or terminal is
pre-aggregated before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules


PERFORMANCE_KEYS = ["crane_id", "terminal_id", "operation_date", "operation_hour", "crane_operation"]
ANOMALY_KEYS = ["crane_id", "terminal_id", "anomali_type", "date"]


def _is_anomaly() -> Column:
    return F.when(F.col("anomali_type").isNotNull(), 1).otherwise(0)


def crane_performance(crane: DataFrame, processing_time: bool = True) -> DataFrame:
    """Per crane, terminal, date, hour and operation.

    `estimated_moves_per_hour` is total_moves * 3600 / max cycle, as defined
    by the source (not a rate); a max cycle of 0 gives NULL instead of a
    division error."""
    n = F.count(F.lit(1))
    anomalies = F.sum(_is_anomaly())
    aggs = [
        n.alias("total_moves"),
        F.round(F.avg("cycle_time_sec"), 2).alias("avg_cycle_time_sec"),
        F.min("cycle_time_sec").alias("min_cycle_time_sec"),
        F.max("cycle_time_sec").alias("max_cycle_time_sec"),
        F.round(n / 1.0 * F.try_divide(F.lit(3600.0), F.max("cycle_time_sec").cast("double")), 2)
        .alias("estimated_moves_per_hour"),
        F.round(F.avg("load_cell_kg"), 2).alias("avg_load_kg"),
        F.max("load_cell_kg").alias("max_load_kg"),
        anomalies.alias("anomaly_count"),
        F.round(anomalies / n * 100, 2).alias("anomaly_rate_pct"),
    ]
    if processing_time:
        aggs.append(F.current_timestamp().alias("gold_processed_at"))
    out = crane.groupBy(
        "crane_id", "terminal_id",
        F.to_date("crane_timestamp").alias("operation_date"),
        F.hour("crane_timestamp").alias("operation_hour"),
        "crane_operation",
    ).agg(*aggs)
    return out.withColumn("performance_rating",
                          rules.performance_rating("anomaly_rate_pct", "avg_cycle_time_sec"))


def anomaly_summary(crane: DataFrame, processing_time: bool = True) -> DataFrame:
    aggs = [
        F.count(F.lit(1)).alias("total_anomalies"),
        F.round(F.avg("cycle_time_sec"), 2).alias("avg_cycle_time_when_anomaly"),
        F.round(F.avg("load_cell_kg"), 2).alias("avg_load_when_anomaly"),
        F.max("load_cell_kg").alias("max_load_when_anomaly"),
        F.max("crane_timestamp").alias("last_anomaly_time"),
        F.min("crane_timestamp").alias("first_anomaly_time"),
    ]
    if processing_time:
        aggs.append(F.current_timestamp().alias("gold_processed_at"))
    out = (crane.where(F.col("anomali_type").isNotNull())
           .groupBy("crane_id", "terminal_id", "anomali_type",
                    F.to_date("crane_timestamp").alias("date"))
           .agg(*aggs))
    return out.withColumn("anomaly_severity", rules.anomaly_severity("total_anomalies"))


def exact_avg_hundredths(col: str) -> Column:
    """round(avg(x), 2) for x holding 2-decimal values, computed exactly.

    A double `avg` sums in partition order, so a mean on a .xx5 tie rounds
    either way depending on the cluster layout; summing integer hundredths and
    rounding the exact mean HALF_UP (integer `div`) gives one answer everywhere."""
    k = f"CAST(round(`{col}` * 100) AS BIGINT)"
    s, n = f"sum({k})", f"count({k})"
    return F.expr(f"CASE WHEN {n} > 0 THEN sign({s}) * ((2 * abs({s}) + {n}) div (2 * {n})) / 100 END")


def _flow_daily(flow: DataFrame, ts: str, side: str) -> DataFrame:
    cat = F.col("dwell_time_category")
    cnt = lambda v: F.sum(F.when(cat == v, 1).otherwise(0))
    return flow.groupBy("terminal_id", F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias(f"total_{side}_containers"),
        exact_avg_hundredths("yard_dwell_time_hours").alias(f"avg_{side}_dwell_hours"),
        F.max("yard_dwell_time_hours").alias(f"max_{side}_dwell_hours"),
        cnt("NORMAL").alias(f"{side}_normal_count"),
        cnt("DELAYED").alias(f"{side}_delayed_count"),
        cnt("LONG_DELAY").alias(f"{side}_long_delay_count"),
        cnt("CRITICAL").alias(f"{side}_critical_count"),
    )


def crane_daily(crane: DataFrame) -> DataFrame:
    """Daily crane moves with an exact distinct crane count.

    Pre-aggregated per (terminal, date, crane) first, so the distinct count is
    a plain count of a tiny second level instead of an Expand over every
    event; both levels are partial+final hash aggregates."""
    per_crane = crane.groupBy("terminal_id", F.to_date("crane_timestamp").alias("date"),
                              "crane_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("cycle_time_sec").alias("_cyc_sum"),
        F.count("cycle_time_sec").alias("_cyc_n"),
        F.sum(_is_anomaly()).alias("_anom"),
    )
    return per_crane.groupBy("terminal_id", "date").agg(
        F.sum("_n").alias("total_crane_moves"),
        F.count("crane_id").alias("active_cranes"),
        F.round(F.try_divide(F.sum("_cyc_sum").cast("double"), F.sum("_cyc_n")), 2)
        .alias("avg_cycle_time_sec"),
        F.sum("_anom").alias("total_anomalies"),
    )


def terminal_daily_summary(export: DataFrame, imports: DataFrame, crane: DataFrame,
                           processing_time: bool = True) -> DataFrame:
    """Export summary FULL JOIN import summary, then LEFT JOIN crane summary on
    (terminal_id, date).  Days with crane moves but no flows are dropped, as in
    the source.  All three inputs are aggregated before joining, so the joins
    see one row per terminal-day."""
    ex = _flow_daily(export, "gate_in_timestamp", "export")
    im = _flow_daily(imports, "gate_out_timestamp", "import")
    out = (ex.join(im, ["terminal_id", "date"], "full")
           .join(crane_daily(crane), ["terminal_id", "date"], "left"))
    extra = [(F.coalesce(F.col("total_export_containers"), F.lit(0))
              + F.coalesce(F.col("total_import_containers"), F.lit(0))).alias("total_throughput")]
    if processing_time:
        extra.append(F.current_timestamp().alias("gold_processed_at"))
    return out.select("*", *extra)


def _hourly(gate: DataFrame, ts: str, side: str, window: str) -> DataFrame:
    return gate.groupBy("terminal_id", "gate_id", F.window(ts, window).alias("window")).agg(
        F.count(F.lit(1)).alias(f"vehicles_{side}"),
        F.approx_count_distinct("truck_plate_no").alias(f"unique_trucks_{side}"),
    )


def gate_hourly_traffic(gate_in: DataFrame, gate_out: DataFrame, *, busy: int = 20,
                        peak: int = 50, window: str = "1 hour",
                        processing_time: bool = True) -> DataFrame:
    tin = _hourly(gate_in, "gate_in_timestamp", "in", window).alias("tin")
    tout = _hourly(gate_out, "gate_out_timestamp", "out", window).alias("tout")
    j = tin.join(tout, (F.col("tin.terminal_id") == F.col("tout.terminal_id"))
                 & (F.col("tin.gate_id") == F.col("tout.gate_id"))
                 & (F.col("tin.window") == F.col("tout.window")), "full")
    out = j.select(
        F.coalesce("tin.terminal_id", "tout.terminal_id").alias("terminal_id"),
        F.coalesce("tin.gate_id", "tout.gate_id").alias("gate_id"),
        F.coalesce("tin.window", "tout.window").alias("window"),
        "tin.vehicles_in", "tin.unique_trucks_in", "tout.vehicles_out", "tout.unique_trucks_out",
    )
    total: Column = (F.coalesce(F.col("vehicles_in"), F.lit(0))
                     + F.coalesce(F.col("vehicles_out"), F.lit(0)))
    cols = [F.col("terminal_id"), F.col("gate_id"),
            F.to_date(F.col("window.start")).alias("date"),
            F.hour(F.col("window.start")).alias("hour"), F.col("window"),
            F.col("vehicles_in"), F.col("unique_trucks_in"), F.col("vehicles_out"),
            F.col("unique_trucks_out"), total.alias("total_traffic"),
            rules.peak_category(total, busy, peak).alias("peak_category")]
    if processing_time:
        cols.append(F.current_timestamp().alias("gold_processed_at"))
    return out.select(*cols)


SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)      # relative standard error


def gate_hourly_sketches(gate: DataFrame, ts: str, window: str = "1 hour") -> DataFrame:
    """Hourly vehicles and a mergeable sketch of the trucks at every gate, to be stored: counts of
    trucks do not add up over hours, sketches do.  Batch, or a stream with a watermark on `ts`."""
    return gate.groupBy("terminal_id", "gate_id", F.window(ts, window).alias("window")).agg(
        F.count(F.lit(1)).alias("vehicles"), F.hll_sketch_agg("truck_plate_no", F.lit(SKETCH_BITS)).alias("truck_sketch"))


def truck_rollup(sketches: DataFrame, period: str) -> DataFrame:
    """Vehicles and distinct trucks per gate and `period` (day, week, month, quarter, year), from
    stored hourly sketches alone."""
    units = ("day", "week", "month", "quarter", "year")
    if period not in units:
        raise ValueError(f"period must be one of {', '.join(units)}")
    start = F.to_date(F.date_trunc(period, F.col("window.start")))
    return sketches.groupBy("terminal_id", "gate_id", start.alias("period")).agg(
        F.sum("vehicles").alias("vehicles"),
        F.hll_sketch_estimate(F.hll_union_agg("truck_sketch")).alias("trucks"))
