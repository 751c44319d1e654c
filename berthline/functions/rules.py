"""Business rules as Column expressions (JVM-side, codegen'd; no UDFs).

Fixed values (thresholds, labels and code tables) must equal the source
system's, so they are stated together here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dwell-time category bounds in hours (strict "<").
DWELL_NORMAL_BELOW = 24
DWELL_DELAYED_BELOW = 48
DWELL_LONG_DELAY_BELOW = 72
# Crane performance rating (first match; strict ">").
POOR_ANOMALY_RATE_ABOVE = 10
FAIR_ANOMALY_RATE_ABOVE = 5
SLOW_AVG_CYCLE_ABOVE = 120
# Anomaly severity by daily count (">=").
SEVERITY_HIGH_AT = 10
SEVERITY_MEDIUM_AT = 5
# Gate traffic per hour (">=").
TRAFFIC_PEAK_AT = 50
TRAFFIC_BUSY_AT = 20
# Customs code tables.
PROCESS_TYPE_DESC = {"01": "IMPORT", "02": "EXPORT"}
TRANSPORT_MODE_DESC = {"01": "LAUT", "02": "UDARA", "03": "DARAT"}
# OCR confidence bands.
OCR_SUCCESS_AT = 0.95
OCR_LOW_CONFIDENCE_AT = 0.80


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dwell_hours(start, end) -> Column:
    """Hours between two timestamps, from whole epoch seconds, rounded HALF_UP to 2."""
    return F.round((F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 3600, 2)


def dwell_category(hours, normal_below=DWELL_NORMAL_BELOW, delayed_below=DWELL_DELAYED_BELOW,
                   long_delay_below=DWELL_LONG_DELAY_BELOW, null_category="CRITICAL") -> Column:
    """NORMAL / DELAYED / LONG_DELAY / CRITICAL.  A NULL dwell (no match) falls
    through every branch and is CRITICAL, as in the source; `null_category`
    lets a caller name it differently."""
    h = _c(hours)
    chain = (F.when(h < normal_below, "NORMAL")
             .when(h < delayed_below, "DELAYED")
             .when(h < long_delay_below, "LONG_DELAY"))
    if null_category != "CRITICAL":
        chain = chain.when(h.isNull(), null_category)
    return chain.otherwise("CRITICAL")


def container_status(matched_ts, own_ts, matched_label: str) -> Column:
    return (F.when(_c(matched_ts).isNotNull(), F.lit(matched_label))
            .when(_c(own_ts).isNotNull(), F.lit("IN_YARD"))
            .otherwise(F.lit("UNKNOWN")))


def performance_rating(anomaly_rate_pct, avg_cycle_time_sec) -> Column:
    r, c = _c(anomaly_rate_pct), _c(avg_cycle_time_sec)
    return (F.when(r > POOR_ANOMALY_RATE_ABOVE, "POOR")
            .when(r > FAIR_ANOMALY_RATE_ABOVE, "FAIR")
            .when(c > SLOW_AVG_CYCLE_ABOVE, "SLOW")
            .otherwise("GOOD"))


def anomaly_severity(total) -> Column:
    t = _c(total)
    return (F.when(t >= SEVERITY_HIGH_AT, "HIGH")
            .when(t >= SEVERITY_MEDIUM_AT, "MEDIUM")
            .otherwise("LOW"))


def peak_category(total, busy=TRAFFIC_BUSY_AT, peak=TRAFFIC_PEAK_AT) -> Column:
    t = _c(total)
    return F.when(t >= peak, "PEAK").when(t >= busy, "BUSY").otherwise("NORMAL")


def _lookup(table: dict, code) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(m[_c(code)], F.lit("UNKNOWN"))


def process_type_desc(code) -> Column:
    return _lookup(PROCESS_TYPE_DESC, code)


def transport_mode_desc(code) -> Column:
    return _lookup(TRANSPORT_MODE_DESC, code)


def epoch_to_iso(epoch) -> Column:
    """Epoch seconds -> ISO-8601 UTC text; NULL or 0 -> NULL."""
    ts = F.timestamp_seconds(F.nullif(_c(epoch), F.lit(0)))
    utc_wall = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc_wall, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def ocr_band(confidence, container_no) -> Column:
    """Expected OCR status from confidence: SUCCESS >= 0.95, LOW_CONFIDENCE
    0.80-0.94, FAILED below (with a blank number)."""
    s, n = _c(confidence), _c(container_no)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when((s >= OCR_SUCCESS_AT) & (F.coalesce(n, F.lit("")) != ""), "SUCCESS")
            .when((s >= OCR_LOW_CONFIDENCE_AT) & (F.coalesce(n, F.lit("")) != ""), "LOW_CONFIDENCE")
            .otherwise("FAILED"))
