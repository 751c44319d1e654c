"""Oracle SQL (DuckDB dialect) for the registered queries.

The silver relations are built straight from the parquet `events` table with
the adapter's own field expressions (`sources.testdata`), so the Spark path
(JSON bytes -> parse -> flatten -> gold) is checked end to end against an
independent relational evaluation.

Rounding: Spark rounds a double by its shortest decimal text, HALF_UP.  For
averages of integers and for dwell times the exact rational is rounded with
integer arithmetic; other doubles are rounded through their decimal text.
"""

from __future__ import annotations

from ..sources import testdata as td

SQL: dict[str, str] = {}


def _sel(fields: dict, prefix: str = "", rename: dict | None = None) -> list[str]:
    rename = rename or {}
    return [f"{e} AS {rename.get(n, prefix + n)}" for n, e in fields.items()]


def crane_silver_sql() -> str:
    c, o, r = td.CRANE, td.CRANE_OCR, td.CONTAINER_REF
    cols = ["ts AS crane_timestamp", f"{c['event_id']} AS event_id",
            f"{c['crane_id']} AS crane_id", f"{c['terminal_id']} AS terminal_id",
            f"{c['operation']} AS crane_operation"]
    for n in ("spreader_height_m", "trolley_position_m", "hoist_speed_mps", "cycle_time_sec",
              "load_cell_kg", "spreader_locked", "gps_lat", "gps_lng", "anomali_type"):
        cols.append(f"{c[n]} AS {n}")
    cols += _sel(o, "ocr_", {"container_no": "ocr_container_no",
                             "confidence_score": "ocr_confidence_score", "status": "ocr_status"})
    cols += _sel(r)
    cols += ["ts AS kafka_timestamp", "'crane_events' AS topic"]
    return f"SELECT {', '.join(cols)} FROM events WHERE {td.CRANE_PREDICATE}"


def gate_silver_sql(direction: str) -> str:
    g = td.GATE_IN if direction == "in" else td.GATE_OUT
    pred = td.GATE_IN_PREDICATE if direction == "in" else td.GATE_OUT_PREDICATE
    topic = "gate_in_events" if direction == "in" else "gate_out_events"
    t, o, w, r = td.TRUCK, td.GATE_OCR, td.WEIGHT, td.CONTAINER_REF
    cols = [f"{g['event_id']} AS event_id", f"ts AS gate_{direction}_timestamp",
            f"{g['gate_id']} AS gate_id", f"{g['terminal_id']} AS terminal_id",
            f"{g['direction']} AS direction",
            f"{t['plate_no']} AS truck_plate_no", f"{t['rfid_tag']} AS truck_rfid_tag",
            f"{t['rfid_read_success']} AS truck_rfid_success", f"{t['driver_id']} AS driver_id",
            f"{t['do_number']} AS do_number",
            f"{o['container_no']} AS ocr_container_no",
            f"{o['confidence_score']} AS ocr_confidence_score", f"{o['status']} AS ocr_status",
            f"{w['gross_weight_kg']} AS gross_weight_kg",
            f"{w['tare_weight_kg']} AS tare_weight_kg", f"{w['nett_weight_kg']} AS nett_weight_kg"]
    cols += _sel(r)
    cols += [f"{g['status']} AS gate_status", f"{g['anomali_type']} AS anomali_type",
             "ts AS kafka_timestamp", f"'{topic}' AS topic"]
    return f"SELECT {', '.join(cols)} FROM events WHERE {pred}"


def silver_ctes() -> str:
    return (f"crane AS ({crane_silver_sql()}), "
            f"gate_in AS ({gate_silver_sql('in')}), "
            f"gate_out AS ({gate_silver_sql('out')})")


# ------------------------------------------------------------- rounding helpers
def sround(x: str, d: int = 2) -> str:
    """Spark's round(double, d): HALF_UP on the shortest decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 16)), {d}) AS DOUBLE)"


def avg_int_round(col: str) -> str:
    """round(avg(integer column), 2) exactly: HALF_UP of sum/count."""
    s, n = f"sum({col})", f"count({col})"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(sign({s}) * ((200 * abs({s}) + {n}) "
            f"// (2 * {n})) AS DOUBLE) / 100 END")


def hundredths_avg_round(k: str) -> str:
    """round(avg(x), 2) where x = k / 100 with integer k."""
    s, n = f"sum({k})", f"count({k})"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(sign({s}) * ((2 * abs({s}) + {n}) "
            f"// (2 * {n})) AS DOUBLE) / 100 END")


def dwell_k(start: str, end: str) -> str:
    """Dwell in hundredths of an hour, HALF_UP, from whole epoch seconds."""
    secs = f"(CAST(floor(epoch({end})) AS BIGINT) - CAST(floor(epoch({start})) AS BIGINT))"
    return f"(sign({secs}) * ((abs({secs}) + 18) // 36))"


def dwell_category_sql(h: str) -> str:
    return (f"CASE WHEN {h} < 24 THEN 'NORMAL' WHEN {h} < 48 THEN 'DELAYED' "
            f"WHEN {h} < 72 THEN 'LONG_DELAY' ELSE 'CRITICAL' END")


# ------------------------------------------------------------- silver keys
SQL["silver_crane"] = f"SELECT * FROM ({crane_silver_sql()})"
SQL["silver_gate_in"] = f"SELECT * FROM ({gate_silver_sql('in')})"
SQL["silver_gate_out"] = f"SELECT * FROM ({gate_silver_sql('out')})"


# The payload as it is on the wire: ISO text for the time, nested records.
_ISO_TS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"
_CRANE_PAYLOAD = [("timestamp", _ISO_TS), *td.CRANE.items(),
                  *[(f"ocr_{n}", e) for n, e in td.CRANE_OCR.items()],
                  *[(f"container_ref_{n}", e) for n, e in td.CONTAINER_REF.items()]]


def _gate_payload(gate: dict) -> list:
    return [("timestamp", _ISO_TS), *gate.items(), *[(f"truck_{n}", e) for n, e in td.TRUCK.items()],
            *[(f"ocr_{n}", e) for n, e in td.GATE_OCR.items()], *[(f"weight_{n}", e) for n, e in td.WEIGHT.items()],
            *[(f"container_ref_{n}", e) for n, e in td.CONTAINER_REF.items()]]


_TOPICS = (("crane_events", "crane_events_bronze", td.CRANE_PREDICATE, _CRANE_PAYLOAD),
           ("gate_in_events", "gate_in_events_bronze", td.GATE_IN_PREDICATE, _gate_payload(td.GATE_IN)),
           ("gate_out_events", "gate_out_events_bronze", td.GATE_OUT_PREDICATE, _gate_payload(td.GATE_OUT)))
_KAFKA = ("CAST(user_id AS VARCHAR) AS key, '{topic}' AS topic, CAST(user_id % 12 AS INTEGER) AS partition, "
          "event_id AS offset, ts AS timestamp, 0 AS timestampType")

for _key, (_topic, _table, _pred, _fields) in zip(("bronze_crane", "bronze_gate_in", "bronze_gate_out"), _TOPICS):
    SQL[_key] = (f"SELECT {_KAFKA.format(topic=_topic)}, "
                 + ", ".join(f"{e} AS payload_{n}" for n, e in _fields) + f" FROM events WHERE {_pred}")


def _some_fields(fields: list) -> str:
    """Payload fields that are compared as JSON text, by name (nested: with a dot)."""
    f = dict(fields)
    return (f"{f['event_id']} AS event_id, {f['timestamp']} AS event_time, {f['terminal_id']} AS terminal_id, "
            f"{f['container_ref_container_number']} AS container_number, {f['ocr_status']} AS ocr_status")


# ------------------------------------------------------------- flows
def flow_sql(direction: str) -> str:
    if direction == "export":
        gate, ts, p, label = "gate_in", "gate_in_timestamp", "gate_in", "LOADED_TO_VESSEL"
        on = (f"g.container_id = c.container_id AND c.crane_timestamp >= g.{ts} "
              f"AND c.crane_timestamp <= g.{ts} + INTERVAL 24 HOUR")
        k = dwell_k(f"g.{ts}", "c.crane_timestamp")
    else:
        gate, ts, p, label = "gate_out", "gate_out_timestamp", "gate_out", "DISCHARGE_FROM_VESSEL"
        on = (f"g.container_id = c.container_id AND g.{ts} >= c.crane_timestamp "
              f"AND g.{ts} <= c.crane_timestamp + INTERVAL 24 HOUR")
        k = dwell_k("c.crane_timestamp", f"g.{ts}")
    h = f"(CASE WHEN c.crane_timestamp IS NULL OR g.{ts} IS NULL THEN NULL ELSE CAST({k} AS DOUBLE) / 100 END)"
    return f"""
WITH {silver_ctes()}
SELECT g.container_number, g.container_id, g.container_size, g.container_type, g.seal_number,
       g.terminal_id, g.event_id AS {p}_event_id, g.{ts}, g.gate_id AS {p}_gate_id,
       g.truck_plate_no AS {p}_truck, g.do_number, g.gross_weight_kg AS {p}_gross_weight,
       g.nett_weight_kg AS {p}_nett_weight, g.gate_status AS {p}_status,
       c.event_id AS crane_event_id, c.crane_timestamp, c.crane_id, c.crane_operation,
       c.cycle_time_sec, c.load_cell_kg AS crane_load_kg, c.anomali_type AS crane_anomaly,
       {h} AS yard_dwell_time_hours,
       CASE WHEN c.crane_timestamp IS NOT NULL THEN '{label}'
            WHEN g.{ts} IS NOT NULL THEN 'IN_YARD' ELSE 'UNKNOWN' END AS container_status,
       {dwell_category_sql(h)} AS dwell_time_category
FROM {gate} g LEFT JOIN crane c ON {on}"""


SQL["gold_export_flow"] = flow_sql("export")
SQL["gold_import_flow"] = flow_sql("import")


# ------------------------------------------------------------- crane aggregates
def crane_performance_sql() -> str:
    rate = sround("CAST(sum(CASE WHEN anomali_type IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) "
                  "/ CAST(count(*) AS DOUBLE) * 100")
    mph = sround("CAST(count(*) AS DOUBLE) * (CAST(3600 AS DOUBLE) / "
                 "CAST(nullif(max(cycle_time_sec), 0) AS DOUBLE))")
    return f"""
WITH {silver_ctes()},
agg AS (
  SELECT crane_id, terminal_id, CAST(crane_timestamp AS DATE) AS operation_date,
         CAST(hour(crane_timestamp) AS INTEGER) AS operation_hour, crane_operation,
         count(*) AS total_moves,
         {avg_int_round('cycle_time_sec')} AS avg_cycle_time_sec,
         min(cycle_time_sec) AS min_cycle_time_sec, max(cycle_time_sec) AS max_cycle_time_sec,
         {mph} AS estimated_moves_per_hour,
         {avg_int_round('load_cell_kg')} AS avg_load_kg,
         max(load_cell_kg) AS max_load_kg,
         CAST(sum(CASE WHEN anomali_type IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
         {rate} AS anomaly_rate_pct
  FROM crane GROUP BY ALL)
SELECT *, CASE WHEN anomaly_rate_pct > 10 THEN 'POOR' WHEN anomaly_rate_pct > 5 THEN 'FAIR'
               WHEN avg_cycle_time_sec > 120 THEN 'SLOW' ELSE 'GOOD' END AS performance_rating
FROM agg"""


SQL["gold_crane_performance"] = crane_performance_sql()

SQL["gold_anomaly_summary"] = f"""
WITH {silver_ctes()},
agg AS (
  SELECT crane_id, terminal_id, anomali_type, CAST(crane_timestamp AS DATE) AS date,
         count(*) AS total_anomalies,
         {avg_int_round('cycle_time_sec')} AS avg_cycle_time_when_anomaly,
         {avg_int_round('load_cell_kg')} AS avg_load_when_anomaly,
         max(load_cell_kg) AS max_load_when_anomaly,
         max(crane_timestamp) AS last_anomaly_time, min(crane_timestamp) AS first_anomaly_time
  FROM crane WHERE anomali_type IS NOT NULL GROUP BY ALL)
SELECT *, CASE WHEN total_anomalies >= 10 THEN 'HIGH' WHEN total_anomalies >= 5 THEN 'MEDIUM'
               ELSE 'LOW' END AS anomaly_severity
FROM agg"""


def _flow_daily_sql(direction: str) -> str:
    side = "export" if direction == "export" else "import"
    ts = "gate_in_timestamp" if direction == "export" else "gate_out_timestamp"
    cnt = lambda v: f"CAST(sum(CASE WHEN dwell_time_category = '{v}' THEN 1 ELSE 0 END) AS BIGINT)"
    return f"""
  SELECT terminal_id, CAST({ts} AS DATE) AS date, count(*) AS total_{side}_containers,
         {hundredths_avg_round('dwell_k')} AS avg_{side}_dwell_hours,
         CAST(max(dwell_k) AS DOUBLE) / 100 AS max_{side}_dwell_hours,
         {cnt('NORMAL')} AS {side}_normal_count, {cnt('DELAYED')} AS {side}_delayed_count,
         {cnt('LONG_DELAY')} AS {side}_long_delay_count, {cnt('CRITICAL')} AS {side}_critical_count
  FROM (SELECT *, CAST(round(yard_dwell_time_hours * 100) AS BIGINT) AS dwell_k
        FROM ({flow_sql(direction)}) f) x
  GROUP BY ALL"""


SQL["gold_terminal_daily_summary"] = f"""
WITH ex AS ({_flow_daily_sql('export')}),
im AS ({_flow_daily_sql('import')}),
{silver_ctes()},
cr AS (
  SELECT terminal_id, CAST(crane_timestamp AS DATE) AS date, count(*) AS total_crane_moves,
         count(DISTINCT crane_id) AS active_cranes,
         {avg_int_round('cycle_time_sec')} AS avg_cycle_time_sec,
         CAST(sum(CASE WHEN anomali_type IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS total_anomalies
  FROM crane GROUP BY ALL)
SELECT *, coalesce(total_export_containers, 0) + coalesce(total_import_containers, 0)
          AS total_throughput
FROM ex FULL OUTER JOIN im USING (terminal_id, date) LEFT JOIN cr USING (terminal_id, date)"""


def _hourly_sql(side: str) -> str:
    gate = "gate_in" if side == "in" else "gate_out"
    return f"""
  SELECT terminal_id, gate_id, date_trunc('hour', {gate}_timestamp) AS window_start,
         count(*) AS vehicles_{side}
  FROM {gate} GROUP BY ALL"""


SQL["gold_gate_hourly_traffic"] = f"""
WITH {silver_ctes()},
tin AS ({_hourly_sql('in')}), tout AS ({_hourly_sql('out')}),
j AS (
  SELECT coalesce(tin.terminal_id, tout.terminal_id) AS terminal_id,
         coalesce(tin.gate_id, tout.gate_id) AS gate_id,
         coalesce(tin.window_start, tout.window_start) AS window_start,
         tin.vehicles_in, tout.vehicles_out
  FROM tin FULL OUTER JOIN tout ON tin.terminal_id = tout.terminal_id
       AND tin.gate_id = tout.gate_id AND tin.window_start = tout.window_start)
SELECT terminal_id, gate_id, CAST(window_start AS DATE) AS date,
       CAST(hour(window_start) AS INTEGER) AS hour, window_start,
       window_start + INTERVAL 1 HOUR AS window_end, vehicles_in, vehicles_out,
       coalesce(vehicles_in, 0) + coalesce(vehicles_out, 0) AS total_traffic,
       CASE WHEN coalesce(vehicles_in, 0) + coalesce(vehicles_out, 0) >= 50 THEN 'PEAK'
            WHEN coalesce(vehicles_in, 0) + coalesce(vehicles_out, 0) >= 20 THEN 'BUSY'
            ELSE 'NORMAL' END AS peak_category
FROM j"""


# ------------------------------------------------------------- quality
# The expectations of each gold table.
_CHECKS = [
    ("gold_container_export_flow", "gold_export_flow", "valid_container_number", "container_number IS NOT NULL"),
    ("gold_container_export_flow", "gold_export_flow", "valid_dwell_time",
     "yard_dwell_time_hours >= 0 OR yard_dwell_time_hours IS NULL"),
    ("gold_container_export_flow", "gold_export_flow", "valid_operation", "crane_operation IN ('LOAD', 'DISCHARGE')"),
    ("gold_container_import_flow", "gold_import_flow", "valid_container_number", "container_number IS NOT NULL"),
    ("gold_container_import_flow", "gold_import_flow", "valid_dwell_time",
     "yard_dwell_time_hours >= 0 OR yard_dwell_time_hours IS NULL"),
    ("gold_container_import_flow", "gold_import_flow", "valid_operation", "crane_operation IN ('LOAD', 'DISCHARGE')"),
    ("gold_crane_performance", "gold_crane_performance", "valid_crane_id", "crane_id IS NOT NULL"),
    ("gold_crane_performance", "gold_crane_performance", "valid_total_moves", "total_moves > 0"),
    ("gold_anomaly_summary", "gold_anomaly_summary", "valid_anomaly_type", "anomali_type IS NOT NULL"),
    ("gold_terminal_daily_summary", "gold_terminal_daily_summary", "valid_terminal", "terminal_id IS NOT NULL"),
    ("gold_terminal_daily_summary", "gold_terminal_daily_summary", "valid_date", "date IS NOT NULL"),
    ("gold_gate_hourly_traffic", "gold_gate_hourly_traffic", "valid_gate", "gate_id IS NOT NULL"),
]


def _expectations_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS expectation, "
        f"CAST(count_if(({pred})) AS BIGINT) AS passed, "
        f"CAST(count_if(NOT ({pred})) AS BIGINT) AS failed, "
        f"CAST(count_if(({pred}) IS NULL) AS BIGINT) AS null_result "
        f"FROM ({SQL[key]}) t" for table, key, name, pred in _CHECKS)


SQL["expectations"] = _expectations_sql()

SQL["silver_parse_errors"] = " UNION ALL ".join(
    f"SELECT '{topic}' AS topic, count(*) AS rows, CAST(0 AS BIGINT) AS null_payloads, "
    f"CAST(0 AS BIGINT) AS malformed_payloads, CAST(0 AS BIGINT) AS bad_timestamps, "
    f"CAST(count_if(ts IS NULL) AS BIGINT) AS missing_timestamps, "
    f"CAST(0 AS BIGINT) AS missing_event_ids FROM events WHERE {pred}"
    for topic, pred in (("crane_events", td.CRANE_PREDICATE),
                        ("gate_in_events", td.GATE_IN_PREDICATE),
                        ("gate_out_events", td.GATE_OUT_PREDICATE)))

# Distinct trucks of a gate and ten days, exactly; every group is to lie within the bound.
SQL["approx_trucks_error"] = f"""
WITH {silver_ctes()},
i AS (SELECT terminal_id, gate_id, time_bucket(INTERVAL 10 DAY, gate_in_timestamp, TIMESTAMP '1970-01-01') AS w,
             count(DISTINCT truck_plate_no) AS n FROM gate_in GROUP BY ALL),
o AS (SELECT terminal_id, gate_id, time_bucket(INTERVAL 10 DAY, gate_out_timestamp, TIMESTAMP '1970-01-01') AS w,
             count(DISTINCT truck_plate_no) AS n FROM gate_out GROUP BY ALL)
SELECT coalesce(i.terminal_id, o.terminal_id) AS terminal_id, coalesce(i.gate_id, o.gate_id) AS gate_id,
       coalesce(i.w, o.w) AS window_start, i.n AS exact_in, o.n AS exact_out,
       CASE WHEN i.n IS NOT NULL THEN true END AS in_within, CASE WHEN o.n IS NOT NULL THEN true END AS out_within
FROM i FULL OUTER JOIN o ON i.terminal_id = o.terminal_id AND i.gate_id = o.gate_id AND i.w = o.w"""

_FAULTS = (("unreadable", 7), ("missing:terminal_id", 11), ("unknown:terminal", 11), ("mistyped:ocr.confidence_score", 13),
           ("not_an_object", 17), ("empty", 19))
SQL["payload_faults"] = " UNION ALL ".join(
    f"SELECT '{topic}' AS topic, '{fault}' AS fault, count(*) AS n FROM events WHERE ({pred}) AND event_id % 50 = {kind} "
    f"HAVING count(*) > 0" for topic, _, pred, _ in _TOPICS for fault, kind in _FAULTS)

SQL["truck_rollups"] = f"""
WITH {silver_ctes()}
""" + " UNION ALL ".join(f"""
SELECT '{side}' AS side, terminal_id, gate_id, CAST(date_trunc('month', gate_{side}_timestamp) AS DATE) AS period,
       count(*) AS vehicles, count(DISTINCT truck_plate_no) AS exact_trucks, true AS "within"
FROM gate_{side} GROUP BY ALL""" for side in ("in", "out"))

SQL["daily_view_refreshed"] = SQL["gold_terminal_daily_summary"]

SQL["route_by_topic"] = " UNION ALL ".join(
    f"SELECT {_KAFKA.format(topic=topic)}, '{table}' AS target_table, {_some_fields(fields)} FROM events WHERE {pred}"
    for topic, table, pred, fields in _TOPICS)

SQL["offset_ledger"] = "WITH topics AS (" + " UNION ALL ".join(
    f"SELECT {_KAFKA.format(topic=topic)} FROM events WHERE {pred}" for topic, _, pred, _ in _TOPICS) + """),
numbered AS (SELECT topic, partition, row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") - 1 AS o FROM topics),
kept AS (SELECT * FROM numbered WHERE o % 97 NOT BETWEEN 5 AND 7),
islands AS (SELECT topic, partition, min(o) AS a, max(o) AS b FROM (
              SELECT *, o - row_number() OVER (PARTITION BY topic, partition ORDER BY o) AS run FROM kept)
            GROUP BY topic, partition, run),
lines AS (SELECT *, lag(b) OVER (PARTITION BY topic, partition ORDER BY a) AS before FROM islands)
SELECT 'kept' AS kind, topic, partition, a AS first_offset, b AS last_offset, b - a + 1 AS n_offsets FROM islands
UNION ALL SELECT 'gap', topic, partition, before + 1, a - 1, a - before - 1 FROM lines WHERE before IS NOT NULL
UNION ALL SELECT 'again', topic, partition, o, o, 1 FROM kept WHERE o % 89 = 3"""

# ------------------------------------------------------------- yard
_REF = ["container_id", "container_number", "container_type", "container_type_name",
        "container_size", "container_category", "seal_number"]

YARD_LOG_SQL = f"""
WITH {silver_ctes()},
moves AS (SELECT * FROM crane WHERE coalesce(ocr_container_no, '') <> ''
          AND crane_operation IN ('DISCHARGE', 'LOAD'))
SELECT m.container_number, m.container_id, m.crane_operation AS operation,
       m.event_id AS crane_event_id, m.crane_id, m.crane_timestamp,
       CASE WHEN m.crane_operation = 'LOAD' THEN
         (SELECT max(g.gate_in_timestamp) FROM gate_in g WHERE g.container_id = m.container_id
           AND g.gate_in_timestamp <= m.crane_timestamp) END AS gate_in_timestamp,
       m.load_cell_kg, {', '.join(f'm.{c} AS container_ref_{c}' for c in _REF)}
FROM moves m"""
SQL["yard_log"] = YARD_LOG_SQL
SQL["yard_operation_counts"] = (
    "SELECT CAST(count_if(operation = 'DISCHARGE') AS BIGINT) AS total_discharge, "
    f"CAST(count_if(operation = 'LOAD') AS BIGINT) AS total_load FROM ({YARD_LOG_SQL}) y")
SQL["events_chronological"] = (f"WITH {silver_ctes()} SELECT * FROM crane "
                               "ORDER BY crane_timestamp, event_id")

SQL["weight_reconciliation"] = f"""
WITH {silver_ctes()}
SELECT g.event_id AS gate_event_id, c.event_id AS crane_event_id, g.container_id, g.terminal_id,
       g.gross_weight_kg, g.tare_weight_kg, g.nett_weight_kg, c.load_cell_kg AS crane_load_kg,
       CAST(g.gross_weight_kg AS BIGINT) = CAST(g.tare_weight_kg AS BIGINT) + CAST(g.nett_weight_kg AS BIGINT) AS gross_consistent,
       CAST(g.nett_weight_kg AS BIGINT) - c.load_cell_kg AS nett_minus_load_kg,
       abs(CAST(g.nett_weight_kg AS BIGINT) - c.load_cell_kg) <= 150 AS within_tolerance
FROM gate_in g JOIN crane c ON g.container_id = c.container_id
 AND c.crane_timestamp >= g.gate_in_timestamp AND c.crane_timestamp <= g.gate_in_timestamp + INTERVAL 24 HOUR"""


# ------------------------------------------------------------- anomaly rules
def _crane_rules_sql() -> str:
    # Least and greatest load by container type, normal hoist speed.
    lo = ("CASE container_type WHEN '1' THEN 5000 WHEN '2' THEN 5000 WHEN '3' THEN 5000 WHEN '4' THEN 4000 "
          "WHEN '5' THEN 8000 WHEN '6' THEN 5000 WHEN '7' THEN 5000 WHEN '8' THEN 10000 ELSE 5000 END")
    hi = ("CASE container_type WHEN '1' THEN 30480 WHEN '2' THEN 30480 WHEN '3' THEN 28000 WHEN '4' THEN 25000 "
          "WHEN '5' THEN 34000 WHEN '6' THEN 30000 WHEN '7' THEN 30000 WHEN '8' THEN 26000 ELSE 30000 END")
    keep = ("event_id, crane_id, terminal_id, crane_timestamp, container_id, container_type, "
            "load_cell_kg, hoist_speed_mps, anomali_type")
    rules = [
        ("WEIGHT_EXTREME", f"load_cell_kg < ({lo}) OR load_cell_kg > ({hi})"),
        ("SPEED_EXTREME", "hoist_speed_mps < 0.5 OR hoist_speed_mps > 1.2"),
        ("MISSING_OCR", "coalesce(ocr_container_no, '') = '' AND ocr_confidence_score = 0.0 "
                        "AND ocr_status = 'FAILED'"),
    ]
    body = " UNION ALL ".join(
        f"SELECT {keep}, '{n}' AS detected_rule, '{n}' = anomali_type AS matches_declared "
        f"FROM crane WHERE {cond}" for n, cond in rules)
    return f"WITH {silver_ctes()} {body}"


def _gate_rules_sql() -> str:
    parts = []
    for gate, ts in (("gate_in", "gate_in_timestamp"), ("gate_out", "gate_out_timestamp")):
        keep = (f"event_id, gate_id, terminal_id, {ts} AS gate_timestamp, direction, "
                "container_id, truck_plate_no, anomali_type")
        rules = [
            ("RFID_FAILED", "truck_rfid_success = false AND coalesce(truck_rfid_tag, '') = ''"),
            ("OCR_MISMATCH", "coalesce(ocr_container_no, '') <> '' AND ocr_container_no <> container_number"),
            ("WEIGHT_EXTREME", "gross_weight_kg IN (0, 99999, -100)"),
            ("MISSING_DO", "coalesce(do_number, '') = ''"),
        ]
        parts += [f"SELECT {keep}, '{n}' AS detected_rule, '{n}' = anomali_type AS matches_declared "
                  f"FROM {gate} WHERE {cond}" for n, cond in rules]
    return f"WITH {silver_ctes()} " + " UNION ALL ".join(parts)


SQL["crane_anomaly_rules"] = _crane_rules_sql()
SQL["gate_anomaly_rules"] = _gate_rules_sql()


def _ocr_sql() -> str:
    band = ("CASE WHEN ocr_confidence_score IS NULL THEN NULL "
            "WHEN ocr_confidence_score >= 0.95 AND coalesce(ocr_container_no, '') <> '' THEN 'SUCCESS' "
            "WHEN ocr_confidence_score >= 0.80 AND coalesce(ocr_container_no, '') <> '' THEN 'LOW_CONFIDENCE' "
            "ELSE 'FAILED' END")
    parts = [f"SELECT '{src}' AS source, ocr_status, count(*) AS events, "
             "min(ocr_confidence_score) AS min_confidence, max(ocr_confidence_score) AS max_confidence, "
             "CAST(count_if(coalesce(ocr_container_no, '') = '') AS BIGINT) AS blank_numbers, "
             f"CAST(count_if(({band}) <> ocr_status) AS BIGINT) AS band_mismatches "
             f"FROM {src} GROUP BY ocr_status" for src in ("crane", "gate_in", "gate_out")]
    return f"WITH {silver_ctes()} " + " UNION ALL ".join(parts)


SQL["ocr_quality"] = _ocr_sql()


# ------------------------------------------------------------- manifests
_EPOCH = "CAST(floor(epoch(o_orderdate)) AS BIGINT)"
MANIFEST_ROWS = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in td.MANIFEST_HEADER.items())
    + f", {td.MANIFEST_ETA.format(epoch=_EPOCH)} AS eta, {td.MANIFEST_ETD.format(epoch=_EPOCH)} AS etd, "
    + ", ".join(f"CASE WHEN l_orderkey IS NULL THEN NULL ELSE {e} END AS {n}"
                for n, e in td.MANIFEST_CONTAINER.items())
    + ", l_orderkey IS NOT NULL AS present FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")

_HDR = ["vessel_id", "vessel_name", "imo_number", "call_sign", "mmsi_number", "voyage",
        "process_type", "transport_mode", "terminal_code", "customs_office_code",
        "captain_name", "eta", "etd"]
_CF = list(td.MANIFEST_CONTAINER)

SQL["manifest_containers"] = f"SELECT {', '.join(_HDR + _CF)} FROM ({MANIFEST_ROWS}) m"

_DIMS = {"by_size": "container_size", "by_type": "container_type", "by_status": "status_code"}
_H = ", ".join(_HDR)
MANIFEST_SUMMARY_SQL = (
    f"WITH m AS ({MANIFEST_ROWS}) "
    f"SELECT {_H}, 'total' AS dimension, 'all' AS value, "
    f"CAST(count_if(present) AS BIGINT) AS containers FROM m GROUP BY {_H} "
    + " ".join(f"UNION ALL SELECT {_H}, '{d}' AS dimension, "
               f"coalesce({f}, 'unknown') AS value, count(*) AS containers FROM m WHERE present "
               "GROUP BY ALL" for d, f in _DIMS.items()))
SQL["manifest_summary"] = MANIFEST_SUMMARY_SQL

SQL["work_orders"] = (
    f"SELECT {', '.join(_HDR + _CF)}, CASE WHEN process_type = '01' THEN 'DISCHARGE' "
    f"ELSE 'LOAD' END AS operation FROM ({MANIFEST_ROWS}) m "
    "WHERE present AND process_type IN ('01', '02')")


def _iso(e: str) -> str:
    return (f"CASE WHEN {e} IS NULL OR {e} = 0 THEN NULL ELSE "
            f"strftime(make_timestamp({e} * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END")


def _schedule_sql(where: str = "") -> str:
    maps = ", ".join(
        f"coalesce(string_agg(CASE WHEN dimension = '{d}' THEN value || ':' || CAST(containers AS VARCHAR) END, ',' "
        f"ORDER BY CASE WHEN dimension = '{d}' THEN value || ':' || CAST(containers AS VARCHAR) END), '') "
        f"AS containers_summary_{d}" for d in _DIMS)
    return f"""
WITH s AS ({MANIFEST_SUMMARY_SQL}),
h AS (SELECT {_H}, max(CASE WHEN dimension = 'total' THEN containers END) AS containers_summary_total, {maps}
      FROM s GROUP BY {_H})
SELECT vessel_id, vessel_name, imo_number, call_sign, mmsi_number, voyage AS voyage_number,
       process_type,
       CASE process_type WHEN '01' THEN 'IMPORT' WHEN '02' THEN 'EXPORT' ELSE 'UNKNOWN' END AS process_type_desc,
       transport_mode,
       CASE transport_mode WHEN '01' THEN 'LAUT' WHEN '02' THEN 'UDARA' WHEN '03' THEN 'DARAT' ELSE 'UNKNOWN' END AS transport_mode_desc,
       terminal_code, customs_office_code, captain_name,
       {_iso('eta')} AS schedule_eta, {_iso('etd')} AS schedule_etd, containers_summary_total,
       {', '.join(f'containers_summary_{d}' for d in _DIMS)}
FROM h {where}"""


SQL["vessel_schedule"] = _schedule_sql()
SQL["vessel_schedule_by_type"] = _schedule_sql("WHERE process_type = '01'")
SQL["vessel_schedule_total"] = f"""
WITH s AS ({SQL["vessel_schedule"]})
SELECT process_type, false AS all_types, count(*) AS total FROM s GROUP BY process_type
UNION ALL SELECT NULL, true, count(*) FROM s"""


# ------------------------------------------------------------- streaming twins
# After the sentinel flush a stream equals its batch table.
SQL["stream_export_flow"] = SQL["gold_export_flow"]
SQL["stream_import_flow"] = SQL["gold_import_flow"]
SQL["stream_gate_traffic"] = SQL["gold_gate_hourly_traffic"]
SQL["stream_crane_performance"] = SQL["gold_crane_performance"]
SQL["stream_anomaly_summary"] = SQL["gold_anomaly_summary"]
SQL["late_data_dropped"] = f"""
WITH {silver_ctes()}
SELECT terminal_id, date_trunc('hour', gate_in_timestamp) AS window_start,
       date_trunc('hour', gate_in_timestamp) + INTERVAL 1 HOUR AS window_end,
       count(*) AS vehicles_in
FROM gate_in
WHERE NOT (gate_in_timestamp < TIMESTAMP '2024-01-15' AND CAST(event_id AS BIGINT) % 10 = 0)
GROUP BY ALL"""


_LATE = "gate_in_timestamp < TIMESTAMP '2024-01-15' AND CAST(event_id AS BIGINT) % 10 = 0"
SQL["late_rows_kept"] = f"""
WITH {silver_ctes()}
SELECT terminal_id, date_trunc('hour', gate_in_timestamp) AS window_start,
       date_trunc('hour', gate_in_timestamp) + INTERVAL 1 HOUR AS window_end,
       count(*) FILTER (NOT ({_LATE})) AS vehicles_on_time, count(*) FILTER ({_LATE}) AS vehicles_late, count(*) AS vehicles_in
FROM gate_in GROUP BY ALL"""

# ------------------------------------------------------------- sinks
SQL["clustered_export_flow"] = SQL["gold_export_flow"]

SQL["raw_landing"] = " UNION ALL ".join(
    f"SELECT {_KAFKA.format(topic=topic)}, CAST(ts AS DATE) AS date, {_some_fields(fields)} FROM events WHERE {pred}"
    for topic, _, pred, fields in _TOPICS)

_LAND_EPOCH = f"coalesce(nullif({td.MANIFEST_ETA.format(epoch=_EPOCH)}, 0), {td.MANIFEST_ETD.format(epoch=_EPOCH)})"
SQL["manifest_landing_counts"] = f"""
WITH o AS (
  SELECT CAST(make_timestamp({_LAND_EPOCH} * 1000000) AS DATE) AS d,
         CASE WHEN o_orderkey % 2 = 1 THEN 'import' ELSE 'export' END AS label,
         (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n
  FROM orders)
SELECT strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day, label,
       count(*) AS manifests, CAST(sum(n) AS BIGINT) AS containers
FROM o GROUP BY ALL"""

SQL["manifest_containers_json"] = SQL["manifest_containers"]
