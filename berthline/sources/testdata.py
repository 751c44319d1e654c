"""Stand-in adapter: the driver's tables as terminal event streams and manifests.

The reference's inputs (crane / gate JSON events on Kafka, manifest JSON
documents) are not in the test data, so they are derived deterministically
from `events`, `orders` and `lineitem`.  Every field is one SQL expression
that is valid both in Spark SQL and in DuckDB; the oracle SQL reuses the very
same expressions to build its silver relations straight from the parquet
tables, while the Spark side serialises them to JSON bytes (bronze) and parses
them back (silver), so the parse path is really exercised.

Streams over `events`:
  crane     event_type IN ('click', 'purchase', 'error')   (purchase = DISCHARGE)
  gate in   event_type = 'view'
  gate out  event_type = 'signup'
Containers are users (`container_id` = user_id), terminals are user_id % 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas

CRANE_TYPES = ("click", "purchase", "error")
GATE_IN_TYPE = "view"
GATE_OUT_TYPE = "signup"

CRANE_PREDICATE = "event_type IN ('click', 'purchase', 'error')"
GATE_IN_PREDICATE = "event_type = 'view'"
GATE_OUT_PREDICATE = "event_type = 'signup'"

# Container type codes and names of the simulated fleet.
CONTAINER_TYPE_NAMES = ["Dry", "Tunnel Type", "Open Top", "Flat Rack", "Reefer",
                        "Barge", "Bulk", "ISO Tank"]

_type_name_case = "CASE 1 + user_id % 8 " + " ".join(
    f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(CONTAINER_TYPE_NAMES)) + " END"

CONTAINER_REF = {
    "container_id": "CAST(user_id AS STRING)",
    "container_number": "'CTNU' || lpad(CAST(user_id AS STRING), 7, '0')",
    "container_type": "CAST(1 + user_id % 8 AS STRING)",
    "container_type_name": _type_name_case,
    "container_size": "CASE user_id % 3 WHEN 0 THEN '20' WHEN 1 THEN '40' ELSE '45' END",
    "container_category": "CASE WHEN user_id % 2 = 0 THEN 'FULL' ELSE 'EMPTY' END",
    "seal_number": "'SL' || lpad(CAST(user_id * 7919 % 1000000 AS STRING), 6, '0')",
}

_CRANE_ANOMALY_ROW = "event_id % 20 = 0"
_WEIGHT_X = "(event_id % 20 = 0 AND event_id % 3 = 0)"
_SPEED_X = "(event_id % 20 = 0 AND event_id % 3 = 1)"
_MISSING_OCR = "(event_id % 20 = 0 AND event_id % 3 = 2)"
_LOAD = "5000 + CAST(floor(value * 100) AS BIGINT) % 21000"

CRANE = {
    "event_id": "CAST(event_id AS STRING)",
    "crane_id": "'CRANE-0' || CAST(1 + user_id % 8 AS STRING)",
    "terminal_id": "'TERM-' || CAST(user_id % 3 AS STRING)",
    "operation": "CASE WHEN event_type = 'purchase' THEN 'DISCHARGE' ELSE 'LOAD' END",
    "spreader_height_m": "8 + CAST(event_id % 321 AS DOUBLE) / 10",
    "trolley_position_m": "CAST(event_id % 351 AS DOUBLE) / 10",
    "hoist_speed_mps": f"CASE WHEN {_SPEED_X} THEN 2.5 + CAST(event_id % 251 AS DOUBLE) / 100 "
                       "ELSE 0.5 + CAST(event_id % 71 AS DOUBLE) / 100 END",
    "cycle_time_sec": "60 + event_id % 91",
    "load_cell_kg": f"CASE WHEN {_WEIGHT_X} THEN (CASE event_id % 180 WHEN 0 THEN 0 "
                    f"WHEN 60 THEN 99999 ELSE -100 END) ELSE {_LOAD} END",
    "spreader_locked": "event_id % 5 <> 0",
    "gps_lat": "51.25 + CAST(event_id % 40 AS DOUBLE) / 1024",
    "gps_lng": "4.5 - CAST(event_id % 56 AS DOUBLE) / 2048",
    "anomali_type": f"CASE WHEN {_CRANE_ANOMALY_ROW} THEN (CASE event_id % 3 "
                    "WHEN 0 THEN 'WEIGHT_EXTREME' WHEN 1 THEN 'SPEED_EXTREME' "
                    "ELSE 'MISSING_OCR' END) END",
}

CRANE_OCR = {
    "container_no": f"CASE WHEN {_MISSING_OCR} OR event_id % 100 >= 95 THEN '' "
                    f"ELSE {CONTAINER_REF['container_number']} END",
    "confidence_score": f"CASE WHEN {_MISSING_OCR} THEN 0.0 "
                        "WHEN event_id % 100 < 86 THEN 0.95 + CAST(event_id % 6 AS DOUBLE) / 100 "
                        "WHEN event_id % 100 < 95 THEN 0.8 + CAST(event_id % 15 AS DOUBLE) / 100 "
                        "ELSE CAST(event_id % 80 AS DOUBLE) / 100 END",
    "status": f"CASE WHEN {_MISSING_OCR} OR event_id % 100 >= 95 THEN 'FAILED' "
              "WHEN event_id % 100 < 86 THEN 'SUCCESS' ELSE 'LOW_CONFIDENCE' END",
}

_RFID_FAILED = "(event_id % 80 = 0)"
_OCR_MISMATCH = "(event_id % 80 = 20)"
_GROSS_X = "(event_id % 80 = 40)"
_MISSING_DO = "(event_id % 80 = 60)"
_TARE = "12500 + 10 * (event_id % 173)"
_NETT = f"{_LOAD} + event_id % 301 - 150"


def _gate(direction: str, status: str) -> dict:
    return {
        "event_id": "CAST(event_id AS STRING)",
        "gate_id": "'GATE-0' || CAST(1 + event_id % 4 AS STRING)",
        "terminal_id": "'TERM-' || CAST(user_id % 3 AS STRING)",
        "direction": f"'{direction}'",
        "status": f"'{status}'",
        "anomali_type": "CASE WHEN event_id % 20 = 0 THEN (CASE event_id % 80 "
                        "WHEN 0 THEN 'RFID_FAILED' WHEN 20 THEN 'OCR_MISMATCH' "
                        "WHEN 40 THEN 'WEIGHT_EXTREME' ELSE 'MISSING_DO' END) END",
    }


GATE_IN = _gate("IN", "APPROVED")
GATE_OUT = _gate("OUT", "RELEASED")

TRUCK = {
    "plate_no": "'TRK-' || CAST(user_id % 50 AS STRING)",
    "rfid_tag": f"CASE WHEN {_RFID_FAILED} THEN '' "
                "ELSE 'RFID-' || lpad(CAST(user_id % 500 AS STRING), 5, '0') END",
    "rfid_read_success": f"NOT {_RFID_FAILED} AND event_id % 10 <> 3",
    "driver_id": "'DRV-' || lpad(CAST(user_id % 331 AS STRING), 4, '0')",
    "do_number": f"CASE WHEN {_MISSING_DO} THEN '' "
                 "ELSE 'DO-' || lpad(CAST(event_id AS STRING), 8, '0') END",
}

GATE_OCR = {
    "container_no": f"CASE WHEN {_OCR_MISMATCH} THEN 'MSCU' || CAST(1000000 + event_id % 9000000 AS STRING) "
                    f"WHEN event_id % 100 >= 90 THEN '' ELSE {CONTAINER_REF['container_number']} END",
    "confidence_score": f"CASE WHEN {_OCR_MISMATCH} OR (event_id % 100 >= 70 AND event_id % 100 < 90) "
                        "THEN 0.8 + CAST(event_id % 15 AS DOUBLE) / 100 "
                        "WHEN event_id % 100 < 70 THEN 0.95 + CAST(event_id % 6 AS DOUBLE) / 100 "
                        "ELSE CAST(event_id % 80 AS DOUBLE) / 100 END",
    "status": f"CASE WHEN {_OCR_MISMATCH} THEN 'LOW_CONFIDENCE' WHEN event_id % 100 < 70 THEN 'SUCCESS' "
              "WHEN event_id % 100 < 90 THEN 'LOW_CONFIDENCE' ELSE 'FAILED' END",
}

WEIGHT = {
    "gross_weight_kg": f"CAST(CASE WHEN {_GROSS_X} THEN (CASE event_id % 3 WHEN 0 THEN 0 "
                       f"WHEN 1 THEN 99999 ELSE -100 END) ELSE {_TARE} + {_NETT} END AS INT)",
    "tare_weight_kg": f"CAST({_TARE} AS INT)",
    "nett_weight_kg": f"CAST({_NETT} AS INT)",
}

# Spark-only: the ISO-8601 text the producers put on the wire.
ISO_TEXT = "date_format(CAST(ts AS TIMESTAMP), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")"


def _struct_of(fields: dict) -> Column:
    return F.struct(*[F.expr(e).alias(n) for n, e in fields.items()])


def _payload(schema, flat: dict, nested: dict) -> Column:
    cols = []
    for f in schema.fields:
        if f.name == "timestamp":
            cols.append(F.expr(ISO_TEXT).alias("timestamp"))
        elif f.name in nested:
            cols.append(_struct_of(nested[f.name]).alias(f.name))
        else:
            cols.append(F.expr(flat[f.name]).alias(f.name))
    return F.struct(*cols)


# Partitions per topic of the stand-in Kafka topics.
KAFKA_PARTITIONS = 12


def _kafka_rows(events: DataFrame, predicate: str, payload: Column, topic: str) -> DataFrame:
    """Kafka-shaped rows: records keyed by container, dealt to KAFKA_PARTITIONS topic
    partitions.  No shuffle: tasks follow the splits of the scan."""
    return events.where(predicate).select(
        F.expr("CAST(CAST(user_id AS STRING) AS BINARY)").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.expr(f"CAST(pmod(user_id, {KAFKA_PARTITIONS}) AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def crane_bronze(events: DataFrame) -> DataFrame:
    payload = _payload(schemas.CRANE_EVENT, CRANE,
                       {"ocr": CRANE_OCR, "container_ref": CONTAINER_REF})
    return _kafka_rows(events, CRANE_PREDICATE, payload, schemas.TOPIC_CRANE)


def gate_bronze(events: DataFrame, direction: str) -> DataFrame:
    flat, pred, topic = ((GATE_IN, GATE_IN_PREDICATE, schemas.TOPIC_GATE_IN) if direction == "in"
                         else (GATE_OUT, GATE_OUT_PREDICATE, schemas.TOPIC_GATE_OUT))
    payload = _payload(schemas.GATE_EVENT, flat,
                       {"truck": TRUCK, "ocr": GATE_OCR, "weight": WEIGHT,
                        "container_ref": CONTAINER_REF})
    return _kafka_rows(events, pred, payload, topic)


def all_topics_bronze(events: DataFrame) -> DataFrame:
    """One multi-topic Kafka-shaped stream, as a broker rule would route it."""
    return crane_bronze(events).unionByName(gate_bronze(events, "in")) \
        .unionByName(gate_bronze(events, "out"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- manifests
# Header fields of a vessel manifest, derived from `orders`.
MANIFEST_HEADER = {
    "vessel_id": "CAST(o_orderkey AS STRING)",
    "vessel_name": "'MV ' || CAST(o_custkey AS STRING)",
    "imo_number": "CAST(9000000 + o_custkey % 999999 AS STRING)",
    "call_sign": "'9V' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0')",
    "mmsi_number": "'5250' || lpad(CAST(o_custkey AS STRING), 5, '0')",
    "voyage": "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') || "
              "CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'S' END",
    "process_type": "CASE WHEN o_orderkey % 2 = 1 THEN '01' ELSE '02' END",
    "transport_mode": "CASE o_orderkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' "
                      "WHEN 2 THEN '03' ELSE '09' END",
    "terminal_code": "'UTC' || CAST(10 + o_custkey % 3 AS STRING)",
    "customs_office_code": "'040300'",
    "captain_name": "o_orderpriority",
}
# eta/etd as epoch seconds; every 97th vessel call has an unknown eta (0).
MANIFEST_ETA = "CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE {epoch} END"
MANIFEST_ETD = "{epoch} + 86400 * (1 + o_orderkey % 3)"

MANIFEST_CONTAINER = {
    "container_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "container_number": "'MNFU' || lpad(CAST(l_partkey AS STRING), 7, '0')",
    "container_type": "l_returnflag",
    "container_type_name": "l_returnflag",
    "container_size": "CAST(l_linenumber AS STRING)",
    "container_category": "CASE WHEN l_quantity > 25 THEN 'FULL' ELSE 'EMPTY' END",
    "seal_number": "'SL' || lpad(CAST(l_suppkey AS STRING), 6, '0')",
    "status_code": "l_linestatus",
}

# A manifest page carries at most this many containers (the producer's cap);
# longer manifests become several pages of the same vessel call.
MANIFEST_PAGE = 1000


# Long orders up to which their keys are passed along as a small table.
LONG_KEYS = 10_000


def manifest_documents(orders: DataFrame, lineitem: DataFrame, page_size: int = MANIFEST_PAGE,
                       partitions: int | None = None) -> DataFrame:
    """Nested manifest documents shaped like `schemas.MANIFEST`.

    Lines of an order are counted first (combined before the shuffle).  A long order's
    lines are dealt by row hash to groups of about half a page, each group is
    numbered and cut at the page size: no array exceeds it and no task sees
    more than a group of any order.  The lines of all other orders go once, as plain
    columns, to their order's partition, where they are gathered and joined.  Orders
    without lines get an empty container list.  `partitions` (default: the session's)
    follows the size of the input."""
    epoch = "unix_seconds(CAST(o_orderdate AS TIMESTAMP))"
    header = [*[F.expr(e).alias(n) for n, e in MANIFEST_HEADER.items()],
              F.expr(MANIFEST_ETA.format(epoch=epoch)).alias("eta"),
              F.expr(MANIFEST_ETD.format(epoch=epoch)).alias("etd")]

    def dealt(df: DataFrame, key: str) -> DataFrame:
        return df.repartition(partitions, key) if partitions else df.repartition(key)
    lineitem = lineitem.where("l_orderkey IS NOT NULL")
    groups = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines")).where(
        F.col("lines") > page_size).select(
        F.col("l_orderkey").alias("long_key"), F.ceil(F.col("lines") * 2 / page_size).alias("groups"))
    few = groups.limit(LONG_KEYS + 1).collect()
    if len(few) <= LONG_KEYS:
        groups = F.broadcast(lineitem.sparkSession.createDataFrame(few, groups.schema))
    is_long, ordered = F.col("l_orderkey") == F.col("long_key"), F.col("o_orderkey") == F.col("long_key")
    container = _struct_of(MANIFEST_CONTAINER).alias("c")
    whole = dealt(lineitem.join(groups, is_long, "left_anti"), "l_orderkey").select("l_orderkey", container).groupBy(
        "l_orderkey").agg(F.collect_list("c").alias("containers"))
    row = F.struct(*[F.col(c) for c in lineitem.columns])
    in_part = Window.partitionBy("l_orderkey", "part").orderBy("row_hash")
    cut = lineitem.withColumn("row_hash", F.xxhash64(row)).join(groups, is_long).select(
        "l_orderkey", "row_hash", F.pmod("row_hash", "groups").alias("part"), container).withColumn(
        "number", F.row_number().over(in_part) - 1).withColumn("page", F.expr(f"CAST(number AS BIGINT) div {page_size}"))
    pages = cut.groupBy("l_orderkey", "part", "page").agg(F.collect_list("c").alias("containers"))
    names = [f.name for f in schemas.MANIFEST.fields]
    held = F.coalesce(F.col("containers"), F.array().cast(schemas.MANIFEST["containers"].dataType)).alias("containers")

    def documents(some: DataFrame, gathered: DataFrame, how: str) -> DataFrame:
        return some.join(gathered, some.o_orderkey == gathered.l_orderkey, how).select(*header, held).select(*names)
    return documents(dealt(orders.join(groups, ordered, "left_anti"), "o_orderkey"), whole, "left").unionByName(
        documents(orders.join(groups, ordered, "left_semi"), pages, "inner"))
