"""Vessel manifests: containers, summaries and the vessel schedule.

A manifest is a nested document (header + `containers` array); the source
summarises one document at a time in Python.  Here codes are counted inside
each document with array functions (no shuffle), and documents with the same
full header -- the pages of one vessel call -- are summed.  Voyages, process
types and NULL fields of the header keep documents apart; rows are grouped,
never joined, so NULLs need no care.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import rules

HEADER = ["vessel_id", "vessel_name", "imo_number", "call_sign", "mmsi_number", "voyage",
          "process_type", "transport_mode", "terminal_code", "customs_office_code",
          "captain_name", "eta", "etd"]
CONTAINER_FIELDS = ["container_id", "container_number", "container_type",
                    "container_type_name", "container_size", "container_category",
                    "seal_number", "status_code"]
# Summary dimension -> container field.
DIMENSIONS = {"by_size": "container_size", "by_type": "container_type",
              "by_status": "status_code"}


def manifest_containers(manifests: DataFrame, keep_empty: bool = True) -> DataFrame:
    """One row per container with the manifest's header; with `keep_empty` a
    manifest without containers keeps one row with NULL container fields."""
    ex = F.explode_outer if keep_empty else F.explode
    return manifests.select(*HEADER, ex("containers").alias("c")) \
        .select(*HEADER, *[F.col(f"c.{f}").alias(f) for f in CONTAINER_FIELDS])


def manifest_containers_json(lines: DataFrame, keep_empty: bool = True) -> DataFrame:
    """`lines(value)`, one manifest as JSON text a row -> the rows of `manifest_containers`.

    The document stays one VARIANT and its containers are taken from it one by one, so
    a manifest of any size builds no array of typed records; unknown fields cost
    nothing, and a document that is no JSON gives no row.  Batch or file stream."""
    def got(value: str, field: T.StructField) -> str:
        return f"try_variant_get({value}, '$.{field.name}', '{field.dataType.simpleString()}') AS {field.name}"
    header = [got("v", schemas.MANIFEST[f]) for f in HEADER]
    container = [got("value", schemas.MANIFEST_CONTAINER[f]) for f in CONTAINER_FIELDS]
    # the header is read once a document, before its containers are taken apart
    docs = lines.select(F.try_parse_json("value").alias("v")).where(F.col("v").isNotNull()).selectExpr(
        *header, "try_variant_get(v, '$.containers', 'variant') AS list")
    explode = "variant_explode_outer" if keep_empty else "variant_explode"
    return lines.sparkSession.sql(
        f"SELECT {', '.join(HEADER + container)} FROM {{docs}}, LATERAL {explode}(list)",
        docs=docs)


def _codes(field: str):
    """(value, containers) pairs of one document, a missing code counted as 'unknown'."""
    values = F.transform("containers", lambda c: F.coalesce(c[field], F.lit("unknown")))
    return F.transform(F.array_distinct(values), lambda v: F.struct(
        v.alias("value"), F.size(F.filter(values, lambda x: x == v)).cast("long").alias("containers")))


def manifest_summary(manifests: DataFrame, partitions: int | None = None) -> DataFrame:
    """Long form: (header, dimension, value, containers), one row a code of a vessel call.

    Documents go to their call's partition as header and counts, one row each, and are
    unfolded there; nothing is combined before (calls rarely repeat within a task, and a
    table of wide keys of everything that a task reads would have no bound).  `partitions`
    (default: the session's) follows the size of the input, so that a task's share does not grow.

    dimension 'total' (value 'all') counts every container, 0 for an empty
    manifest; by_size / by_type / by_status count per code."""
    docs = manifests.withColumn("containers", F.filter("containers", lambda c: c.isNotNull()))
    total = F.array(F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value"),
                             F.coalesce(F.size("containers"), F.lit(0)).cast("long").alias("containers")))
    none = F.array().cast("array<struct<value:string,containers:bigint>>")
    pairs = [total, *[_labelled(F.coalesce(_codes(f), none), d) for d, f in DIMENSIONS.items()]]
    counted = docs.select(*HEADER, F.concat(*pairs).alias("pairs"))
    dealt = counted.repartition(partitions, *HEADER) if partitions else counted.repartition(*HEADER)
    long = dealt.select(*HEADER, F.explode("pairs").alias("p"))
    return long.groupBy(*HEADER, F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value")).agg(
        F.sum("p.containers").alias("containers"))


def _labelled(codes, dimension: str):
    return F.transform(codes, lambda p: F.struct(
        F.lit(dimension).alias("dimension"), p["value"].alias("value"), p["containers"].alias("containers")))


def vessel_schedule(*manifest_sets: DataFrame, partitions: int | None = None) -> DataFrame:
    """Schedule entries of all given manifest sets (import, export, ...):
    renamed header, code descriptions, ISO eta/etd and the container summary
    (total + count maps), one row per vessel call.  Unknown process types stay,
    described as UNKNOWN."""
    manifests = manifest_sets[0]
    for m in manifest_sets[1:]:
        manifests = manifests.unionByName(m)
    # A map holds one entry per distinct code of the call.
    dim = F.col("dimension")
    s = manifest_summary(manifests, partitions).groupBy(*HEADER).agg(
        F.sum(F.when(dim == "total", F.col("containers"))).alias("total"),
        *[F.map_from_entries(F.collect_list(F.when(dim == d, F.struct("value", "containers"))))
          .alias(d) for d in DIMENSIONS])
    return s.select(
        "vessel_id", "vessel_name", "imo_number", "call_sign", "mmsi_number",
        F.col("voyage").alias("voyage_number"), "process_type",
        rules.process_type_desc("process_type").alias("process_type_desc"),
        "transport_mode", rules.transport_mode_desc("transport_mode").alias("transport_mode_desc"),
        "terminal_code", "customs_office_code", "captain_name",
        F.struct(rules.epoch_to_iso("eta").alias("eta"),
                 rules.epoch_to_iso("etd").alias("etd")).alias("schedule"),
        F.struct("total", *DIMENSIONS).alias("containers_summary"),
    )


def schedule_total(schedule: DataFrame) -> DataFrame:
    """Number of schedule entries, in all and per process type (NULL: of all)."""
    return schedule.rollup("process_type").agg(
        F.grouping("process_type").cast("boolean").alias("all_types"), F.count("*").alias("total"))


def vessel_schedule_by_type(schedule: DataFrame, process_type: str) -> DataFrame:
    if process_type not in rules.PROCESS_TYPE_DESC:
        raise ValueError("process_type must be '01' (import) or '02' (export)")
    return schedule.where(F.col("process_type") == process_type)
