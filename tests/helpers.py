"""Small fixture builders: silver-shaped rows with only the fields a test needs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from berthline.operators import silver

_SPECS = {"crane": silver.CRANE, "gate_in": silver.GATE_IN, "gate_out": silver.GATE_OUT}


def _type_of(spec, name):
    if name == "kafka_timestamp" or name == spec.ts_name or name == "silver_timestamp":
        return T.TimestampType()
    if name == "topic":
        return T.StringType()
    for out, path in spec.columns:
        if out == name:
            t = spec.schema
            for part in path.split("."):
                t = t[part].dataType
            return t
    raise KeyError(name)


def silver_schema(kind: str) -> T.StructType:
    spec = _SPECS[kind]
    names = [c for c, _ in spec.columns] + ["kafka_timestamp", "topic"]
    return T.StructType([T.StructField(n, _type_of(spec, n), True) for n in names])


def silver_rows(spark, kind: str, rows: list[dict]):
    sch = silver_schema(kind)
    conv = []
    for r in rows:
        d = {}
        for f in sch.fields:
            v = r.get(f.name)
            if isinstance(v, str) and isinstance(f.dataType, T.TimestampType):
                v = dt.datetime.fromisoformat(v)
            d[f.name] = v
        conv.append(tuple(d[f.name] for f in sch.fields))
    return spark.createDataFrame(conv, sch)
