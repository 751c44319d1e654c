"""Unreadable and drifted payloads: found, kept raw, and let go once repaired.

`from_json` turns whatever it cannot read into NULL, so a producer that cuts a
message off, renames a field or writes text for a number shows as missing
values much later.  Here every payload is read as a VARIANT beside its declared
schema and the differences are named:

    empty               no payload
    unreadable          no JSON
    not_an_object       JSON, but no object
    missing:<field>     a required field is not there
    unknown:<field>     a field that the schema does not have
    mistyped:<field>    a value that the declared type cannot hold (silver would read NULL)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ("event_id", "timestamp", "terminal_id")
AT = ["topic", "partition", "offset"]


def _records(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.StructType]]:
    """(path, schema) of the object and its nested objects."""
    out = [(prefix, schema)]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            out += _records(f.dataType, f"{prefix}{f.name}.")
    return out


def _there(field: Column) -> Column:
    """Whether a field is there and not JSON's null."""
    return field.isNotNull() & ~F.is_variant_null(field)


def _named(fault: str, names: Column) -> Column:
    return F.coalesce(F.transform(names, lambda n: F.concat(F.lit(fault), n)), F.array().cast("array<string>"))


def _unknown(fields: Column, prefix: str, record: T.StructType) -> Column:
    """Faults of the fields of a record that its schema does not have."""
    return _named(f"unknown:{prefix}", F.array_except(F.map_keys(fields), F.array(*[F.lit(f.name) for f in record.fields])))


def _mistyped(fields: Column, prefix: str, record: T.StructType) -> Column:
    """Faults of the fields that are there and not JSON's null, yet NULL under the schema."""
    null = F.array_compact(F.array(F.lit(None).cast("string"), *[
        F.when(F.col(f"_d.{prefix}{f.name}").isNull(), F.lit(f.name))
        for f in record.fields if not isinstance(f.dataType, T.StructType)]))
    return _named(f"mistyped:{prefix}", F.filter(null, lambda n: _there(F.element_at(fields, n))))


def _faults(schema: T.StructType, required: tuple[str, ...]) -> Column:
    """Array of faults, from the columns _v (VARIANT), _f (each record's fields), _d (declared
    schema) and value."""
    v, none = F.col("_v"), F.lit(None).cast("string")
    of_object = [F.when(~_there(F.try_variant_get(v, f"$.{f}", "variant")), F.lit(f"missing:{f}")) for f in required]
    extra = []
    for i, (prefix, record) in enumerate(_records(schema)):
        extra += [_unknown(F.col(f"_f{i}"), prefix, record), _mistyped(F.col(f"_f{i}"), prefix, record)]
    whole = F.when(F.col("value").isNull(), "empty").when(v.isNull(), "unreadable").when(
        F.col("_f0").isNull(), "not_an_object")
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(
        F.array_sort(F.concat(F.array_compact(F.array(*(of_object or [none]))), *extra)))


def inspected(bronze: DataFrame, schema: T.StructType, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """`bronze` with `faults`, an array that is empty for sound payloads.  Batch or stream.

    Each record is opened once, as a map of its fields.  The faults are given out by a
    generator of one row: Spark puts a filter on a projected column below the projection, and
    would parse the payload again for every mention of it there."""
    text = F.col("value").cast("string")
    read = bronze.select("*", F.try_parse_json(text).alias("_v"), F.from_json(text, schema).alias("_d"))
    fields = [F.try_variant_get("_v", f"$.{prefix}".rstrip("."), "map<string,variant>").alias(f"_f{i}")
              for i, (prefix, _) in enumerate(_records(schema))]
    return read.select("*", *fields).select(*bronze.columns, F.explode(F.array(_faults(schema, required))).alias("faults"))


def sound(inspected_rows: DataFrame) -> DataFrame:
    return inspected_rows.where(F.size("faults") == 0).drop("faults")


def faulty(inspected_rows: DataFrame) -> DataFrame:
    return inspected_rows.where(F.size("faults") > 0)


def fault_counts(inspected_rows: DataFrame) -> DataFrame:
    """(topic, fault, n): faults by kind and field; a payload with several counts under each."""
    return inspected_rows.select("topic", F.explode("faults").alias("fault")).groupBy("topic", "fault").agg(
        F.count("*").alias("n"))


def quarantine_writer(path: str, schema: T.StructType, required: tuple[str, ...] = REQUIRED):
    """foreachBatch sink: sound rows to <path>/sound, faulty ones, raw, to <path>/faulty; a batch
    that runs again replaces its folders."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = inspected(batch, schema, required)
        sound(rows).write.mode("overwrite").parquet(f"{path}/sound/batch={batch_id}")
        faulty(rows).write.mode("overwrite").parquet(f"{path}/faulty/batch={batch_id}")
    return write


def released(quarantined: DataFrame, repaired: DataFrame, bronze: DataFrame, schema: T.StructType,
             required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows to append to the sound bronze table: quarantined rows with their `repaired(topic,
    partition, offset, value)` payload, if that is sound now and the table does not hold the
    row yet.  Run again, or with the same repair twice, it gives no row a second time."""
    new = repaired.groupBy(*AT).agg(F.max("value").alias("_new")).alias("n")
    rows = quarantined.dropDuplicates(AT).alias("q").join(
        new, [F.col(f"q.{c}").eqNullSafe(F.col(f"n.{c}")) for c in AT])
    rows = rows.select(*[F.col("_new").alias("value") if c == "value" else F.col(f"q.{c}").alias(c) for c in bronze.columns])
    fit = sound(inspected(rows, schema, required)).alias("f")
    held = bronze.select(*AT).distinct().alias("b")
    return fit.join(held, [F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}")) for c in AT], "left_anti")
