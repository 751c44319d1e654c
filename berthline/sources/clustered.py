"""Clustered tables kept up as rows arrive: curve order, zone map, file-wise rewrites.

A table is a set of parquet files and a zone map with one row a file: its rows
and the smallest and largest value of every cluster key.  Files follow a curve
over all keys (bits of each key's quantile bin, interleaved), so a filter on
any one of them leaves out most files.  The curve is halved into slots of one
file at most (a block of the curve is a box of the keys), which the table keeps
for good: a new row belongs to a slot and, within it, to the files whose key
ranges hold it.  `merge` rewrites these files
alone, together with the new rows; all others stay as they are.

Every change writes new files and a new zone map, then names that map the
current version by a numbered file that must not exist yet.  Readers see one
version, whole; of two writers that start from the same version the second
fails and can merge again.

    <folder>/data/<id>/_slot=<n>/part-*     rows
    <folder>/zones/<id>/part-*.parquet      zone map; <id>-layout.json: the curve;
                                            <id>-inputs: files the rows came from
    <folder>/_versions/<number>             names a zone map
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import sinks

FILE_ROWS = 1_000_000       # rows of a slot when the table is laid out, at most; of a task's files, about
BINS = 64                   # quantile bins of a key: BINS ** len(keys) cells of the curve, at most
SAMPLED = 20_000            # rows the bins are chosen from, about (they shape the layout, not the result)


class Conflict(RuntimeError):
    """Another writer has published a version since this one was read."""


@dataclass(frozen=True)
class Layout:
    keys: list[str]
    types: list[str]            # of the keys
    bounds: list[list[str]]     # upper ends of each key's bins, but for the last
    slots: list[int]            # slot of every cell of the curve
    file_rows: int
    schema: str                 # of the table, as JSON

    def slot(self) -> Column:
        """Slot of a row, from its keys: comparisons with constants, no shuffle."""
        cell = _interleaved([(_bin(F.col(f"`{k}`"), [F.lit(b).cast(t) for b in bounds]), _bits(bounds))
                             for k, t, bounds in zip(self.keys, self.types, self.bounds)])
        slots = F.split(F.lit(",".join(map(str, self.slots))), ",").cast("array<int>")     # folded to a constant
        return F.element_at(slots, (cell + 1).cast("int"))


def _bits(bounds: list) -> int:
    return len(bounds).bit_length()


def _bin(value: Column, bounds: list[Column]) -> Column:
    """Number of bounds at or below the value, by a balanced tree of comparisons (null: all)."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < bounds[mid], among(low, mid)).otherwise(among(mid + 1, high))
    return among(0, len(bounds))


def _interleaved(parts: list[tuple[Column, int]]) -> Column:
    """Place on the curve: the highest bit of every part in turn, then the next ones."""
    out = F.lit(0).cast("long")
    for level in range(max((bits for _, bits in parts), default=0)):
        for value, bits in parts:
            if level < bits:
                bit = F.shiftright(value.cast("long"), bits - 1 - level).bitwiseAND(F.lit(1))
                out = F.shiftleft(out, 1).bitwiseOR(bit)
    return out


def plan_layout(df: DataFrame, keys: list[str], file_rows: int = FILE_ROWS, bins: int = BINS) -> Layout:
    """Bins by quantiles of a sample, slots by the rows of every cell (one narrow
    aggregate; the cells are bounded by the bins)."""
    total = df.count()
    sample = df.select(*[F.col(f"`{k}`").cast("string").alias(f"s{i}") for i, k in enumerate(keys)],
                       *[F.col(f"`{k}`").alias(f"v{i}") for i, k in enumerate(keys)])
    rows = sample.sample(min(1.0, SAMPLED / max(total, 1)), seed=17).collect()
    bounds = []
    for i in range(len(keys)):
        values = sorted((r[f"v{i}"], r[f"s{i}"]) for r in rows if r[f"v{i}"] is not None)
        cut = [values[len(values) * b // bins][1] for b in range(1, bins)] if values else []
        first = values[0][1] if values else None
        bounds.append([c for c in dict.fromkeys(cut) if c != first])
    types = [df.schema[k].dataType.simpleString() for k in keys]
    cells = 1 << sum(map(_bits, bounds))
    whole = Layout(keys, types, bounds, list(range(cells)), file_rows, df.schema.json())
    counts = {r["cell"]: r["n"] for r in df.groupBy(whole.slot().alias("cell")).agg(F.count("*").alias("n")).collect()}
    upto = [0, *accumulate(counts.get(cell, 0) for cell in range(cells))]
    slots, open_ = [], [(0, cells)]
    while open_:                # blocks of the curve in order
        a, b = open_.pop()
        if b - a > 1 and upto[b] - upto[a] > file_rows:
            open_ += [((a + b) // 2, b), (a, (a + b) // 2)]
        else:
            slots += [slots[-1] + 1 if slots else 0] * (b - a)
    return Layout(keys, types, bounds, slots, file_rows, whole.schema)


class ClusteredTable:
    """The version of a table published last (or `version`, if given)."""

    def __init__(self, spark: SparkSession, folder: str, version: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        found = sinks._versions(spark, self.folder)
        self.version = version if version is not None else max(found, default=0)
        self._zones = sinks._read_text(spark, self._pointer(self.version)) if self.version else None
        self.layout = Layout(**json.loads(sinks._read_text(spark, f"{self._zones}-layout.json"))) if self._zones else None

    def _pointer(self, version: int) -> str:
        return f"{self.folder}/_versions/{version:08d}"

    # ------------------------------------------------------------ reading
    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.layout.schema))

    def inputs(self) -> set[str]:
        """Files whose rows the version holds, as far as they were named in `merge`."""
        if not self._zones:
            return set()
        return {r["file"] for r in self.spark.read.schema("file string").parquet(f"{self._zones}-inputs").collect()}

    def zones(self) -> DataFrame:
        """One row a file: file, slot, n_rows, and lo_<key>, hi_<key>, nulls_<key> of every key."""
        if not self._zones:
            raise FileNotFoundError(f"no version of {self.folder} has been published")
        return self.spark.read.parquet(self._zones)

    def files(self, **ranges: tuple) -> list[str]:
        """Files that may hold rows with every named key within its (low, high), ends included."""
        at = self.zones()
        for key, (low, high) in ranges.items():
            t = self.layout.types[self.layout.keys.index(key)]
            at = at.where((F.col(f"`hi_{key}`") >= F.lit(low).cast(t)) & (F.col(f"`lo_{key}`") <= F.lit(high).cast(t)))
        return sorted(r["file"] for r in at.select("file").collect())

    def read(self, **ranges: tuple) -> DataFrame:
        """All rows, or those with the named keys within their ranges, from the files that may hold them."""
        files, schema = self.files(**ranges), self.schema
        df = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        for key, (low, high) in ranges.items():
            df = df.where(F.col(f"`{key}`").between(F.lit(low).cast(schema[key].dataType), F.lit(high).cast(schema[key].dataType)))
        return df

    # ------------------------------------------------------------ writing
    def merge(self, rows: DataFrame, *, replace: list[str] | None = None, keys: list[str] | None = None,
              file_rows: int = FILE_ROWS, inputs: list[str] = ()) -> dict:
        """Publish a version with `rows` added; with `replace` (which must include the cluster
        keys), rows equal in these columns, nulls included, make way for them.

        The first call lays the table out (`keys`, `file_rows`).  `inputs` names the files
        the rows are from; they are recorded with the version, so that a writer lost
        half way neither loses nor repeats any.  Returns the numbers of files
        rewritten, kept and written.  No rows and no inputs: nothing is published."""
        spark, first = self.spark, self._zones is None
        if replace and not set(self.layout.keys if self.layout else keys) <= set(replace):
            raise ValueError("the cluster keys must be among the columns replaced on")
        incoming = sinks.fresh_path(spark, "clustered-incoming")
        rows = rows if first else rows.select(*[F.col(f"`{c}`") for c in self.schema.names])
        rows.write.parquet(incoming)
        rows = spark.read.schema(rows.schema).parquet(incoming)
        n = rows.count()
        if first:
            if not keys:
                raise ValueError("the first merge needs the cluster keys")
            self.layout = plan_layout(rows, keys, file_rows)
        elif not n and not inputs:
            return {"rewritten": 0, "kept": self.zones().count(), "written": 0}
        touched = {} if first or not n else {t["file"]: t["n_rows"] for t in self._overlapping(rows)}
        merged = rows
        if touched:
            n += sum(touched.values())
            old = spark.read.schema(rows.schema).parquet(*sorted(touched))
            if replace:
                new, same = rows.select(*[F.col(f"`{c}`").alias(f"_n{i}") for i, c in enumerate(replace)]).distinct(), F.lit(True)
                for i, c in enumerate(replace):
                    same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_n{i}"))
                old = old.join(new, same, "left_anti")
            merged = old.unionByName(rows)
        added = self._write(merged, n)
        kept = None
        if not first:
            gone = spark.createDataFrame([(f,) for f in touched], "file string")
            kept = self.zones().join(gone, "file", "left_anti")
        self._publish(added if kept is None else kept.unionByName(added), sorted(self.inputs() | set(inputs)))
        return {"rewritten": len(touched), "kept": 0 if kept is None else kept.count(), "written": added.count()}

    def _overlapping(self, rows: DataFrame) -> list:
        """Files whose slots and key ranges hold a new row.  Equal keys are combined first, so a
        hot one is a single row of the join."""
        keys = self.layout.keys
        new = rows.select(self.layout.slot().alias("slot"), *[F.col(f"`{k}`") for k in keys]).distinct()
        inside = F.lit(True)
        for k in keys:
            inside = inside & (F.col(f"`{k}`").eqNullSafe(F.col(f"`lo_{k}`")) | F.col(f"`{k}`").between(
                F.col(f"`lo_{k}`"), F.col(f"`hi_{k}`")) | (F.col(f"`{k}`").isNull() & F.col(f"`nulls_{k}`")))
        return self.zones().join(new, "slot").where(inside).select("file", "n_rows").distinct().collect()

    def _write(self, rows: DataFrame, n: int) -> DataFrame:
        """New files in curve order, and their zones (a scan of the keys alone)."""
        path, keys, names = f"{self.folder}/data/{uuid.uuid4().hex[:16]}", self.layout.keys, rows.columns
        order = ["_slot", *[f"`{k}`" for k in keys]]
        count = max(1, math.ceil(n / self.layout.file_rows))
        rows.withColumn("_slot", self.layout.slot()).repartitionByRange(count, *order, F.xxhash64(*names)) \
            .sortWithinPartitions(*order).write.partitionBy("_slot").parquet(path)
        back = self.spark.read.schema(rows.schema.add("_slot", "integer")).parquet(path)
        file = F.concat(F.lit(f"{path}/_slot="), "_slot", F.lit("/"), "_metadata.file_name")
        zones = back.groupBy(file.alias("file"), F.col("_slot").alias("slot")).agg(
            F.count("*").alias("n_rows"),
            *[c for k in keys for c in (F.min(f"`{k}`").alias(f"lo_{k}"), F.max(f"`{k}`").alias(f"hi_{k}"),
                                        F.bool_or(F.col(f"`{k}`").isNull()).alias(f"nulls_{k}"))])
        at = f"{self.folder}/zones/{uuid.uuid4().hex[:16]}-added"
        zones.write.parquet(at)
        return self.spark.read.schema(zones.schema).parquet(at)

    def _publish(self, zones: DataFrame, inputs: list[str]) -> None:
        own = f"{self.folder}/zones/{uuid.uuid4().hex[:16]}"
        zones.coalesce(4).write.parquet(own)        # one narrow row a file
        self.spark.createDataFrame([(f,) for f in inputs], "file string").coalesce(1).write.parquet(f"{own}-inputs")
        sinks._publish(self.spark, f"{own}-layout.json", json.dumps(asdict(self.layout)))
        pointer = self._pointer(self.version + 1)
        sinks._publish(self.spark, pointer, own)
        if sinks._read_text(self.spark, pointer) != own:
            raise Conflict(f"{self.folder}: version {self.version + 1} was published by another writer")
        self.version, self._zones = self.version + 1, own
