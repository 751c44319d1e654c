"""The daily terminal summary kept up by change sets instead of full recomputation.

A refresh reads the rows that came since the last one (the input files that the
view's current version does not list), takes from them the touched (terminal,
date) keys, recomputes these keys alone from the whole inputs, and writes the
dates they stand in.  All other dates keep their files.  A version is a list of
date folders and of the input files they were computed from; it is named by a
numbered file that must not exist yet, so readers see one version, whole, and a
refresh that is lost half way is simply done again.

    <folder>/data/<id>/_day=<date>/part-*.parquet   rows of one date
    <folder>/state/<id>/days, <id>/inputs           what a version holds
    <folder>/_versions/<number>                     names a state
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..sources import sinks

KEYS = ["terminal_id", "date"]
NO_DATE = "none"            # folder of rows without a date


@dataclass(frozen=True)
class Refresh:
    """What one refresh did."""
    new_files: int
    touched_keys: int
    touched_dates: int
    kept_dates: int


def _day() -> Column:
    return F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit(NO_DATE))


def _same(keys: list[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


class DailyView:
    """`inputs`: {"export": (frame, time column), "import": ..., "crane": ...}, batch frames over
    files that are only ever added (streamed tables, landed parquet)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _state(self) -> tuple[int, str | None]:
        number = max(sinks._versions(self.spark, self.folder), default=0)
        return number, sinks._read_text(self.spark, f"{self.folder}/_versions/{number:08d}") if number else None

    def days(self) -> dict[str, str]:
        """{date: folder} of the current version; one entry a date."""
        _, state = self._state()
        return {r["day"]: r["folder"] for r in self.spark.read.parquet(f"{state}/days").collect()} if state else {}

    def read(self) -> DataFrame:
        days = self.days()
        if not days:
            raise FileNotFoundError(f"no version of {self.folder} has been published")
        return self.spark.read.parquet(*sorted(days.values()))

    def refresh(self, inputs: dict[str, tuple[DataFrame, str]], processing_time: bool = True) -> Refresh:
        """Publish a version that equals the summary of all rows of `inputs`, recomputing only the
        keys that rows from new files touch."""
        spark = self.spark
        number, state = self._state()
        known = spark.read.parquet(f"{state}/inputs") if state else spark.createDataFrame([], "input string, file string")
        listed = {name: set(df.inputFiles()) for name, (df, _) in inputs.items()}
        now = spark.createDataFrame([(n, f) for n, files in listed.items() for f in files], "input string, file string")
        fresh: dict[str, list[str]] = {}
        for r in now.join(known, ["input", "file"], "left_anti").collect():
            fresh.setdefault(r["input"], []).append(r["file"])
        new_files = sum(map(len, fresh.values()))
        before = self.days()
        if not new_files:
            return Refresh(0, 0, 0, len(before))
        touched = None
        for name, files in fresh.items():
            df, ts = inputs[name]
            part = spark.read.schema(df.schema).parquet(*files).select("terminal_id", F.to_date(ts).alias("date")).distinct()
            touched = part if touched is None else touched.unionByName(part)
        own = f"{self.folder}/state/{uuid.uuid4().hex[:16]}"
        touched.distinct().write.parquet(f"{own}/touched")
        touched = spark.read.schema(touched.schema).parquet(f"{own}/touched")

        def of_touched(name: str) -> DataFrame:
            df, ts = inputs[name]
            rows = df.withColumn("date", F.to_date(ts)).alias("r")
            return rows.join(touched.alias("t"), _same(KEYS, "r", "t"), "left_semi").drop("date")
        rows = gold.terminal_daily_summary(of_touched("export"), of_touched("import"), of_touched("crane"), processing_time)
        dates = {r["day"] for r in touched.select(_day().alias("day")).distinct().collect()}
        again = [before[d] for d in sorted(dates & set(before))]
        if again:       # other terminals' rows of the same dates move along
            old = spark.read.schema(rows.schema).parquet(*again).alias("o")
            rows = rows.unionByName(old.join(touched.alias("t"), _same(KEYS, "o", "t"), "left_anti"))
        data = f"{self.folder}/data/{uuid.uuid4().hex[:16]}"
        rows.withColumn("_day", _day()).repartition("_day").write.partitionBy("_day").parquet(data)
        written = self._written(data)
        after = {**{d: f for d, f in before.items() if d not in dates}, **written}
        spark.createDataFrame(sorted(after.items()), "day string, folder string").coalesce(1).write.parquet(f"{own}/days")
        now.coalesce(1).write.parquet(f"{own}/inputs")
        pointer = f"{self.folder}/_versions/{number + 1:08d}"
        sinks._publish(spark, pointer, own)
        if sinks._read_text(spark, pointer) != own:
            raise RuntimeError(f"{self.folder}: version {number + 1} was published by another refresh")
        return Refresh(new_files, touched.count(), len(dates), len(after) - len(written))

    def _written(self, data: str) -> dict[str, str]:
        """{date: folder} that a write left below `data`."""
        found = sinks._fs(self.spark, data).listStatus(sinks._hpath(self.spark, data))
        paths = [st.getPath() for st in found if st.getPath().getName().startswith("_day=")]
        return {p.getName().removeprefix("_day="): p.toString() for p in paths}
