"""As-of lookup: for each left row, the latest right row of the same key at or
before the left time (no upper bound on how far back).

A plain `Window.partitionBy(key).orderBy(ts)` over the union sends every row of
a hot key to one task.  Here the time axis is cut into buckets of an hour:

1. in-bucket: window over (key, bucket) ordered by time carrying the last right
   row forward (running frame; the sort spills, nothing is collected);
2. carry-over: one aggregate over both sides (keys and times only) gives each
   (key, bucket) its latest right row and whether left rows stand in it; a running
   max over earlier buckets -- a window over one row per key-bucket, not per
   event -- gives what comes before;
3. left rows without an in-bucket match take the carry-over of their bucket
   through an equi-join on (key, bucket), which reuses the window's
   partitioning (no second shuffle of the left side).

Left rows that cannot match (NULL key or time) get a synthetic key of their own
("n" + hash) instead of sharing one NULL partition; real keys are prefixed "k".
Exact; no row is dropped; every step is a DataFrame operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket

HOUR = 3600


def _real_key(key: str):
    return F.concat(F.lit("k"), F.col(key).cast("string"))


def asof_latest(left: DataFrame, right: DataFrame, *, key: str, left_ts: str, right_ts: str,
                values: list[str], bucket_seconds: int = HOUR, prefix: str = "asof_") -> DataFrame:
    """Left rows + `prefix<right_ts>` and `prefix<value>` of the latest right row
    with right_ts <= left_ts (NULL when none or when key/time is NULL)."""
    w_us = bucket_seconds * 1_000_000
    rstruct = F.struct(F.col(right_ts).alias("t"), *[F.col(v).alias(v) for v in values])
    rtype = right.select(rstruct.alias("r")).schema["r"].dataType
    lcols = left.columns
    rvalid = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())

    unmatchable = F.col(key).isNull() | F.col(left_ts).isNull()
    synthetic = F.concat(F.lit("n"), F.xxhash64(*[F.col(c) for c in lcols]).cast("string"))
    l = left.select(*[F.col(c) for c in lcols],
                    F.when(unmatchable, synthetic).otherwise(_real_key(key)).alias("_a_key"),
                    F.col(left_ts).alias("_a_ts"),
                    F.coalesce(time_bucket(left_ts, w_us), F.lit(0)).alias("_a_b"),
                    F.lit(1).alias("_a_side"), F.lit(None).cast(rtype).alias("_a_r"))
    r = rvalid.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields],
                      _real_key(key).alias("_a_key"), F.col(right_ts).alias("_a_ts"),
                      time_bucket(right_ts, w_us).alias("_a_b"), F.lit(0).alias("_a_side"),
                      rstruct.alias("_a_r"))
    # Right rows sort before left rows at equal time: "at or before".
    w = (Window.partitionBy("_a_key", "_a_b").orderBy("_a_ts", "_a_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lhs = (l.unionByName(r).withColumn("_a_in", F.last("_a_r", ignorenulls=True).over(w))
           .where(F.col("_a_side") == 1))

    # Carry-over table: for every (key, bucket) holding left rows, the latest right
    # row of any earlier bucket.
    carried = rstruct if values else F.struct(F.col(right_ts).alias("t"))
    marks = left.where(~unmatchable).select(
        _real_key(key).alias("_a_key"), time_bucket(left_ts, w_us).alias("_a_b"),
        F.lit(None).cast(rtype).alias("_c_r"), F.lit(True).alias("_c_left"))
    found = rvalid.select(_real_key(key).alias("_a_key"), time_bucket(right_ts, w_us).alias("_a_b"),
                          carried.alias("_c_r"), F.lit(False).alias("_c_left"))
    both = marks.unionByName(found)
    # without values a plain max of the time: a hash aggregate, no sort
    latest = F.max("_c_r") if values else F.struct(F.max("_c_r.t").alias("t"))
    per_bucket = both.groupBy("_a_key", "_a_b").agg(latest.alias("_c_r"), F.max("_c_left").alias("_c_left"))
    wc = Window.partitionBy("_a_key").orderBy("_a_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (per_bucket.withColumn("_c_prev", F.max(F.when(F.col("_c_r.t").isNotNull(), F.col("_c_r"))).over(wc))
             .where("_c_left").select("_a_key", "_a_b", "_c_prev"))

    out = lhs.join(carry, ["_a_key", "_a_b"], "left")
    best = F.coalesce(F.col("_a_in"), F.col("_c_prev"))
    return out.select(*[F.col(c) for c in lcols],
                      best["t"].alias(prefix + right_ts),
                      *[best[v].alias(prefix + v) for v in values])
