"""Equi + time-interval join (left outer or inner), skew-aware.

    left.k = right.k AND left_ts + lower <= right_ts <= left_ts + upper

Plain Spark plans this as a hash/sort-merge join on `k` with the range as a
residual, so every row of one key meets every row of the same key on the other
side: a container that sees millions of events becomes one quadratic task.

Here the time axis is cut into buckets of `bucket_seconds`, by default as wide as
the interval (an hour at least), so the other side is copied twice and a bucket's
rows meet at most about twice the rows they match.  Narrower buckets part a busy
key further, for more copies: an eighth makes nine, all of which a stream keeps as
state.  The preserved (left) side keeps exactly ONE bucket,
floor(left_ts / w); the other side is copied into every bucket b with
floor((right_ts - upper) / w) <= b <= floor((right_ts - lower) / w), i.e. each
bucket a matching left time can fall in.  A matching pair therefore meets in
exactly one bucket, left rows are never duplicated, and the outer join stays
exact.

A key can be hot within one bucket too.  Left rows of such a (key, bucket) are
dealt over salts by row hash and the right rows of that bucket are copied to
each salt.  In batch the hot ones are found first: more than HOT_SHARE of the
left rows, so there are at most 1 / HOT_SHARE of them, and only they are copied.
On streams nothing can be counted ahead: `salts` deals every left row, at the
price of that many copies of the right side.

Rows that can never match (NULL key or NULL time) get a deterministic salt of
their own, so they spread over partitions instead of piling up in the partition
of the NULL hash.  A blank key is a key like any other.  The output holds every
matching pair, as the join is defined: a container with n gate and m crane
events within the interval gives n x m rows.

Works on streaming inputs too: the bucket copy is a stateless `explode` before
the symmetric-hash join, and the range predicate on the watermarked time columns
lets the state store evict.  A streaming left row whose time is NULL would never
leave the join state, so on streams never-matching left rows are routed around
the join (stateless) and unioned back with NULL right columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket

_SALT_SPACE = 1 << 62
HOT_SHARE = 1 / 256         # of the left rows in one (key, bucket)
HOT_LEAST = 16              # rows below which a (key, bucket) is not split


def _hot(left: DataFrame, keys: list[str], bucket: Column, matchable: Column) -> DataFrame | None:
    """(keys, bucket, salts) of the (key, bucket) groups to split; None if there are none.
    Counts are combined before the shuffle; at most 1 / HOT_SHARE rows reach the driver."""
    counts = left.where(matchable).groupBy(*[F.col(k) for k in keys], bucket.alias("_ij_bucket")).agg(
        F.count("*").alias("n"))
    # one job: the total is observed while the largest groups are taken
    seen = Observation()
    largest = counts.observe(seen, F.sum("n").alias("total")).orderBy(F.desc("n")).limit(int(1 / HOT_SHARE)).collect()
    limit = max((seen.get["total"] or 0) * HOT_SHARE, HOT_LEAST)
    rows = [r for r in largest if r["n"] > limit]
    if not rows:
        return None
    schema = counts.select(*keys, "_ij_bucket").schema.add("_ij_salts", "integer")
    return left.sparkSession.createDataFrame(
        [(*[r[k] for k in keys], r["_ij_bucket"], int(-(-r["n"] // limit))) for r in rows], schema)


def interval_join(left: DataFrame, right: DataFrame, *, keys: list[str],
                  left_ts: str, right_ts: str, lower_seconds: int, upper_seconds: int,
                  how: str = "left", bucket_seconds: int | None = None, salts: int = 1,
                  left_alias: str = "l", right_alias: str = "r",
                  right_filter: Column | None = None) -> DataFrame:
    """Join `left` to `right` on equal `keys` and right_ts within
    [left_ts + lower, left_ts + upper] (both ends inclusive).

    Returns the joined frame with `left_alias` / `right_alias` aliases so
    callers select `l.col` / `r.col`.  Helper columns start with `_ij_`.
    Batch inputs are counted once when the join is built (see `_hot`).
    """
    if how not in ("left", "inner"):
        raise ValueError("interval_join supports how='left' or 'inner'")
    if upper_seconds < lower_seconds:
        raise ValueError("upper bound below lower bound")
    streaming = left.isStreaming or right.isStreaming
    width = bucket_seconds or max(upper_seconds - lower_seconds, 3600)
    w_us = width * 1_000_000
    lo_us, hi_us = lower_seconds * 1_000_000, upper_seconds * 1_000_000
    if right_filter is not None:
        right = right.where(right_filter)

    unmatched = F.col(left_ts).isNull()
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    row_hash = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(_SALT_SPACE))
    rt = F.col(right_ts)
    l = left.withColumn("_ij_bucket", time_bucket(left_ts, w_us))
    r = right.where(rt.isNotNull() & F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys) if keys else "TRUE")) \
        .select("*", F.explode(F.sequence(time_bucket(right_ts, w_us, hi_us),
                                          time_bucket(right_ts, w_us, lo_us))).alias("_ij_bucket"))
    hot = None if streaming else _hot(left, keys, time_bucket(left_ts, w_us), ~unmatched)
    n_salts = F.lit(salts)
    if hot is not None:
        hot = F.broadcast(hot)          # at most 1 / HOT_SHARE rows
        l, r = (x.join(hot, [*keys, "_ij_bucket"], "left") for x in (l, r))
        n_salts = F.coalesce(F.col("_ij_salts"), F.lit(1)) * salts
    # Never-matching rows keep their whole row hash (deterministic, so recomputation after
    # an executor loss lands rows in the same place): as many ways as rows.
    l = l.select(*left.columns, "_ij_bucket", F.when(unmatched, -1 - row_hash).otherwise(
        F.pmod(row_hash, n_salts)).alias("_ij_salt"))
    # The right salts start at 0 for every row, written as a non-constant expression so
    # that the optimizer keeps `l._ij_salt = r._ij_salt` as a hash key (a literal 0
    # would be folded into a residual filter and the salt would spread nothing).
    zero = F.pmod(F.xxhash64(*[F.col(k) for k in keys] or [rt]), F.lit(1))
    copies = zero if hot is None and salts == 1 else F.explode(F.sequence(zero, zero + n_salts - 1))
    r = r.select(*right.columns, "_ij_bucket", copies.alias("_ij_salt"))

    split = how == "left" and left.isStreaming
    if split:
        around = l.where(F.col("_ij_salt") < 0)
        l = l.where(F.col("_ij_salt") >= 0)
    la, ra = l.alias(left_alias), r.alias(right_alias)
    cond = [F.col(f"{left_alias}.{k}") == F.col(f"{right_alias}.{k}") for k in keys]
    cond += [F.col(f"{left_alias}._ij_bucket") == F.col(f"{right_alias}._ij_bucket"),
             F.col(f"{left_alias}._ij_salt") == F.col(f"{right_alias}._ij_salt")]
    lts = F.col(f"{left_alias}.{left_ts}")
    rts = F.col(f"{right_alias}.{right_ts}")
    cond += [rts >= lts + F.expr(f"INTERVAL {lower_seconds} SECONDS"),
             rts <= lts + F.expr(f"INTERVAL {upper_seconds} SECONDS")]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    joined = la.join(ra, on, how)
    if not split:
        return joined
    # Right columns as one struct (NULL for rows routed around the join), so the
    # union keeps `l.x` / `r.x` access for callers.
    rstruct = F.struct(*[F.col(f"{right_alias}.{c}").alias(c) for c in r.columns])
    matched = joined.select(*[F.col(f"{left_alias}.{c}") for c in l.columns],
                            rstruct.alias(right_alias))
    rtype = matched.schema[right_alias].dataType
    unmatched = around.select(*[F.col(c) for c in l.columns],
                              F.lit(None).cast(rtype).alias(right_alias))
    return matched.unionByName(unmatched).alias(left_alias)
