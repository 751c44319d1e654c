"""A key holding a third of all rows must not land in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from berthline.operators.interval_join import interval_join

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def _max_task_share(df) -> float:
    # all columns are read, else the optimizer leaves out what a mere count does not need
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(*df.columns))).collect()]
    return max(counts) / sum(counts)


def _sides(spark, hot_key):
    n = 3000
    left = spark.range(n).select(
        F.col("id").alias("lid"),
        F.when(F.col("id") % 3 == 0, F.lit(hot_key)).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        (F.lit(BASE) + F.make_interval(hours=(F.col("id") % 720).cast("int"))).alias("lt"))
    right = spark.range(n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        (F.lit(BASE) + F.make_interval(hours=(F.col("id") % 720).cast("int"))).alias("rt"))
    return left, right


def test_hot_container_spreads_over_days(no_aqe):
    left, right = _sides(no_aqe, "HOT")
    j = interval_join(left, right, keys=["k"], left_ts="lt", right_ts="rt",
                      lower_seconds=0, upper_seconds=86400)
    plain = left.alias("l").join(right.alias("r"), (F.col("l.k") == F.col("r.k"))
                                 & (F.col("r.rt") >= F.col("l.lt"))
                                 & (F.col("r.rt") <= F.col("l.lt") + F.expr("INTERVAL 1 DAY")), "left")
    assert _max_task_share(plain.select("l.lid")) >= 0.3          # the hot key in one task
    assert _max_task_share(j.select("l.lid")) < 0.2               # spread over day buckets


def test_null_keys_spread(no_aqe):
    left, right = _sides(no_aqe, None)                            # a third of keys NULL
    j = interval_join(left, right, keys=["k"], left_ts="lt", right_ts="rt",
                      lower_seconds=0, upper_seconds=86400)
    assert j.count() >= 3000
    assert _max_task_share(j.select("l.lid")) < 0.2


def test_asof_hot_key_spreads(no_aqe):
    from berthline.operators.asof import asof_latest
    left, right = _sides(no_aqe, "HOT")
    out = asof_latest(left, right.withColumnRenamed("rid", "v"), key="k", left_ts="lt",
                      right_ts="rt", values=["v"], prefix="m_")
    assert out.count() == 3000
    assert _max_task_share(out) < 0.2


def _one_day(spark, key):
    """A third of both sides on one key within one day, the rest on many keys over a month."""
    n = 3000
    hot = F.col("id") % 3 == 0
    minute = F.when(hot, F.pmod(F.col("id") * 7, F.lit(1440))).otherwise(F.pmod(F.col("id") * 997, F.lit(43200)))
    ts = F.lit(BASE) + F.make_interval(mins=minute.cast("int"))
    side = lambda i, t: spark.range(n).select(
        F.col("id").alias(i), F.when(hot, F.lit(key)).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        ts.alias(t))
    return side("lid", "lt"), side("rid", "rt")


@pytest.mark.parametrize("key", ["HOT", ""])
def test_hot_container_within_one_day_is_split(no_aqe, key):
    left, right = _one_day(no_aqe, key)
    j = interval_join(left, right, keys=["k"], left_ts="lt", right_ts="rt", lower_seconds=0, upper_seconds=86400)
    assert _max_task_share(j.select("l.lid", "r.rid")) < 0.2
    plain = left.alias("l").join(right.alias("r"), (F.col("l.k") == F.col("r.k"))
                                 & (F.col("r.rt") >= F.col("l.lt"))
                                 & (F.col("r.rt") <= F.col("l.lt") + F.expr("INTERVAL 1 DAY")), "left")
    digest = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("l.lid", "r.rid")),
                               F.count("r.rid")).first()
    assert tuple(digest(j)) == tuple(digest(plain))


@pytest.mark.parametrize("salts", [1, 3])
def test_salts_change_no_answer(spark, salts):
    left, right = _one_day(spark, "HOT")
    left, right = left.where("lid < 300"), right.where("rid < 300")
    j = interval_join(left, right, keys=["k"], left_ts="lt", right_ts="rt", lower_seconds=-3600,
                      upper_seconds=7200, salts=salts)
    got = sorted((r.lid, r.rid) for r in j.select("l.lid", "r.rid").collect() if r.rid is not None)
    lrows, rrows = left.collect(), right.collect()
    want = sorted((a.lid, b.rid) for a in lrows for b in rrows
                  if a.k == b.k and -3600 <= (b.rt - a.lt).total_seconds() <= 7200)
    assert got == want and j.select("l.lid").distinct().count() == 100 * 3


def test_asof_hot_key_within_one_day(no_aqe):
    from berthline.operators.asof import asof_latest
    left, right = _one_day(no_aqe, "HOT")
    out = asof_latest(left, right, key="k", left_ts="lt", right_ts="rt", values=["rid"], prefix="m_")
    assert out.count() == 3000
    assert _max_task_share(out) < 0.2
