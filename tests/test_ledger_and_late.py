"""Offset intervals, and late rows beside a watermark."""
import datetime as dt
import random

from pyspark.sql import functions as F

from berthline.operators import ledger
from berthline.streaming import late
from berthline.streaming.runner import Replay

KAFKA = "topic string, partition int, offset long"


def _plain(rows):
    """Intervals of (topic, partition, offset) rows, offset by offset."""
    out = []
    for at in sorted({r[:2] for r in rows}):
        offsets = sorted(o for t, p, o in rows if (t, p) == at and o is not None)
        for o in offsets:
            if out and out[-1][:2] == at and o <= out[-1][3] + 1:
                out[-1] = (*at, out[-1][2], o, out[-1][4] + 1)
            else:
                out.append((*at, o, o, 1))
    return out


def _got(df):
    return sorted(map(tuple, df.select("topic", "partition", "first_offset", "last_offset", "n_rows").collect()))


def test_intervals_gaps_and_redeliveries(spark, tmp_path):
    rng = random.Random(1)
    rows = [(t, p, o) for t in ("a", "b") for p in (0, 1) for o in range(60) if rng.random() < 0.8]
    rows += rng.sample(rows, 20) + [("a", 0, None)]
    df = spark.createDataFrame(rows, KAFKA)
    for block in (7, 1_000_000):
        kept = ledger.intervals(df, block)
        assert _got(kept) == _plain(rows)
    held = {(t, p, o) for t, p, o in rows if o is not None}
    missing = {(t, p, o) for t in ("a", "b") for p in (0, 1)
               for o in range(min(x for a, b, x in held if (a, b) == (t, p)), max(x for a, b, x in held if (a, b) == (t, p)))} - held
    found = {(r.topic, r.partition, o) for r in ledger.gaps(kept).collect() for o in range(r.first_offset, r.last_offset + 1)}
    assert found == missing and missing
    assert sum(r.n_offsets for r in ledger.redelivered(kept).collect()) == 20
    assert sum(r.copies - 1 for r in ledger.duplicates(df).collect()) == 20
    # stored batch by batch, a batch twice
    write = ledger.ledger_writer(str(tmp_path / "ledger"), 7)
    for n, part in enumerate((rows[::3], rows[1::3], rows[1::3], rows[2::3])):
        write(spark.createDataFrame(part, KAFKA), min(n, 1) if n < 3 else 2)
    assert _got(ledger.stored_ledger(spark, str(tmp_path / "ledger"))) == _plain(rows)
    none = ledger.intervals(spark.createDataFrame([], KAFKA))
    assert none.count() == ledger.gaps(none).count() == 0


def test_late_rows_go_aside_and_nothing_is_lost(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    schema = "id long, terminal_id string, t timestamp"
    batches = [[(1, "A", t0), (2, None, None)], [(3, "A", t0 + dt.timedelta(hours=10)), (4, "B", t0 - dt.timedelta(hours=5))],
               [(5, "A", t0 + dt.timedelta(hours=8, minutes=59)), (6, "B", t0 + dt.timedelta(hours=9)), (7, "A", t0), (8, None, t0)], []]
    rp = Replay(spark, "late-test")
    empty = spark.createDataFrame([], schema)
    src, out = rp.source("in", empty.schema, "t"), rp.path("out")
    split = late.splitter(out, "t", "1 hour")
    for rows in batches:
        rp.stage("in", spark.createDataFrame(rows, schema))
        src.writeStream.option("checkpointLocation", rp.path("ck")).trigger(availableNow=True).foreachBatch(split).start().awaitTermination()

    def sides():
        return {part: late.rows(spark, out, part, empty.schema) for part in ("on_time", "late")}
    ids = {part: sorted(r.id for r in df.collect()) for part, df in sides().items()}
    # judged by the batch before: 4 lies over an hour behind 10:00, 5 a minute behind 19:00, 6 on the mark
    assert ids == {"on_time": [1, 2, 3, 6], "late": [4, 5, 7, 8]}
    # a batch that runs again is split as before
    split(spark.createDataFrame(batches[1], schema), 1)
    assert sorted(r.id for r in late.rows(spark, out, "late", empty.schema).collect()) == [4, 5, 7, 8]
    both = late.corrected(late.hourly_vehicles(sides()["on_time"], "t", "vehicles_on_time"),
                          late.hourly_vehicles(sides()["late"], "t", "vehicles_late")).collect()
    got = {(r.terminal_id, r.window.start): (r.vehicles_on_time, r.vehicles_late, r.vehicles_in) for r in both}
    assert got[("A", t0)] == (1, 1, 2) and got[(None, t0)] == (0, 1, 1) and sum(x[2] for x in got.values()) == 7
    # with a window, a row is late once its whole window is
    wide = late.splitter(rp.path("wide"), "t", "1 hour", 3600)
    for n, rows in enumerate(batches):
        wide(spark.createDataFrame(rows, schema), n)
    assert sorted(r.id for r in late.rows(spark, rp.path("wide"), "late", empty.schema).collect()) == [4, 5, 7, 8]
    at = spark.createDataFrame([(9, "A", t0 + dt.timedelta(hours=9, minutes=1))], schema).withColumn("t", F.col("t"))
    wide(at, 4)
    assert 9 not in {r.id for r in late.rows(spark, rp.path("wide"), "late", empty.schema).collect()}
