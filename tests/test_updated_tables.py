"""Tables of updates: base and batches merged on read, compaction."""
import threading

from pyspark.sql import functions as F

from berthline.sources import sinks
from berthline.streaming import updated


def _batch(spark, n):
    """Batch n changes the keys 0..9 + n."""
    return spark.range(n, n + 10).select(F.col("id").alias("k"), F.lit(n).cast("long").alias("v"))


def _want(batches):
    out = {}
    for n in range(batches):
        out.update({k: n for k in range(n, n + 10)})
    return out


def _got(df):
    rows = df.collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: r.v for r in rows}


def test_reads_stay_bounded_however_many_batches_ran(spark, tmp_path):
    path = str(tmp_path / "t")
    write = updated.batch_writer(path, keys=["k"], compact_every=4)
    for n in range(11):
        write(_batch(spark, n), n)
        _, last, base = updated._version(spark, path)
        assert sum(b > last for b in updated._batches(spark, path)) < 4
    assert base and _got(updated.latest(spark, path, ["k"])) == _want(11)
    read = {f.split("/t/")[1].split("/")[0] for f in updated.latest(spark, path, ["k"]).inputFiles()}
    assert len(read) <= 4 and "_base" in read


def test_a_batch_that_runs_again(spark, tmp_path):
    path = str(tmp_path / "t")
    write = updated.batch_writer(path, keys=["k"], compact_every=3)
    for n in (0, 1, 1, 2, 2, 3):        # batch 2 again after its compaction
        write(_batch(spark, n), n)
    assert _got(updated.latest(spark, path, ["k"])) == _want(4)


def test_a_reader_during_compaction_sees_a_whole_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write = updated.batch_writer(path)
    for n in range(5):
        write(_batch(spark, n), n)
    started, go_on, publish = threading.Event(), threading.Event(), sinks._publish

    def slow(*args):
        started.set()
        go_on.wait(60)
        publish(*args)
    monkeypatch.setattr(sinks, "_publish", slow)
    done = []
    thread = threading.Thread(target=lambda: done.append(updated.compact(spark, path, ["k"])))
    thread.start()
    assert started.wait(60)
    early = updated.latest(spark, path, ["k"])      # planned before the new base is named
    assert _got(early) == _want(5)
    go_on.set()
    thread.join()
    assert done == [True] and _got(early) == _want(5) == _got(updated.latest(spark, path, ["k"]))
    assert updated.compact(spark, path, ["k"]) is False
    monkeypatch.undo()
    # superseded batches go only when two versions hold them
    assert updated.expire(spark, path) == 0
    write(_batch(spark, 5), 5)
    assert updated.compact(spark, path, ["k"]) and updated.expire(spark, path) == 5
    assert _got(updated.latest(spark, path, ["k"])) == _want(6)
