"""Clustered tables kept up by file-wise rewrites."""
import pytest
from pyspark.sql import functions as F

from berthline.sources.clustered import ClusteredTable, Conflict


def _rows(spark, a, b, salt=0):
    """Two independent keys of 97 and 89 values, and a payload."""
    return spark.range(a, b).select(
        F.format_string("T%02d", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(97))).alias("k1"),
        F.pmod(F.xxhash64("id", F.lit(salt + 1)), F.lit(89)).cast("int").alias("k2"), F.col("id").alias("v"))


def _sorted(df):
    return sorted(map(tuple, df.select("k1", "k2", "v").collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clustered") / "t")
    ClusteredTable(spark, folder).merge(_rows(spark, 0, 8000), keys=["k1", "k2"], file_rows=200)
    return folder


def test_filters_on_either_key_leave_out_most_files(spark, table):
    t = ClusteredTable(spark, table)
    files = t.files()
    assert len(files) >= 32 and t.read().count() == 8000
    for ranges in ({"k1": ("T40", "T40")}, {"k2": (30, 30)}):
        assert 0 < len(t.files(**ranges)) < 0.2 * len(files)
        (key, (low, _)), = ranges.items()
        assert _sorted(t.read(**ranges)) == _sorted(_rows(spark, 0, 8000).where(F.col(key) == low))
    assert t.read(k1=("a", "b")).count() == 0


def test_a_batch_rewrites_only_the_files_its_keys_lie_in(spark, table):
    before = ClusteredTable(spark, table)
    files = set(before.files())
    batch = spark.createDataFrame([("T40", 30, 90001), ("T40", 31, 90002), ("T41", 30, 90003)], "k1 string, k2 int, v long")
    holding = {f for a, b in (("T40", 30), ("T40", 31), ("T41", 30)) for f in before.files(k1=(a, a), k2=(b, b))}
    t = ClusteredTable(spark, table)
    done = t.merge(batch)
    after = set(t.files())
    assert 1 <= done["rewritten"] <= len(holding) <= 8 and done["kept"] == len(files) - done["rewritten"]
    assert files - after <= holding and len(files & after) == done["kept"]
    assert _sorted(t.read()) == _sorted(_rows(spark, 0, 8000).unionByName(batch))
    # the version before is still whole, and a writer that started from it fails
    assert before.read().count() == 8000 and t.read().count() == 8003
    with pytest.raises(Conflict):
        before.merge(batch)


def test_rows_are_replaced_by_their_keys(spark, tmp_path):
    folder = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), (None, 1, 1), ("b", None, 1), ("b", None, 2)], "k1 string, k2 int, v long")
    ClusteredTable(spark, folder).merge(first, keys=["k1", "k2"], file_rows=2)
    t = ClusteredTable(spark, folder)
    t.merge(spark.createDataFrame([("a", 2, 7), (None, 1, 8), ("c", 3, 9), ("b", None, 10)], "k1 string, k2 int, v long"),
            replace=["k1", "k2"])
    assert _sorted(ClusteredTable(spark, folder).read()) == sorted(
        [("a", 1, 1), ("a", 2, 7), (None, 1, 8), ("c", 3, 9), ("b", None, 10)], key=repr)
    with pytest.raises(ValueError):
        t.merge(first, replace=["k1"])


def test_empty_tables_and_recorded_inputs(spark, tmp_path):
    folder = str(tmp_path / "t")
    none = _rows(spark, 0, 0)
    t = ClusteredTable(spark, folder)
    with pytest.raises(FileNotFoundError):
        t.zones()
    t.merge(none, keys=["k1", "k2"], inputs=["x"])
    assert ClusteredTable(spark, folder).read().count() == 0 and t.inputs() == {"x"}
    assert t.merge(none) == {"rewritten": 0, "kept": 0, "written": 0} and t.version == 1
    t.merge(_rows(spark, 0, 10), inputs=["y"])
    t.merge(none, inputs=["z"])
    again = ClusteredTable(spark, folder)
    assert again.inputs() == {"x", "y", "z"} and again.version == 3 and again.read().count() == 10


def test_a_hot_key_spreads_over_files(spark, tmp_path):
    rows = _rows(spark, 0, 3000).unionByName(spark.range(3000).select(F.lit("T40").alias("k1"), F.lit(30).alias("k2"), F.col("id").alias("v")))
    t = ClusteredTable(spark, str(tmp_path / "t"))
    t.merge(rows, keys=["k1", "k2"], file_rows=200)
    most = t.zones().agg(F.max("n_rows")).first()[0]
    assert most < 0.2 * 6000 and t.read().count() == 6000
