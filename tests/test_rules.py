import pytest
from pyspark.sql import functions as F

from berthline.functions import rules


def _eval(spark, col, values, typ):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_dwell_category_bounds(spark):
    got = _eval(spark, rules.dwell_category, [None, 0.0, 23.99, 24.0, 47.99, 48.0, 71.99, 72.0],
                "double")
    assert got == ["CRITICAL", "NORMAL", "NORMAL", "DELAYED", "DELAYED", "LONG_DELAY",
                   "LONG_DELAY", "CRITICAL"]
    named = _eval(spark, lambda c: rules.dwell_category(c, null_category="UNMATCHED"), [None], "double")
    assert named == ["UNMATCHED"]


def test_dwell_hours_rounding(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 23:59:42.9")],
                               "a string, b string").select(
        F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    # 86382 whole seconds / 3600 = 23.995 -> HALF_UP 24.0 -> DELAYED
    r = df.select(rules.dwell_hours("a", "b").alias("h")).collect()[0]
    assert r.h == 24.0


def test_performance_rating_first_match(spark):
    df = spark.createDataFrame([(5.0, 100.0), (5.01, 100.0), (10.0, 100.0), (10.01, 200.0),
                                (0.0, 120.0), (0.0, 120.01)], "r double, c double")
    got = [x[0] for x in df.select(rules.performance_rating("r", "c")).collect()]
    assert got == ["GOOD", "FAIR", "FAIR", "POOR", "GOOD", "SLOW"]


@pytest.mark.parametrize("n,exp", [(4, "LOW"), (5, "MEDIUM"), (9, "MEDIUM"), (10, "HIGH")])
def test_severity(spark, n, exp):
    assert _eval(spark, rules.anomaly_severity, [n], "bigint") == [exp]


@pytest.mark.parametrize("n,exp", [(19, "NORMAL"), (20, "BUSY"), (49, "BUSY"), (50, "PEAK")])
def test_peak(spark, n, exp):
    assert _eval(spark, rules.peak_category, [n], "bigint") == [exp]


def test_code_labels_and_iso(spark):
    assert _eval(spark, rules.process_type_desc, ["01", "02", "03", None], "string") == \
        ["IMPORT", "EXPORT", "UNKNOWN", "UNKNOWN"]
    assert _eval(spark, rules.transport_mode_desc, ["01", "02", "03", "09"], "string") == \
        ["LAUT", "UDARA", "DARAT", "UNKNOWN"]
    assert _eval(spark, rules.epoch_to_iso, [0, None, 1704067200], "bigint") == \
        [None, None, "2024-01-01T00:00:00+00:00"]


def test_ocr_band(spark):
    df = spark.createDataFrame([(0.95, "C"), (0.94, "C"), (0.80, "C"), (0.79, ""), (0.99, "")],
                               "s double, n string")
    got = [x[0] for x in df.select(rules.ocr_band("s", "n")).collect()]
    assert got == ["SUCCESS", "LOW_CONFIDENCE", "LOW_CONFIDENCE", "FAILED", "FAILED"]
