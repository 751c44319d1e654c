"""Property tests: rule functions are total; expectation
counts add up to the row count."""

from hypothesis import given, settings
from hypothesis import strategies as st

from berthline.functions import rules
from berthline.operators import gold, quality

num = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(num, num), min_size=1, max_size=20))
def test_rule_functions_total(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    out = df.select(rules.dwell_category("a").alias("d"),
                    rules.performance_rating("a", "b").alias("p"),
                    rules.anomaly_severity("a").alias("s"),
                    rules.peak_category("a").alias("k")).collect()
    for r in out:
        assert r.d in ("NORMAL", "DELAYED", "LONG_DELAY", "CRITICAL")
        assert r.p in ("POOR", "FAIR", "SLOW", "GOOD")
        assert r.s in ("HIGH", "MEDIUM", "LOW")
        assert r.k in ("PEAK", "BUSY", "NORMAL")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=3)), num,
                          st.sampled_from(["LOAD", "DISCHARGE", "X", None])), max_size=25))
def test_expectation_counts_add_up(spark, rows):
    df = spark.createDataFrame(rows, "container_number string, yard_dwell_time_hours double, "
                                     "crane_operation string")
    for r in quality.expectation_counts("t", df, quality.EXPECTATIONS["gold_container_export_flow"]).collect():
        assert r.passed + r.failed + r.null_result == len(rows)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=30))
def test_exact_mean_dwell(spark, ks):
    """round(avg, 2) of 2-decimal values equals the HALF_UP rounding of the exact mean."""
    from decimal import ROUND_HALF_UP, Decimal
    df = spark.createDataFrame([(k / 100,) for k in ks], "h double")
    got = df.agg(gold.exact_avg_hundredths("h").alias("m")).collect()[0].m
    want = (Decimal(sum(ks)) / Decimal(100 * len(ks))).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == float(want)
