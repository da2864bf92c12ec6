"""Recorded values: the same inputs must give the same results."""

import math

import pytest
from pyspark.sql import functions as F

from traceframe.functions import rules, significance as sig
from traceframe.operators import distribution, drift, evaluation as ev, quality

MATRIX = [[41, 11, 0], [22, 7, 0], [9, 9, 1]]


def test_metrics_of_recorded_confusion_matrix(spark):
    counts = spark.createDataFrame(
        [(t, p, MATRIX[t][p]) for t in range(3) for p in range(3)], "t bigint, p bigint, n bigint"
    )
    row = ev.summary_metrics(counts).first()
    expected = {
        "accuracy": 0.49,
        "precision_macro": 0.609568,
        "precision_weighted": 0.561296,
        "recall_macro": 0.360824,
        "f1_macro": 0.337097,
        "f1_weighted": 0.435371,
    }
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=1e-6), name


def test_chi_square_of_recorded_counts(spark):
    counts = spark.createDataFrame(
        [("0", 188, 193), ("1", 60, 53), ("2", 2, 4)], "category string, reference_count bigint, current_count bigint"
    )
    row = drift.chi_square(counts).first()
    assert row.chi2_statistic == pytest.approx(0.9913611, abs=1e-6)
    assert row.chi2_pvalue == pytest.approx(0.6091562, abs=1e-6)
    assert row.drift_detected is False


def test_two_categories_are_corrected(spark):
    counts = spark.createDataFrame([("a", 9, 19), ("b", 29, 19)], "category string, reference_count bigint, current_count bigint")
    row = drift.chi_square(counts).first()
    # 2 x 2 table [[10, 30], [20, 20]]: (|ad - bc| - n/2)^2 n / (r1 r2 c1 c2)
    assert row.chi2_statistic == pytest.approx((abs(10 * 20 - 30 * 20) - 40) ** 2 * 80 / (30 * 50 * 40 * 40))
    assert row.chi2_pvalue == pytest.approx(math.erfc(math.sqrt(row.chi2_statistic / 2)))


@pytest.mark.parametrize(
    "counts, expected", [((260, 146, 94), 0.9227105), ((5106, 2972, 1922), 0.9291693), ((7,), 0.0)]
)
def test_balance(spark, counts, expected):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "class_label bigint, c int").select(
        "class_label", F.explode(F.sequence(F.lit(1), F.col("c")))
    )
    row = quality.balance(df).first()
    assert row.balance_score == pytest.approx(expected, abs=1e-6)
    assert row.imbalance_score == pytest.approx(1 - expected, abs=1e-6)


@pytest.mark.parametrize("statistic, p", [(15.892166883788612, 3.5404609484e-4), (32.8006226496331, 7.54111024959e-8)])
def test_normality_p_values(statistic, p):
    assert sig.chi2_upper_tail(statistic, 2) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize(
    "d, n, m, p",
    [(0.112, 250, 250, 0.0868811014), (0.116, 250, 250, 0.0691338272), (0.15375, 320, 100, 0.0486525420)],
)
def test_exact_two_sample_tail(spark, d, n, m, p):
    assert sig.exact_two_sample_tail(d, n, m) == pytest.approx(p, abs=1e-9)
    df = spark.createDataFrame([(d, n, m)], "d double, n bigint, m bigint")
    assert df.select(sig.ks_p_value(F.col("d"), F.col("n"), F.col("m"), "exact")).first()[0] == pytest.approx(p, abs=1e-9)
    # The series is near the exact tail at this size already.
    assert df.select(sig.ks_p_value(F.col("d"), F.col("n"), F.col("m"))).first()[0] == pytest.approx(p, abs=7e-3)


@pytest.mark.parametrize("d, n, m", [(0.03, 4000, 4000), (0.02, 9000, 7000), (0.05, 3000, 900)])
def test_series_against_the_exact_tail(spark, d, n, m):
    df = spark.createDataFrame([(d, n, m)], "d double, n bigint, m bigint")
    got = df.select(sig.ks_p_value(F.col("d"), F.col("n"), F.col("m"))).first()[0]
    assert got == pytest.approx(sig.exact_two_sample_tail(d, n, m), abs=3e-3)


def test_large_samples(spark):
    df = spark.createDataFrame([(0.01, 20_000, 20_000)], "d double, n bigint, m bigint")
    p = df.select(sig.ks_p_value(F.col("d"), F.col("n"), F.col("m"))).first()[0]
    assert p == pytest.approx(sig.exact_two_sample_tail(0.05, 800, 800), abs=0.03)


@pytest.mark.parametrize("ratio, lower, upper", [(0.025, "low", "low"), (0.0, "none", "none"), (0.1, "medium", "low"), (0.3, "high", "medium")])
def test_severity_edges(spark, ratio, lower, upper):
    df = spark.createDataFrame([(ratio,)], "r double")
    got = df.select(rules.drift_severity(F.col("r"), "lower"), rules.drift_severity(F.col("r"), "upper")).first()
    assert tuple(got) == (lower, upper)


def test_relative_difference(spark):
    df = spark.createDataFrame([(-1.8147880952380955, -2.1825281385281388), (0.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(rules.relative_difference_pct(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([-20.263525215697246, 0.0])


def test_no_anomalies_pass(spark):
    df = spark.createDataFrame([(True, 0), (False, 2), (True, 1)], "ok boolean, n int")
    level = rules.priority(F.col("ok"), F.col("n"))
    got = [tuple(r) for r in df.select(level, rules.action(level)).collect()]
    assert got == [("LOW", "PASS"), ("HIGH", "FAIL"), ("MEDIUM", "WARN")]


def test_shapiro_against_published_example(spark):
    """Published W and p of eleven men's weights."""
    x = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([("a", float(v)) for v in x], "g string, x double")
    row = distribution.shapiro(df, "x", ["g"]).first()
    assert (row.statistic, row.p_value) == pytest.approx((0.78881, 0.006704), abs=1e-5)


def test_normal_quantile_and_tail(spark):
    from statistics import NormalDist

    p = [1e-9, 1e-4, 0.01, 0.07, 0.0751, 0.3, 0.5, 0.9, 0.999, 1 - 1e-7]
    df = spark.createDataFrame([(v,) for v in p], "p double")
    got = [r[0] for r in df.select(sig.normal_quantile(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(v) for v in p], rel=1e-9, abs=1e-12)
    z = [-6.0, -1.0, 0.0, 0.5, 2.0, 7.5]
    df = spark.createDataFrame([(v,) for v in z], "z double")
    got = [r[0] for r in df.select(sig.normal_upper_tail(F.col("z"))).collect()]
    assert got == pytest.approx([math.erfc(v / math.sqrt(2)) / 2 for v in z], rel=1e-6)


@pytest.mark.parametrize("x, dof, p", [(3.841459, 1, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05), (0.0, 3, 1.0)])
def test_chi_square_tail(x, dof, p):
    assert sig.chi2_upper_tail(x, dof) == pytest.approx(p, abs=1e-6)


def test_alerts(spark):
    df = spark.createDataFrame(
        [("high", 3, True, 0.3), ("low", 1, False, None), ("none", 0, False, 0.4)],
        "s string, n bigint, p boolean, a double",
    )
    got = df.select(rules.alerts(F.col("s"), F.col("n"), F.col("p"), F.col("a")).alias("x")).collect()
    assert [[a["type"] for a in r.x] for r in got] == [["feature_drift", "prediction_drift", "low_accuracy"], [], []]
    assert got[0].x[2]["message"] == "Model accuracy (30.00%) below threshold"
