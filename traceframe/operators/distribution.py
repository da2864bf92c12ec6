"""Normality tests and the comparison of two datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from traceframe.functions import rules, significance as sig
from traceframe.functions.labels import present
from traceframe.operators.quality import balance, trace_statistics
from traceframe.plans.ranking import unpivot

NORMAL_LEVEL = 0.05
SHAPIRO_MIN, SHAPIRO_MAX = 3, 5000


def _moments(value: str) -> list[Column]:
    return [
        F.count(value).alias("_n"),
        F.skewness(value).alias("_skew"),
        F.kurtosis(value).alias("_kurt"),
    ]


def _test_row(statistic: Column) -> Column:
    p = sig.chi2_two_dof(statistic)
    return F.struct(statistic.alias("statistic"), p.alias("p_value"), (p > NORMAL_LEVEL).alias("is_normal"))


def normality(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Omnibus and Jarque-Bera tests per group, from one pass of central moments."""
    stats = df.groupBy(*by).agg(*_moments(value))
    args = (F.col("_n"), F.col("_skew"), F.col("_kurt"))
    tested = stats.select(
        *by,
        _test_row(sig.k_squared(*args)).alias("dagostino_pearson"),
        _test_row(sig.jarque_bera(*args)).alias("jarque_bera"),
    )
    return unpivot(tested, by, ["dagostino_pearson", "jarque_bera"], "test", "r").select(*by, "test", "r.*")


def shapiro(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """W test per group, one row for every group: statistic, p_value, is_normal, n, reason.

    The published weights and tails hold for 3 to 5000 values that are not all equal; for
    other groups the statistic is null and ``reason`` says why. Sizes are counted first, so
    no group above that bound is ever ordered. Nulls and NaN are left out.
    """
    rows = df.select(*by, present(F.col(value).cast("double")).alias("_x"))
    sizes = rows.groupBy(*by).agg(F.count("_x").alias("_n"), (F.min("_x") == F.max("_x")).alias("_flat"))
    reason = (
        F.when(F.col("_n") < SHAPIRO_MIN, "fewer than 3 values")
        .when(F.col("_n") > SHAPIRO_MAX, "more than 5000 values")
        .when(F.col("_flat"), "all values are equal")
    )
    named = sizes.select(*by, F.col("_n").alias("n"), reason.alias("reason"))
    key = F.to_json(F.struct(*by)).alias("_g")  # null groups are groups
    fit = named.where("reason is null").select(key, "n")
    inside = Window.partitionBy("_g").orderBy("_x")
    scored = (
        rows.where("_x is not null").select(key, "_x").join(fit, "_g")
        .withColumn("_i", F.row_number().over(inside))
        .withColumn("_m", sig.normal_quantile((F.col("_i") - 0.375) / (F.col("n") + 0.25)))
    )
    at = lambda i: F.max(F.when(F.col("_i") == i, F.col("_x")))
    score = lambda i: F.max(F.when(F.col("_i") == i, F.col("_m")))
    n = F.col("n").cast("double")
    sums = scored.groupBy("_g", "n").agg(
        F.sum(F.col("_m") * F.col("_m")).alias("_ssm"), F.sum(F.col("_m") * F.col("_x")).alias("_mx"), (F.var_pop("_x") * F.count("_x")).alias("_ss"),
        at(F.col("n")).alias("_x1"), at(F.lit(1)).alias("_x0"), at(F.col("n") - 1).alias("_y1"), at(F.lit(2)).alias("_y0"),
        score(F.col("n")).alias("_last"), score(F.col("n") - 1).alias("_second"),
    )
    top, second, divisor = sig.w_weights(n, F.col("_last"), F.col("_second"), F.col("_ssm"))
    ends, inner = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    # The scores of both ends leave the sum and their own weights come in.
    rest = F.col("_mx") - F.col("_last") * ends - F.when(n > 5, F.col("_second") * inner).otherwise(0.0)
    total = top * ends + F.when(n > 5, second * inner).otherwise(0.0) + rest / divisor
    w = F.least(F.lit(1.0), total * total / F.col("_ss"))
    tested = sums.select("_g", w.alias("statistic")).join(fit.select("_g", n.alias("_size")), "_g").select("_g", "statistic", sig.w_p_value(F.col("statistic"), F.col("_size")).alias("p_value"))
    out = named.withColumn("_g", key).join(tested, "_g", "left")
    return out.select(*by, "statistic", "p_value", (F.col("p_value") > NORMAL_LEVEL).alias("is_normal"), "n", "reason")


COMPARED = ("mean_of_means", "mean_of_stds")


def compare_datasets(rows: DataFrame, side: str = "dataset", base: str = "a", other: str = "b") -> DataFrame:
    """Long comparison of two sides of one table: (statistic, base, other, difference, pct).

    Both sides are computed in the same aggregates and turned sideways, so the
    table is read once per statistic family, not once per side.
    """
    stats = trace_statistics(rows, by=[side])
    scores = balance(rows, by=[side])
    wide = stats.select(side, *COMPARED).join(scores.select(side, "balance_score"), side)
    long = unpivot(wide, [side], [*COMPARED, "balance_score"], "statistic", "v")
    counts = rows.filter(F.col("class_label").isNotNull()).groupBy(side, "class_label").agg(
        F.count(F.lit(1)).alias("_n")
    )
    totals = rows.groupBy(side).agg(F.count(F.lit(1)).alias("_t"))
    classes = counts.join(totals, side).select(
        side,
        F.concat(F.lit("class_pct_"), F.col("class_label").cast("string")).alias("statistic"),
        F.round(F.col("_n") / F.col("_t") * 100, 2).alias("v"),
    )
    aligned = (
        long.unionByName(classes)
        .groupBy("statistic")
        .agg(
            F.coalesce(F.max(F.when(F.col(side) == base, F.col("v"))), F.lit(0.0)).alias("base_value"),
            F.coalesce(F.max(F.when(F.col(side) == other, F.col("v"))), F.lit(0.0)).alias("other_value"),
        )
    )
    return aligned.select(
        "statistic",
        "base_value",
        "other_value",
        (F.col("other_value") - F.col("base_value")).alias("difference"),
        rules.relative_difference_pct(F.col("base_value"), F.col("other_value")).alias("relative_diff_pct"),
    )


def verdicts(comparison: DataFrame, normality_rows: DataFrame, side: str, base: str, other: str) -> DataFrame:
    """One row of verdicts and four recommendations from a comparison."""
    pick = lambda s, c: F.max(F.when(F.col("statistic") == s, F.col(c)))
    row = comparison.agg(
        pick("mean_of_means", "relative_diff_pct").alias("mean_pct"),
        pick("mean_of_stds", "relative_diff_pct").alias("std_pct"),
        pick("balance_score", "difference").alias("balance_diff"),
        pick("balance_score", "other_value").alias("balance_score"),
    )
    per_test = normality_rows.groupBy("test").agg(
        (F.max(F.when(F.col(side) == base, F.col("is_normal")))
         == F.max(F.when(F.col(side) == other, F.col("is_normal")))).alias("same")
    )
    agree = F.coalesce(per_test.agg(F.min("same")).scalar(), F.lit(True))
    mean_pct, std_pct, diff = F.col("mean_pct"), F.col("std_pct"), F.col("balance_diff")
    advice = rules.recommendations(mean_pct, diff, F.col("balance_score"), agree)
    return row.select(
        rules.similarity_verdict(mean_pct, std_pct, diff).alias("similarity"),
        agree.alias("normality_agreement"),
        rules.balance_verdict(diff).alias("class_balance"),
        *[c.alias(f"recommendation_{i}") for i, c in enumerate(advice, 1)],
    )
