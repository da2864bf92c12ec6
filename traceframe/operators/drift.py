"""Feature drift, prediction drift and the monitoring report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from traceframe.functions import rules, significance as sig
from traceframe.functions.labels import present
from traceframe.plans.gaps import largest_gaps
from traceframe.plans.ranking import bucket_count, running_totals, unpivot

LEVEL = 0.05


def ks_statistics(df: DataFrame, columns: list[str], is_reference: Column, buckets: int | None = None) -> DataFrame:
    """Two-sample distance of every column between the two sides of one table.

    Values are counted in cells; only cells that can hold the largest gap are counted value by
    value, so what moves does not grow with the distinct values. Nulls and NaN are left
    out per column.
    """
    buckets = buckets or bucket_count(df)
    sides = df.select(
        is_reference.alias("_ref"),
        # Adding zero folds the two signed zeros into one value.
        *[(present(F.col(c).cast("double")) + F.lit(0.0)).alias(c) for c in columns],
    )
    return largest_gaps(sides, columns, buckets)


def _distances(counts: DataFrame, cuts: DataFrame, buckets: int) -> DataFrame:
    """Distance per feature from counts ``a`` and ``b`` per (feature, value)."""
    ranked = running_totals(counts, cuts, "feature", "value", ["a", "b"], buckets)
    # One row per feature.
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("a").alias("n_reference"), F.sum("b").alias("n_current")))
    gap = F.abs(F.col("cum_a") / F.col("n_reference") - F.col("cum_b") / F.col("n_current"))
    return (
        ranked.join(totals, "feature")
        .filter((F.col("n_reference") > 0) & (F.col("n_current") > 0))
        .groupBy("feature")
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.first("n_reference").alias("n_reference"),
            F.first("n_current").alias("n_current"),
        )
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value of each column occurs: feature, value, n."""
    plain = df.select(*[(present(F.col(c).cast("double")) + F.lit(0.0)).alias(c) for c in columns])
    long = unpivot(plain, [], columns, "feature", "value").filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def feature_drift_of_counts(
    reference: DataFrame, current: DataFrame, cuts: DataFrame, buckets: int, level: float = LEVEL, method: str = sig.AUTO, exact_upto: int = sig.EXACT_UPTO
) -> DataFrame:
    """``feature_drift`` from the value counts of both sides; ``cuts`` has borders per feature."""
    side = lambda df, own, other: df.select("feature", "value", F.col("n").alias(own), F.lit(0).cast("long").alias(other))
    both = side(reference, "a", "b").unionByName(side(current, "b", "a")).groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return _decided(_distances(both, cuts, buckets), level, method, exact_upto)


def feature_drift(
    df: DataFrame, columns: list[str], is_reference: Column, level: float = LEVEL, buckets: int | None = None,
    method: str = sig.AUTO, exact_upto: int = sig.EXACT_UPTO,
) -> DataFrame:
    """Distance, p-value, its method and decision per feature.

    The p-value is exact where no side has more than ``exact_upto`` values, else the limit
    series; ``method`` asks for one of them at every size.
    """
    return _decided(ks_statistics(df, columns, is_reference, buckets), level, method, exact_upto)


def _decided(d: DataFrame, level: float, method: str, exact_upto: int) -> DataFrame:
    n, m = F.col("n_reference"), F.col("n_current")
    p = sig.ks_p_value(F.col("ks_statistic"), n, m, method, exact_upto)
    return d.withColumn("ks_pvalue", p).withColumn("ks_method", sig.ks_method(n, m, method, exact_upto)).withColumn("drifted", F.col("ks_pvalue") < level)


def two_tables(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Stack the wanted columns of two tables with a side flag."""
    return reference.select(F.lit(True).alias("_reference"), *columns).unionByName(
        current.select(F.lit(False).alias("_reference"), *columns)
    )


def feature_drift_of(reference: DataFrame, current: DataFrame, columns: list[str], level: float = LEVEL, method: str = sig.AUTO) -> DataFrame:
    return feature_drift(two_tables(reference, current, columns), columns, F.col("_reference"), level, method=method)


def drift_summary(per_feature: DataFrame, n_columns: int, edge: str = "lower") -> DataFrame:
    """One row: how many features drifted, the share and its severity."""
    drifted = F.count(F.when(F.col("drifted"), 1))
    ratio = drifted / F.lit(n_columns)
    return per_feature.agg(
        F.lit(n_columns).cast("long").alias("features_tested"),
        drifted.alias("features_drifted"),
        ratio.alias("drift_ratio"),
        (drifted > 0).alias("drift_detected"),
    ).withColumn("severity", rules.drift_severity(F.col("drift_ratio"), edge))


def aligned_counts(df: DataFrame, category: str, is_reference: Column) -> DataFrame:
    """Counts of both sides per category; a category missing on one side counts 0."""
    return df.groupBy(F.col(category).cast("string").alias("category")).agg(
        F.count(F.when(is_reference, 1)).alias("reference_count"),
        F.count(F.when(~is_reference, 1)).alias("current_count"),
    )


def chi_square(counts: DataFrame, level: float = LEVEL) -> DataFrame:
    """Contingency test of two smoothed count columns, with the 2 x 2 correction.

    The table of counts has one row per category, so the totals are scalars.
    """
    smooth = counts.select(
        (F.col("reference_count") + 1).cast("double").alias("a"), (F.col("current_count") + 1).cast("double").alias("b")
    )
    t = smooth.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("k"))).scalar()

    def term(observed: Column, side: Column) -> Column:
        expected = (F.col("a") + F.col("b")) * side / (t["a"] + t["b"])
        gap = F.abs(observed - expected)
        corrected = F.when(t["k"] == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return corrected * corrected / expected

    out = smooth.agg(
        F.sum(term(F.col("a"), t["a"]) + term(F.col("b"), t["b"])).alias("_chi2"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )
    # A single category leaves nothing to test.
    stat = F.when(F.col("dof") > 0, F.col("_chi2")).otherwise(F.lit(0.0))
    return (
        out.select(stat.alias("chi2_statistic"), "dof")
        .withColumn("chi2_pvalue", sig.chi2_p_value(F.col("chi2_statistic"), F.col("dof")))
        .withColumn("drift_detected", F.col("chi2_pvalue") < level)
    )


PREDICTION_COLUMNS = ("predicted_class", "predicted_label", "prediction")


def prediction_column(columns: list[str]) -> str:
    for c in PREDICTION_COLUMNS:
        if c in columns:
            return c
    raise ValueError("no prediction column found")


def scored_accuracy(df: DataFrame) -> DataFrame:
    """Accuracy and mean confidence of a scored table; null where a column is missing."""
    have = set(df.columns)
    truth = next((c for c in ("class_label", "true_label") if c in have), None)
    guess = next((c for c in PREDICTION_COLUMNS if c in have), None)
    accuracy = (
        F.avg((F.col(truth) == F.col(guess)).cast("double")) if truth and guess else F.lit(None).cast("double")
    )
    conf = F.avg("confidence") if "confidence" in have else F.lit(None).cast("double")
    return df.agg(accuracy.alias("accuracy"), conf.alias("avg_confidence"))


def monitoring_report(
    df: DataFrame, columns: list[str], is_reference: Column, category: str, level: float = LEVEL, method: str = sig.AUTO
) -> DataFrame:
    """One row: drift summary, prediction drift, accuracy and the fired alerts."""
    summary = drift_summary(feature_drift(df, columns, is_reference, level, method=method), len(columns), edge="upper")
    chi = chi_square(aligned_counts(df, category, is_reference), level)
    metrics = scored_accuracy(df)
    out = (
        summary.withColumn("prediction", chi.select(F.struct(*chi.columns)).scalar())
        .withColumn("performance", metrics.select(F.struct(*metrics.columns)).scalar())
    )
    return out.withColumn(
        "alerts",
        rules.alerts(
            F.col("severity"),
            F.col("features_drifted"),
            F.col("prediction")["drift_detected"],
            F.col("performance")["accuracy"],
        ),
    )
