"""Classification metrics from one count table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from traceframe.functions.labels import class_name
from traceframe.plans.ranking import bucket_count, running_totals, unpivot, wide_cuts

AVERAGES = ("precision", "recall", "f1")


def outcome_counts(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Rows per (truth, predicted): all later metrics work on this small table."""
    return df.groupBy(
        *(by or []), F.col(truth).cast("long").alias("t"), F.col(predicted).cast("long").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Dense matrix in long form; pairs that never occur count 0."""
    counts = outcome_counts(df, truth, predicted)
    ids = F.array(*[F.lit(c).cast("long") for c in classes])
    dense = df.sparkSession.range(1).select(F.explode(ids).alias("t")).select("t", F.explode(ids).alias("p"))
    # classes x classes rows.
    return (
        F.broadcast(dense)
        .join(counts, ["t", "p"], "left")
        .select(F.col("t").alias("true_label"), F.col("p").alias("predicted_label"), F.coalesce("n", F.lit(0)).alias("n"))
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_metrics(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; an empty denominator gives 0.

    Every count row speaks for its true class and for its predicted class.
    """
    by = by or []
    votes = F.array(
        F.struct(
            F.col("t").alias("class_label"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).cast("long").alias("hits"),
        ),
        F.struct(
            F.col("p").alias("class_label"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        counts.select(*by, F.inline(votes))
        .groupBy(*by, "class_label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    p, r = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    scored = sums.withColumn("precision", p).withColumn("recall", r)
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both))


def summary_metrics(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy with macro and support-weighted averages, one row (per group)."""
    per_class = class_metrics(counts, by)
    total = F.sum("support")
    return per_class.groupBy(*(by or [])).agg(
        (F.sum("hits") / total).alias("accuracy"),
        *[F.avg(m).alias(f"{m}_macro") for m in AVERAGES],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"{m}_weighted") for m in AVERAGES],
        total.alias("num_samples"),
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class rows followed by macro and weighted averages, long form."""
    per_class = class_metrics(counts).select(
        F.coalesce(class_name(F.col("class_label")), F.col("class_label").cast("string")).alias("entry"),
        *AVERAGES,
        "support",
    )
    s = summary_metrics(counts)
    rows = [
        F.struct(
            F.lit(f"{kind} avg").alias("entry"),
            *[F.col(f"{m}_{kind}").alias(m) for m in AVERAGES],
            F.col("num_samples").alias("support"),
        )
        for kind in ("macro", "weighted")
    ]
    return per_class.unionByName(s.select(F.inline(F.array(*rows))))


def roc_auc(
    df: DataFrame, truth: str, probabilities: list[str], buckets: int | None = None
) -> DataFrame:
    """One-vs-rest AUC per class by tie-aware counting; no row if a class is absent.

    Scores are reduced to distinct values first, and the running count of
    negatives is split into value buckets.
    """
    buckets = buckets or bucket_count(df)
    long = unpivot(df, [truth], probabilities, "class_column", "score")
    at = {c: i for i, c in enumerate(probabilities)}
    is_class = F.lit(False)
    for c, i in at.items():
        is_class = is_class | ((F.col("class_column") == c) & (F.col(truth) == i))
    counts = long.groupBy("class_column", "score").agg(
        F.count(F.when(is_class, 1)).alias("pos"), F.count(F.when(~is_class, 1)).alias("neg")
    )
    cuts = wide_cuts(df, probabilities, "class_column", buckets)
    ranked = running_totals(counts, cuts, "class_column", "score", ["neg"], buckets)
    below = F.col("cum_neg") - F.col("neg") / 2
    return (
        ranked.groupBy("class_column")
        .agg(
            F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(F.col("pos") * below).alias("_w")
        )
        .filter((F.col("positives") > 0) & (F.col("negatives") > 0))
        .select(
            "class_column",
            "positives",
            "negatives",
            (F.col("_w") / (F.col("positives").cast("double") * F.col("negatives"))).alias("auc"),
        )
    )


def auc_averages(per_class: DataFrame, classes: int) -> DataFrame:
    """Macro and support-weighted AUC; null when a class is missing."""
    whole = F.count(F.lit(1)) == classes
    return per_class.agg(
        F.when(whole, F.avg("auc")).alias("roc_auc_macro"),
        F.when(whole, F.sum(F.col("auc") * F.col("positives")) / F.sum("positives")).alias("roc_auc_weighted"),
    )


def fold_scores(df: DataFrame, truth: str, predicted: str, fold: str) -> DataFrame:
    """Mean over folds of the weighted F1 of each fold."""
    per_fold = summary_metrics(outcome_counts(df, truth, predicted, [fold]), [fold])
    return per_fold.agg(F.avg("f1_weighted").alias("cv_f1_weighted"), F.count(F.lit(1)).alias("folds"))


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


def important_drift(importances: DataFrame, drift: DataFrame, n: int = 10) -> DataFrame:
    """The most important features with their drift result."""
    top = F.broadcast(top_importances(importances, n))
    return top.join(drift, "feature", "left").select("feature", "importance", "ks_statistic", "ks_pvalue", "drifted")


def predictions_table(df: DataFrame) -> DataFrame:
    """Gold predictions from (file_id, trace_id, true_label, predicted_label, scores)."""
    return df.select(
        "file_id",
        "trace_id",
        "true_label",
        "predicted_label",
        (F.col("true_label") == F.col("predicted_label")).alias("correct"),
        class_name(F.col("true_label")).alias("true_class"),
        class_name(F.col("predicted_label")).alias("predicted_class"),
        *[
            F.element_at("scores", i + 1).alias(c)
            for i, c in enumerate(("prob_normal", "prob_anomaly", "prob_boundary"))
        ],
    )
