"""Threshold rules: severities, priorities, verdicts, alerts, previews."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def relative_difference_pct(base: Column, other: Column) -> Column:
    return F.when(base != 0, (other - base) / F.abs(base) * 100).otherwise(F.lit(0.0))


def drift_severity(ratio: Column, edge: str = "lower") -> Column:
    """none / low / medium / high by the share of drifted features.

    ``edge='lower'`` puts 0.1 and 0.3 into the higher class, ``edge='upper'``
    keeps them in the lower one.
    """
    if edge == "lower":
        medium, high = ratio >= 0.1, ratio >= 0.3
    elif edge == "upper":
        medium, high = ratio > 0.1, ratio > 0.3
    else:
        raise ValueError("edge must be 'lower' or 'upper'")
    return (
        F.when(high, "high").when(medium, "medium").when(ratio > 0, "low").otherwise("none")
    )


def priority(passed: Column, anomalies: Column) -> Column:
    return (
        F.when(~F.coalesce(passed, F.lit(True)), "HIGH")
        .when(anomalies > 0, "MEDIUM")
        .otherwise("LOW")
    )


def action(level: Column) -> Column:
    return F.when(level == "HIGH", "FAIL").when(level == "MEDIUM", "WARN").otherwise("PASS")


def reasoning(level: Column) -> Column:
    return (
        F.when(level == "HIGH", "Validation failed")
        .when(level == "MEDIUM", "Anomalies detected")
        .otherwise("Quality acceptable")
    )


def similarity_verdict(mean_pct: Column, std_pct: Column, balance: Column) -> Column:
    m, s, b = F.abs(mean_pct), F.abs(std_pct), F.abs(balance)
    return (
        F.when((m < 5) & (s < 5) & (b < 0.1), "high")
        .when((m < 10) & (s < 10) & (b < 0.2), "moderate")
        .otherwise("low")
    )


def balance_verdict(balance: Column) -> Column:
    b = F.abs(balance)
    return F.when(b < 0.05, "very similar").when(b < 0.1, "similar").otherwise("noticeable differences")


def recommendations(mean_pct: Column, balance: Column, balance_score: Column, agree: Column) -> list[Column]:
    """The four advice lines of a dataset comparison, in order."""
    m, b = F.abs(mean_pct), F.abs(balance)
    return [
        F.when(m < 10, "representative").otherwise("adjust sampling"),
        F.when(agree, "similar distributions").otherwise("preprocess differently"),
        F.when(balance_score > 0.8, "well balanced").otherwise("balance classes"),
        F.when((m < 10) & (b < 0.1), "suitable for training").otherwise("review sampling"),
    ]


def alerts(severity: Column, n_drifted: Column, prediction_drift: Column, accuracy: Column) -> Column:
    """Array of fired alerts. A null accuracy fires nothing.

    Kinds, severities and messages are fixed values of the report; the advice is this library's.
    """
    low = F.format_number(accuracy * 100, 2)
    fired = F.array(
        F.when(
            severity.isin("medium", "high"),
            _alert(
                "feature_drift",
                severity,
                F.concat(F.lit("Feature drift detected: "), n_drifted.cast("string"), F.lit(" features drifted")),
                "Fit the model again on the rows that moved",
            ),
        ),
        F.when(
            prediction_drift,
            _alert(
                "prediction_drift",
                F.lit("medium"),
                F.lit("Prediction distribution has shifted"),
                "Look at what the model is given before looking at the model",
            ),
        ),
        F.when(
            accuracy < 0.4,
            _alert(
                "low_accuracy",
                F.lit("high"),
                F.concat(F.lit("Model accuracy ("), low, F.lit("%) below threshold")),
                "Stop acting on predictions until the cause is known",
            ),
        ),
    )
    return F.filter(fired, lambda a: a.isNotNull())


def _alert(kind: str, severity: Column, message: Column, advice: str) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        severity.alias("severity"),
        message.alias("message"),
        F.lit(advice).alias("recommendation"),
    )


def preview(text: Column, width: int = 200) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)
