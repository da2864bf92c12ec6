"""Class names, predicted class and confidence."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The three classes in id order, and their names in scored tables.
CLASS_NAMES = ["Normal", "Anomaly", "Boundary"]
SCORED_NAMES = ["normal", "anomaly", "boundary"]
PROBABILITIES = ["prob_normal", "prob_anomaly", "prob_boundary"]


def class_name(label: Column, names: list[str] = CLASS_NAMES) -> Column:
    out = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        out = F.when(label == i, F.lit(names[i])).otherwise(out)
    return out


def confidence(scores: Column) -> Column:
    return F.array_max(scores)


def first_maximum(scores: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("long")


def shares(scores: Column) -> Column:
    """Non-negative scores divided by their sum."""
    size = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scores, lambda x: F.try_divide(x, size))


def present(value: Column) -> Column:
    """The value, or null where it is NaN: both mean that a number is missing."""
    return F.when(~F.isnan(value), value)
