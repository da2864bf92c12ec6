"""Largest gap of two distribution functions per column, found by bounds on cells.

Values are counted in cells first: a row per column and cell, however many distinct values
there are. At the upper edge of a cell the gap of the two distribution functions is known;
inside it can be no larger than if all values of one side came before all of the other. A
cell whose bound does not exceed the largest gap at an edge cannot hold a larger one; only
the values of the others, few cells around the largest gap, are counted one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from traceframe.plans.ranking import unpivot, wide_cuts, with_bucket
from traceframe.session import cut_lineage


def cell_counts(sides: DataFrame, columns: list[str], cells: int) -> tuple[DataFrame, DataFrame]:
    """(values with their cell, counts per cell) of a table with a flag ``_ref`` and columns of doubles.

    The counts have, per feature and cell, both sides' rows in it (a, b), up to it (ca, cb) and in all
    (n_reference, n_current), the least and the largest value.
    """
    # Stored: both scans must agree on the cells.
    cuts = cut_lineage(wide_cuts(sides, columns, "feature", cells), "cuts")
    long = unpivot(sides, ["_ref"], columns, "feature", "value").where(F.col("value").isNotNull())
    tagged = with_bucket(long.join(F.broadcast(cuts), "feature"), F.col("cuts"), F.col("value"), cells).drop("cuts")
    counts = tagged.groupBy("feature", "_b").agg(F.count_if("_ref").alias("a"), F.count_if(~F.col("_ref")).alias("b"), F.min("value").alias("low"), F.max("value").alias("high"))
    upto, every = Window.partitionBy("feature").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    counts = counts.select(
        "*", F.sum("a").over(upto).alias("ca"), F.sum("b").over(upto).alias("cb"), F.sum("a").over(every).alias("n_reference"), F.sum("b").over(every).alias("n_current")
    )
    return tagged, cut_lineage(counts, "cell-counts")


def open_cells(counts: DataFrame) -> DataFrame:
    """Cells of several values that may hold a larger gap than any edge has; adds ``best``, the largest gap at an edge."""
    gap = F.abs(F.col("ca") / F.col("n_reference") - F.col("cb") / F.col("n_current"))
    before_a, before_b = F.col("ca") - F.col("a"), F.col("cb") - F.col("b")
    reference_first = F.col("ca") / F.col("n_reference") - before_b / F.col("n_current")
    current_first = F.col("cb") / F.col("n_current") - before_a / F.col("n_reference")
    with_best = counts.withColumn("best", F.max(gap).over(Window.partitionBy("feature"))).withColumn("bound", F.greatest(reference_first, current_first))
    return with_best.withColumn("open", (F.col("bound") > F.col("best")) & (F.col("low") < F.col("high")))


def largest_gaps(sides: DataFrame, columns: list[str], cells: int) -> DataFrame:
    """feature, ks_statistic, n_reference, n_current of columns with values on both sides."""
    tagged, counts = cell_counts(sides, columns, cells)
    bounded = open_cells(counts.where((F.col("n_reference") > 0) & (F.col("n_current") > 0)))
    edges = bounded.groupBy("feature").agg(F.max("best").alias("best"), F.max("n_reference").alias("n_reference"), F.max("n_current").alias("n_current"))
    # At most cells x columns rows.
    chosen = F.broadcast(bounded.where("open").select("feature", "_b", (F.col("ca") - F.col("a")).alias("pa"), (F.col("cb") - F.col("b")).alias("pb"), "n_reference", "n_current"))
    values = tagged.join(chosen, ["feature", "_b"]).groupBy("feature", "_b", "value", "pa", "pb", "n_reference", "n_current").agg(
        F.count_if("_ref").alias("a"), F.count_if(~F.col("_ref")).alias("b")
    )
    inside = Window.partitionBy("feature", "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs((F.col("pa") + F.sum("a").over(inside)) / F.col("n_reference") - (F.col("pb") + F.sum("b").over(inside)) / F.col("n_current"))
    largest = values.select("feature", gap.alias("gap")).groupBy("feature").agg(F.max("gap").alias("gap"))
    return edges.join(F.broadcast(largest), "feature", "left").select("feature", F.greatest("best", F.coalesce("gap", F.lit(0.0))).alias("ks_statistic"), "n_reference", "n_current")
