"""Per-batch drift monitoring, metric history and validated ingest of new tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from traceframe.functions.labels import present
from traceframe.functions.significance import AUTO, EXACT_UPTO, ks_p_value
from traceframe.operators.drift import LEVEL, drift_summary, feature_drift_of_counts, value_counts
from traceframe.operators.quality import row_rules
from traceframe.plans.ranking import bucket_count, unpivot, wide_cuts

SKETCH_SIZE, GRID = 4096, 2000


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drift_monitor(stream: DataFrame, reference: DataFrame, columns: list[str], path: str, checkpoint: str, method: str = AUTO) -> StreamingQuery:
    """Compare every batch with a fixed reference; one summary row per batch.

    The reference is reduced to counts per value once, when the monitor starts, and stored
    beside the checkpoint; a batch is read once and only its own values are counted.
    """
    spark, buckets = reference.sparkSession, bucket_count(reference)
    value_counts(reference, columns).write.mode("overwrite").parquet(f"{checkpoint}-reference/counts")
    wide_cuts(reference.select(*columns), columns, "feature", buckets).write.mode("overwrite").parquet(f"{checkpoint}-reference/cuts")
    counts, cuts = (spark.read.parquet(f"{checkpoint}-reference/{part}") for part in ("counts", "cuts"))

    def check(batch: DataFrame, number: int) -> None:
        found = feature_drift_of_counts(counts, value_counts(batch, columns), cuts, buckets, method=method)
        summary = drift_summary(found, len(columns), edge="upper").withColumn("batch", F.lit(number))
        summary.write.mode("overwrite").parquet(f"{path}/part={number}")

    return _start(stream, check, checkpoint)


def sketches(df: DataFrame, columns: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """One quantile sketch per column, of a static table or of a stream: feature, n, sketch.

    Sketches merge, so a stream keeps one per column as its state (about 100 kB at the default
    size) however many values have come. Nulls and NaN are left out.
    """
    plain = df.select(*[(present(F.col(c).cast("double")) + F.lit(0.0)).alias(c) for c in columns])
    long = unpivot(plain, [], columns, "feature", "value").filter(F.col("value").isNotNull())
    return long.groupBy("feature").agg(F.count("value").alias("n"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"))


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Published bound of the difference of two ranks of one sketch, at 99 % confidence."""
    return 2.446 / size**0.9433


def sketch_drift(reference: DataFrame, current: DataFrame, size: int = SKETCH_SIZE, level: float = LEVEL, method: str = AUTO, exact_upto: int = EXACT_UPTO) -> DataFrame:
    """Two-sample distance per feature from the ``sketches`` of both sides.

    Each sketch gives its quantiles j / ``GRID``; how many of them lie at or below a value tells its
    rank to 1 / ``GRID``, and the distance is the largest difference of these counts. ``ks_error`` bounds
    how far ``ks_statistic`` may be from the distance of all values: the rank errors of both
    sketches (0 for a sketch that still holds all its values) and that step. ``certain`` tells that no
    distance within the bound would change the decision.
    """
    side = lambda df, name: df.select("feature", F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"_{name}"))
    # One row per feature on both sides.
    both = side(current, "current").join(F.broadcast(side(reference, "reference")), "feature")
    # The function takes constants only: one text of numbers instead of as many literals.
    steps = F.split(F.lit(" ".join(str(j / GRID) for j in range(1, GRID + 1))), " ").cast("array<double>")
    sides = ("reference", "current")
    marked = lambda s: F.transform(
        F.kll_sketch_get_quantile_double(f"_{s}", steps), lambda x: F.struct(x.alias("x"), F.lit(s).alias("side"))
    )
    marks = [marked(s) for s in sides]
    counted = both.select("feature", "n_reference", "n_current", F.inline(F.concat(*marks))).groupBy("feature", "n_reference", "n_current", "x")
    counted = counted.agg(*[F.count(F.when(F.col("side") == s, 1)).alias(s) for s in sides])
    # At most 2 * GRID rows per feature, whatever came.
    below = Window.partitionBy("feature").orderBy("x")
    gap = F.abs(F.sum(F.col("reference") - F.col("current")).over(below)) / GRID
    lost = [F.when(F.col(f"n_{s}") > size, rank_error(size)).otherwise(0.0) for s in sides]
    n, m, d = F.col("n_reference"), F.col("n_current"), F.col("ks_statistic")
    p = lambda x: ks_p_value(x, n, m, method, exact_upto)
    measured = (
        counted.withColumn("_gap", gap)
        .groupBy("feature", "n_reference", "n_current")
        .agg(F.max("_gap").alias("ks_statistic"))
        .withColumn("ks_error", lost[0] + lost[1] + F.lit(1.0 / GRID))
    )
    low, high = F.greatest(d - F.col("ks_error"), F.lit(0.0)), F.least(d + F.col("ks_error"), F.lit(1.0))
    return (
        measured.withColumn("ks_pvalue", p(d))
        .withColumn("drifted", F.col("ks_pvalue") < level)
        .withColumn("certain", (p(low) < level) == (p(high) < level))
    )


def cumulative_drift_monitor(
    stream: DataFrame, reference: DataFrame, columns: list[str], path: str, checkpoint: str,
    size: int = SKETCH_SIZE, level: float = LEVEL, method: str = AUTO, exact_upto: int = EXACT_UPTO,
) -> StreamingQuery:
    """Compare all that has come so far with a fixed reference, after every batch.

    The state of the stream is one mergeable sketch per column; ``drift_monitor`` judges each batch by
    itself and exactly. The reference is read once and stored as sketches beside the checkpoint.
    Each batch appends ``sketch_drift`` of the columns that got values; ``counters.current_state``
    by feature gives the latest. A sketch draws random bits, so a repeated batch may differ within the bound.
    """
    stored = f"{checkpoint}-reference/sketches"
    sketches(reference, columns, size).write.mode("overwrite").parquet(stored)
    fixed = reference.sparkSession.read.parquet(stored)

    def compare(batch: DataFrame, number: int) -> None:
        found = sketch_drift(fixed, batch, size, level, method, exact_upto).withColumn("batch", F.lit(number))
        found.write.mode("overwrite").parquet(f"{path}/part={number}")

    return (
        sketches(stream, columns, size)
        .writeStream.outputMode("update")
        .foreachBatch(compare)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def metric_history(stream: DataFrame, measure: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Append the measures of every batch, e.g. accuracy, to a history table."""

    def append(batch: DataFrame, number: int) -> None:
        measure(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/part={number}")

    return _start(stream, append, checkpoint)


def validated_ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Split arriving traces by the row rules into ``valid`` and ``rejected`` tables.

    Each batch is written in one pass, partitioned by outcome.
    """

    def split(batch: DataFrame, number: int) -> None:
        outcome = F.when(F.size("broken_rules") == 0, "valid").otherwise("rejected")
        row_rules(batch).withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(
            f"{path}/part={number}"
        )

    return _start(stream, split, checkpoint)
