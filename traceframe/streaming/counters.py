"""Prediction counters, latency histograms and gauges: batch and streaming forms.

The aggregates are written once and used on static and streaming tables alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

# Upper bounds of the latency buckets in seconds.
LATENCY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]


def prediction_counts(df: DataFrame, time: str = "ts", width: str = "1 hour") -> DataFrame:
    """Predictions per class and tumbling window."""
    return df.groupBy(F.window(time, width).alias("w"), "predicted_class").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), "predicted_class", "n"
    )


def bucket_name(bound: float) -> str:
    return "le_" + f"{bound:g}".replace(".", "_")


def latency_histogram(df: DataFrame, time: str = "ts", width: str = "1 hour") -> DataFrame:
    """Cumulative bucket counts, total count and sum of latencies per window."""
    buckets = [F.count(F.when(F.col("latency") <= b, 1)).alias(bucket_name(b)) for b in LATENCY_BOUNDS]
    return (
        df.groupBy(F.window(time, width).alias("w"))
        .agg(*buckets, F.count(F.lit(1)).alias("le_inf"), F.sum("latency").alias("latency_sum"))
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )


def latest_gauge(history: DataFrame, name: str = "name", time: str = "ts") -> DataFrame:
    """Current value of every gauge in an append-only metric history."""
    rest = [c for c in history.columns if c != name]
    return history.groupBy(name).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_r")).select(name, "_r.*")


def stream_table(spark, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream with a declared schema."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_available(updates: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Process what is there and append every batch of updates with its number.

    A repeated batch after a failure writes the same folder again, so each
    batch is stored exactly once.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/part={number}")

    return (
        updates.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Latest update of every key in a table of stored updates."""
    rest = [c for c in stored.columns if c not in {*keys, "batch", "part"}]
    return (
        stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_r")).select(*keys, "_r.*")
    )


def _bounded(stream: DataFrame, watermark: str | None) -> DataFrame:
    return stream if watermark is None else stream.withWatermark("ts", watermark)


def counted_stream(stream: DataFrame, watermark: str | None, width: str = "1 hour") -> DataFrame:
    """Counts per window. ``watermark`` is how late a row may come before it is dropped and its
    window forgotten; None for a backfill, whose files come in any order: no row is dropped
    and all windows are kept. ``late_rows`` tells how many rows a run has dropped.
    """
    return prediction_counts(_bounded(stream, watermark), width=width)


def histogram_stream(stream: DataFrame, watermark: str | None, width: str = "1 hour") -> DataFrame:
    """Latency histogram per window; ``watermark`` as in ``counted_stream``."""
    return latency_histogram(_bounded(stream, watermark), width=width)


def late_rows(query: StreamingQuery) -> int:
    """Rows (after the first aggregation of a batch) that a watermark has dropped so far."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
