from pyspark.sql import functions as F

from traceframe.checks.drifts import ks_sql
from traceframe.checks.registry import query, rounded
from traceframe.operators import drift
from traceframe.session import shared_folder
from traceframe.sources import roles
from traceframe.streaming import counters, monitors

_COUNTS_SQL = """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_micros, event_type AS predicted_class, count(*) AS n FROM events GROUP BY 1, 2"""
_HIST_SQL = (
    "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_micros, "
    + ", ".join(f"count(*) FILTER (WHERE value / 1000 <= {b}) AS {counters.bucket_name(b)}" for b in counters.LATENCY_BOUNDS)
    + ", count(*) AS le_inf, round(sum(value / 1000), 6) AS latency_sum FROM events GROUP BY 1"
)


def _micros(df):
    return df.withColumn("window_micros", F.unix_micros(F.col("window_start").cast("timestamp"))).drop("window_start")


def _stream(spark, sf, table="events"):
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    return counters.stream_table(spark, sf, schema, pattern=f"{table}.parquet")


def _scored_stream(spark, sf):
    # Watermarks need instants, so the zone-less times are read as session time.
    return _stream(spark, sf).select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("predicted_class"), (F.col("value") / 1000).alias("latency")
    )


@query("prediction_counts", _COUNTS_SQL)
def prediction_counts(spark, sf):
    return _micros(counters.prediction_counts(roles.scored_events(spark, sf)))


@query("latency_histogram", _HIST_SQL)
def latency_histogram(spark, sf):
    return rounded(_micros(counters.latency_histogram(roles.scored_events(spark, sf))))


def _run(spark, updates, purpose):
    folder = shared_folder(spark, purpose)
    counters.run_available(updates, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("prediction_counts_stream", _COUNTS_SQL)
def prediction_counts_stream(spark, sf):
    stored = _run(spark, counters.counted_stream(_scored_stream(spark, sf), None), "counts")
    return _micros(counters.current_state(stored, ["window_start", "predicted_class"]))


@query("latency_histogram_stream", _HIST_SQL)
def latency_histogram_stream(spark, sf):
    stored = _run(spark, counters.histogram_stream(_scored_stream(spark, sf), None), "histogram")
    return rounded(_micros(counters.current_state(stored, ["window_start"])))


@query("latest_gauges", "SELECT event_type AS name, arg_max(value, {'t': ts, 'e': event_id}) AS value FROM events GROUP BY 1")
def latest_gauges(spark, sf):
    history = roles.table(spark, sf, "events").select(
        F.col("event_type").alias("name"), F.struct("ts", "event_id").alias("at"), "value"
    )
    return counters.latest_gauge(history, time="at").select("name", "value")


@query(
    "accuracy_history_stream",
    "SELECT round(avg(CAST(event_type = 'view' AS INT)), 6) AS accuracy, count(*) AS n FROM events",
)
def accuracy_history_stream(spark, sf):
    folder = shared_folder(spark, "history")
    stream = _stream(spark, sf).select("event_type")

    def measure(batch):
        return batch.agg(F.avg((F.col("event_type") == "view").cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))

    monitors.metric_history(stream, measure, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/out").select("accuracy", "n"))


_DRIFT_SQL = """SELECT 'value' AS feature, true AS is_ref, value FROM events WHERE ts < TIMESTAMP '2024-01-15'
  UNION ALL SELECT 'latency', true, value / 1000 FROM events WHERE ts < TIMESTAMP '2024-01-15'
  UNION ALL SELECT 'value', false, value FROM events UNION ALL SELECT 'latency', false, value / 1000 FROM events"""


@query(
    "drift_stream",
    f"""WITH {ks_sql(_DRIFT_SQL)}, s AS (SELECT count(*) AS features_tested, count(*) FILTER (WHERE p < 0.05) AS features_drifted FROM p)
SELECT features_tested, features_drifted, round(features_drifted / features_tested, 6) AS drift_ratio,
  CASE WHEN features_drifted = 0 THEN 'none' WHEN features_drifted / features_tested > 0.3 THEN 'high'
    WHEN features_drifted / features_tested > 0.1 THEN 'medium' ELSE 'low' END AS severity FROM s""",
)
def drift_stream(spark, sf):
    """Arriving events against the first half month as the stored reference."""
    folder = shared_folder(spark, "drift")
    columns = ["value", "latency"]
    both = [F.col("value"), (F.col("value") / 1000).alias("latency")]
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    reference = roles.table(spark, sf, "events").filter(early).select(*both)
    stream = _stream(spark, sf).select(*both)
    monitors.drift_monitor(stream, reference, columns, f"{folder}/out", f"{folder}/checkpoint", method="series").awaitTermination()
    stored = spark.read.parquet(f"{folder}/out")
    return rounded(stored.select("features_tested", "features_drifted", "drift_ratio", "severity"))


@query(
    "cumulative_drift_stream",
    f"""WITH {ks_sql(_DRIFT_SQL)} SELECT feature, n AS n_reference, m AS n_current, p < 0.05 AS drifted, true AS within_error FROM p""",
)
def cumulative_drift_stream(spark, sf):
    """Sketches of all events so far against those of the first half month, held against the exact distance."""
    folder = shared_folder(spark, "cumulative")
    columns = ["value", "latency"]
    both = [F.col("value"), (F.col("value") / 1000).alias("latency")]
    events = roles.table(spark, sf, "events")
    reference = events.filter(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))).select(*both)
    stream = _stream(spark, sf).select(*both)
    monitors.cumulative_drift_monitor(stream, reference, columns, f"{folder}/out", f"{folder}/checkpoint", method="series").awaitTermination()
    found = counters.current_state(spark.read.parquet(f"{folder}/out"), ["feature"])
    exact = drift.feature_drift_of(reference, events.select(*both), columns, method="series").select("feature", F.col("ks_statistic").alias("exact"))
    within = F.abs(F.col("ks_statistic") - F.col("exact")) <= F.col("ks_error")
    return found.join(exact, "feature").select("feature", "n_reference", "n_current", "drifted", within.alias("within_error"))


@query(
    "validated_ingest_stream",
    f"""WITH {roles.GAPPY_SQL}
SELECT CASE WHEN trace_data IS NULL OR cdp_x IS NULL OR cdp_y IS NULL OR len(trace_data) <> num_samples OR sample_rate <= 0
  THEN 'rejected' ELSE 'valid' END AS outcome, count(*) AS n FROM gappy GROUP BY 1""",
)
def validated_ingest_stream(spark, sf):
    folder = shared_folder(spark, "ingest")
    gappy = roles.gappy_traces(spark, sf)
    gappy.write.parquet(f"{folder}/arrivals")
    stream = counters.stream_table(spark, f"{folder}/arrivals", gappy.schema)
    monitors.validated_ingest(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


