"""Role adapters: the shared test tables seen as traces, predictions, views, runs.

Each adapter is a projection of one table. ``SQL`` holds the same projection as
a common table expression, so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from traceframe.functions.hashing import uniform
from traceframe.functions.labels import first_maximum, shares
from traceframe.plans.spread import spread
from traceframe.schemas import HEADERS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A text table, ready for heavy work per row."""
    return spread(table(spark, sf_dir, name))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as trace rows in the bronze layout."""
    v = F.col("vec_id")
    inline, crossline = F.floor(v / 25), v % 25
    return table(spark, sf_dir, "embeddings").select(
        F.format_string("%03d", F.floor(v / 100).cast("long")).alias("file_id"),
        v.alias("trace_id"),
        F.col("embedding").cast("array<double>").alias("trace_data"),
        F.size("embedding").cast("long").alias("num_samples"),
        F.lit(0.004).alias("sample_rate"),
        inline.cast("long").alias("inline"),
        crossline.cast("long").alias("crossline"),
        (inline * 25).cast("long").alias("cdp_x"),
        (crossline * 25).cast("long").alias("cdp_y"),
        (inline + 1).cast("long").alias("field_record"),
        (v + 1).alias("trace_number"),
        (F.col("label") % 3).cast("long").alias("class_label"),
    )


def _gap(column: str) -> Column:
    return F.when(uniform(f"gap-{column}", "trace_id") >= 0.05, F.col(column)).alias(column)


def gappy_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces with about 5 % of every header and of the sample arrays missing."""
    gaps = set(HEADERS) | {"trace_data"}
    df = traces(spark, sf_dir)
    return df.select(*[_gap(c) if c in gaps else F.col(c) for c in df.columns])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as scored rows: three scores from the first three values."""
    scores = F.array(*[F.abs(F.element_at("embedding", i).cast("double")) for i in (1, 2, 3)])
    return (
        table(spark, sf_dir, "embeddings")
        .select(
            F.format_string("%03d", F.floor(F.col("vec_id") / 100).cast("long")).alias("file_id"),
            F.col("vec_id").alias("trace_id"),
            (F.col("label") % 3).cast("long").alias("true_label"),
            scores.alias("scores"),
        )
        .withColumn("scores", shares(F.col("scores")))
        .withColumn("predicted_label", first_maximum(F.col("scores")))
    )


def feature_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feature rows: entity ``user_id``, event time ``ts``."""
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases plus one hour as the rows that ask for features."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select("event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"))
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as experiment runs."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("experiment"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderstatus").alias("stage"),
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a version table: model = customer, version = order number."""
    stage = (
        F.when(F.col("o_orderstatus") == "F", "Archived")
        .when(F.col("o_orderstatus") == "P", "Production")
        .otherwise("Staging")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("model_name"),
        F.col("o_orderkey").alias("version"),
        stage.alias("stage"),
        F.col("o_orderdate").alias("created"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as recorded predictions: class and latency in seconds."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("predicted_class"), (F.col("value") / 1000).alias("latency")
    )


_U = "('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::UBIGINT::DOUBLE / 4294967296.0"


def sql_uniform(seed: str, key: str) -> str:
    return "(" + _U.format(seed=seed, key=key) + ")"


TRACES_SQL = """traces AS (
  SELECT format('{:03d}', vec_id // 100) AS file_id, vec_id AS trace_id,
    list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS trace_data,
    CAST(len(embedding) AS BIGINT) AS num_samples, CAST(0.004 AS DOUBLE) AS sample_rate,
    vec_id // 25 AS inline, vec_id % 25 AS crossline,
    (vec_id // 25) * 25 AS cdp_x, (vec_id % 25) * 25 AS cdp_y,
    vec_id // 25 + 1 AS field_record, vec_id + 1 AS trace_number,
    CAST(label % 3 AS BIGINT) AS class_label
  FROM embeddings)"""

GAPPY_SQL = (
    TRACES_SQL
    + ",\ngappy AS (SELECT file_id, trace_id, class_label, "
    + ", ".join(
        f"CASE WHEN {sql_uniform('gap-' + c, 'trace_id')} >= 0.05 THEN {c} END AS {c}"
        for c in ["trace_data", *HEADERS]
    )
    + " FROM traces)"
)

PREDICTIONS_SQL = """raw_scores AS (
  SELECT format('{:03d}', vec_id // 100) AS file_id, vec_id AS trace_id,
    CAST(label % 3 AS BIGINT) AS true_label,
    abs(CAST(embedding[1] AS DOUBLE)) AS a, abs(CAST(embedding[2] AS DOUBLE)) AS b,
    abs(CAST(embedding[3] AS DOUBLE)) AS c
  FROM embeddings),
predictions AS (
  SELECT file_id, trace_id, true_label,
    a / (a + b + c) AS prob_normal, b / (a + b + c) AS prob_anomaly, c / (a + b + c) AS prob_boundary,
    CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS BIGINT) AS predicted_label
  FROM raw_scores)"""

SPINE_SQL = """spine AS (
  SELECT event_id, user_id, ts + INTERVAL 1 HOUR AS ts FROM events WHERE event_type = 'purchase')"""

# The eight signal features without the spectrum, from list functions.
FEATURES_SQL = """base AS (
  SELECT *, list_sum(trace_data) / len(trace_data) AS mean_amplitude FROM traces),
features AS (
  SELECT file_id, trace_id, class_label, trace_data, num_samples, sample_rate, mean_amplitude,
    sqrt(list_sum(list_transform(trace_data, lambda x: (x - mean_amplitude) * (x - mean_amplitude)))
      / len(trace_data)) AS std_amplitude,
    list_min(trace_data) AS min_amplitude, list_max(trace_data) AS max_amplitude,
    sqrt(list_sum(list_transform(trace_data, lambda x: x * x)) / len(trace_data)) AS rms_amplitude,
    list_sum(list_transform(trace_data, lambda x: x * x)) AS energy,
    CAST(len(list_filter(list_zip(trace_data[1:len(trace_data) - 1], trace_data[2:]),
      lambda p: (p[1] < 0) <> (p[2] < 0))) AS DOUBLE) AS zero_crossings
  FROM base)"""
