from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions import rules, text as tx
from traceframe.operators import audit, evaluation as ev, features as ft, quality, reporting, retrieval as rt, sampling
from traceframe.schemas import BRONZE, HISTORY, PREDICTIONS
from traceframe.session import shared_folder
from traceframe.sources import roles, tables

_BRONZE_SQL = f"""WITH {roles.TRACES_SQL}
SELECT file_id, trace_id, num_samples, sample_rate, inline, crossline, cdp_x, cdp_y, field_record, trace_number, class_label,
  round(list_sum(trace_data), 6) AS sample_sum FROM traces"""


def _with_sum(df):
    total = F.aggregate("trace_data", F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("sample_sum", F.round(total, 6)).drop("trace_data")


@query("bronze_round_trip", _BRONZE_SQL)
def bronze_round_trip(spark, sf):
    folder = shared_folder(spark, "bronze")
    tables.write_layer(roles.traces(spark, sf), f"{folder}/traces", BRONZE, partition_by="file_id")
    return _with_sum(tables.read_layer(spark, folder, "traces", BRONZE))


@query("flat_table_fallback", _BRONZE_SQL)
def flat_table_fallback(spark, sf):
    """Only the flat file exists, so the partitioned name falls through to it."""
    folder = shared_folder(spark, "flat")
    tables.write_layer(roles.traces(spark, sf), f"{folder}/traces.parquet", BRONZE)
    return _with_sum(tables.read_layer(spark, folder, "traces"))


@query(
    "silver_round_trip",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT file_id, trace_id, class_label, round(mean_amplitude, 6) AS mean_amplitude, round(energy, 6) AS energy FROM features""",
)
def silver_round_trip(spark, sf):
    """A second write with other columns replaces the first."""
    folder = shared_folder(spark, "silver")
    feats = ft.extract(roles.traces(spark, sf))
    tables.write_layer(feats, f"{folder}/features", partition_by="file_id")
    tables.write_layer(feats.select("file_id", "trace_id", "class_label", "mean_amplitude", "energy"), f"{folder}/features", partition_by="file_id")
    out = tables.read_layer(spark, folder, "features").select(
        F.format_string("%03d", F.col("file_id").cast("int")).alias("file_id"), "trace_id", "class_label", "mean_amplitude", "energy"
    )
    return rounded(out)


@query(
    "gold_round_trip",
    f"""WITH {roles.PREDICTIONS_SQL}
SELECT predicted_label, count(*) AS n, count(*) FILTER (WHERE true_label = predicted_label) AS correct_rows,
  round(avg(prob_normal), 6) AS mean_prob FROM predictions GROUP BY 1""",
)
def gold_round_trip(spark, sf):
    folder = shared_folder(spark, "gold")
    tables.write_layer(ev.predictions_table(roles.predictions(spark, sf)), f"{folder}/predictions", PREDICTIONS)
    stored = tables.read_layer(spark, folder, "predictions")
    return rounded(
        stored.groupBy("predicted_label").agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("correct"), 1)).alias("correct_rows"),
            F.avg("prob_normal").alias("mean_prob"),
        )
    )


_SUPPLIER_SQL = "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier"


@query("csv_round_trip", _SUPPLIER_SQL)
def csv_round_trip(spark, sf):
    path = shared_folder(spark, "batch") + ".csv"
    df = roles.table(spark, sf, "supplier")
    tables.write_batch(df, path)
    return rounded(tables.read_batch(spark, path, df.schema))


@query("parquet_round_trip", _SUPPLIER_SQL)
def parquet_round_trip(spark, sf):
    path = shared_folder(spark, "batch") + ".parquet"
    tables.write_batch(roles.table(spark, sf, "supplier"), path)
    return rounded(tables.read_batch(spark, path))


@query("json_results", "SELECT event_type AS class_label, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM events), 4) AS percentage FROM events GROUP BY 1")
def json_results(spark, sf):
    path = shared_folder(spark, "report")
    df = quality.class_distribution(roles.table(spark, sf, "events").select(F.col("event_type").alias("class_label")))
    tables.write_json(df, path)
    schema = "class_label string, n bigint, percentage double"
    return rounded(spark.read.schema(schema).json(path), 4)


@query(
    "json_history",
    f"""WITH {roles.TRACES_SQL} SELECT class_label, round(count(*) / (SELECT count(*) FROM traces), 6) AS share,
  (SELECT count(*) FROM traces) AS total_traces FROM traces GROUP BY 1""",
)
def json_history(spark, sf):
    """A history record is written as JSON, read with its schema and unfolded."""
    path = shared_folder(spark, "history")
    tables.write_json(quality.history_record(roles.traces(spark, sf)), path)
    stored = tables.read_json(spark, path, HISTORY)
    return rounded(
        stored.select("total_traces", F.explode("class_distribution").alias("class_label", "share")).withColumn(
            "class_label", F.col("class_label").cast("long")
        )
    )


@query("whole_text_files", "SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations")
def whole_text_files(spark, sf):
    """Texts written one folder per conversation role, then read as whole files."""
    path = shared_folder(spark, "texts")
    # Line feeds inside a text are escaped, so that a file of lines keeps texts apart.
    df = roles.table(spark, sf, "conversations").select("role", F.regexp_replace("text", "\n", "\u0001").alias("text"))
    df.write.partitionBy("role").option("lineSep", "\u0002").text(path)
    files = tables.read_texts(spark, f"{path}/*")
    pieces = files.select(F.explode(F.split(F.regexp_replace("content", "\u0002$", ""), "\u0002")).alias("t"))
    return pieces.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("t")).cast("long").alias("chars"))


@query("file_names_to_ids", "SELECT o_orderstatus AS file_id, count(*) AS n FROM orders GROUP BY 1")
def file_names_to_ids(spark, sf):
    """Rows learn their file id from the folder they were read from."""
    path = shared_folder(spark, "files")
    df = roles.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("part_"), "o_orderstatus").alias("file"))
    df.write.partitionBy("file").parquet(path)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return tables.with_file_id(spark.read.parquet(path), folder).groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))


@query("bronze_union", "SELECT event_type AS source, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'orders', count(*) FROM orders")
def bronze_union(spark, sf):
    """Tables of one layout are appended by column name."""
    a = roles.table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("key"))
    b = roles.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.lit("orders").alias("source"))
    return a.unionByName(b).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


_EXPECTED = ["bronze", "silver", "gold", "registry", "monitoring"]


@query(
    "output_audit",
    f"""WITH e AS (SELECT unnest({_EXPECTED}) AS layer), {roles.PREDICTIONS_SQL},
o AS (SELECT 'bronze' AS layer, (SELECT count(*) FROM embeddings) AS num_rows, NULL::DOUBLE AS metric
  UNION ALL SELECT 'gold', count(*), avg(CAST(true_label = predicted_label AS INT)) FROM predictions
  UNION ALL SELECT 'registry', count(*), NULL FROM orders UNION ALL SELECT 'monitoring', 0, NULL)
SELECT e.layer, num_rows, round(metric, 6) AS metric,
  CASE WHEN num_rows IS NULL THEN 'missing' WHEN num_rows = 0 THEN 'empty' ELSE 'success' END AS status, 'failed' AS overall_status
FROM e LEFT JOIN o ON e.layer = o.layer""",
)
def output_audit(spark, sf):
    events = roles.table(spark, sf, "events")
    observed = audit.observe(
        {
            "bronze": roles.traces(spark, sf),
            "gold": roles.predictions(spark, sf),
            "registry": roles.runs(spark, sf),
            "monitoring": events.filter(F.col("value") < 0),
        },
        {"gold": F.avg((F.col("true_label") == F.col("predicted_label")).cast("double"))},
    )
    return rounded(audit.audit(spark, _EXPECTED, observed))


@query(
    "content_preview",
    "SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview FROM documents",
)
def content_preview(spark, sf):
    return roles.table(spark, sf, "documents").select("doc_id", rules.preview(F.col("text")).alias("preview"))


@query(
    "record_text",
    """SELECT doc_id, 'Document:' || chr(10) || 'Language: ' || coalesce(lang, 'Unknown') || chr(10) || 'Source: ' || coalesce(source, 'Unknown')
  || chr(10) || 'Characters: ' || coalesce(CAST(n_chars AS VARCHAR), 'Unknown') AS content FROM documents""",
)
def record_text(spark, sf):
    return roles.table(spark, sf, "documents").select(
        "doc_id",
        tx.record_lines(
            "Document:", [("Language", F.col("lang")), ("Source", F.col("source")), ("Characters", F.col("n_chars"))]
        ).alias("content"),
    )


@query(
    "class_lines",
    """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT lang, chr(10) || 'Class Distribution:' || chr(10) || string_agg('  - ' || source || ': ' || n, chr(10) ORDER BY source) AS content FROM c GROUP BY 1""",
)
def class_lines(spark, sf):
    c = roles.table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    maps = c.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("m"))
    return maps.select("lang", tx.map_lines("Class Distribution:", F.col("m")).alias("content"))


@query(
    "metadata_record",
    f"""WITH {roles.GAPPY_SQL},
c AS (SELECT CASE class_label WHEN 0 THEN 'normal' WHEN 1 THEN 'anomaly' ELSE 'boundary' END AS name, count(*) AS n FROM gappy GROUP BY 1),
d AS (SELECT string_agg('  - ' || name || ': ' || n, chr(10) ORDER BY name) AS lines FROM c),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE len(trace_data) > 0) AS k, max(num_samples) AS s, round(max(sample_rate) * 1000, 6) AS r FROM gappy)
SELECT 'dataset_metadata' AS source, 'Dataset: embeddings' || chr(10) || 'Total traces: ' || n || chr(10) || 'Sampled traces: ' || k || chr(10) ||
  'Samples per trace: ' || s || chr(10) || 'Sample rate: ' || r || ' ms' || chr(10) || chr(10) || 'Class Distribution:' || chr(10) || lines AS content FROM t, d""",
)
def metadata_record(spark, sf):
    """Totals of a dataset as the text that a search can find."""
    return rt.metadata_text(sampling.dataset_totals(roles.gappy_traces(spark, sf), "embeddings"))


@query("quality_report_lines")
def quality_report_lines(spark, sf):
    return reporting.quality_report(quality.evaluate(roles.gappy_traces(spark, sf)))


@query("comparison_report_lines")
def comparison_report_lines(spark, sf):
    from traceframe.checks.profiles import _two_sides
    from traceframe.functions.signal import mean
    from traceframe.operators import distribution as dist

    rows = _two_sides(spark, sf)
    norm = dist.normality(rows.select("dataset", mean(F.col("trace_data")).alias("m")), "m", ["dataset"])
    comparison = dist.compare_datasets(rows)
    return reporting.comparison_report(comparison, dist.verdicts(comparison, norm, "dataset", "a", "b"))


