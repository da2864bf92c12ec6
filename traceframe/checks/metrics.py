from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions.hashing import uniform
from traceframe.operators import evaluation as ev, registry as reg, scoring
from traceframe.sources import roles


def _predictions(spark, sf):
    return roles.predictions(spark, sf)


@query(
    "confusion_matrix",
    f"""WITH {roles.PREDICTIONS_SQL}, k AS (SELECT CAST(unnest(range(3)) AS BIGINT) AS c)
SELECT a.c AS true_label, b.c AS predicted_label, count(p.trace_id) AS n
FROM k a CROSS JOIN k b LEFT JOIN predictions p ON p.true_label = a.c AND p.predicted_label = b.c GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(_predictions(spark, sf), "true_label", "predicted_label")


_CLASS_SQL = """k AS (SELECT DISTINCT t AS c FROM pr UNION SELECT DISTINCT p FROM pr),
pc AS (SELECT c AS class_label, (SELECT count(*) FROM pr WHERE t = c) AS support, (SELECT count(*) FROM pr WHERE p = c) AS predicted,
  (SELECT count(*) FROM pr WHERE t = c AND p = c) AS hits FROM k),
pm AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pm),
sm AS (SELECT sum(hits) / sum(support) AS accuracy,
  avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
  sum(precision * support) / sum(support) AS precision_weighted, sum(recall * support) / sum(support) AS recall_weighted,
  sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS BIGINT) AS num_samples FROM pf)"""
_SUMMARY = ["accuracy"] + [f"{m}_{k}" for k in ("macro", "weighted") for m in ("precision", "recall", "f1")]
_TRACE_PR = f"{roles.PREDICTIONS_SQL}, pr AS (SELECT true_label AS t, predicted_label AS p FROM predictions)"


@query(
    "class_metrics",
    f"""WITH {_TRACE_PR}, {_CLASS_SQL}
SELECT class_label, support, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pf""",
)
def class_metrics(spark, sf):
    return rounded(ev.class_metrics(ev.outcome_counts(_predictions(spark, sf), "true_label", "predicted_label")))


@query(
    "summary_metrics",
    f"WITH {_TRACE_PR}, {_CLASS_SQL}\nSELECT {', '.join(f'round({c}, 6) AS {c}' for c in _SUMMARY)}, num_samples FROM sm",
)
def summary_metrics(spark, sf):
    return rounded(ev.summary_metrics(ev.outcome_counts(_predictions(spark, sf), "true_label", "predicted_label")))


@query(
    "binary_label_metrics",
    f"""WITH pr AS (SELECT quality AS t, toxic AS p FROM labels), {_CLASS_SQL}
SELECT {', '.join(f'round({c}, 6) AS {c}' for c in _SUMMARY)}, num_samples FROM sm""",
)
def binary_label_metrics(spark, sf):
    return rounded(ev.summary_metrics(ev.outcome_counts(roles.table(spark, sf, "labels"), "quality", "toxic")))


@query(
    "classification_report",
    f"""WITH {_TRACE_PR}, {_CLASS_SQL},
rep AS (SELECT CASE class_label WHEN 0 THEN 'Normal' WHEN 1 THEN 'Anomaly' ELSE 'Boundary' END AS entry, precision, recall, f1, support FROM pf
  UNION ALL SELECT 'macro avg', precision_macro, recall_macro, f1_macro, num_samples FROM sm
  UNION ALL SELECT 'weighted avg', precision_weighted, recall_weighted, f1_weighted, num_samples FROM sm)
SELECT entry, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""",
)
def classification_report(spark, sf):
    return rounded(ev.classification_report(ev.outcome_counts(_predictions(spark, sf), "true_label", "predicted_label")))


def _auc_sql(source: str) -> str:
    return f"""long AS ({source}),
ranked AS (SELECT class_column, is_pos, (rank() OVER (PARTITION BY class_column ORDER BY score)
  + (count(*) OVER (PARTITION BY class_column, score) - 1) / 2) AS r FROM long),
auc AS (SELECT class_column, count(*) FILTER (WHERE is_pos) AS positives, count(*) FILTER (WHERE NOT is_pos) AS negatives,
  sum(r) FILTER (WHERE is_pos) AS rs FROM ranked GROUP BY 1),
per AS (SELECT class_column, positives, negatives, (rs - positives * (positives + 1) / 2) / (positives * negatives) AS auc FROM auc)"""


_PROB = " UNION ALL ".join(
    f"SELECT '{c}' AS class_column, {c} AS score, true_label = {i} AS is_pos FROM predictions"
    for i, c in enumerate(("prob_normal", "prob_anomaly", "prob_boundary"))
)


def _wide(spark, sf):
    return ev.predictions_table(_predictions(spark, sf))


PROBS = ["prob_normal", "prob_anomaly", "prob_boundary"]


@query(
    "roc_auc_per_class",
    f"WITH {roles.PREDICTIONS_SQL}, {_auc_sql(_PROB)}\nSELECT class_column, positives, negatives, round(auc, 6) AS auc FROM per",
)
def roc_auc_per_class(spark, sf):
    return rounded(ev.roc_auc(_wide(spark, sf), "true_label", PROBS))


@query(
    "roc_auc_averages",
    f"""WITH {roles.PREDICTIONS_SQL}, {_auc_sql(_PROB)}
SELECT round(avg(auc), 6) AS roc_auc_macro, round(sum(auc * positives) / sum(positives), 6) AS roc_auc_weighted FROM per""",
)
def roc_auc_averages(spark, sf):
    return rounded(ev.auc_averages(ev.roc_auc(_wide(spark, sf), "true_label", PROBS), 3))


_FLAGS = " UNION ALL ".join(
    f"SELECT '{c}' AS class_column, {e} AS score, flag = {i} AS is_pos FROM flags"
    for i, (c, e) in enumerate((("quantity_score", "l_quantity"), ("price_score", "l_extendedprice")))
)


@query(
    "roc_auc_large",
    f"""WITH flags AS (SELECT CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS flag, l_quantity, l_extendedprice FROM lineitem), {_auc_sql(_FLAGS)}
SELECT class_column, positives, negatives, round(auc, 6) AS auc FROM per""",
)
def roc_auc_large(spark, sf):
    df = roles.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("flag"),
        F.col("l_quantity").alias("quantity_score"),
        F.col("l_extendedprice").alias("price_score"),
    )
    return rounded(ev.roc_auc(df, "flag", ["quantity_score", "price_score"]))


@query(
    "fold_scores",
    f"""WITH {roles.PREDICTIONS_SQL}, pr AS (SELECT true_label AS t, predicted_label AS p,
  (row_number() OVER (PARTITION BY true_label ORDER BY md5('42:' || trace_id), trace_id) - 1) % 5 AS f FROM predictions),
k AS (SELECT DISTINCT f, t AS c FROM pr UNION SELECT DISTINCT f, p FROM pr),
pc AS (SELECT k.f, c, count(*) FILTER (WHERE t = c) AS s, count(*) FILTER (WHERE p = c) AS q, count(*) FILTER (WHERE t = c AND p = c) AS h
  FROM k JOIN pr ON pr.f = k.f GROUP BY k.f, c),
pf AS (SELECT f, s, CASE WHEN h > 0 THEN 2 * (h / q) * (h / s) / (h / q + h / s) ELSE 0 END AS f1 FROM pc),
ff AS (SELECT f, sum(f1 * s) / sum(s) AS w FROM pf GROUP BY f)
SELECT round(avg(w), 6) AS cv_f1_weighted, count(*) AS folds FROM ff""",
)
def fold_scores(spark, sf):
    from traceframe.operators.sampling import stratified_folds

    df = stratified_folds(_predictions(spark, sf), "true_label", ["trace_id"])
    return rounded(ev.fold_scores(df, "true_label", "predicted_label", "fold"))


@query(
    "predictions_table",
    f"""WITH {roles.PREDICTIONS_SQL}
SELECT file_id, trace_id, true_label, predicted_label, true_label = predicted_label AS correct,
  list_extract(['Normal', 'Anomaly', 'Boundary'], true_label + 1) AS true_class,
  list_extract(['Normal', 'Anomaly', 'Boundary'], predicted_label + 1) AS predicted_class,
  round(prob_normal, 6) AS prob_normal, round(prob_anomaly, 6) AS prob_anomaly, round(prob_boundary, 6) AS prob_boundary FROM predictions""",
)
def predictions_table(spark, sf):
    return rounded(_wide(spark, sf))


@query("scored_distribution", f"WITH {roles.PREDICTIONS_SQL}\nSELECT predicted_label AS predicted_class, count(*) AS n FROM predictions GROUP BY 1")
def scored_distribution(spark, sf):
    return scoring.scored_distribution(_predictions(spark, sf).withColumnRenamed("predicted_label", "predicted_class"))


@query(
    "scored_accuracy",
    f"""WITH {roles.PREDICTIONS_SQL}
SELECT round(avg(CAST(true_label = predicted_label AS INT)), 6) AS accuracy,
  round(avg(greatest(prob_normal, prob_anomaly, prob_boundary)), 6) AS avg_confidence FROM predictions""",
)
def scored_accuracy(spark, sf):
    from traceframe.operators.drift import scored_accuracy as measure

    df = _predictions(spark, sf).withColumn("confidence", F.array_max("scores"))
    return rounded(measure(df))


@query(
    "latest_runs",
    """SELECT o_custkey AS experiment, arg_max(o_orderkey, {'t': o_orderdate, 'k': o_orderkey}) AS run_id,
  round(arg_max(o_totalprice, {'t': o_orderdate, 'k': o_orderkey}), 6) AS metric FROM orders GROUP BY 1""",
)
def latest_runs(spark, sf):
    return rounded(reg.latest_run(roles.runs(spark, sf)).select("experiment", "run_id", "metric"))


@query(
    "best_runs",
    """SELECT o_custkey AS experiment, arg_max(o_orderkey, {'m': o_totalprice, 'k': -o_orderkey}) AS run_id,
  round(max(o_totalprice), 6) AS metric FROM orders GROUP BY 1""",
)
def best_runs(spark, sf):
    return rounded(reg.best_run(roles.runs(spark, sf)).select("experiment", "run_id", "metric"))


_VERSIONS_SQL = """versions AS (SELECT o_custkey AS model_name, o_orderkey AS version,
  CASE o_orderstatus WHEN 'F' THEN 'Archived' WHEN 'P' THEN 'Production' ELSE 'Staging' END AS stage, o_orderdate AS created FROM orders)"""


@query("latest_versions", f"WITH {_VERSIONS_SQL}\nSELECT model_name, stage, max(version) AS version FROM versions GROUP BY 1, 2")
def latest_versions(spark, sf):
    return reg.latest_versions(roles.model_versions(spark, sf)).select("model_name", "stage", "version")


@query(
    "production_versions",
    f"WITH {_VERSIONS_SQL}\nSELECT model_name, max(version) AS version FROM versions WHERE stage = 'Production' GROUP BY 1",
)
def production_versions(spark, sf):
    return reg.production_version(roles.model_versions(spark, sf)).select("model_name", "version")


@query(
    "registered_versions",
    f"""WITH {_VERSIONS_SQL}, fresh AS (SELECT c_custkey AS model_name FROM customer)
SELECT model_name, version, stage FROM versions UNION ALL
SELECT f.model_name, coalesce(max(v.version), 0) + 1, 'None' FROM fresh f LEFT JOIN versions v ON v.model_name = f.model_name GROUP BY 1""",
)
def registered_versions(spark, sf):
    new = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("model_name"), F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")).alias("created")
    )
    return reg.register(roles.model_versions(spark, sf), new).drop("created")


@query(
    "stage_transition",
    f"""WITH {_VERSIONS_SQL}, last AS (SELECT model_name, max(version) AS version FROM versions GROUP BY 1)
SELECT v.model_name, v.version, CASE WHEN l.version IS NULL THEN v.stage ELSE 'Production' END AS stage
FROM versions v LEFT JOIN last l ON l.model_name = v.model_name AND l.version = v.version""",
)
def stage_transition(spark, sf):
    versions = roles.model_versions(spark, sf)
    last = versions.groupBy("model_name").agg(F.max("version").alias("version"))
    return reg.transition(versions, last, "Production").drop("created")


@query(
    "best_trials",
    f"""WITH t AS (SELECT o_orderpriority AS model_type, o_orderkey AS trial, round(o_totalprice, -4) AS value FROM orders),
b AS (SELECT model_type, arg_max(trial, {{'v': value, 't': -trial}}) AS trial, max(value) AS value FROM t GROUP BY 1)
SELECT model_type, trial, value, model_type = (SELECT arg_max(model_type, {{'v': value,
  't': -list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], model_type)}}) FROM b) AS is_best FROM b""",
)
def best_trials(spark, sf):
    trials = roles.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model_type"), F.col("o_orderkey").alias("trial"), F.round("o_totalprice", -4).alias("value")
    )
    return reg.best_trial(trials, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


_IMPORTANCE_SQL = f"SELECT p_partkey AS feature, round({roles.sql_uniform('importance', 'p_partkey')}, 9) AS importance FROM part"


@query("top_importances", f"{_IMPORTANCE_SQL} ORDER BY importance DESC, feature LIMIT 10")
def top_importances(spark, sf):
    table = roles.table(spark, sf, "part").select(
        F.col("p_partkey").alias("feature"), F.round(uniform("importance", "p_partkey"), 9).alias("importance")
    )
    return ev.top_importances(table)
