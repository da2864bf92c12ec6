from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions.hashing import uniform
from traceframe.operators import drift as dr, evaluation as ev, features as ft
from traceframe.sources import roles

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUT = "1998-01-01 00:00:00"


def _lines(spark, sf):
    return roles.table(spark, sf, "lineitem").select("l_shipdate", *COLUMNS)


def _early():
    return F.col("l_shipdate") < F.to_timestamp_ntz(F.lit(CUT))


def ks_sql(source: str) -> str:
    """Distance per feature from a long table (feature, is_ref, value)."""
    return f"""long AS ({source}),
cnt AS (SELECT feature, value, count(*) FILTER (WHERE is_ref) AS a, count(*) FILTER (WHERE NOT is_ref) AS b
  FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS n,
  sum(b) OVER (PARTITION BY feature) AS m FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, max(abs(ca / n - cb / m)) AS d, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM cum GROUP BY feature),
z AS (SELECT *, (sqrt(CAST(n AS DOUBLE) * m / (n + m)) + 0.12 + 0.11 / sqrt(CAST(n AS DOUBLE) * m / (n + m))) * d AS z FROM ks),
p AS (SELECT feature, d, n, m, CASE WHEN z < 0.2 THEN 1.0 ELSE greatest(0, least(1, (SELECT sum(2 * pow(-1, j - 1) * exp(-2.0 * j * j * z * z))
  FROM range(1, 41) t(j)))) END AS p FROM z)"""


_LINES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, l_shipdate < TIMESTAMP '{CUT}' AS is_ref, {c} AS value FROM lineitem" for c in COLUMNS
)


@query(
    "ks_statistics",
    f"WITH {ks_sql(_LINES_SQL)}\nSELECT feature, round(d, 6) AS ks_statistic, n AS n_reference, m AS n_current FROM p",
)
def ks_statistics(spark, sf):
    return rounded(dr.ks_statistics(_lines(spark, sf), COLUMNS, _early()))


@query(
    "feature_drift",
    f"""WITH {ks_sql(_LINES_SQL)}
SELECT feature, round(d, 6) AS ks_statistic, n AS n_reference, m AS n_current, round(p, 6) AS ks_pvalue, 'series' AS ks_method, p < 0.05 AS drifted FROM p""",
)
def feature_drift(spark, sf):
    df = _lines(spark, sf)
    # Two tables, as a stored reference and a new load would come.
    return rounded(dr.feature_drift_of(df.filter(_early()), df.filter(~_early()), COLUMNS, method="series"))


_GAPPY_EVENTS = f"""SELECT 'value_scaled' AS feature, ts < TIMESTAMP '2024-01-15' AS is_ref,
  CASE WHEN {roles.sql_uniform('gap-value', 'event_id')} >= 0.05 THEN value END AS value FROM events"""


@query(
    "feature_drift_with_gaps",
    f"""WITH {ks_sql(_GAPPY_EVENTS)}
SELECT feature, round(d, 6) AS ks_statistic, n AS n_reference, m AS n_current, round(p, 6) AS ks_pvalue, 'series' AS ks_method, p < 0.05 AS drifted FROM p""",
)
def feature_drift_with_gaps(spark, sf):
    df = roles.table(spark, sf, "events").select(
        "ts",
        "event_id",
        F.when(uniform("gap-value", "event_id") >= 0.05, F.col("value")).alias("value_scaled"),
    )
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return rounded(dr.feature_drift(df, ft.drift_columns(df.columns), early, method="series"))


_SUMMARY_SQL = """s AS (SELECT count(*) AS features_tested, count(*) FILTER (WHERE p < 0.05) AS features_drifted FROM p)"""


@query(
    "drift_summary",
    f"""WITH {ks_sql(_LINES_SQL)}, {_SUMMARY_SQL}
SELECT features_tested, features_drifted, round(features_drifted / features_tested, 6) AS drift_ratio, features_drifted > 0 AS drift_detected,
  CASE WHEN features_drifted = 0 THEN 'none' WHEN features_drifted / features_tested < 0.1 THEN 'low'
    WHEN features_drifted / features_tested < 0.3 THEN 'medium' ELSE 'high' END AS severity FROM s""",
)
def drift_summary(spark, sf):
    found = dr.feature_drift(_lines(spark, sf), COLUMNS, _early(), method="series")
    return rounded(dr.drift_summary(found, len(COLUMNS)))


_HALVES_SQL = f"""r AS (SELECT embedding, row_number() OVER (ORDER BY vec_id) <= (SELECT count(*) FROM embeddings) // 2 AS is_ref FROM embeddings),
{ks_sql("SELECT 'embedding_' || unnest(range(64)) AS feature, is_ref, CAST(unnest(embedding) AS DOUBLE) AS value FROM r")}"""


@query(
    "small_sample_drift",
    # For samples of one size the exact tail is a finite alternating sum, independent of the lattice walk.
    f"""WITH {_HALVES_SQL},
h AS (SELECT *, CAST(round(d * n) AS BIGINT) AS h FROM p),
e AS (SELECT feature, d, n, m, least(1.0, 2 * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END *
  exp(2 * lgamma(n + 1) - lgamma(n - k * h + 1) - lgamma(n + k * h + 1))) FROM range(1, 2000) t(k) WHERE k * h <= n)) AS p FROM h)
SELECT feature, round(d, 6) AS ks_statistic, n AS n_reference, m AS n_current, round(p, 6) AS ks_pvalue, 'exact' AS ks_method, p < 0.05 AS drifted FROM e""",
)
def small_sample_drift(spark, sf):
    """All embedding columns of two row-order halves: exact p-values."""
    from traceframe.operators.sampling import halves

    traces = roles.traces(spark, sf).select("trace_id", F.col("trace_data").alias("embedding"))
    wide = halves(ft.spread_embedding(traces, dim=64), "trace_id")
    return rounded(dr.feature_drift(wide, ft.drift_columns(wide.columns), F.col("side") == "reference"))


@query(
    "small_sample_distance",
    f"""WITH {_HALVES_SQL}
SELECT feature, round(d, 6) AS ks_statistic, n AS n_reference, m AS n_current FROM p""",
)
def small_sample_distance(spark, sf):
    return small_sample_drift(spark, sf).select("feature", "ks_statistic", "n_reference", "n_current")


_COUNTS_SQL = """c AS (SELECT event_type AS category, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS reference_count,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS current_count FROM events GROUP BY 1)"""


def _event_counts(spark, sf):
    df = roles.table(spark, sf, "events").select("ts", "event_type")
    return dr.aligned_counts(df, "event_type", F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))


@query("aligned_counts", f"WITH {_COUNTS_SQL}\nSELECT * FROM c")
def aligned_counts(spark, sf):
    return _event_counts(spark, sf)


_CHI_SQL = """s AS (SELECT CAST(reference_count + 1 AS DOUBLE) AS a, CAST(current_count + 1 AS DOUBLE) AS b FROM c),
t AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS k FROM s),
e AS (SELECT a, b, (a + b) * ta / (ta + tb) AS ea, (a + b) * tb / (ta + tb) AS eb, k FROM s, t),
g AS (SELECT ea, eb, k, CASE WHEN k = 2 THEN abs(a - ea) - least(0.5, abs(a - ea)) ELSE abs(a - ea) END AS da,
  CASE WHEN k = 2 THEN abs(b - eb) - least(0.5, abs(b - eb)) ELSE abs(b - eb) END AS db FROM e),
x AS (SELECT sum(da * da / ea + db * db / eb) AS chi2, max(k) - 1 AS dof FROM g)"""
# Closed form of the upper tail for an even number of degrees of freedom.
_TAIL_SQL = "exp(-chi2 / 2) * (SELECT sum(pow(chi2 / 2, i) / gamma(i + 1)) FROM range(0, dof // 2) t(i))"


@query(
    "prediction_drift",
    f"WITH {_COUNTS_SQL}, {_CHI_SQL}\nSELECT round(chi2, 6) AS chi2_statistic, dof, round({_TAIL_SQL}, 6) AS chi2_pvalue, {_TAIL_SQL} < 0.05 AS drift_detected FROM x",
)
def prediction_drift(spark, sf):
    return rounded(dr.chi_square(_event_counts(spark, sf)))


@query(
    "two_class_drift",
    f"""WITH c AS (SELECT l_linestatus AS category, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '{CUT}') AS reference_count,
  count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '{CUT}') AS current_count FROM lineitem GROUP BY 1), {_CHI_SQL}
SELECT round(chi2, 6) AS chi2_statistic, dof FROM x""",
)
def two_class_drift(spark, sf):
    df = roles.table(spark, sf, "lineitem").select("l_shipdate", "l_linestatus")
    return rounded(dr.chi_square(dr.aligned_counts(df, "l_linestatus", _early())).select("chi2_statistic", "dof"))


@query("class_union", "SELECT DISTINCT o_orderstatus AS category FROM orders UNION SELECT DISTINCT l_linestatus FROM lineitem")
def class_union(spark, sf):
    a = roles.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("category")).distinct()
    b = roles.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("category")).distinct()
    return a.union(b).distinct()


_IMPORTANCES_SQL = """imp AS (SELECT feature, CAST(n AS DOUBLE) AS importance FROM (SELECT count(DISTINCT l_quantity) AS l_quantity,
  count(DISTINCT l_extendedprice) AS l_extendedprice, count(DISTINCT l_discount) AS l_discount, count(DISTINCT l_tax) AS l_tax
  FROM lineitem) UNPIVOT (n FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax)))"""


@query(
    "important_feature_drift",
    f"""WITH {ks_sql(_LINES_SQL)}, {_IMPORTANCES_SQL}
SELECT i.feature, importance, round(d, 6) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.05 AS drifted
FROM (SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 3) i LEFT JOIN p ON p.feature = i.feature""",
)
def important_feature_drift(spark, sf):
    """Importance stands in as the number of distinct values of a column."""
    from traceframe.plans.ranking import unpivot

    df = _lines(spark, sf)
    wide = df.agg(*[F.countDistinct(c).cast("double").alias(c) for c in COLUMNS])
    imp = unpivot(wide, [], COLUMNS, "feature", "importance")
    return rounded(ev.important_drift(imp, dr.feature_drift(df, COLUMNS, _early(), method="series"), n=3))


_WIDE_EVENTS = f"""SELECT feature, ts < TIMESTAMP '2024-01-15' AS is_ref, v AS value FROM
  (SELECT ts, value AS value_scaled, value / 1000 AS latency_scaled FROM events) UNPIVOT (v FOR feature IN (value_scaled, latency_scaled))"""


@query(
    "monitoring_report",
    f"""WITH {ks_sql(_WIDE_EVENTS)}, fs AS (SELECT count(*) AS features_tested, count(*) FILTER (WHERE p < 0.05) AS features_drifted FROM p),
{_COUNTS_SQL}, {_CHI_SQL}, pd AS (SELECT chi2, {_TAIL_SQL} < 0.05 AS drift FROM x),
acc AS (SELECT avg(CAST(event_type = CASE WHEN value > 20 THEN 'view' ELSE 'click' END AS INT)) AS accuracy FROM events),
r AS (SELECT *, features_drifted / features_tested AS ratio, CASE WHEN features_drifted / features_tested > 0.3 THEN 'high'
  WHEN features_drifted / features_tested > 0.1 THEN 'medium' WHEN features_drifted > 0 THEN 'low' ELSE 'none' END AS severity FROM fs, pd, acc)
SELECT features_tested, features_drifted, round(ratio, 6) AS drift_ratio, features_drifted > 0 AS drift_detected, severity,
  round(chi2, 6) AS chi2_statistic, drift AS prediction_drift, round(accuracy, 6) AS accuracy,
  concat_ws('; ', CASE WHEN severity IN ('medium', 'high') THEN 'feature_drift|' || severity || '|Feature drift detected: ' || features_drifted || ' features drifted' END,
    CASE WHEN drift THEN 'prediction_drift|medium|Prediction distribution has shifted' END,
    CASE WHEN accuracy < 0.4 THEN 'low_accuracy|high|Model accuracy (' || format('{{:.2f}}', accuracy * 100) || '%) below threshold' END) AS alert_list FROM r""",
)
def monitoring_report(spark, sf):
    df = roles.table(spark, sf, "events").select(
        "ts",
        F.col("value").alias("value_scaled"),
        (F.col("value") / 1000).alias("latency_scaled"),
        F.col("event_type").alias("predicted_class"),
        F.when(F.col("value") > 20, "view").otherwise("click").alias("class_label"),
    )
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    out = dr.monitoring_report(df, ft.drift_columns(df.columns), early, "predicted_class", method="series")
    return rounded(
        out.select(
            "features_tested", "features_drifted", "drift_ratio", "drift_detected", "severity",
            "prediction.chi2_statistic", F.col("prediction.drift_detected").alias("prediction_drift"),
            "performance.accuracy",
            F.concat_ws("; ", F.transform("alerts", lambda a: F.concat_ws("|", a["type"], a["severity"], a["message"]))).alias("alert_list"),
        )
    )
