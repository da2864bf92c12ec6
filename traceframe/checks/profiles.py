from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions import rules, significance as sig
from traceframe.functions.hashing import uniform
from traceframe.operators import distribution as dist, imputation, quality, sampling
from traceframe.plans.ranking import exact_median
from traceframe.schemas import HEADERS
from traceframe.sources import roles

_COLUMNS = ["file_id", "trace_id", "class_label", "trace_data", *HEADERS]


def _missing(c: str) -> str:
    return f"{c} IS NULL OR len({c}) = 0" if c == "trace_data" else f"{c} IS NULL"


@query(
    "missing_profile",
    f"WITH {roles.GAPPY_SQL},\ncounts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_missing(c)}) AS missing_count, count(*) AS n FROM gappy"
        for c in _COLUMNS
    )
    + ")\nSELECT column_name, missing_count, round(missing_count / n * 100, 6) AS missing_pct FROM counts WHERE missing_count > 0",
)
def missing_profile(spark, sf):
    return rounded(quality.missing_profile(roles.gappy_traces(spark, sf)))


@query(
    "non_empty_traces",
    f"WITH {roles.GAPPY_SQL}\nSELECT trace_id, CAST(len(trace_data) AS BIGINT) AS n FROM gappy WHERE len(trace_data) > 0",
)
def non_empty_traces(spark, sf):
    kept = quality.drop_empty_traces(roles.gappy_traces(spark, sf))
    return kept.select("trace_id", F.size("trace_data").cast("long").alias("n"))


_VALIDATION_SQL = """v AS (
  SELECT count(*) AS total_traces, count(DISTINCT file_id) AS total_files,
    count(*) FILTER (WHERE trace_data IS NULL) AS missing_trace_data,
    count(*) FILTER (WHERE cdp_x IS NULL OR cdp_y IS NULL) AS missing_coordinates,
    count(DISTINCT sample_rate) = 1 AS sample_rate_consistency,
    count(DISTINCT num_samples) = 1 AS num_samples_consistency FROM {t})
SELECT *, concat_ws('; ',
  CASE WHEN missing_trace_data > 0 THEN 'Found ' || missing_trace_data || ' traces with missing data' END,
  CASE WHEN NOT sample_rate_consistency THEN 'Inconsistent sample rates across traces' END,
  CASE WHEN NOT num_samples_consistency THEN 'Inconsistent number of samples across traces' END) AS anomaly_list,
  missing_trace_data = 0 AND sample_rate_consistency AND num_samples_consistency AS validation_passed,
  (SELECT string_agg(class_label || ':' || n, ',' ORDER BY class_label) FROM (SELECT class_label, count(*) AS n FROM {t} WHERE class_label IS NOT NULL GROUP BY 1)) AS class_list FROM v"""


def _validation(df):
    classes = F.array_join(F.transform(F.map_entries("class_counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return quality.validation(df).withColumn("anomaly_list", F.concat_ws("; ", "anomalies")).withColumn("class_list", classes).drop("anomalies", "class_counts")


@query("validation_clean", f"WITH {roles.TRACES_SQL},\n{_VALIDATION_SQL.format(t='traces')}")
def validation_clean(spark, sf):
    return _validation(roles.traces(spark, sf))


@query("validation_gappy", f"WITH {roles.GAPPY_SQL},\n{_VALIDATION_SQL.format(t='gappy')}")
def validation_gappy(spark, sf):
    return _validation(roles.gappy_traces(spark, sf))


@query(
    "class_distribution",
    """SELECT event_type AS class_label, count(*) AS n, round(count(*) / (SELECT count(*) FROM events) * 100, 6) AS percentage
FROM events GROUP BY event_type""",
)
def class_distribution(spark, sf):
    df = roles.table(spark, sf, "events").select(F.col("event_type").alias("class_label"))
    return rounded(quality.class_distribution(df))


@query(
    "balance_score",
    """WITH c AS (SELECT event_type, count(*) / (SELECT count(*) FROM events) AS p FROM events GROUP BY event_type)
SELECT count(*) AS num_classes, round(-sum(p * log2(p)) / log2(count(*)), 6) AS balance_score,
  round(1 + sum(p * log2(p)) / log2(count(*)), 6) AS imbalance_score FROM c""",
)
def balance_score(spark, sf):
    return rounded(quality.balance(roles.table(spark, sf, "events"), "event_type"))


@query(
    "trace_statistics",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT file_id, round(avg(mean_amplitude), 6) AS mean_of_means, round(stddev_pop(mean_amplitude), 6) AS std_of_means,
  round(avg(std_amplitude), 6) AS mean_of_stds, round(stddev_pop(std_amplitude), 6) AS std_of_stds,
  round(min(min_amplitude), 6) AS overall_min, round(max(max_amplitude), 6) AS overall_max,
  count(*) FILTER (WHERE std_amplitude = 0) AS dead_traces, count(*) AS sample_size FROM features GROUP BY file_id""",
)
def trace_statistics(spark, sf):
    return rounded(quality.trace_statistics(roles.traces(spark, sf), by=["file_id"]))


@query(
    "coordinate_ranges",
    f"""WITH {roles.GAPPY_SQL}
"""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM gappy"
        for c in ("cdp_x", "cdp_y")
    ),
)
def coordinate_ranges(spark, sf):
    return rounded(quality.coordinate_ranges(roles.gappy_traces(spark, sf)))


@query(
    "rate_and_length",
    f"""WITH {roles.TRACES_SQL}
SELECT round(arg_min(sample_rate, trace_id) * 1000, 6) AS sample_rate_ms, count(DISTINCT sample_rate) = 1 AS sample_rate_consistent,
  arg_min(num_samples, trace_id) AS num_samples, count(DISTINCT num_samples) = 1 AS num_samples_consistent FROM traces""",
)
def rate_and_length(spark, sf):
    return rounded(quality.rate_and_length(roles.traces(spark, sf)))


_RANGES = ",\n".join(
    f"CAST(min({c}) AS DOUBLE) AS {c}_min, CAST(max({c}) AS DOUBLE) AS {c}_max" for c in ("inline", "crossline", "cdp_x", "cdp_y")
)
_UNIQUE = ", ".join(f"count(DISTINCT {c}) AS unique_{c}" for c in ("inline", "crossline", "cdp_x", "cdp_y", "file_id"))


@query(
    "domain_checks",
    f"""WITH {roles.GAPPY_SQL},
flat AS (SELECT unnest(trace_data) AS x FROM gappy),
a AS (SELECT round(min(x), 6) AS min_amplitude, round(max(x), 6) AS max_amplitude, round(avg(x), 6) AS mean_amplitude,
  round(stddev_pop(x), 6) AS std_amplitude FROM flat),
d AS (SELECT count(*) FILTER (WHERE list_min(trace_data) = list_max(trace_data)) AS dead_traces,
  round(count(*) FILTER (WHERE list_min(trace_data) = list_max(trace_data)) / count(trace_data) * 100, 6) AS dead_traces_pct FROM gappy),
r AS (SELECT round(arg_min(sample_rate, trace_id) * 1000, 6) AS sample_rate_ms,
  arg_min(sample_rate, trace_id) * 1000 BETWEEN 0.5 AND 4.0 AS within_standards, {_RANGES}, {_UNIQUE},
  count(*) AS total_traces, count(*) FILTER (WHERE trace_data IS NULL) AS missing_trace_data,
  count(*) FILTER (WHERE cdp_x IS NULL OR cdp_y IS NULL) AS missing_coordinates FROM gappy)
SELECT * FROM a, d, r""",
)
def domain_checks(spark, sf):
    return rounded(quality.domain_checks(roles.gappy_traces(spark, sf)))


# History: an earlier load in which the empty traces had been dropped.
_HISTORY_SQL = "history AS (SELECT * FROM gappy WHERE len(trace_data) > 0)"


def _history(spark, sf):
    return quality.drop_empty_traces(roles.gappy_traces(spark, sf))


@query(
    "history_statistics",
    f"""WITH {roles.TRACES_SQL}, flat AS (SELECT unnest(trace_data) AS x FROM traces)
SELECT (SELECT count(*) FROM traces) AS total_traces, (SELECT count(DISTINCT file_id) FROM traces) AS total_files,
  round(avg(x), 6) AS mean_amplitude, round(stddev_pop(x), 6) AS std_amplitude FROM flat""",
)
def history_statistics(spark, sf):
    return rounded(quality.history_statistics(roles.traces(spark, sf)))


_SHARES_SQL = """cur AS (SELECT class_label, count(*) / (SELECT count(*) FROM traces) AS share FROM traces GROUP BY 1),
past AS (SELECT class_label, count(*) / (SELECT count(*) FROM history) AS share FROM history GROUP BY 1),
changes AS (SELECT coalesce(c.class_label, p.class_label) AS class_label, coalesce(c.share, 0) AS current_share,
  coalesce(p.share, 0) AS historical_share FROM cur c FULL JOIN past p ON c.class_label = p.class_label)"""


@query(
    "class_share_changes",
    f"""WITH {roles.GAPPY_SQL}, {_HISTORY_SQL}, {_SHARES_SQL}
SELECT class_label, round(current_share, 6) AS current_share, round(historical_share, 6) AS historical_share,
  round(abs(current_share - historical_share), 6) AS change FROM changes""",
)
def class_share_changes(spark, sf):
    now, past = roles.traces(spark, sf), _history(spark, sf)
    return rounded(quality.compare_shares(quality.class_shares(now), quality.class_shares(past)))


@query(
    "drift_indicators",
    f"""WITH {roles.GAPPY_SQL}, {_HISTORY_SQL}, {_SHARES_SQL},
m AS (SELECT max(abs(current_share - historical_share)) AS c FROM changes),
a AS (SELECT abs((SELECT avg(x) FROM (SELECT unnest(trace_data) AS x FROM traces)) -
  (SELECT avg(x) FROM (SELECT unnest(trace_data) AS x FROM history))) AS s),
n AS (SELECT (SELECT count(*) FROM traces) AS now, (SELECT count(*) FROM history) AS past)
SELECT round(c, 6) AS max_class_change, c > 0.1 AS class_change_significant, round(s, 6) AS amplitude_shift,
  s > 100 AS amplitude_shift_significant, abs(now - past) AS volume_change,
  round(abs(now - past) / greatest(past, 1) * 100, 6) AS volume_change_pct,
  abs(now - past) / greatest(past, 1) * 100 > 20 AS volume_change_significant FROM m, a, n""",
)
def drift_indicators(spark, sf):
    now, past = roles.traces(spark, sf), _history(spark, sf)
    return rounded(
        quality.drift_indicators(
            quality.history_statistics(now), quality.class_shares(now), quality.history_statistics(past), quality.class_shares(past)
        )
    )


@query(
    "quality_evaluation",
    f"""WITH {roles.GAPPY_SQL}, {_HISTORY_SQL},
flat AS (SELECT unnest(trace_data) AS x FROM gappy),
c AS (SELECT class_label, count(*) / (SELECT count(*) FROM gappy) AS p FROM gappy GROUP BY 1),
h AS (SELECT class_label, count(*) / (SELECT count(*) FROM history) AS p FROM history GROUP BY 1)
SELECT CASE WHEN count(*) FILTER (WHERE trace_data IS NULL) > 0 THEN 'HIGH' ELSE 'LOW' END AS priority,
  CASE WHEN count(*) FILTER (WHERE trace_data IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS action,
  CASE WHEN count(*) FILTER (WHERE trace_data IS NULL) > 0 THEN 'Validation failed' ELSE 'Quality acceptable' END AS reasoning,
  count(*) AS total_traces, (SELECT round(-sum(p * log2(p)) / log2(count(*)), 6) FROM c) AS balance_score,
  (SELECT round(avg(x), 6) FROM flat) AS mean_amplitude, 'compared' AS drift_status,
  (SELECT round(max(abs(c.p - coalesce(h.p, 0))), 6) FROM c LEFT JOIN h ON c.class_label = h.class_label) AS max_class_change
FROM gappy""",
)
def quality_evaluation(spark, sf):
    now = roles.gappy_traces(spark, sf)
    out = quality.evaluate(now, quality.history_record(_history(spark, sf)))
    return rounded(
        out.select(
            "priority", "action", "reasoning", "total_traces", "balance.balance_score", "domain.mean_amplitude",
            "drift_status", "drift.max_class_change",
        )
    )


@query(
    "column_medians",
    """SELECT column_name, median FROM (SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice,
  median(l_discount) AS l_discount, median(l_tax) AS l_tax FROM lineitem)
UNPIVOT (median FOR column_name IN (l_quantity, l_extendedprice, l_discount, l_tax))""",
)
def column_medians(spark, sf):
    df = roles.table(spark, sf, "lineitem")
    return rounded(exact_median(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query(
    "median_imputation",
    f"""WITH g AS (SELECT event_id, CASE WHEN {roles.sql_uniform('gap-value', 'event_id')} >= 0.05 THEN value END AS value FROM events)
SELECT event_id, round(coalesce(value, (SELECT median(value) FROM g)), 6) AS value FROM g""",
)
def median_imputation(spark, sf):
    gap = F.when(uniform("gap-value", "event_id") >= 0.05, F.col("value")).alias("value")
    return rounded(imputation.impute_median(roles.table(spark, sf, "events").select("event_id", gap), ["value"]))


_KNN_VALUES = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in HEADERS) + "]"


@query(
    "nearest_imputation",
    f"""WITH {roles.GAPPY_SQL},
vectors AS (SELECT trace_id, {_KNN_VALUES} AS v FROM gappy),
gaps AS (SELECT trace_id, v, c FROM vectors, range(1, {len(HEADERS) + 1}) t(c) WHERE v[c] IS NULL),
pairs AS (
  SELECT g.trace_id, g.c, d.trace_id AS donor, d.v[g.c] AS value,
    list_sum(list_transform(list_zip(g.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS s,
    len(list_filter(list_zip(g.v, d.v), lambda p: (p[1] - p[2]) IS NOT NULL)) AS present
  FROM gaps g JOIN vectors d ON d.v[g.c] IS NOT NULL),
best AS (SELECT *, row_number() OVER (PARTITION BY trace_id, c ORDER BY sqrt(s * {len(HEADERS)} / present), donor) AS r
  FROM pairs WHERE present > 0),
filled AS (SELECT trace_id, c, avg(value) AS value FROM best WHERE r <= 2 GROUP BY trace_id, c)
SELECT v.trace_id, """
    + ", ".join(
        f"round(coalesce(v.v[{i}], f{i}.value), 6) AS {c}" for i, c in enumerate(HEADERS, 1)
    )
    + " FROM vectors v"
    + "".join(f" LEFT JOIN filled f{i} ON f{i}.trace_id = v.trace_id AND f{i}.c = {i}" for i in range(1, len(HEADERS) + 1)),
)
def nearest_imputation(spark, sf):
    df = roles.gappy_traces(spark, sf).select("trace_id", *HEADERS)
    return rounded(imputation.impute_nearest(df, HEADERS, "trace_id"))


def _per_file(spark, sf):
    """Traces numbered anew in every file; half of the gaps are NaN instead of null."""
    nan = lambda c: F.when(uniform(f"nan-{c}", "trace_id") < 0.5, F.lit(float("nan")))
    df = roles.gappy_traces(spark, sf)
    gaps = [F.coalesce(F.col(c).cast("double"), nan(c)).alias(c) for c in HEADERS]
    return df.select("file_id", (F.col("trace_id") % 100).alias("trace_id"), *gaps)


@query(
    "nearest_imputation_per_file",
    f"""WITH {roles.GAPPY_SQL},
vectors AS (SELECT file_id, trace_id % 100 AS trace_id, {_KNN_VALUES} AS v FROM gappy),
gaps AS (SELECT file_id, trace_id, v, c FROM vectors, range(1, {len(HEADERS) + 1}) t(c) WHERE v[c] IS NULL),
pairs AS (
  SELECT g.file_id, g.trace_id, g.c, d.file_id AS donor_file, d.trace_id AS donor, d.v[g.c] AS value,
    list_sum(list_transform(list_zip(g.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS s,
    len(list_filter(list_zip(g.v, d.v), lambda p: (p[1] - p[2]) IS NOT NULL)) AS present
  FROM gaps g JOIN vectors d ON d.v[g.c] IS NOT NULL),
best AS (SELECT *, row_number() OVER (PARTITION BY file_id, trace_id, c ORDER BY sqrt(s * {len(HEADERS)} / present), donor_file, donor) AS r
  FROM pairs WHERE present > 0),
filled AS (SELECT file_id, trace_id, c, avg(value) AS value FROM best WHERE r <= 2 GROUP BY file_id, trace_id, c)
SELECT v.file_id, v.trace_id, """
    + ", ".join(f"round(coalesce(v.v[{i}], f{i}.value), 6) AS {c}" for i, c in enumerate(HEADERS, 1))
    + " FROM vectors v"
    + "".join(f" LEFT JOIN filled f{i} ON f{i}.file_id = v.file_id AND f{i}.trace_id = v.trace_id AND f{i}.c = {i}" for i in range(1, len(HEADERS) + 1)),
)
def nearest_imputation_per_file(spark, sf):
    return rounded(imputation.impute_nearest(_per_file(spark, sf), HEADERS, ["file_id", "trace_id"]))


_NAN_GAPS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n FROM gappy" for c in HEADERS)


@query(
    "missing_profile_with_nan",
    f"WITH {roles.GAPPY_SQL},\ncounts AS ({_NAN_GAPS})\nSELECT column_name, missing_count, round(missing_count / n * 100, 6) AS missing_pct FROM counts WHERE missing_count > 0",
)
def missing_profile_with_nan(spark, sf):
    return rounded(quality.missing_profile(_per_file(spark, sf).select(*HEADERS)))


@query(
    "median_imputation_with_nan",
    f"""WITH {roles.GAPPY_SQL}
SELECT file_id, trace_id % 100 AS trace_id, """
    + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM gappy)), 6) AS {c}" for c in HEADERS)
    + " FROM gappy",
)
def median_imputation_with_nan(spark, sf):
    return rounded(imputation.impute_median(_per_file(spark, sf), HEADERS))


@query(
    "file_halves",
    f"""WITH {roles.TRACES_SQL}
SELECT file_id, trace_id % 100 AS trace_id, CASE WHEN row_number() OVER (ORDER BY file_id, trace_id % 100) <= (SELECT count(*) FROM traces) // 2
  THEN 'reference' ELSE 'current' END AS side FROM traces""",
)
def file_halves(spark, sf):
    return sampling.halves(_per_file(spark, sf).select("file_id", "trace_id"), ["file_id", "trace_id"])


_MOMENTS_SQL = """mu AS (SELECT {by}, count({x}) AS n, avg({x}) AS m FROM {t} GROUP BY {by}),
mom AS (SELECT t.{by}, any_value(n) AS n, avg(pow({x} - m, 2)) AS m2, avg(pow({x} - m, 3)) AS m3, avg(pow({x} - m, 4)) AS m4
  FROM {t} t JOIN mu ON t.{by} = mu.{by} GROUP BY t.{by}),
sk AS (SELECT {by}, CAST(n AS DOUBLE) AS n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM mom),
s1 AS (SELECT *, g1 * sqrt((n+1)*(n+3)/(6*(n-2))) AS y, 3*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) AS beta2 FROM sk),
s2 AS (SELECT *, sqrt(2*(beta2-1)) - 1 AS w2 FROM s1),
s3 AS (SELECT *, 1/sqrt(0.5*ln(w2)) AS delta, sqrt(2/(w2-1)) AS alpha FROM s2),
s4 AS (SELECT *, delta*ln(y/alpha + sqrt(pow(y/alpha, 2)+1)) AS z1,
  (b2 - 3*(n-1)/(n+1)) / sqrt(24*n*(n-2)*(n-3)/(pow(n+1,2)*(n+3)*(n+5))) AS x,
  6*(n*n-5*n+2)/((n+7)*(n+9))*sqrt(6*(n+3)*(n+5)/(n*(n-2)*(n-3))) AS rb FROM s3),
s5 AS (SELECT *, 6+8/rb*(2/rb+sqrt(1+4/(rb*rb))) AS a FROM s4),
s6 AS (SELECT *, (1-2/a)/(1+x*sqrt(2/(a-4))) AS u FROM s5),
k2 AS (SELECT {by}, n, g1, b2, pow(z1,2) + pow((1-2/(9*a)-sign(u)*pow(abs(u),1.0/3))/sqrt(2/(9*a)), 2) AS k FROM s6),
tests AS (SELECT {by}, 'dagostino_pearson' AS test, k AS statistic FROM k2
  UNION ALL SELECT {by}, 'jarque_bera', n/6*(g1*g1+pow(b2-3,2)/4) FROM k2)"""


@query(
    "normality_tests",
    f"""WITH {_MOMENTS_SQL.format(by='l_linenumber', x='l_extendedprice', t='lineitem')}
SELECT l_linenumber, test, round(statistic, 4) AS statistic, round(exp(-statistic/2), 6) AS p_value,
  exp(-statistic/2) > 0.05 AS is_normal FROM tests""",
)
def normality_tests(spark, sf):
    df = roles.table(spark, sf, "lineitem").select("l_linenumber", "l_extendedprice")
    out = dist.normality(df, "l_extendedprice", ["l_linenumber"])
    return out.withColumn("statistic", F.round("statistic", 4)).withColumn("p_value", F.round("p_value", 6))


@query(
    "trace_mean_normality",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL},
{_MOMENTS_SQL.format(by='class_label', x='mean_amplitude', t='features')}
SELECT class_label, test, round(statistic, 4) AS statistic, round(exp(-statistic/2), 6) AS p_value,
  exp(-statistic/2) > 0.05 AS is_normal FROM tests""",
)
def trace_mean_normality(spark, sf):
    from traceframe.functions.signal import mean

    df = roles.traces(spark, sf).select("class_label", mean(F.col("trace_data")).alias("m"))
    out = dist.normality(df, "m", ["class_label"])
    return out.withColumn("statistic", F.round("statistic", 4)).withColumn("p_value", F.round("p_value", 6))


def _sql_poly(coefficients, x):
    return "(" + " + ".join(f"{c!r} * pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"


def _sql_quantile(p):
    r, t = f"(0.180625 - pow({p} - 0.5, 2))", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    middle = f"({p} - 0.5) * {_sql_poly(sig.QUANTILE_MIDDLE[0], r)} / {_sql_poly(sig.QUANTILE_MIDDLE[1], r)}"
    tail = f"sign({p} - 0.5) * {_sql_poly(sig.QUANTILE_TAIL[0], t)} / {_sql_poly(sig.QUANTILE_TAIL[1], t)}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN {middle} ELSE {tail} END"


@query(
    "shapiro_wilk",
    f"""WITH s AS (SELECT user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY value) AS i, count(*) OVER (PARTITION BY user_id) AS n,
  min(value) OVER (PARTITION BY user_id) = max(value) OVER (PARTITION BY user_id) AS flat FROM events WHERE value IS NOT NULL),
p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM s WHERE n BETWEEN 3 AND 5000 AND NOT flat),
m AS (SELECT *, {_sql_quantile('p')} AS m FROM p),
t AS (SELECT user_id, any_value(n) AS n, sum(m * m) AS ssm, max(m) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2, avg(x) AS mean FROM m GROUP BY 1),
a AS (SELECT *, CASE WHEN n = 3 THEN sqrt(0.5) ELSE {_sql_poly(sig.ROYSTON_C1, '(1 / sqrt(n))')} + m1 / sqrt(ssm) END AS a1,
  {_sql_poly(sig.ROYSTON_C2, '(1 / sqrt(n))')} + m2 / sqrt(ssm) AS a2 FROM t),
phi AS (SELECT *, CASE WHEN n > 5 THEN (ssm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2) WHEN n > 3 THEN (ssm - 2 * m1 * m1) / (1 - 2 * a1 * a1) ELSE ssm END AS phi FROM a),
w AS (SELECT m.user_id, any_value(m.n) AS n, pow(sum((x - mean) * CASE WHEN i = m.n THEN a1 WHEN i = 1 THEN -a1 WHEN m.n > 5 AND i = m.n - 1 THEN a2 WHEN m.n > 5 AND i = 2 THEN -a2
  ELSE m / sqrt(phi) END), 2) / sum(pow(x - mean, 2)) AS w FROM m JOIN phi USING (user_id) GROUP BY 1),
every AS (SELECT user_id, count(value) AS n, CASE WHEN count(value) < 3 THEN 'fewer than 3 values' WHEN count(value) > 5000 THEN 'more than 5000 values'
  WHEN min(value) = max(value) THEN 'all values are equal' END AS reason FROM events GROUP BY 1)
SELECT user_id, round(least(1.0, w), 6) AS statistic, e.n, reason FROM every e LEFT JOIN w USING (user_id)""",
)
def shapiro_wilk(spark, sf):
    """Per user; the statistic only, p-values are held against published ones in the tests."""
    return rounded(dist.shapiro(roles.table(spark, sf, "events"), "value", ["user_id"]).select("user_id", "statistic", "n", "reason"))


@query("shapiro_wilk_p_values")
def shapiro_wilk_p_values(spark, sf):
    return rounded(dist.shapiro(roles.table(spark, sf, "events"), "value", ["user_id"]))


def _two_sides(spark, sf):
    side = F.when(F.col("inline") % 2 == 0, "a").otherwise("b")
    return roles.traces(spark, sf).withColumn("dataset", side)


_SIDES_SQL = f"""{roles.TRACES_SQL}, {roles.FEATURES_SQL},
sides AS (SELECT *, CASE WHEN (trace_id // 25) % 2 = 0 THEN 'a' ELSE 'b' END AS dataset FROM features),
cls AS (SELECT dataset, class_label, count(*) AS n FROM sides GROUP BY 1, 2),
tot AS (SELECT dataset, sum(n) AS t FROM cls GROUP BY 1),
long AS (
  SELECT dataset, 'mean_of_means' AS statistic, avg(mean_amplitude) AS v FROM sides GROUP BY 1
  UNION ALL SELECT dataset, 'mean_of_stds', avg(std_amplitude) FROM sides GROUP BY 1
  UNION ALL SELECT cls.dataset, 'balance_score', -sum(n/t*log2(n/t))/log2(count(*)) FROM cls JOIN tot ON cls.dataset = tot.dataset GROUP BY 1
  UNION ALL SELECT cls.dataset, 'class_pct_' || class_label, round(n / t * 100, 2) FROM cls JOIN tot ON cls.dataset = tot.dataset),
cmp AS (SELECT statistic, coalesce(max(v) FILTER (WHERE dataset = 'a'), 0) AS a, coalesce(max(v) FILTER (WHERE dataset = 'b'), 0) AS b
  FROM long GROUP BY statistic)"""


@query(
    "dataset_comparison",
    f"""WITH {_SIDES_SQL}
SELECT statistic, round(a, 6) AS base_value, round(b, 6) AS other_value, round(b - a, 6) AS difference,
  round(CASE WHEN a <> 0 THEN (b - a) / abs(a) * 100 ELSE 0 END, 4) AS relative_diff_pct FROM cmp""",
)
def dataset_comparison(spark, sf):
    out = dist.compare_datasets(_two_sides(spark, sf))
    return rounded(out.withColumn("relative_diff_pct", F.round("relative_diff_pct", 4)))


@query(
    "similarity_verdict",
    f"""WITH {_SIDES_SQL},
{_MOMENTS_SQL.format(by='dataset', x='mean_amplitude', t='sides')},
agree AS (SELECT min(same) AS same FROM (SELECT test,
  max(exp(-statistic/2) > 0.05) FILTER (WHERE dataset = 'a') = max(exp(-statistic/2) > 0.05) FILTER (WHERE dataset = 'b') AS same
  FROM tests GROUP BY test)),
p AS (SELECT max(abs((b-a)/abs(a)*100)) FILTER (WHERE statistic = 'mean_of_means') AS m,
  max(abs((b-a)/abs(a)*100)) FILTER (WHERE statistic = 'mean_of_stds') AS s,
  max(abs(b-a)) FILTER (WHERE statistic = 'balance_score') AS d, max(b) FILTER (WHERE statistic = 'balance_score') AS score FROM cmp)
SELECT CASE WHEN m < 5 AND s < 5 AND d < 0.1 THEN 'high' WHEN m < 10 AND s < 10 AND d < 0.2 THEN 'moderate' ELSE 'low' END AS similarity,
  same AS normality_agreement,
  CASE WHEN d < 0.05 THEN 'very similar' WHEN d < 0.1 THEN 'similar' ELSE 'noticeable differences' END AS class_balance,
  CASE WHEN m < 10 THEN 'representative' ELSE 'adjust sampling' END AS recommendation_1,
  CASE WHEN same THEN 'similar distributions' ELSE 'preprocess differently' END AS recommendation_2,
  CASE WHEN score > 0.8 THEN 'well balanced' ELSE 'balance classes' END AS recommendation_3,
  CASE WHEN m < 10 AND d < 0.1 THEN 'suitable for training' ELSE 'review sampling' END AS recommendation_4 FROM p, agree""",
)
def similarity_verdict(spark, sf):
    from traceframe.functions.signal import mean

    rows = _two_sides(spark, sf)
    norm = dist.normality(rows.select("dataset", mean(F.col("trace_data")).alias("m")), "m", ["dataset"])
    return dist.verdicts(dist.compare_datasets(rows), norm, "dataset", "a", "b")


@query(
    "price_severity",
    """WITH g AS (SELECT l_suppkey, avg(CAST(l_discount > 0.08 AS INT)) AS ratio FROM lineitem GROUP BY 1)
SELECT l_suppkey, round(ratio, 6) AS ratio,
  CASE WHEN ratio = 0 THEN 'none' WHEN ratio < 0.1 THEN 'low' WHEN ratio < 0.3 THEN 'medium' ELSE 'high' END AS lower_edge,
  CASE WHEN ratio > 0.3 THEN 'high' WHEN ratio > 0.1 THEN 'medium' WHEN ratio > 0 THEN 'low' ELSE 'none' END AS upper_edge FROM g""",
)
def price_severity(spark, sf):
    g = roles.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg((F.col("l_discount") > 0.08).cast("int")).alias("ratio"))
    return rounded(
        g.select(
            "l_suppkey",
            "ratio",
            rules.drift_severity(F.col("ratio"), "lower").alias("lower_edge"),
            rules.drift_severity(F.col("ratio"), "upper").alias("upper_edge"),
        )
    )


def _hash(seed, key):
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


@query(
    "random_sample",
    f"""SELECT sample_id, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_hash('42', 'o_orderkey')}, o_orderkey) - 1
  AS sample_id FROM orders) WHERE sample_id < 500""",
)
def random_sample(spark, sf):
    df = roles.table(spark, sf, "orders").select("o_orderkey")
    return sampling.sample_rows(df, 500, ["o_orderkey"]).select("sample_id", "o_orderkey")


@query("first_rows", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 50")
def first_rows(spark, sf):
    return sampling.first_rows(roles.table(spark, sf, "events").select("event_id", "value"), 50, ["event_id"])


@query(
    "row_order_halves",
    """WITH r AS (SELECT event_type, row_number() OVER (ORDER BY event_id) AS r, count(*) OVER () AS n FROM events)
SELECT event_type, CASE WHEN r <= n // 2 THEN 'reference' ELSE 'current' END AS side, count(*) AS n FROM r GROUP BY 1, 2""",
)
def row_order_halves(spark, sf):
    df = sampling.halves(roles.table(spark, sf, "events").select("event_id", "event_type"), "event_id")
    return df.groupBy("event_type", "side").agg(F.count(F.lit(1)).alias("n"))


_RANK = "row_number() OVER (PARTITION BY label ORDER BY {h}, vec_id)"


@query(
    "stratified_split",
    f"""WITH r AS (SELECT vec_id, label, {_RANK.format(h=_hash('42', 'vec_id'))} AS r, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
s AS (SELECT *, round(n * 0.2) AS t, round((n - round(n * 0.2)) * 0.2) AS v FROM r)
SELECT vec_id, label, CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'validation' ELSE 'train' END AS split FROM s""",
)
def stratified_split(spark, sf):
    df = roles.table(spark, sf, "embeddings").select("vec_id", "label")
    return sampling.stratified_split(df, "label", ["vec_id"])


@query(
    "stratified_folds",
    f"""WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_hash('7', 'event_id')}, event_id) AS r FROM events)
SELECT event_id, event_type, CAST((r - 1) % 5 AS INT) AS fold FROM r""",
)
def stratified_folds(spark, sf):
    df = roles.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.stratified_folds(df, "event_type", ["event_id"], seed="7")


@query(
    "class_weights",
    """SELECT event_type, count(*) AS n, round((SELECT count(*) FROM events) / ((SELECT count(DISTINCT event_type) FROM events) * count(*)), 6)
  AS weight FROM events GROUP BY 1""",
)
def class_weights(spark, sf):
    return rounded(sampling.class_weights(roles.table(spark, sf, "events"), "event_type"))


@query(
    "file_numbers",
    """WITH r AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS file_no FROM events)
SELECT file_no, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM r GROUP BY 1""",
)
def file_numbers(spark, sf):
    df = sampling.number_files(roles.table(spark, sf, "events").select("event_id"), "event_id")
    return df.groupBy("file_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "dataset_metadata",
    f"""WITH {roles.TRACES_SQL}, r AS (SELECT class_label, (row_number() OVER (ORDER BY trace_id) - 1) // 100 AS file_no FROM traces)
SELECT file_no, count(*) AS num_traces, count(*) FILTER (WHERE class_label = 0) AS normal,
  count(*) FILTER (WHERE class_label = 1) AS anomaly, count(*) FILTER (WHERE class_label = 2) AS boundary FROM r GROUP BY 1""",
)
def dataset_metadata(spark, sf):
    df = roles.traces(spark, sf).select("trace_id", "class_label")
    return sampling.dataset_metadata(sampling.number_files(df, "trace_id"))


