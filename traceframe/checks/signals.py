from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions import signal
from traceframe.functions.hashing import three_way_label, uniform
from traceframe.functions.labels import class_name, confidence, first_maximum
from traceframe.functions.text import file_id
from traceframe.operators import features as ft, quality, synthetic
from traceframe.plans.ranking import unpivot
from traceframe.schemas import HANDCRAFTED
from traceframe.sources import roles

BASIC = [c for c in HANDCRAFTED if c != "dominant_frequency"]


@query(
    "class_signal_profile",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT class_label, count(*) AS num_traces, round(avg(rms_amplitude), 6) AS mean_rms,
  round(avg(energy), 6) AS mean_energy, round(avg(zero_crossings), 6) AS mean_crossings
FROM features GROUP BY class_label""",
)
def class_signal_profile(spark, sf):
    xs = F.col("trace_data")
    rows = roles.traces(spark, sf).select(
        "class_label", signal.rms(xs).alias("r"), signal.energy(xs).alias("e"), signal.zero_crossings(xs).alias("z")
    )
    return rounded(
        rows.groupBy("class_label").agg(
            F.count(F.lit(1)).alias("num_traces"),
            F.avg("r").alias("mean_rms"),
            F.avg("e").alias("mean_energy"),
            F.avg("z").alias("mean_crossings"),
        )
    )


@query(
    "trace_features",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT file_id, trace_id, class_label, {", ".join(f"round({c}, 6) AS {c}" for c in BASIC)} FROM features""",
)
def trace_features(spark, sf):
    return rounded(ft.extract(roles.traces(spark, sf)).drop("dominant_frequency"))


FREQUENCY_SQL = f"""WITH {roles.TRACES_SQL},
samples AS (SELECT trace_id, sample_rate, num_samples AS n, unnest(range(num_samples)) AS t, unnest(trace_data) AS x FROM traces),
bins AS (SELECT DISTINCT n, unnest(range(1, n // 2)) AS k FROM (SELECT DISTINCT num_samples AS n FROM traces)),
power AS (
  SELECT trace_id, sample_rate, s.n, k,
    pow(sum(x * cos(2 * pi() * k * t / s.n)), 2) + pow(sum(x * sin(2 * pi() * k * t / s.n)), 2) AS p
  FROM samples s JOIN bins b ON s.n = b.n GROUP BY trace_id, sample_rate, s.n, k),
best AS (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY round(p, 6) DESC, k) AS r FROM power)
SELECT trace_id, round(k / n, 6) AS dominant_frequency, round(k / n / sample_rate, 4) AS dominant_frequency_hz
FROM best WHERE r = 1"""


@query("dominant_frequency", FREQUENCY_SQL)
def dominant_frequency(spark, sf):
    df = roles.traces(spark, sf).withColumn("dominant_frequency", signal.dominant_frequency("trace_data"))
    return ft.with_frequency_hz(df).select(
        "trace_id",
        F.round("dominant_frequency", 6).alias("dominant_frequency"),
        F.round("dominant_frequency_hz", 4).alias("dominant_frequency_hz"),
    )


@query("dominant_frequency_native", FREQUENCY_SQL)
def dominant_frequency_native(spark, sf):
    df = roles.traces(spark, sf).withColumn("dominant_frequency", signal.dominant_frequency_native(F.col("trace_data")))
    return ft.with_frequency_hz(df).select(
        "trace_id",
        F.round("dominant_frequency", 6).alias("dominant_frequency"),
        F.round("dominant_frequency_hz", 4).alias("dominant_frequency_hz"),
    )


@query(
    "fit_trace_length",
    f"""WITH {roles.TRACES_SQL},
shapes AS (SELECT trace_id, list_concat(trace_data, list_transform(range(80), lambda i: CAST(0 AS DOUBLE)))[1:80] AS padded,
  trace_data[1:40] AS cut FROM traces)
SELECT trace_id, CAST(len(padded) AS BIGINT) AS padded_length, CAST(len(cut) AS BIGINT) AS cut_length,
  round(list_sum(padded), 6) AS padded_sum, round(list_sum(cut), 6) AS cut_sum FROM shapes""",
)
def fit_trace_length(spark, sf):
    xs = F.col("trace_data")
    rows = roles.traces(spark, sf).select(
        "trace_id", signal.fit_length(xs, 80).alias("padded"), signal.fit_length(xs, 40).alias("cut")
    )
    return rounded(
        rows.select(
            "trace_id",
            F.size("padded").cast("long").alias("padded_length"),
            F.size("cut").cast("long").alias("cut_length"),
            signal.total(F.col("padded")).alias("padded_sum"),
            signal.total(F.col("cut")).alias("cut_sum"),
        )
    )


@query(
    "vector_normalise",
    f"""WITH {roles.TRACES_SQL},
norms AS (SELECT trace_id, trace_data, sqrt(list_sum(list_transform(trace_data, lambda x: x * x))) AS size FROM traces)
SELECT trace_id, round(list_sum(list_transform(trace_data, lambda x: x / size)), 6) AS unit_sum,
  round(trace_data[1] / size, 6) AS unit_first FROM norms""",
)
def vector_normalise(spark, sf):
    unit = roles.traces(spark, sf).select("trace_id", signal.l2_normalise(F.col("trace_data")).alias("u"))
    return rounded(
        unit.select("trace_id", signal.total(F.col("u")).alias("unit_sum"), F.element_at("u", 1).alias("unit_first"))
    )


@query(
    "argmax_class",
    f"""WITH {roles.PREDICTIONS_SQL}
SELECT trace_id, predicted_label,
  CASE predicted_label WHEN 0 THEN 'Normal' WHEN 1 THEN 'Anomaly' ELSE 'Boundary' END AS predicted_class,
  round(greatest(prob_normal, prob_anomaly, prob_boundary), 6) AS confidence FROM predictions""",
)
def argmax_class(spark, sf):
    df = roles.predictions(spark, sf)
    best = first_maximum(F.col("scores"))
    return rounded(
        df.select(
            "trace_id",
            best.alias("predicted_label"),
            class_name(best).alias("predicted_class"),
            confidence(F.col("scores")).alias("confidence"),
        )
    )


@query(
    "hash_labels",
    f"""SELECT doc_id, round({roles.sql_uniform('42', 'doc_id')}, 9) AS draw,
  CAST(CASE WHEN {roles.sql_uniform('42', 'doc_id')} < 0.5 THEN 0
    WHEN {roles.sql_uniform('42', 'doc_id')} < 0.8 THEN 1 ELSE 2 END AS BIGINT) AS class_label
FROM documents""",
)
def hash_labels(spark, sf):
    return roles.table(spark, sf, "documents").select(
        "doc_id", F.round(uniform("42", "doc_id"), 9).alias("draw"), three_way_label("42", "doc_id").alias("class_label")
    )


@query(
    "file_id_from_path",
    """SELECT page_id, list_extract(string_split(regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1), '_'), -1) AS file_id
FROM pages""",
)
def file_id_from_path(spark, sf):
    return roles.table(spark, sf, "pages").select("page_id", file_id(F.col("url")).alias("file_id"))


SCALED_SQL = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM features)) / (SELECT stddev_pop({c}) FROM features), 6) AS {c}_scaled" for c in BASIC
)


@query("standardised_features", f"WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}\nSELECT trace_id, {SCALED_SQL} FROM features")
def standardised_features(spark, sf):
    df = signal.handcrafted(roles.traces(spark, sf)).select("trace_id", *BASIC)
    return rounded(ft.standardise(df, BASIC).select("trace_id", *[f"{c}_scaled" for c in BASIC]))


@query(
    "standardised_columns",
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
  stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(avg((l_quantity - mq) / sq), 6) AS quantity_scaled,
  round(avg((l_extendedprice - mp) / sp), 6) AS price_scaled FROM lineitem, s GROUP BY l_returnflag""",
)
def standardised_columns(spark, sf):
    df = roles.table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    scaled = ft.standardise(df, ["l_quantity", "l_extendedprice"])
    return rounded(
        scaled.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("l_quantity_scaled").alias("quantity_scaled"),
            F.avg("l_extendedprice_scaled").alias("price_scaled"),
        )
    )


@query(
    "standardised_positions",
    f"""WITH {roles.TRACES_SQL},
long AS (SELECT trace_id, unnest(range(num_samples)) AS pos, unnest(trace_data) AS x FROM traces),
z AS (SELECT trace_id, pos, (x - avg(x) OVER (PARTITION BY pos)) / stddev_pop(x) OVER (PARTITION BY pos) AS z FROM long)
SELECT trace_id, round(sum(z), 5) AS z_sum, round(sum(z * z), 5) AS z_energy FROM z GROUP BY trace_id""",
)
def standardised_positions(spark, sf):
    df = ft.standardise_positions(roles.traces(spark, sf), ["trace_id"])
    z = F.col("standardised")
    return rounded(df.select("trace_id", signal.total(z).alias("z_sum"), signal.energy(z).alias("z_energy")), 5)


@query("pca_embedding")
def pca_embedding(spark, sf):
    traces = roles.traces(spark, sf)
    model = ft.TraceEmbedder.fit(traces, k=32, length=64)
    coded = model.encode(traces).select("file_id", "trace_id", "embedding")
    return rounded(ft.spread_embedding(coded), 4)


@query("pca_report")
def pca_report(spark, sf):
    traces = roles.traces(spark, sf)
    return rounded(ft.TraceEmbedder.fit(traces, k=32, length=64).report(traces))


@query("silver_table")
def silver_table(spark, sf):
    table, _, _ = ft.silver(roles.traces(spark, sf))
    return rounded(table.select("trace_id", *ft.feature_columns(table.columns)), 4)


@query(
    "feature_summary",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
"""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM features"
        for c in BASIC
    ),
)
def feature_summary(spark, sf):
    return rounded(quality.column_summary(ft.extract(roles.traces(spark, sf)), BASIC))



@query(
    "feature_column_set",
    """SELECT CAST(unnest(embedding) AS DOUBLE) AS value, unnest(list_transform(range(64), lambda i: 'embedding_' || i)) AS feature,
  vec_id AS trace_id FROM embeddings""",
)
def feature_column_set(spark, sf):
    """Scoring fallback: with no scaled columns, all embedding-like ones."""
    wide = ft.spread_embedding(
        roles.traces(spark, sf).select("trace_id", F.col("trace_data").alias("embedding")), dim=64
    )
    columns = ft.scoring_columns(wide.columns)
    return unpivot(wide, ["trace_id"], columns, "feature", "value")


@query(
    "feature_source",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT trace_id, file_id, '2024-01-31 00:00:00' AS event_time, class_label,
  {", ".join(f"round({c}, 6) AS {c}" for c in BASIC)} FROM features""",
)
def feature_source(spark, sf):
    table = ft.feature_source(ft.extract(roles.traces(spark, sf)), F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")))
    return rounded(
        table.select(
            "trace_id",
            "file_id",
            F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
            "class_label",
            *BASIC,
        )
    )


SYNTHETIC = [c for c in HANDCRAFTED if c != "dominant_frequency"]
_FREQ = "CASE c WHEN 0 THEN {} WHEN 1 THEN {} ELSE {} END"


def _by_class(at: int) -> str:
    return _FREQ.format(*[synthetic.SHAPES[c][at] for c in (0, 1, 2)])


def _u(seed: str, *keys: str) -> str:
    return roles.sql_uniform(f"42-{seed}", " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys))


@query(
    "synthetic_traces",
    f"""WITH keys AS (SELECT vec_id AS k, CASE WHEN {roles.sql_uniform('42', 'vec_id')} < 0.5 THEN 0
    WHEN {roles.sql_uniform('42', 'vec_id')} < 0.8 THEN 1 ELSE 2 END AS c FROM embeddings),
par AS (SELECT k, c, ({_by_class(0)}) + ({_by_class(1)}) * ({_u('freq', 'k')} * 2 - 1) AS f,
  ({_by_class(2)}) + ({_by_class(3)}) * ({_u('amp', 'k')} * 2 - 1) AS a, {_by_class(4)} AS sd,
  35.0 + 5.0 * ({_u('second', 'k')} * 2 - 1) AS f2,
  list_transform(range(1, 6), lambda j: CAST(floor({_u('spike', 'k', 'j')} * 500) AS BIGINT)) AS spikes FROM keys),
pts AS (SELECT *, unnest(range(500)) AS i FROM par),
vals AS (SELECT k, c, i, a * sin(2 * pi() * CASE WHEN c = 2 AND i >= 250 THEN f2 ELSE f END * i * (500 * 0.002 / 499))
  + CASE WHEN c = 1 AND list_contains(spikes, i) THEN 500.0 + 500.0 * {_u('lift', 'k', 'i')} ELSE 0 END
  + sd * sqrt(-2 * ln(greatest({_u('noise-u', 'k', 'i')}, 1e-12))) * cos(2 * pi() * {_u('noise-v', 'k', 'i')}) AS x FROM pts),
marked AS (SELECT *, (x < 0) <> lag(x < 0) OVER (PARTITION BY k ORDER BY i) AS crossed FROM vals)
SELECT format('{{:03d}}', k // 100) AS file_id, k AS trace_id, CAST(any_value(c) AS BIGINT) AS class_label,
  round(avg(x), 2) AS mean_amplitude, round(stddev_pop(x), 2) AS std_amplitude, round(min(x), 2) AS min_amplitude,
  round(max(x), 2) AS max_amplitude, round(sqrt(avg(x * x)), 2) AS rms_amplitude, round(sum(x * x), 0) AS energy,
  CAST(count(*) FILTER (WHERE crossed) AS DOUBLE) AS zero_crossings FROM marked GROUP BY k""",
)
def synthetic_traces(spark, sf):
    keys = roles.traces(spark, sf).select("file_id", "trace_id", three_way_label("42", "trace_id").alias("class_label"))
    made = synthetic.synthesize(keys, "trace_id", "class_label", samples=500)
    out = ft.extract(made).select("file_id", "trace_id", "class_label", *SYNTHETIC)
    return rounded(out.withColumn("energy", F.round("energy", 0)), 2)
