from datetime import timedelta

from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions.signal import rms, mean
from traceframe.operators import featureviews as fv
from traceframe.session import shared_folder
from traceframe.sources import roles

DAY, YEAR = timedelta(days=1), timedelta(days=365)

_LATEST_EVENTS_SQL = """ev AS (SELECT user_id, ts, arg_max(value, event_id) AS value, arg_max(event_type, event_id) AS event_type
  FROM events GROUP BY user_id, ts)"""


def _as_of_sql(days: int) -> str:
    return f"""WITH {roles.SPINE_SQL}, {_LATEST_EVENTS_SQL}
SELECT s.event_id, s.user_id, CASE WHEN e.ts >= s.ts - INTERVAL {days} DAY THEN e.value END AS value,
  CASE WHEN e.ts >= s.ts - INTERVAL {days} DAY THEN e.event_type END AS event_type,
  CASE WHEN e.ts >= s.ts - INTERVAL {days} DAY THEN epoch_us(e.ts) END AS feature_micros
FROM spine s ASOF LEFT JOIN ev e ON s.user_id = e.user_id AND s.ts >= e.ts"""


def _as_of(spark, sf, ttl, **options):
    out = fv.as_of_join(
        roles.spine(spark, sf), roles.feature_events(spark, sf), ["user_id"], "ts", ["value", "event_type"], ttl,
        tie_break="event_id", **options,
    )
    return out.select("event_id", "user_id", "value", "event_type", F.unix_micros("feature_time").alias("feature_micros"))


@query("as_of_features_day", _as_of_sql(1))
def as_of_features_day(spark, sf):
    return _as_of(spark, sf, DAY)


@query("as_of_features_year", _as_of_sql(365))
def as_of_features_year(spark, sf):
    return _as_of(spark, sf, YEAR)


@query("as_of_features_hot_keys", _as_of_sql(1))
def as_of_features_hot_keys(spark, sf):
    """The same answer with keys above 40 rows cut into time buckets."""
    return _as_of(spark, sf, DAY, hot_rows=40, buckets=8)


def _online(spark, sf):
    view = fv.FeatureView(
        "event_values", roles.feature_events(spark, sf), ["user_id"], ["value", "event_type"], "ts", YEAR, "event_id"
    )
    return fv.materialise(view, F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00")))


_ONLINE_SQL = """online AS (SELECT user_id, arg_max(value, {'t': ts, 'e': event_id}) AS value,
  arg_max(event_type, {'t': ts, 'e': event_id}) AS event_type, max(ts) AS ts FROM events
  WHERE ts <= TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-20' - INTERVAL 365 DAY GROUP BY user_id)"""


@query(
    "materialised_features",
    f"WITH {_ONLINE_SQL}\nSELECT user_id, value, event_type, epoch_us(ts) AS event_micros FROM online",
)
def materialised_features(spark, sf):
    return _online(spark, sf).select(
        "user_id", "value", "event_type", F.unix_micros(F.col("event_timestamp").cast("timestamp")).alias("event_micros")
    )


@query(
    "online_lookup",
    f"WITH {_ONLINE_SQL}\nSELECT c.c_custkey AS user_id, o.value, o.event_type FROM customer c LEFT JOIN online o ON o.user_id = c.c_custkey",
)
def online_lookup(spark, sf):
    entities = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return fv.online_features(entities, _online(spark, sf), ["user_id"], ["value", "event_type"])


@query(
    "online_merges",
    f"WITH {_ONLINE_SQL}\nSELECT c.c_custkey AS user_id, o.value, o.event_type FROM customer c LEFT JOIN online o ON o.user_id = c.c_custkey",
)
def online_merges(spark, sf):
    """The same lookup in a bucketed table into which three windows were merged, one of them twice."""
    rows = roles.feature_events(spark, sf)
    view = fv.FeatureView("event_values", rows, ["user_id"], ["value", "event_type"], "ts", YEAR, "event_id")
    day = lambda text: F.to_timestamp_ntz(F.lit(f"{text} 00:00:00"))
    online = fv.OnlineTable(spark, shared_folder(spark, "online"), ["user_id"], buckets=8)
    for start, end in (("2024-01-05", "2024-01-12"), ("2023-01-20", "2024-01-05"), ("2024-01-12", "2024-01-20"), ("2024-01-05", "2024-01-12")):
        online.merge(fv.materialise(view, day(end), day(start)))
    entities = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return online.lookup(entities, ["value", "event_type"])


@query(
    "multi_view_features",
    f"""WITH {roles.SPINE_SQL}, {_LATEST_EVENTS_SQL},
buys AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts),
a AS (SELECT s.*, CASE WHEN e.ts >= s.ts - INTERVAL 365 DAY THEN e.event_type END AS event_type
  FROM spine s ASOF LEFT JOIN ev e ON s.user_id = e.user_id AND s.ts >= e.ts)
SELECT a.event_id, a.event_type, CASE WHEN b.ts >= a.ts - INTERVAL 1 DAY THEN b.value END AS last_purchase
FROM a ASOF LEFT JOIN buys b ON a.user_id = b.user_id AND a.ts >= b.ts""",
)
def multi_view_features(spark, sf):
    events = roles.feature_events(spark, sf)
    buys = events.filter(F.col("event_type") == "purchase").withColumnRenamed("value", "last_purchase")
    views = [
        fv.FeatureView("activity", events, ["user_id"], ["value", "event_type"], "ts", YEAR, "event_id"),
        fv.FeatureView("purchases", buys, ["user_id"], ["last_purchase"], "ts", DAY, "event_id"),
    ]
    out = fv.historical_features(roles.spine(spark, sf), views, ["activity:event_type", "purchases:last_purchase"], "ts")
    return out.select("event_id", "event_type", "last_purchase")


@query(
    "year_window",
    """SELECT o_orderkey FROM orders WHERE o_orderdate <= (SELECT max(o_orderdate) FROM orders)
  AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY""",
)
def year_window(spark, sf):
    df = roles.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    end = df.agg(F.max("o_orderdate")).scalar()
    return fv.in_window(df, "o_orderdate", end).select("o_orderkey")


@query(
    "training_set",
    f"""WITH {roles.TRACES_SQL}, {roles.FEATURES_SQL}
SELECT round(mean_amplitude, 6) AS mean_amplitude, round(rms_amplitude, 6) AS rms_amplitude, class_label FROM features""",
)
def training_set(spark, sf):
    xs = F.col("trace_data")
    feats = roles.traces(spark, sf).select(
        "file_id", "trace_id", "class_label", mean(xs).alias("mean_amplitude"), rms(xs).alias("rms_amplitude")
    )
    source = feats.withColumn("event_timestamp", F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")))
    return rounded(fv.training_set(source))


