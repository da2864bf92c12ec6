"""Point-in-time retrieval from feature tables."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from traceframe.plans.ranking import bucket_count, quantile_cuts, with_bucket

# Rows of one key that are still ordered in one task.
HOT_ROWS = 2_000_000
# Hot keys that may be sent to all tasks.
SENT_KEYS = 1000


@dataclass
class FeatureView:
    """A named group of feature columns with entity key, event time and lifetime."""

    name: str
    source: DataFrame
    keys: list[str]
    fields: list[str]
    event_time: str = "event_timestamp"
    ttl: timedelta = timedelta(days=365)
    tie_break: str | None = None
    tags: dict[str, str] = field(default_factory=dict)


def _micros(c: Column) -> Column:
    """Event time as microseconds, for time stamps with and without zone."""
    return F.unix_micros(c.cast("timestamp"))


def as_of_join(
    spine: DataFrame,
    features: DataFrame,
    keys: list[str],
    time: str,
    fields: list[str],
    ttl: timedelta,
    feature_time: str | None = None,
    tie_break: str | None = None,
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Latest feature row at or before each spine row and no older than ``ttl``.

    Spine rows without a match get nulls; their count never changes. See
    :func:`as_of_answers` for how skewed keys are handled.
    """
    answers = as_of_answers(
        spine, features, keys, time, fields, ttl, feature_time, tie_break, hot_rows, buckets
    )
    out = spine.withColumn("_t", _micros(F.col(time))).join(answers, [*keys, "_t"], "left")
    return out.select(*spine.columns, "feature_time", *fields)


def _hot_key_cuts(times: DataFrame, keys: list[str], hot_rows: int, buckets: int) -> DataFrame | None:
    """Time cut points of every key with more than ``hot_rows`` rows; None if there is no such key.

    The keys are counted on the raw rows first, combined on the map side. A short
    list of hot keys is sent to all tasks; a list beyond ``SENT_KEYS`` is joined
    the ordinary way. A key gets about one cut per ``hot_rows`` rows.
    """
    hot = times.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    found = hot.limit(SENT_KEYS + 1).collect()
    if not found:
        return None
    few = len(found) <= SENT_KEYS
    sizes = F.broadcast(times.sparkSession.createDataFrame(found, hot.schema)) if few else hot
    step = F.greatest(F.lit(1), F.floor(F.lit(float(buckets) * hot_rows) / F.col("_n")).cast("int"))
    cuts = (
        times.join(sizes, keys)
        .groupBy(*keys)
        .agg(quantile_cuts(F.col("_t"), buckets).alias("_all"), F.max("_n").alias("_n"))
        .withColumn("_step", step)
        .select(*keys, F.filter("_all", lambda _, i: i % F.col("_step") == 0).alias("_cuts"))
    )
    return F.broadcast(cuts) if few else cuts


def as_of_answers(
    spine: DataFrame,
    features: DataFrame,
    keys: list[str],
    time: str,
    fields: list[str],
    ttl: timedelta,
    feature_time: str | None = None,
    tie_break: str | None = None,
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """The answer for every distinct (key, time) a spine asks for.

    Both sides are stacked and walked once in time order. Features are first
    reduced to one row per key and time, and spine rows to distinct points, so
    copies never pile up. A key with more than ``hot_rows`` rows is cut into
    time buckets; the last feature of earlier buckets is carried over.
    """
    feature_time = feature_time or time
    buckets = buckets or bucket_count(spine)
    value = F.struct(*[F.col(f) for f in fields])
    # A null key matches nothing, so its rows need not be walked; the join back gives them nulls.
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spine, features = spine.filter(known), features.filter(known)
    order = [F.col(feature_time)] + ([F.col(tie_break)] if tie_break else [])
    latest = (
        features.filter(F.col(feature_time).isNotNull())
        .groupBy(*keys, _micros(F.col(feature_time)).alias("_t"))
        .agg(F.max_by(value, F.struct(*order)).alias("_f"))
    )
    points = spine.select(*keys, _micros(F.col(time)).alias("_t")).distinct()
    stacked = latest.select(*keys, "_t", "_f", F.lit(0).alias("_point")).unionByName(
        points.select(*keys, "_t", F.lit(None).cast(latest.schema["_f"].dataType).alias("_f"), F.lit(1).alias("_point"))
    )

    times = features.select(*keys, _micros(F.col(feature_time)).alias("_t")).unionByName(
        spine.select(*keys, _micros(F.col(time)).alias("_t"))
    )
    cuts = _hot_key_cuts(times, keys, hot_rows, buckets)
    if cuts is None:
        tagged = stacked.withColumn("_b", F.lit(0))
    else:
        tagged = with_bucket(stacked.join(cuts, keys, "left"), F.col("_cuts"), F.col("_t"), buckets)
    stamped = F.when(F.col("_f").isNotNull(), F.struct(F.col("_t").alias("at"), F.col("_f").alias("f")))
    walk = (
        Window.partitionBy(*keys, "_b").orderBy("_t", "_point").rowsBetween(Window.unboundedPreceding, 0)
    )
    walked = tagged.withColumn("_last", F.last(stamped, ignorenulls=True).over(walk))

    answered = walked.filter(F.col("_point") == 1)
    if cuts is None:
        answered = answered.withColumn("_hit", F.col("_last"))
    else:
        # One row per hot key and bucket.
        carried = (
            tagged.filter(F.col("_cuts").isNotNull())
            .groupBy(*keys, "_b")
            .agg(F.max_by(stamped, stamped["at"]).alias("_s"))
            .withColumn(
                "_carry",
                F.last("_s", ignorenulls=True).over(
                    Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
                ),
            )
            .select(*keys, "_b", "_carry")
        )
        answered = answered.join(carried, [*keys, "_b"], "left").withColumn("_hit", F.coalesce("_last", "_carry"))
    age = F.col("_t") - F.col("_hit")["at"]
    fresh = age <= int(ttl.total_seconds() * 1_000_000)
    return answered.select(
        *keys,
        "_t",
        F.when(fresh, F.timestamp_micros(F.col("_hit")["at"])).alias("feature_time"),
        *[F.when(fresh, F.col("_hit")["f"][f]).alias(f) for f in fields],
    )


def historical_features(spine: DataFrame, views: list[FeatureView], refs: list[str], time: str) -> DataFrame:
    """Several ``view:field`` references for one spine, one as-of search per view.

    Every view is searched for the points of the spine itself and joined to it
    by key and time, so the spine is not computed anew on top of each join.
    """
    by_name = {v.name: v for v in views}
    wanted: dict[str, list[str]] = {}
    for ref in refs:
        view, _, column = ref.partition(":")
        if view not in by_name or column not in by_name[view].fields:
            raise ValueError(f"unknown feature reference {ref}")
        wanted.setdefault(view, []).append(column)
    out = spine.withColumn("_t", _micros(F.col(time)))
    for name, fields in wanted.items():
        v = by_name[name]
        answers = as_of_answers(
            spine, v.source, v.keys, time, fields, v.ttl, feature_time=v.event_time, tie_break=v.tie_break
        )
        out = out.join(answers.drop("feature_time"), [*v.keys, "_t"], "left")
    return out.select(*spine.columns, *[f for fields in wanted.values() for f in fields])


def in_window(df: DataFrame, time: str, end: Column, days: int = 365, start: Column | None = None) -> DataFrame:
    """Rows between ``start`` (default: ``days`` before ``end``) and ``end``."""
    low = start if start is not None else end - F.make_interval(days=F.lit(days))
    return df.filter((F.col(time) >= low) & (F.col(time) <= end))


def latest_features(df: DataFrame, keys: list[str], time: str, fields: list[str], tie_break: str | None = None) -> DataFrame:
    """Latest row per entity: one aggregate with map-side reduction."""
    order = F.struct(F.col(time), *([F.col(tie_break)] if tie_break else []))
    row = F.struct(F.col(time).alias("event_timestamp"), *[F.col(f) for f in fields])
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_r")).select(*keys, "_r.*")


def materialise(view: FeatureView, end: Column, start: Column | None = None) -> DataFrame:
    """The online table of a view: latest row per entity inside a time window."""
    rows = in_window(view.source, view.event_time, end, view.ttl.days, start)
    return latest_features(rows, view.keys, view.event_time, view.fields, view.tie_break)


def save_online(df: DataFrame, path: str, keys: list[str], files: int = 64) -> None:
    """Write an online table clustered by key, so that a lookup touches few files."""
    df.repartition(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


class OnlineTable:
    """The latest features per entity, stored in buckets of the key, a new version with every merge.

    A merge joins the rows of a new window to the last version bucket by bucket, and a lookup joins
    the wanted keys to it: only the window and the keys are dealt out, the stored side is
    read where its rows already lie together. A version counts once it is written whole, so a merge
    that is cut short leaves the last one as it is.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int = 64, time: str = "event_timestamp"):
        self.spark, self.folder, self.keys, self.buckets, self.time = spark, folder.rstrip("/"), keys, buckets, time

    def version(self) -> int:
        """Number of the last whole version, 0 if there is none."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        whole = [n for n in names if n.startswith("version-") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))]
        return max((int(n.split("-")[1]) for n in whole), default=0)

    def _path(self, version: int) -> str:
        return f"{self.folder}/version-{version}"

    def read(self, version: int | None = None) -> DataFrame:
        """A version as a bucketed table of this session, the last one by default."""
        version = version or self.version()
        if not version:
            raise ValueError(f"no version at {self.folder}")
        name = f"online_{hashlib.md5(self._path(version).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self._path(version)).schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self._path(version)}'")
        return self.spark.table(name)

    def merge(self, window: DataFrame) -> int:
        """Take in rows of a new window, one per entity; of two rows the later stays. Returns the new version."""
        last = self.version()
        out = window.repartition(self.buckets, *self.keys)
        if last:
            old = self.read(last)
            row = F.struct(*[c for c in old.columns if c not in self.keys])
            both = window.select(*self.keys, row.alias("_new")).join(old.select(*self.keys, row.alias("_old")).hint("merge"), self.keys, "full_outer")
            newer = F.col("_old").isNull() | (F.col(f"_new.{self.time}") >= F.col(f"_old.{self.time}"))
            out = both.select(*self.keys, F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select(*self.keys, "_row.*").select(*old.columns)
        name = f"online_write_{uuid.uuid4().hex}"
        out.write.format("parquet").mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self._path(last + 1)).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay, they are outside the warehouse
        return last + 1

    def lookup(self, entities: DataFrame, fields: list[str]) -> DataFrame:
        """Stored features of the given entities; an unknown entity gets nulls."""
        return entities.join(self.read().select(*self.keys, *fields).hint("merge"), self.keys, "left")


def online_features(entities: DataFrame, online: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Stored features of the given entities; an unknown entity gets nulls."""
    return entities.join(online.select(*keys, *fields), keys, "left")


def training_set(df: DataFrame, metadata: tuple[str, ...] = ("trace_id", "file_id", "event_timestamp")) -> DataFrame:
    """Features and label of a feature-source table, metadata left out."""
    return df.select(*[c for c in df.columns if c not in metadata])
