"""Missing values, validation, statistics, domain checks and history drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from traceframe.functions import rules
from traceframe.functions.signal import mean as trace_mean
from traceframe.plans.ranking import unpivot


def _n(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percent of every column that has any; NaN and empty arrays count."""

    def missing(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return c.isNull() | (F.size(c) == 0)
        return c.isNull() | F.isnan(c) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c.isNull()

    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[_n(missing(f)).alias(f.name) for f in df.schema.fields])
    return (
        unpivot(wide, ["_n"], df.columns, "column_name", "missing_count")
        .filter(F.col("missing_count") > 0)
        .select(
            "column_name", "missing_count", (F.col("missing_count") / F.col("_n") * 100).alias("missing_pct")
        )
    )


def drop_empty_traces(df: DataFrame, trace: str = "trace_data") -> DataFrame:
    return df.filter(F.col(trace).isNotNull() & (F.size(trace) > 0))


def _single_valued(column: str) -> Column:
    """True when all non-null values agree: a min and a max, not a distinct count."""
    return F.coalesce(F.min(column) == F.max(column), F.lit(False))


def _validation_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_traces"),
        F.countDistinct("file_id").alias("total_files"),
        _n(F.col("trace_data").isNull()).alias("missing_trace_data"),
        _n(F.col("cdp_x").isNull() | F.col("cdp_y").isNull()).alias("missing_coordinates"),
        _single_valued("sample_rate").alias("sample_rate_consistency"),
        _single_valued("num_samples").alias("num_samples_consistency"),
    ]


def class_counts(df: DataFrame, label: str = "class_label") -> Column:
    """Rows per class as one map, classes in ascending order; one entry per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(label, "n")))
    return counts.agg(F.map_from_entries(F.transform(entries, lambda e: F.struct(e[label].cast("string").alias("key"), e["n"].alias("value"))))).scalar()


def validation(df: DataFrame) -> DataFrame:
    """One row of validation results with rows per class, if there are classes, and the list of broken rules."""
    found = _with_rules(df.agg(*_validation_measures()))
    return found.withColumn("class_counts", class_counts(df)) if "class_label" in df.columns else found


def _with_rules(df: DataFrame) -> DataFrame:
    # The sentences of the validation record.
    fired = F.array(
        F.when(
            F.col("missing_trace_data") > 0,
            F.concat(F.lit("Found "), F.col("missing_trace_data").cast("string"), F.lit(" traces with missing data")),
        ),
        F.when(~F.col("sample_rate_consistency"), "Inconsistent sample rates across traces"),
        F.when(~F.col("num_samples_consistency"), "Inconsistent number of samples across traces"),
    )
    return df.withColumn("anomalies", F.filter(fired, lambda x: x.isNotNull())).withColumn(
        "validation_passed", F.size("anomalies") == 0
    )


def row_rules(df: DataFrame) -> DataFrame:
    """Append the rules a single row can break, for a stream or a quarantine split."""
    fired = F.array(
        F.when(F.col("trace_data").isNull() | (F.size("trace_data") == 0), "missing samples"),
        F.when(F.col("cdp_x").isNull() | F.col("cdp_y").isNull(), "missing coordinates"),
        F.when(F.size("trace_data") != F.col("num_samples"), "length differs from header"),
        F.when(~(F.col("sample_rate") > 0), "sample rate not positive"),
    )
    return df.withColumn("broken_rules", F.filter(fired, lambda x: x.isNotNull()))


def class_distribution(df: DataFrame, label: str = "class_label") -> DataFrame:
    """Count and percentage per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percentage", F.col("n") / total * 100)


def balance(df: DataFrame, label: str = "class_label", by: list[str] | None = None) -> DataFrame:
    """Entropy over log2 of the class count, and one minus it; a single class gives 0."""
    by = by or []
    counts = df.filter(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    # sum(p log p) = sum(n log n) / N - log N, so one more pass over class counts is enough.
    agg = counts.groupBy(*by).agg(
        F.sum("n").alias("_n"),
        F.count(F.lit(1)).alias("num_classes"),
        F.sum(F.col("n") * F.log2(F.col("n"))).alias("_s"),
    )
    entropy = F.log2("_n") - F.col("_s") / F.col("_n")
    score = F.when(F.col("num_classes") > 1, entropy / F.log2("num_classes")).otherwise(F.lit(0.0))
    return agg.select(*by, "num_classes", score.alias("balance_score"), (F.lit(1.0) - score).alias("imbalance_score"))


def with_row_measures(df: DataFrame, trace: str = "trace_data") -> DataFrame:
    """Per trace: count ``_c``, mean ``_m``, squared deviations ``_q``, range ``_lo`` to ``_hi``.

    Everything the roll-ups need, so that no sample array passes an aggregate.
    Traces without samples have a count of 0 and nulls.
    """
    xs = F.col(trace)
    count = F.when(F.size(xs) > 0, F.size(xs)).otherwise(0).cast("long")
    rows = df.withColumns({"_c": count, "_m": trace_mean(xs), "_lo": F.array_min(xs), "_hi": F.array_max(xs)})
    squares = F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - F.col("_m")) * (x - F.col("_m")))
    return rows.withColumn("_q", F.when(F.col("_c") > 0, squares))


def _trace_measures() -> list[Column]:
    std = F.sqrt(F.col("_q") / F.nullif(F.col("_c"), F.lit(0)))
    return [
        F.avg("_m").alias("mean_of_means"),
        F.stddev_pop("_m").alias("std_of_means"),
        F.avg(std).alias("mean_of_stds"),
        F.stddev_pop(std).alias("std_of_stds"),
        F.min("_lo").alias("overall_min"),
        F.max("_hi").alias("overall_max"),
        _n(F.col("_q") == 0).alias("dead_traces"),
        _n(F.col("_c") > 0).alias("sample_size"),
    ]


def trace_statistics(df: DataFrame, trace: str = "trace_data", by: list[str] | None = None) -> DataFrame:
    """Roll-up of per-trace mean and deviation, overall range, dead traces."""
    by = by or []
    rows = with_row_measures(df.select(*by, trace), trace)
    return rows.groupBy(*by).agg(*_trace_measures())


def coordinate_ranges(df: DataFrame, columns: tuple[str, ...] = ("cdp_x", "cdp_y")) -> DataFrame:
    """Min, max, mean and sample deviation per coordinate column, in one aggregate."""
    return column_summary(df, list(columns))


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column_name, mean, std, min, max) for many columns in one pass."""
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(
        *[
            F.struct(*[f(F.col(c).cast("double")).alias(m) for m, f in measures.items()]).alias(c)
            for c in columns
        ]
    )
    return unpivot(wide, [], columns, "column_name", "s").select("column_name", "s.*")


# A trace number starts anew in every file.
TRACE_KEY = ("file_id", "trace_id")


def rate_and_length(df: DataFrame, key: tuple[str, ...] = TRACE_KEY) -> DataFrame:
    """First value by key and consistency of sample rate and trace length."""
    first = F.struct(*key)
    return df.agg(
        (F.min_by("sample_rate", first) * 1000).alias("sample_rate_ms"),
        _single_valued("sample_rate").alias("sample_rate_consistent"),
        F.min_by("num_samples", first).cast("long").alias("num_samples"),
        _single_valued("num_samples").alias("num_samples_consistent"),
    )


# Standard range of the sample rate in milliseconds.
RATE_LOW_MS, RATE_HIGH_MS = 0.5, 4.0


def _amplitude() -> list[Column]:
    """Mean and deviation of all samples, from the per-trace parts."""
    n = F.nullif(F.sum("_c"), F.lit(0))
    mu = F.sum(F.col("_c") * F.col("_m")) / n
    second = F.sum(F.col("_q") + F.col("_c") * F.col("_m") * F.col("_m")) / n
    return [mu.alias("mean_amplitude"), F.sqrt(F.greatest(second - mu * mu, F.lit(0.0))).alias("std_amplitude")]


def _domain_measures(key: tuple[str, ...]) -> list[Column]:
    dead = _n(F.col("_q") == 0)
    rate = F.min_by("sample_rate", F.struct(*key)) * 1000
    ranges = [
        f(c).cast("double").alias(f"{c}_{name}")
        for c in ("inline", "crossline", "cdp_x", "cdp_y")
        for name, f in (("min", F.min), ("max", F.max))
    ]
    unique = [F.countDistinct(c).alias(f"unique_{c}") for c in ("inline", "crossline", "cdp_x", "cdp_y", "file_id")]
    return [
        F.min("_lo").alias("min_amplitude"),
        F.max("_hi").alias("max_amplitude"),
        *_amplitude(),
        dead.alias("dead_traces"),
        (dead / F.nullif(_n(F.col("_c") > 0), F.lit(0)) * 100).alias("dead_traces_pct"),
        rate.alias("sample_rate_ms"),
        rate.between(RATE_LOW_MS, RATE_HIGH_MS).alias("within_standards"),
        *ranges,
        *unique,
        F.count(F.lit(1)).alias("total_traces"),
        _n(F.col("_missing")).alias("missing_trace_data"),
        _n(F.col("cdp_x").isNull() | F.col("cdp_y").isNull()).alias("missing_coordinates"),
    ]


def domain_checks(df: DataFrame, key: tuple[str, ...] = TRACE_KEY, trace: str = "trace_data") -> DataFrame:
    """One row of amplitude, rate, spatial, coordinate and completeness checks.

    Flattened amplitudes come from per-row parts; the samples are never exploded.
    """
    rows = with_row_measures(df, trace).withColumn("_missing", F.col(trace).isNull())
    return rows.agg(*_domain_measures(key))


def _history_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_traces"), F.countDistinct("file_id").alias("total_files"), *_amplitude()]


def history_statistics(df: DataFrame, trace: str = "trace_data") -> DataFrame:
    """Totals and flattened amplitude of one load: the numeric part of a history row."""
    return with_row_measures(df, trace).agg(*_history_measures())


def class_shares(df: DataFrame, label: str = "class_label") -> DataFrame:
    """Share of every class, long: (class_label, share)."""
    counts = df.groupBy(F.col(label).cast("long").alias("class_label")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select("class_label", (F.col("_n") / counts.agg(F.sum("_n")).scalar()).alias("share"))


def history_record(df: DataFrame) -> DataFrame:
    """The whole history row: statistics plus the class shares as a map."""
    shares = class_shares(df).filter(F.col("class_label").isNotNull())
    as_map = shares.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("class_label").cast("string"), F.col("share"))))
        )
    ).scalar()
    return history_statistics(df).withColumn("class_distribution", as_map)


def compare_shares(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current and historical class shares side by side; a missing class counts 0."""
    return (
        current.withColumnRenamed("share", "current_share")
        .join(history.withColumnRenamed("share", "historical_share"), "class_label", "full")
        .select(
            "class_label",
            F.coalesce("current_share", F.lit(0.0)).alias("current_share"),
            F.coalesce("historical_share", F.lit(0.0)).alias("historical_share"),
        )
        .withColumn("change", F.abs(F.col("current_share") - F.col("historical_share")))
    )


# Thresholds of the history comparison.
CLASS_CHANGE, AMPLITUDE_SHIFT, VOLUME_CHANGE_PCT = 0.1, 100.0, 20.0


def _indicators(now: Column, past: Column, change: Column) -> list[Column]:
    volume = F.abs(now["total_traces"] - past["total_traces"])
    pct = volume / F.greatest(past["total_traces"], F.lit(1)) * 100
    shift = F.abs(now["mean_amplitude"] - past["mean_amplitude"])
    return [
        change.alias("max_class_change"),
        (change > CLASS_CHANGE).alias("class_change_significant"),
        shift.alias("amplitude_shift"),
        (shift > AMPLITUDE_SHIFT).alias("amplitude_shift_significant"),
        volume.alias("volume_change"),
        pct.alias("volume_change_pct"),
        (pct > VOLUME_CHANGE_PCT).alias("volume_change_significant"),
    ]


def drift_indicators(
    current_stats: DataFrame, current_shares: DataFrame, history_stats: DataFrame, history_shares: DataFrame
) -> DataFrame:
    """One row: largest class change, amplitude shift and volume change, each with a flag."""
    change = compare_shares(current_shares, history_shares).agg(F.max("change")).scalar()
    past = history_stats.select(F.struct("total_traces", "mean_amplitude")).scalar()
    now = current_stats.select(F.struct("total_traces", "mean_amplitude").alias("now"))
    return now.select(*_indicators(F.col("now"), past, change))


def evaluate(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The whole quality evaluation as one row of structs.

    ``history`` is a one-row table as made by :func:`history_record`; without it
    the drift status is ``no_history``.
    """
    key, trace = TRACE_KEY, "trace_data"
    rows = with_row_measures(df, trace).withColumn("_missing", F.col(trace).isNull())
    # One aggregate over the samples for all parts; the rest reads single header columns.
    parts = {
        "validation": _validation_measures(),
        "statistics": _trace_measures(),
        "domain": _domain_measures(key),
        "current": _history_measures(),
    }
    measured = rows.withColumn("trace_data", F.when(~F.col("_missing"), F.lit(1))).agg(
        *[F.struct(*columns).alias(name) for name, columns in parts.items()]
    )
    checked = _with_rules(measured.select("validation.*", "statistics", "domain", "current"))
    level = rules.priority(F.col("validation_passed"), F.size("anomalies"))
    out = checked.withColumn("priority", level).withColumns(
        {
            "action": rules.action(F.col("priority")),
            "reasoning": rules.reasoning(F.col("priority")),
            "balance": balance(df).select(F.struct("balance_score", "imbalance_score")).scalar(),
        }
    )
    if history is None:
        return out.drop("current").withColumn("drift_status", F.lit("no_history"))
    past = history.select(
        F.struct("total_traces", "mean_amplitude").alias("totals"), F.col("class_distribution").alias("shares")
    )
    past_shares = past.select(F.explode("shares").alias("class_label", "share")).select(
        F.col("class_label").cast("long").alias("class_label"), "share"
    )
    change = compare_shares(class_shares(df), past_shares).agg(F.max("change")).scalar()
    drift = _indicators(F.col("current"), past.select("totals").scalar(), change)
    return out.withColumn("drift", F.struct(*drift)).withColumn("drift_status", F.lit("compared")).drop("current")


def historical_frame(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored history record with its declared schema."""
    from traceframe.schemas import HISTORY

    return spark.read.schema(HISTORY).json(path, multiLine=True)
