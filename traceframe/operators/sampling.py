"""Samples, splits and folds, all decided by hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from traceframe.plans.ranking import as_number, bucket_count, hash_rank, nested_rank, ordered_rank, with_value_bucket


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: str = "42") -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer).

    Adds ``sample_id`` 0..n-1. Rows of hash buckets past the n-th are dropped
    during the scan; the rest is ranked bucket by bucket.
    """
    ranked = hash_rank(df, keys, seed, name="_r", first=n)
    return ranked.withColumn("sample_id", F.col("_r") - 1).drop("_r")


def first_rows(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


def number_files(df: DataFrame, order: str | list[str], rows_per_file: int = 100) -> DataFrame:
    """Append ``file_no``: consecutive files of ``rows_per_file`` rows in ``order``, one key or several."""
    ranked = ordered_rank(df, order, name="_r") if isinstance(order, str) else nested_rank(df, order, name="_r")
    return ranked.withColumn("file_no", F.floor((F.col("_r") - 1) / rows_per_file).cast("long")).drop("_r")


def dataset_metadata(df: DataFrame) -> DataFrame:
    """Rows per file and class, with file totals."""
    return df.groupBy("file_no").agg(
        F.count(F.lit(1)).alias("num_traces"),
        *[
            F.count(F.when(F.col("class_label") == i, 1)).alias(name)
            for i, name in enumerate(["normal", "anomaly", "boundary"])
        ],
    )


def dataset_totals(df: DataFrame, source: str) -> DataFrame:
    """The record of a sampled dataset: one row of totals and the count of every class by name."""
    names = F.create_map(F.lit(0), F.lit("normal"), F.lit(1), F.lit("anomaly"), F.lit(2), F.lit("boundary"))
    classes = df.where("class_label in (0, 1, 2)").groupBy(names[F.col("class_label").cast("int")].alias("name")).agg(F.count(F.lit(1)).alias("n"))
    # At most three entries.
    shares = classes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n"))))).scalar()
    return df.agg(
        F.lit(source).alias("source_file"), F.count(F.lit(1)).alias("total_traces"), F.count_if(F.size("trace_data") > 0).alias("sampled_traces"),
        F.max("num_samples").alias("samples_per_trace"), (F.max("sample_rate") * 1000).alias("sample_rate_ms"),
    ).withColumn("class_distribution", shares)


def split_threshold(df: DataFrame, order: str, position: Column, buckets: int | None = None) -> DataFrame:
    """One row with the ``order`` value at a 1-based position.

    Bucket counts find the bucket that holds the position; only that bucket is
    sorted. ``order`` must be unique, numeric or time.
    """
    tagged = with_value_bucket(df.select(order), order, buckets or bucket_count(df)).select("_v", "_b")
    counts = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.lit(1))
    everything = Window.partitionBy("_all")
    before = everything.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    # One row per bucket, so these windows see a fixed number of rows.
    target = (
        counts.withColumn("_upto", F.sum("_n").over(before))
        .withColumn("_total", F.sum("_n").over(everything))
        .withColumn("_pos", position.cast("long"))
        .filter((F.col("_upto") >= F.col("_pos")) & (F.col("_upto") - F.col("_n") < F.col("_pos")))
        .select("_b", (F.col("_pos") - F.col("_upto") + F.col("_n")).alias("_k"))
    )
    inside = Window.partitionBy("_b").orderBy("_v")
    return (
        tagged.join(F.broadcast(target), "_b")
        .withColumn("_r", F.row_number().over(inside))
        .filter(F.col("_r") == F.col("_k"))
        .agg(F.max("_v").alias("threshold"))
    )


def halves(df: DataFrame, order: str | list[str], name: str = "side") -> DataFrame:
    """Tag the first floor(n/2) rows in ``order`` as reference, the rest as current.

    With one key the cut is a value, so the table itself is tagged while it is scanned;
    with several (file and trace) the rows are numbered.
    """
    if not isinstance(order, str):
        ranked, half = nested_rank(df, order, name="_r"), F.floor(F.lit(df.count()) / 2)
        return ranked.withColumn(name, F.when(F.col("_r") <= half, "reference").otherwise("current")).drop("_r")
    cut = split_threshold(df, order, F.floor(F.col("_total") / 2)).scalar()
    inside = F.coalesce(as_number(df, order) <= cut, F.lit(False))
    return df.withColumn(name, F.when(inside, "reference").otherwise("current"))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: list[str],
    test: float = 0.2,
    validation: float = 0.2,
    seed: str = "42",
) -> DataFrame:
    """Append ``split``: test, then validation out of the rest, then train, per class."""
    ranked = hash_rank(df, keys, seed, by=[label], name="_r", total="_n")
    return ranked.withColumn("split", _split(F.col("_r"), F.col("_n"), test, validation)).drop("_r", "_n")


def _split(rank: Column, size: Column, test: float, validation: float) -> Column:
    n_test = F.round(size * test)
    n_val = F.round((size - n_test) * validation)
    return F.when(rank <= n_test, "test").when(rank <= n_test + n_val, "validation").otherwise("train")


def training_assignment(
    df: DataFrame,
    label: str,
    keys: list[str],
    test: float = 0.2,
    validation: float = 0.2,
    k: int = 5,
    seed: str = "42",
) -> DataFrame:
    """Append split, fold and balanced class weight from one ranking of the rows."""
    ranked = hash_rank(df, keys, seed, by=[label], name="_r", total="_n")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    t = sizes.agg(F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))).scalar()
    return (
        ranked.withColumn("split", _split(F.col("_r"), F.col("_n"), test, validation))
        .withColumn("fold", ((F.col("_r") - 1) % k).cast("int"))
        .withColumn("weight", t["total"] / (t["classes"] * F.col("_n")))
        .drop("_r", "_n")
    )


def stratified_folds(
    df: DataFrame, label: str, keys: list[str], k: int = 5, seed: str = "42", name: str = "fold"
) -> DataFrame:
    """Append a fold number 0..k-1, dealt round in hash order inside each class."""
    ranked = hash_rank(df, keys, seed, by=[label], name="_r")
    return ranked.withColumn(name, ((F.col("_r") - 1) % k).cast("int")).drop("_r")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class; one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    t = totals.select(F.struct("total", "classes")).scalar()
    return counts.withColumn("weight", t["total"] / (t["classes"] * F.col("n")))
