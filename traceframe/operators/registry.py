"""Run tables and version tables as table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The stages a version can be in.
STAGES = ("None", "Staging", "Production", "Archived")


def _best_of(df: DataFrame, by: list[str], order) -> DataFrame:
    """The row with the largest ``order`` per group; combined on the map side."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*by, "_r.*")


def latest_run(runs: DataFrame, by: str = "experiment") -> DataFrame:
    return _best_of(runs, [by], F.struct("start_time", "run_id"))


def best_run(runs: DataFrame, metric: str = "metric", by: str = "experiment") -> DataFrame:
    """Highest metric per experiment; the earlier id wins a tie."""
    return _best_of(runs.filter(F.col(metric).isNotNull()), [by], F.struct(F.col(metric), -F.col("run_id")))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Latest version of each model in each stage."""
    return _best_of(versions, ["model_name", "stage"], F.col("version"))


def production_version(versions: DataFrame) -> DataFrame:
    return _best_of(versions.filter(F.col("stage") == "Production"), ["model_name"], F.col("version"))


def register(versions: DataFrame, new: DataFrame) -> DataFrame:
    """A new snapshot of the table with one more version of every model in ``new``.

    ``new`` has (model_name, created); the version is the largest one plus one.
    """
    last = versions.groupBy("model_name").agg(F.max("version").alias("_v"))
    added = new.join(last, "model_name", "left").select(
        "model_name",
        (F.coalesce("_v", F.lit(0)) + 1).cast(versions.schema["version"].dataType).alias("version"),
        F.lit("None").alias("stage"),
        F.col("created").cast(versions.schema["created"].dataType).alias("created"),
    )
    return versions.select("model_name", "version", "stage", "created").unionByName(added)


def transition(versions: DataFrame, changes: DataFrame, stage: str) -> DataFrame:
    """A new snapshot in which the (model_name, version) pairs of ``changes`` are in ``stage``."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    keys = changes.select("model_name", "version").distinct().withColumn("_hit", F.lit(True))
    moved = F.when(F.col("_hit"), F.lit(stage)).otherwise(F.col("stage"))
    return (
        versions.join(keys, ["model_name", "version"], "left")
        .withColumn("stage", moved)
        .select("model_name", "version", "stage", "created")
    )


def describe(versions: DataFrame, notes: DataFrame) -> DataFrame:
    """Attach (model_name, version, description) rows to the version table."""
    return versions.join(notes, ["model_name", "version"], "left")


def best_trial(trials: DataFrame, order: list[str]) -> DataFrame:
    """Best trial per model type and over all types; ties keep the earlier type and trial.

    ``order`` lists the model types as they were tried.
    """
    at = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("model_type"))
    ranked = trials.filter(F.col("value").isNotNull())
    best = F.struct(F.col("value"), -at, -F.col("trial"))
    rest = F.struct("trial", "value")
    per_type = ranked.groupBy("model_type").agg(F.max_by(rest, best).alias("_r")).select("model_type", "_r.*")
    winner = per_type.agg(F.max_by("model_type", F.struct(F.col("value"), -at))).scalar()
    return per_type.withColumn("is_best", F.col("model_type") == winner)
