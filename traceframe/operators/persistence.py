"""Fitted parts to and from storage any executor can read.

Models use their own writer, wrapped in a pipeline so that the kind need not be
known when loading. Fitted numbers are one-row tables.
"""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import PCAModel
from pyspark.sql import SparkSession

from traceframe.operators.features import Standardiser, TraceEmbedder
from traceframe.operators.retrieval import TfidfModel
from traceframe.operators.scoring import TraceScorer


def _write_row(spark: SparkSession, path: str, schema: str, *values) -> None:
    spark.createDataFrame([values], schema).write.mode("overwrite").parquet(path)


def save_model(model: Model, path: str) -> None:
    PipelineModel([model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path).stages[0]


def save_standardiser(spark: SparkSession, scaler: Standardiser, path: str) -> None:
    names = list(scaler.mean)
    _write_row(
        spark,
        path,
        "names array<string>, mean array<double>, deviation array<double>",
        names,
        [scaler.mean[c] for c in names],
        [scaler.deviation[c] for c in names],
    )


def load_standardiser(spark: SparkSession, path: str) -> Standardiser:
    r = spark.read.parquet(path).first()
    return Standardiser(dict(zip(r.names, r.mean)), dict(zip(r.names, r.deviation)))


def save_embedder(spark: SparkSession, embedder: TraceEmbedder, path: str) -> None:
    embedder.model.write().overwrite().save(f"{path}/components")
    _write_row(
        spark,
        f"{path}/numbers",
        "length int, mean array<double>, deviation array<double>, signs array<double>",
        embedder.length,
        embedder.mean,
        embedder.deviation,
        embedder.signs,
    )


def load_embedder(spark: SparkSession, path: str) -> TraceEmbedder:
    r = spark.read.parquet(f"{path}/numbers").first()
    return TraceEmbedder(r.length, r["mean"], r.deviation, PCAModel.load(f"{path}/components"), r.signs)


def save_tfidf(spark: SparkSession, model: TfidfModel, path: str) -> None:
    schema = "terms array<string>, idf array<double>, stop_words array<string>"
    _write_row(spark, path, schema, model.terms, model.idf, model.stop_words)


def load_tfidf(spark: SparkSession, path: str) -> TfidfModel:
    r = spark.read.parquet(path).first()
    return TfidfModel(r.terms, r.idf, r.stop_words)


def save_scorer(spark: SparkSession, scorer: TraceScorer, path: str) -> None:
    save_model(scorer.model, f"{path}/model")
    save_standardiser(spark, scorer.scaler, f"{path}/scaler")
    if scorer.embedder is not None:
        save_embedder(spark, scorer.embedder, f"{path}/embedder")


def load_scorer(spark: SparkSession, path: str, embeddings: bool = True) -> TraceScorer:
    embedder = load_embedder(spark, f"{path}/embedder") if embeddings else None
    return TraceScorer(load_model(f"{path}/model"), load_standardiser(spark, f"{path}/scaler"), embedder)
