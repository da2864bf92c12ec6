"""Scoring of feature tables and of raw traces."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from traceframe.functions import signal
from traceframe.functions.labels import PROBABILITIES, SCORED_NAMES, class_name, confidence
from traceframe.operators.features import Standardiser, TraceEmbedder, scoring_columns, spread_embedding
from traceframe.operators.training import FEATURES, predict


def score_table(model: Model, df: DataFrame, columns: list[str] | None = None, probabilities: bool = True) -> DataFrame:
    """All input columns plus predicted class, its name, probabilities and confidence."""
    columns = columns or scoring_columns(df.columns)
    vectors = VectorAssembler(inputCols=columns, outputCol=FEATURES, handleInvalid="error").transform(df)
    scored = predict(model, vectors).withColumn("predicted_class", F.col("prediction").cast("long"))
    out = [*df.columns, "predicted_class", class_name(F.col("predicted_class"), SCORED_NAMES).alias("predicted_class_name")]
    if probabilities:
        out += [F.element_at("scores", i + 1).alias(p) for i, p in enumerate(PROBABILITIES)]
        out.append(confidence(F.col("scores")).alias("confidence"))
    return scored.select(*out)


@dataclass
class TraceScorer:
    """Features, embedding, scaling and model as one function of a trace table.

    The same fitted parts serve training and scoring.
    """

    model: Model
    scaler: Standardiser
    embedder: TraceEmbedder | None = None

    def score(self, traces: DataFrame, trace: str = "trace_data") -> DataFrame:
        keep = [c for c in traces.columns if c != trace]
        df = signal.handcrafted(traces, trace)
        if self.embedder is not None:
            df = spread_embedding(self.embedder.encode(df, trace), dim=len(self.embedder.signs))
        scaled = self.scaler.transform(df)
        columns = [f"{c}_scaled" for c in self.scaler.mean]
        scored = score_table(self.model, scaled.drop(trace), columns)
        return scored.select(*keep, "predicted_class", "predicted_class_name", *PROBABILITIES, "confidence")


def scored_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"))
