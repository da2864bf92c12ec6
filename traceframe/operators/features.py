"""Feature tables: extraction, standardisation, embeddings, column sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from traceframe.functions import signal
from traceframe.schemas import EMBEDDINGS, HANDCRAFTED, METADATA


def extract(df: DataFrame, trace: str = "trace_data") -> DataFrame:
    """Metadata and the eight signal features of every trace."""
    keep = [c for c in METADATA if c in df.columns]
    return signal.handcrafted(df, trace).select(*keep, *HANDCRAFTED)


def with_frequency_hz(df: DataFrame, rate: str = "sample_rate") -> DataFrame:
    return df.withColumn("dominant_frequency_hz", F.col("dominant_frequency") / F.col(rate))


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Append ``<column>_scaled`` by population statistics; zero deviation divides by 1."""
    stats = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mu"), F.stddev_pop(c).alias("sd")).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    scaled = [
        ((F.col(c) - stats[c]["mu"]) / F.when(stats[c]["sd"] == 0, 1.0).otherwise(stats[c]["sd"])).alias(
            f"{c}_scaled"
        )
        for c in columns
    ]
    return df.select("*", *scaled)


@dataclass
class Standardiser:
    """Fitted column statistics that can be applied to later tables."""

    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "Standardiser":
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).first()
        return cls({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            "*", *[((F.col(c) - self.mean[c]) / self.deviation[c]).alias(f"{c}_scaled") for c in self.mean]
        )


@dataclass
class TraceEmbedder:
    """Standardised samples projected on the leading principal components."""

    length: int
    mean: list[float]
    deviation: list[float]
    model: PCAModel
    signs: list[float]

    @classmethod
    def fit(cls, df: DataFrame, k: int = 32, trace: str = "trace_data", length: int | None = None) -> "TraceEmbedder":
        """Two passes over the traces; the fitted state is the size of one trace times ``k``."""
        if length is None:
            length = df.agg(F.max(F.size(trace))).first()[0]
        fitted = df.select(signal.fit_length(F.col(trace), length).alias("_x"))
        stats = fitted.select(
            Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("_x")).alias("s")
        ).first()["s"]
        n = stats["count"]
        mean = stats["mean"].toArray().tolist()
        # The summary has the sample variance; scaling uses the population one.
        deviation = [(v * (n - 1) / n) ** 0.5 or 1.0 for v in stats["variance"].toArray().tolist()]
        scaled = cls._scaled(fitted, "_x", mean, deviation).select(array_to_vector("_z").alias("_v"))
        model = PCA(k=k, inputCol="_v", outputCol="_p").fit(scaled)
        loadings = model.pc.toArray()
        biggest = abs(loadings).argmax(axis=0)
        signs = [1.0 if loadings[i, j] >= 0 else -1.0 for j, i in enumerate(biggest)]
        return cls(length, mean, deviation, model, signs)

    @staticmethod
    def _scaled(df: DataFrame, column: str, mean: list[float], deviation: list[float]) -> DataFrame:
        mu = F.array(*[F.lit(v) for v in mean])
        sd = F.array(*[F.lit(v) for v in deviation])
        centred = F.zip_with(F.col(column), mu, lambda x, m: x - m)
        return df.withColumn("_z", F.zip_with(centred, sd, lambda x, s: x / s))

    def standardise_samples(self, df: DataFrame, trace: str = "trace_data", name: str = "standardised") -> DataFrame:
        fitted = df.withColumn("_x", signal.fit_length(F.col(trace), self.length))
        return self._scaled(fitted, "_x", self.mean, self.deviation).withColumnRenamed("_z", name).drop("_x")

    def encode(self, df: DataFrame, trace: str = "trace_data", name: str = "embedding") -> DataFrame:
        """Append the embedding as an array; every component has its largest loading positive."""
        ready = self.standardise_samples(df, trace, "_z").withColumn("_v", array_to_vector("_z"))
        signs = F.array(*[F.lit(s) for s in self.signs])
        projected = self.model.transform(ready)
        return projected.withColumn(
            name, F.zip_with(vector_to_array("_p"), signs, lambda x, s: x * s)
        ).drop("_z", "_v", "_p")

    def report(self, df: DataFrame, trace: str = "trace_data") -> DataFrame:
        """Explained variance and the mean squared reconstruction error.

        The components are orthonormal, so the lost energy is the energy of the
        standardised samples minus the energy of the embedding.
        """
        coded = self.encode(self.standardise_samples(df, trace, "_s"), trace, "_e")
        lost = signal.energy(F.col("_s")) - signal.energy(F.col("_e"))
        explained = float(self.model.explainedVariance.toArray().sum())
        return coded.agg(
            F.lit(explained).alias("explained_variance"),
            (F.sum(lost) / F.sum(F.size("_s"))).alias("reconstruction_mse"),
            F.lit(len(self.signs)).cast("long").alias("embedding_dim"),
        )


def standardise_positions(df: DataFrame, keys: list[str], trace: str = "trace_data") -> DataFrame:
    """Standardise every sample position over all traces, by fitted vectors."""
    length = df.agg(F.max(F.size(trace))).first()[0]
    stats = df.select(
        Summarizer.metrics("mean", "variance", "count")
        .summary(array_to_vector(signal.fit_length(F.col(trace), length)))
        .alias("s")
    ).first()["s"]
    n = stats["count"]
    deviation = [(v * (n - 1) / n) ** 0.5 or 1.0 for v in stats["variance"].toArray().tolist()]
    fitted = df.select(*keys, signal.fit_length(F.col(trace), length).alias("_x"))
    return TraceEmbedder._scaled(fitted, "_x", stats["mean"].toArray().tolist(), deviation).select(
        *keys, F.col("_z").alias("standardised")
    )


def spread_embedding(df: DataFrame, name: str = "embedding", dim: int = 32) -> DataFrame:
    """Array embedding to columns ``embedding_0..``."""
    return df.select(
        *[c for c in df.columns if c != name],
        *[F.element_at(name, i + 1).alias(f"embedding_{i}") for i in range(dim)],
    )


def feature_columns(columns: list[str], use_embeddings: bool = True) -> list[str]:
    """Training columns: the handcrafted ones and available embeddings, scaled if all are."""
    have = set(columns)
    chosen = HANDCRAFTED + ([c for c in EMBEDDINGS if c in have] if use_embeddings else [])
    scaled = [f"{c}_scaled" for c in chosen]
    return scaled if have.issuperset(scaled) else chosen


def scoring_columns(columns: list[str], fitted: list[str] | None = None) -> list[str]:
    """Columns to score by, in the order a model was fitted on.

    ``fitted`` is the model's own list; a table without all of it is an error. Without a list,
    the scaled columns count if the handcrafted ones are whole and the embeddings whole or
    absent, else all columns that look like features, at least 8 of them.
    """
    have = set(columns)
    if fitted is not None:
        if lost := [c for c in fitted if c not in have]:
            raise ValueError(f"input lacks columns the model was fitted on: {lost}")
        return list(fitted)
    whole = [f"{c}_scaled" for c in HANDCRAFTED], [f"{c}_scaled" for c in EMBEDDINGS]
    found = [[c for c in part if c in have] for part in whole]
    if any(found):
        if found[0] != whole[0] or found[1] not in ([], whole[1]):
            raise ValueError(f"input has only some of the scaled feature columns: {sum(found, [])}")
        return sum(found, [])
    fallback = drift_columns(columns)
    if len(fallback) >= 8:
        return fallback
    raise ValueError("input has no pre-extracted feature columns")


def drift_columns(columns: list[str]) -> list[str]:
    """All columns whose name has ``scaled`` or ``embedding``."""
    return [c for c in columns if "scaled" in c or "embedding" in c]


def feature_source(df: DataFrame, event_time) -> DataFrame:
    """Typed feature-source table with a given event time, unscaled columns only."""
    wanted = HANDCRAFTED + ["class_label"] + EMBEDDINGS
    return df.select(
        F.col("trace_id").cast("long").alias("trace_id"),
        F.col("file_id").cast("string").alias("file_id"),
        event_time.alias("event_timestamp"),
        *[c for c in wanted if c in df.columns],
    )


def silver(traces: DataFrame, k: int = 32) -> tuple[DataFrame, TraceEmbedder, Standardiser]:
    """The silver table with its fitted embedder and standardiser."""
    embedder = TraceEmbedder.fit(traces, k)
    coded = embedder.encode(signal.handcrafted(traces)).select(*METADATA, *HANDCRAFTED, "embedding")
    wide = spread_embedding(coded, dim=k)
    scaler = Standardiser.fit(wide, HANDCRAFTED + [f"embedding_{i}" for i in range(k)])
    return scaler.transform(wide), embedder, scaler
