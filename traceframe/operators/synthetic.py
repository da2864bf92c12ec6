"""Synthetic traces with three class shapes, made by Spark from a table of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from traceframe.functions.hashing import uniform

# Fixed values per class: frequency centre and spread, amplitude centre and
# spread, noise deviation.
SHAPES = {
    0: (20.0, 5.0, 1000.0, 200.0, 50.0),
    1: (30.0, 10.0, 1500.0, 300.0, 100.0),
    2: (15.0, 3.0, 1200.0, 200.0, 75.0),
}
SECOND_FREQUENCY = (35.0, 5.0)
SPIKES, SPIKE_LOW, SPIKE_HIGH = 5, 500.0, 1000.0


def _draw(seed: str, key: Column, centre: Column, spread: Column) -> Column:
    return centre + spread * (uniform(seed, key) * 2 - 1)


def _noise(seed: str, key: Column, i: Column) -> Column:
    """Normal noise from two hash uniforms (Box-Muller)."""
    u = F.greatest(uniform(f"{seed}-u", key, i), F.lit(1e-12))
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0) * F.pi() * uniform(f"{seed}-v", key, i))


def synthesize(
    keys: DataFrame, key: str, label: str, samples: int = 2000, rate: float = 0.002, seed: str = "42"
) -> DataFrame:
    """Append ``trace_data`` to every row of ``keys`` by its class shape.

    Class 0 is one sine, class 1 a sine with five spikes, class 2 a sine that
    changes frequency half way. All draws are hashes of the row key.
    """
    k = F.col(key)

    def by_class(at: int) -> Column:
        out = F.lit(SHAPES[2][at])
        for c in (1, 0):
            out = F.when(F.col(label) == c, F.lit(SHAPES[c][at])).otherwise(out)
        return out

    shaped = (
        keys.withColumn("_f", _draw(f"{seed}-freq", k, by_class(0), by_class(1)))
        .withColumn("_a", _draw(f"{seed}-amp", k, by_class(2), by_class(3)))
        .withColumn("_sd", by_class(4))
        .withColumn(
            "_f2",
            F.when(F.col(label) == 2, _draw(f"{seed}-second", k, *[F.lit(v) for v in SECOND_FREQUENCY])).otherwise(
                F.col("_f")
            ),
        )
        .withColumn(
            "_spikes",
            F.when(
                F.col(label) == 1,
                F.transform(
                    F.sequence(F.lit(1), F.lit(SPIKES)),
                    lambda j: F.floor(uniform(f"{seed}-spike", k, j) * samples),
                ),
            ),
        )
    )
    step = samples * rate / (samples - 1)

    def value(i: Column) -> Column:
        freq = F.when(i < samples // 2, F.col("_f")).otherwise(F.col("_f2"))
        wave = F.col("_a") * F.sin(F.lit(2.0) * F.pi() * freq * i * step)
        lift = F.lit(SPIKE_LOW) + F.lit(SPIKE_HIGH - SPIKE_LOW) * uniform(f"{seed}-lift", k, i)
        spike = F.when(F.array_contains("_spikes", i.cast("long")), lift).otherwise(F.lit(0.0))
        return wave + spike + F.col("_sd") * _noise(f"{seed}-noise", k, i)

    data = F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), value)
    return shaped.withColumn("trace_data", data).drop("_f", "_a", "_sd", "_f2", "_spikes")
