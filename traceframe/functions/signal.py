"""Per-trace signal expressions over an array of samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

ZERO = 0.0


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(ZERO), lambda acc, x: acc + x)


def mean(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, total(xs) / F.size(xs))


def energy(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(ZERO), lambda acc, x: acc + x * x)


def rms(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, F.sqrt(energy(xs) / F.size(xs)))


def std_pop(xs: Column, mu: Column) -> Column:
    """Population deviation about a mean that is already a column (two passes)."""
    squares = F.aggregate(xs, F.lit(ZERO), lambda acc, x: acc + (x - mu) * (x - mu))
    return F.when(F.size(xs) > 0, F.sqrt(squares / F.size(xs)))


def zero_crossings(xs: Column) -> Column:
    """Sign changes between neighbours; a sample is negative when it is below zero.

    One fold carries the previous sign, so the array is walked once and never copied.
    """
    start = F.struct(F.lit(None).cast("boolean").alias("neg"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        neg = x < 0
        changed = F.coalesce(acc["neg"] != neg, F.lit(False)).cast("long")
        return F.struct(neg.alias("neg"), (acc["n"] + changed).alias("n"))

    return F.aggregate(xs, start, step, lambda acc: acc["n"])


def _spectral_peak(batch: pd.Series) -> pd.Series:
    lengths = batch.map(lambda x: -1 if x is None else len(x)).to_numpy()
    out = np.zeros(len(batch))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        if n < 0:
            out[at] = np.nan
        elif n // 2 > 1:
            block = np.stack([np.asarray(batch.iloc[i], dtype=np.float64) for i in at])
            power = np.abs(np.fft.rfft(block, axis=1)[:, 1 : n // 2]) ** 2
            out[at] = (power.argmax(axis=1) + 1) / n
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def dominant_frequency(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Frequency of the strongest bin in cycles per sample, without DC and Nyquist.

    Ties take the lowest bin; a trace too short to have a bin gives 0. Traces of
    one length are transformed together, a batch at a time.
    """
    for batch in batches:
        yield _spectral_peak(batch)


def dominant_frequency_native(xs: Column) -> Column:
    """The same bin by a discrete Fourier sum in expressions: for short arrays only."""
    n = F.size(xs)
    pairs = F.arrays_zip(F.sequence(F.lit(0), n - 1).alias("t"), xs.alias("x"))

    def power(k: Column) -> Column:
        turn = F.lit(2.0) * F.pi() * k / n
        re = F.aggregate(pairs, F.lit(ZERO), lambda a, p: a + p["x"] * F.cos(turn * p["t"]))
        im = F.aggregate(pairs, F.lit(ZERO), lambda a, p: a + p["x"] * F.sin(turn * p["t"]))
        return F.struct(F.round(re * re + im * im, 6).alias("p"), (-k).alias("k"))

    bins = F.transform(F.sequence(F.lit(1), F.floor(n / 2) - 1), power)
    return F.when(n >= 4, -F.array_max(bins)["k"] / n).otherwise(F.lit(ZERO))


def handcrafted(df, trace: str = "trace_data"):
    """Append the eight signal features of every trace in ``df``."""
    xs = F.col(trace)
    first = df.withColumns(
        {
            "mean_amplitude": mean(xs),
            "min_amplitude": F.array_min(xs),
            "max_amplitude": F.array_max(xs),
            "energy": energy(xs),
            "zero_crossings": zero_crossings(xs).cast("double"),
            "dominant_frequency": dominant_frequency(xs),
        }
    )
    return first.withColumns(
        {
            "std_amplitude": std_pop(xs, F.col("mean_amplitude")),
            "rms_amplitude": F.when(F.size(xs) > 0, F.sqrt(F.col("energy") / F.size(xs))),
        }
    )


def fit_length(xs: Column, n: int) -> Column:
    """Cut to ``n`` samples, or fill with zeros up to ``n``."""
    return F.slice(F.concat(xs, F.array_repeat(F.lit(ZERO), n)), 1, n)


def norm(xs: Column) -> Column:
    return F.sqrt(energy(xs))


def l2_normalise(xs: Column) -> Column:
    """Divide by the Euclidean norm; a zero vector stays zero."""
    size = F.coalesce(F.nullif(norm(xs), F.lit(ZERO)), F.lit(1.0))
    return F.transform(xs, lambda x: x / size)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either side has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(ZERO))
