"""p-values without a statistics library: closed forms, series, small recursions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def chi2_two_dof(x: Column) -> Column:
    """Upper tail of chi-square with two degrees of freedom."""
    return F.exp(-x / 2)


def chi2_upper_tail(x: float, dof: int) -> float:
    """Upper tail of chi-square for any degrees of freedom (one scalar).

    Even and odd degrees have finite sums; both start from a closed form and add
    one term per two degrees.
    """
    if x is None or dof < 1:
        return 1.0
    if x <= 0:
        return 1.0
    half = x / 2
    if dof % 2 == 0:
        term = tail = math.exp(-half)
        for i in range(1, dof // 2):
            term *= half / i
            tail += term
        return min(1.0, tail)
    tail = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range(1, (dof + 1) // 2):
        tail += term
        term *= half / (i + 0.5)
    return min(1.0, tail)


@F.pandas_udf(T.DoubleType())
def chi2_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail for result rows (one per test, never per data row)."""
    return pd.Series([chi2_upper_tail(a, int(k)) for a, k in zip(x, dof)], dtype="float64")


def kolmogorov_series(d: Column, n: Column, m: Column, terms: int = 40) -> Column:
    """Large-sample p-value of a two-sample distance, with the small-sample correction."""
    root = F.sqrt(n.cast("double") * m / (n + m))
    z = (root + 0.12 + F.lit(0.11) / root) * d
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * j * j * z * z),
    )
    # Below this argument the alternating sum has not settled, and the tail is 1.
    return F.when(z < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def exact_two_sample_tail(d: float, n: int, m: int) -> float:
    """P(D >= d) for two samples without ties, by the lattice-path recursion.

    ``a(i, j)`` is the chance that a random path to (i, j) has stayed strictly
    inside the band |i/n - j/m| < d. All cells with the same i + j are computed
    together from the previous diagonal.
    """
    g = math.gcd(n, m)
    limit = round(d * n * m / g)
    if limit <= 0:
        return 1.0
    previous = np.array([1.0])
    low_before = 0
    for s in range(1, n + m + 1):
        low = max(0, s - m)
        i = np.arange(low, min(n, s) + 1)
        j = s - i
        left = np.zeros(len(i))  # from (i-1, j)
        down = np.zeros(len(i))  # from (i, j-1)
        at = i - 1 - low_before
        ok = (i >= 1) & (at >= 0) & (at < len(previous))
        left[ok] = previous[at[ok]]
        at = i - low_before
        ok = (j >= 1) & (at >= 0) & (at < len(previous))
        down[ok] = previous[at[ok]]
        cell = (left * i + down * j) / s
        cell[np.abs(i * (m // g) - j * (n // g)) >= limit] = 0.0
        previous, low_before = cell, low
    return float(min(1.0, max(0.0, 1.0 - previous[-1])))


@F.pandas_udf(T.DoubleType())
def exact_ks_p_value(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact tail for result rows (one per feature, never per data row)."""
    return pd.Series([None if pd.isna(a) else exact_two_sample_tail(a, int(b), int(c)) for a, b, c in zip(d, n, m)], dtype="float64")


# How a two-sample p-value is found: the limit series, all lattice paths, or the latter up to a size.
SERIES, EXACT, AUTO = "series", "exact", "auto"
EXACT_UPTO = 10_000  # values of the larger side, as in the reference


def ks_method(n: Column, m: Column, method: str = AUTO, exact_upto: int = EXACT_UPTO) -> Column:
    """The method that ``ks_p_value`` takes for samples of n and m values."""
    if method not in (SERIES, EXACT, AUTO):
        raise ValueError(f"unknown method {method}")
    return F.when(F.greatest(n, m) <= exact_upto, EXACT).otherwise(SERIES) if method == AUTO else F.lit(method)


def ks_p_value(d: Column, n: Column, m: Column, method: str = AUTO, exact_upto: int = EXACT_UPTO) -> Column:
    """Upper tail of a two-sample distance.

    ``exact`` takes n x m steps per result row; ``series`` is an expression, within 0.007 of
    the exact tail for samples of some hundred values and closer for larger ones; ``auto``, the
    default, is exact as long as the larger sample has at most ``exact_upto`` values.
    """
    chosen = ks_method(n, m, method, exact_upto)
    exact = exact_ks_p_value(F.when(chosen == EXACT, d), n.cast("long"), m.cast("long"))
    if method == SERIES:
        return kolmogorov_series(d, n, m)
    return exact if method == EXACT else F.when(chosen == EXACT, exact).otherwise(kolmogorov_series(d, n, m))


def k_squared(n: Column, skew: Column, excess: Column) -> Column:
    """Omnibus normality statistic from population skewness and excess kurtosis."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (F.lit(6.0) * (n - 2)))
    beta2 = (
        F.lit(3.0) * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(F.lit(2.0) * (beta2 - 1)) - 1
    delta = F.lit(1.0) / F.sqrt(F.lit(0.5) * F.log(w2))
    alpha = F.sqrt(F.lit(2.0) / (w2 - 1))
    z1 = delta * F.log(y / alpha + F.sqrt(y * y / (alpha * alpha) + 1))

    b2 = excess + 3
    expected = F.lit(3.0) * (n - 1) / (n + 1)
    var = F.lit(24.0) * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - expected) / F.sqrt(var)
    root_beta1 = (
        F.lit(6.0) * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(F.lit(6.0) * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = F.lit(6.0) + F.lit(8.0) / root_beta1 * (
        F.lit(2.0) / root_beta1 + F.sqrt(F.lit(1.0) + F.lit(4.0) / (root_beta1 * root_beta1))
    )
    inner = (F.lit(1.0) - F.lit(2.0) / a) / (F.lit(1.0) + x * F.sqrt(F.lit(2.0) / (a - 4)))
    cube = F.signum(inner) * F.pow(F.abs(inner), F.lit(1.0 / 3))
    z2 = (F.lit(1.0) - F.lit(2.0) / (F.lit(9.0) * a) - cube) / F.sqrt(F.lit(2.0) / (F.lit(9.0) * a))
    return z1 * z1 + z2 * z2


def jarque_bera(n: Column, skew: Column, excess: Column) -> Column:
    return n.cast("double") / 6 * (skew * skew + excess * excess / 4)


# Polynomial coefficients of the published approximation to the
# W test of normality (Royston 1995), constant term first.
ROYSTON_C1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
ROYSTON_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
ROYSTON_MU_SMALL = [0.5440, -0.39978, 0.025054, -0.0006714]
ROYSTON_SIGMA_SMALL = [1.3822, -0.77857, 0.062767, -0.0020322]
ROYSTON_GAMMA = [-2.273, 0.459]
ROYSTON_MU_LARGE = [-1.5861, -0.31082, -0.083751, 0.0038915]
ROYSTON_SIGMA_LARGE = [-0.4803, -0.082676, 0.0030302]


# Rational approximation to the normal quantile (Wichura 1988, algorithm AS 241),
# numerator and denominator of the middle and of the tails, constant term first.
QUANTILE_MIDDLE = (
    [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
    [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610],
)
QUANTILE_TAIL = (
    [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9],
)


def poly(coefficients: list[float], x: Column) -> Column:
    """Value of a polynomial by nested multiplication."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution for probabilities of 1e-10 and more on either side."""
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    middle = q * poly(QUANTILE_MIDDLE[0], r) / poly(QUANTILE_MIDDLE[1], r)
    t = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p))) - 1.6
    tail = F.signum(q) * poly(QUANTILE_TAIL[0], t) / poly(QUANTILE_TAIL[1], t)
    return F.when(F.abs(q) <= 0.425, middle).otherwise(tail)


def w_weights(n: Column, last: Column, second: Column, ssm: Column) -> tuple[Column, Column, Column]:
    """Weights of the largest and second largest value, and the divisor of all other normal scores.

    ``last`` and ``second`` are the two largest normal scores, ``ssm`` is the sum of squares of all.
    """
    u = F.lit(1.0) / F.sqrt(n)
    root = F.sqrt(ssm)
    top = F.when(n == 3, F.sqrt(F.lit(0.5))).otherwise(poly(ROYSTON_C1, u) + last / root)
    next_ = F.when(n > 5, poly(ROYSTON_C2, u) + second / root)
    both = (ssm - 2 * last * last - 2 * second * second) / (F.lit(1.0) - 2 * top * top - 2 * next_ * next_)
    one = (ssm - 2 * last * last) / (F.lit(1.0) - 2 * top * top)
    # With three values the middle score is 0, whatever it is divided by.
    return top, next_, F.sqrt(F.when(n > 5, both).when(n > 3, one).otherwise(ssm))


def w_p_value(w: Column, n: Column) -> Column:
    """Upper tail of the W statistic."""
    three = F.lit(6 / math.pi) * (F.asin(F.sqrt(w)) - F.asin(F.sqrt(F.lit(0.75))))
    y = F.log(F.lit(1.0) - w)
    edge = poly(ROYSTON_GAMMA, n)
    small = (-F.log(edge - y) - poly(ROYSTON_MU_SMALL, n)) / F.exp(poly(ROYSTON_SIGMA_SMALL, n))
    large = (y - poly(ROYSTON_MU_LARGE, F.log(n))) / F.exp(poly(ROYSTON_SIGMA_LARGE, F.log(n)))
    return (
        F.when(n == 3, F.greatest(F.lit(0.0), F.least(F.lit(1.0), three)))
        .when(w >= 1, F.lit(1.0))
        .when((n <= 11) & (y >= edge), F.lit(1e-99))
        .otherwise(normal_upper_tail(F.when(n <= 11, small).otherwise(large)))
    )


def normal_upper_tail(z: Column) -> Column:
    """1 - Phi(z) by the composite Simpson rule on the density, in the scaled form that keeps small tails.

    With x = |z| + s the tail is density(|z|) times the integral of exp(-|z| s - s*s/2).
    """
    x = F.abs(z)
    steps, reach = 240, 12.0
    h = reach / steps
    weight = lambda i: F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
    area = F.aggregate(
        F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda acc, i: acc + weight(i) * F.exp(-x * i * h - F.lit(h * h / 2) * i * i)
    ) * (h / 3)
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * area
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)
