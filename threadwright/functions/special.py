"""Tail probabilities as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_SHIFT = 20
#: Expansion of gamma(z + 1/2) / gamma(z) / sqrt(z) in powers of 1 / z.
_HALF_STEP = [1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304]


def _not_zero(value: Column) -> Column:
    return F.when(F.abs(value) < _TINY, F.lit(_TINY)).otherwise(value)


def half_step(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a) for positive ``a``; the expansion is taken at ``a + 20``."""
    z = a + _SHIFT
    series = F.lit(0.0)
    for factor in reversed(_HALF_STEP):
        series = series / z + factor
    steps = F.sequence(F.lit(0), F.lit(_SHIFT - 1))
    back = F.aggregate(steps, F.lit(1.0), lambda p, i: p * ((a + i) / (a + i + 0.5)))
    return F.sqrt(z) * series * back


def beta_fraction(a: Column, b: Column, x: Column, terms: Column) -> Column:
    """Continued fraction of the incomplete beta function, evaluated forwards with ``terms`` terms."""

    def step(state: Column, s: Column) -> Column:
        m = F.floor(s / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = F.when(s % 2 == 0, even).otherwise(odd)
        d = 1 / _not_zero(1 + value * state["d"])
        c = _not_zero(1 + value / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    first = 1 / _not_zero(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(2).cast("long"), terms.cast("long")), start, step, lambda state: state["h"])


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided probability of a Pearson correlation at least as strong as ``r`` among ``n`` unrelated pairs.

    This is the regularised incomplete beta function I(1 - r^2; (n - 2) / 2, 1/2), the tail of Student's t with
    n - 2 degrees of freedom. 1 for two pairs, 0 for a perfect correlation of more, null without ``r``.
    """
    a = (n.cast("double") - 2) / 2
    y = r * r
    x = 1 - y
    front = F.exp(a * F.log1p(-y)) * F.sqrt(y) * half_step(a) / math.sqrt(math.pi)
    half = F.lit(0.5)
    terms = 200 + F.ceil(8 * F.sqrt(a))  # convergence takes about the root of the larger parameter
    low = front * beta_fraction(a, half, x, terms) / a
    high = 1 - 2 * front * beta_fraction(half, a, y, terms)
    tail = F.when(x < (a + 1) / (a + 2.5), low).otherwise(high)
    return F.when(r.isNull() | (n < 2), None).when(n == 2, 1.0).when(y >= 1, 0.0).otherwise(tail)
