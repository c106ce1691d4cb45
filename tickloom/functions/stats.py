"""Correlation that yields null, not an error, on constant input."""

from __future__ import annotations

from collections.abc import Callable
from math import exp, lgamma, log

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_number(x: Column) -> Column:
    """NaN becomes null so that aggregates skip it."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def pearson(x: Column, y: Column, over: Callable[[Column], Column] = lambda c: c) -> Column:
    """Pearson correlation over the rows where both sides are present.

    ``over`` turns each aggregate into a window aggregate where needed.
    """
    x, y = clean_number(x), clean_number(y)
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = over(F.stddev_pop(xs)) * over(F.stddev_pop(ys))
    return F.try_divide(over(F.covar_pop(x, y)), F.nullif(spread, F.lit(0.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz steps)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return value


def pearson_p_value(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a correlation ``r`` seen on ``n`` pairs (Student t with n-2 degrees)."""
    if r is None or r != r or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    if r * r == 0.0:
        return 1.0
    df = n - 2
    x = 1.0 - r * r  # equals df / (df + t^2)
    a, b = df / 2.0, 0.5
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(r * r))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
