"""Tail probabilities of the t and F distributions, as column expressions.

Both are the incomplete beta function, a continued fraction that ``aggregate`` follows
over a sequence of steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Steps of the fraction: the square root of the larger parameter is about enough.
STEPS = 1000
TINY = 1e-300
# From here on Stirling's series is exact to the last digits.
LARGE = 12


def log_gamma(z: Column) -> Column:
    """The logarithm of the gamma function of a positive number."""

    def series(w: Column) -> Column:
        v = 1 / (w * w)
        rest = (F.lit(1 / 12) - v * (F.lit(1 / 360) - v * (F.lit(1 / 1260) - v / 1680))) / w
        return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + rest

    product = z
    for i in range(1, LARGE):
        product = product * (z + i)
    return F.when(z >= LARGE, series(z)).otherwise(series(z + LARGE) - F.log(product))


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) > TINY, x).otherwise(F.lit(TINY))


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction, by its convergents (modified Lentz)."""

    def coefficient(j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 1, odd).otherwise(m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))

    def state(c: Column, d: Column, value: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), value.alias("value"))

    def step(s: Column, j: Column) -> Column:
        k = coefficient(j)
        d = 1 / _away_from_zero(1 + k * s["d"])
        c = _away_from_zero(1 + k / s["c"])
        return state(c, d, s["value"] * d * c)

    first = 1 / _away_from_zero(1 + coefficient(F.lit(1)))
    return F.aggregate(
        F.sequence(F.lit(2), F.lit(STEPS)), state(F.lit(1.0), first, first), step, lambda s: s["value"]
    )


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function; null where a parameter is not positive."""
    swapped = x > (a + 1) / (a + b + 2)
    given = F.struct(
        swapped.alias("swapped"),
        F.when(swapped, b).otherwise(a).alias("a"),
        F.when(swapped, a).otherwise(b).alias("b"),
        F.when(swapped, 1 - x).otherwise(x).alias("x"),
    )

    def value(s: Column) -> Column:
        p, q, y = s["a"], s["b"], s["x"]
        front = log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(y) + q * F.log1p(-y)
        part = F.exp(front) / p * _fraction(p, q, y)
        return F.when(s["swapped"], 1 - part).otherwise(part)

    # A lambda names the parameters once, however often the formula uses them.
    inner = F.transform(F.array(given), value)[0]
    known = (a > 0) & (b > 0) & ~F.isnan(x)
    return F.when(known, F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(inner))


def t_pvalue(t: Column | str, df: Column | str) -> Column:
    """Two-sided p-value of a t statistic; null without a statistic or degrees of freedom."""
    t, df = _double(t), _double(df)
    return F.when(df > 0, incomplete_beta(df / 2, F.lit(0.5), df / (df + t * t)))


def f_pvalue(f: Column | str, df1: Column | str, df2: Column | str) -> Column:
    """Upper tail of an F statistic; null without a statistic or degrees of freedom."""
    f, df1, df2 = _double(f), _double(df1), _double(df2)
    return F.when((df1 > 0) & (df2 > 0), incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)))


def _double(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")
