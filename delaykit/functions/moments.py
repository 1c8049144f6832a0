"""Pairwise-complete moments that never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def both(x: Column, y: Column) -> tuple[Column, Column]:
    """The two columns with both null where either is."""
    ok = x.isNotNull() & y.isNotNull()
    return F.when(ok, x.cast("double")), F.when(ok, y.cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, null when either side does not vary."""
    x, y = both(x, y)
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.when(spread > 0, F.try_divide(F.covar_samp(x, y), spread))


def pair_count(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))


def slope(x: Column, y: Column) -> Column:
    x, y = both(x, y)
    return F.try_divide(F.covar_samp(x, y), F.var_samp(x))


def intercept(x: Column, y: Column) -> Column:
    a, b = both(x, y)
    return F.avg(b) - slope(x, y) * F.avg(a)


def correlation_t(r: Column, n: Column) -> Column:
    """t statistic of a correlation over n pairs."""
    return F.when(
        (n > 2) & (F.abs(r) < 1),
        r * F.sqrt(F.try_divide((n - 2).cast("double"), F.greatest(1 - r * r, F.lit(0.0)))),
    )
