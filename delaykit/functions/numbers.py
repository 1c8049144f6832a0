"""Null-safe numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a number or a whole number in text input.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"


def to_number(text: Column) -> Column:
    """Text to double; text that is not a number is null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def number_or_null(col: Column) -> Column:
    """Double column with NaN turned into null."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """A column as double by what it is: only text is parsed."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return to_number(col)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number_or_null(col)
    return col.cast("double")


def to_whole(text: Column) -> Column:
    """Whole number or null; ``'13.0'`` is not whole."""
    return F.when(text.rlike(WHOLE), F.trim(text).try_cast("bigint"))


def as_whole(df: DataFrame, name: str) -> Column:
    """A column as whole number by what it is: only text is parsed, fractions are cut."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_whole(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number_or_null(F.col(name)).cast("bigint")
    return F.col(name)


def hhmm_to_hour(hhmm: Column) -> Column:
    """HHMM clock value to an hour kept within 0..23; null stays null."""
    hour = F.floor(hhmm / F.lit(100.0)).cast("int")
    # greatest and least skip nulls, so the null has to go through on its own.
    return F.when(hhmm.isNotNull(), F.least(F.lit(23), F.greatest(F.lit(0), hour)))


def over_or_one(numerator: Column, denominator: Column) -> Column:
    """Ratio whose zero denominator counts as one."""
    return numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)


def over_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio that is zero unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def row_count(cols: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + c.isNotNull().cast("int")
    return total


def row_sum(cols: Sequence[Column]) -> Column:
    """Sum across columns skipping nulls; zero when all are null."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
    return total


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean across columns skipping nulls; null when all are null."""
    n = row_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_max(cols: Sequence[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def row_min(cols: Sequence[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]
