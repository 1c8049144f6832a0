"""Named queries over the benchmark tables and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
ROW_DIGITS = 6


class Entry(NamedTuple):
    run: Query
    sql: str | None
    plain: Query  # without the rounding that the comparison needs


CATALOG: dict[str, Entry] = {}


def _near(x: Column, digits: int) -> Column:
    """``F.round``, which goes by way of text only where the last bits may decide."""
    power = float(10**digits)
    whole = F.rint(x * power)
    sure = (F.abs(x) < 1e12 / power) & (F.abs(x * power - whole) < 0.499)
    # No negative zero.
    return F.when(sure, whole / power + 0.0).otherwise(F.round(x, digits))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a fixed number of digits: sums depend on the order of rows.

    They are rounded as one list, so that many columns make no code too long to be compiled. The list
    is named twice, which keeps what makes the columns out of the rounding, where nothing is compiled.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not doubles:
        return df
    place = {c: i for i, c in enumerate(doubles)}
    every = df.withColumn("_given", F.array(*[f"`{c}`" for c in doubles]))
    whole = F.size("_given") == len(doubles)
    every = every.withColumn("_rounded", F.when(whole, F.transform("_given", lambda x: _near(x, digits))))
    return every.select(*[F.col("_rounded")[place[c]].alias(c) if c in place else F.col(f"`{c}`") for c in df.columns])


def query(
    name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = (), digits: int = DIGITS
):
    """Register a query; ``doubles`` are the columns the SQL still has to round.

    Tables with a row per flight use fewer digits: among that many values some
    would otherwise lie where the last bit decides the rounding.
    """

    def register(fn: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(
            lambda spark, path: rounded(fn(spark, path), digits), _rounded_sql(sql, doubles, digits), fn
        )
        return fn

    return register


def _rounded_sql(sql: str | None, doubles, digits: int) -> str | None:
    if sql is None or not doubles:
        return sql
    swaps = ", ".join(f"round({c}, {digits}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS result"
