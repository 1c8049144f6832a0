"""Codes, keys and calendar fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaykit import constants as K


# What ``\s`` stands for in a pattern; trimming needs none and is much faster.
WHITE = " \t\n\x0b\f\r"


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col, F.lit(WHITE))


def normalize_code(col: Column) -> Column:
    return F.upper(strip(col))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def route(origin: Column, dest: Column) -> Column:
    return F.concat(origin, F.lit("-"), dest)


def flight_key(carrier: Column, number: Column) -> Column:
    return F.concat(
        normalize_code(F.coalesce(carrier, F.lit(""))),
        strip(F.coalesce(number.cast("string"), F.lit(""))),
    )


def flight_number_parts(text: Column, upper_only: bool = False) -> tuple[Column, Column]:
    """(carrier, number) of a flight number, both null when it does not parse."""
    pattern = K.FLIGHT_NUMBER_UPPER if upper_only else K.FLIGHT_NUMBER_ANY_CASE
    ok = text.rlike(pattern)
    return (
        F.when(ok, F.upper(F.regexp_extract(text, pattern, 1))),
        F.when(ok, F.regexp_extract(text, pattern, 2)),
    )


def is_airport_code(col: Column) -> Column:
    return F.coalesce(normalize_code(col).rlike(K.AIRPORT_CODE), F.lit(False))


def to_date(col: Column) -> Column:
    return F.try_to_date(col.cast("string"))


def is_weekend(date: Column) -> Column:
    return F.weekday(date).isin(*K.WEEKEND).cast("int")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def one_of(col: Column, values: Iterable) -> Column:
    return col.isin(*list(values))
