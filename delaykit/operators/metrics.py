"""Rates, average minutes and cause shares of delay-cause reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes, numbers

Ratio = Callable[[Column, Column], Column]


def _rates(ratio: Ratio) -> dict[str, Column]:
    flights = F.col("arr_flights")
    rates = {"total_delay_rate": ratio(F.col("arr_del15"), flights)}
    for cause in K.CAUSES:
        rates[f"{cause}_delay_rate"] = ratio(F.col(f"{cause}_ct"), flights)
    return rates


def _averages(ratio: Ratio) -> dict[str, Column]:
    averages = {"avg_delay_minutes": ratio(F.col("arr_delay"), F.col("arr_del15"))}
    for cause in K.CAUSES:
        averages[f"avg_{cause}_delay"] = ratio(F.col(f"{cause}_delay"), F.col(f"{cause}_ct"))
    return averages


def delay_rates_strict(df: DataFrame) -> DataFrame:
    """Rates over the flights; expects rows with flights only."""
    flights = F.col("arr_flights")
    return df.withColumns(
        {
            **_rates(lambda n, d: n / d),
            "cancellation_rate": F.col("arr_cancelled") / flights,
            "diversion_rate": F.col("arr_diverted") / flights,
        }
    )


def delay_rates_safe(df: DataFrame) -> DataFrame:
    """Rates whose zero denominator counts as one."""
    return df.withColumns(_rates(numbers.over_or_one))


def avg_delay_minutes_strict(df: DataFrame) -> DataFrame:
    """Minutes per delay, zero where nothing was delayed or the count is null."""
    return df.withColumns(_averages(numbers.over_or_zero))


def avg_delay_minutes_safe(df: DataFrame) -> DataFrame:
    return df.withColumns(_averages(numbers.over_or_one))


def delay_cause_pct(df: DataFrame) -> DataFrame:
    """Share of each cause in the cause counts, in percent."""
    total = F.col(K.CAUSE_COUNTS[0])
    for c in K.CAUSE_COUNTS[1:]:
        total = total + F.col(c)
    divisor = F.when(total > 0, total).otherwise(F.lit(1.0))
    return df.withColumns(
        {f"{cause}_delay_pct": F.col(f"{cause}_ct") / divisor * F.lit(100.0) for cause in K.CAUSES}
    )


def with_month_start(df: DataFrame) -> DataFrame:
    return df.withColumn("date", codes.month_start(F.col("year"), F.col("month")))


def delay_metrics(df: DataFrame) -> DataFrame:
    """All strict metrics of a cleaned report."""
    return (
        df.transform(delay_rates_strict)
        .transform(avg_delay_minutes_strict)
        .transform(delay_cause_pct)
    )


def delay_history(df: DataFrame) -> DataFrame:
    """The twelve safe statistics used to enrich flights, dated by month."""
    return (
        df.transform(with_month_start)
        .transform(delay_rates_safe)
        .transform(avg_delay_minutes_safe)
    )
