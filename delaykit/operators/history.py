"""Queries over the history of past predictions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators.selection import first_per_key

SORTS = {
    "newest": (F.desc, "timestamp"),
    "oldest": (F.asc, "timestamp"),
    "flight_number": (F.asc, "flight_number"),
    "predicted_delay": (F.desc, "predicted_delay"),
}


def history_key(flight: Column, origin: Column, dest: Column, date: Column, hour: Column) -> Column:
    return F.concat_ws("_", flight, origin, dest, date.cast("string"), hour.cast("string"))


def with_history_key(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "history_key",
        history_key(*[F.col(c) for c in (
            "flight_number", "origin", "destination", "flight_date", "departure_hour")]),
    )


def history_filter(history: DataFrame, kind: str, now: datetime | str | None = None, n: int = 10) -> DataFrame:
    """``recent`` (last n), ``week`` (seven days before now), ``high`` or ``low``."""
    if kind == "recent":
        # Ties on the time are settled by every column.
        return history.orderBy(F.desc("timestamp"), *history.columns).limit(n)
    if kind == "week":
        moment = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
        return history.filter(F.col("timestamp").cast("timestamp") >= moment - F.expr("INTERVAL 7 DAYS"))
    if kind == "high":
        return history.filter(F.col("predicted_delay") > K.SEVERITY_LIMITS[1])
    if kind == "low":
        return history.filter(F.col("predicted_delay") < K.SEVERITY_LIMITS[0])
    raise ValueError(f"unknown filter {kind!r}")


def history_sort(history: DataFrame, by: str = "newest") -> DataFrame:
    direction, column = SORTS[by]
    return history.orderBy(direction(column), *[c for c in history.columns if c != column])


def history_dedup(history: DataFrame) -> DataFrame:
    """First entry of every history key by time."""
    others = [c for c in history.columns if c not in ("history_key", "timestamp")]
    return first_per_key(history, ["history_key"], ["timestamp", *others])


def history_stats(history: DataFrame) -> DataFrame:
    p = F.col("predicted_delay")
    return history.agg(
        F.avg(p).alias("mean_delay"),
        F.max(p).alias("max_delay"),
        F.min(p).alias("min_delay"),
        F.count(F.lit(1)).alias("n_predictions"),
    )


def first_record_per_key(df: DataFrame, keys=("carrier", "airport")) -> DataFrame:
    """Earliest record of each key by year and month."""
    time = [c for c in ("year", "month") if c in df.columns and c not in keys]
    others = [c for c in df.columns if c not in keys and c not in time]
    return first_per_key(df.na.drop(subset=list(keys)), list(keys), time + others)
