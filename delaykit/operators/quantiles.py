"""Exact quantiles that no single task has to hold.

A sketch gives a bracket around each quantile. One more pass counts the values inside
the brackets, each distinct value once, and all rows of a gap between brackets as one.
What is counted is cut into ranges at approximate quantiles, which gives ranges of
similar size whatever the distribution; running counts over the ranges place every
range, and a running count inside each range places every value.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit.operators.lookups import settled

RANGES = 128
# The sketch's rank error is one in so many rows; a bracket reaches four errors to each side.
ACCURACY = 10_000
REACH = 4 / ACCURACY


def placed_values(df: DataFrame, col: str, ranges: int = RANGES) -> DataFrame:
    """Distinct values with ``first`` and ``last``, the zero-based ranks they hold."""
    counted = (
        df.na.drop(subset=[col])
        .groupBy(F.col(col).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _placed(settled(counted), ranges)


def _placed(counted: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The ranks of ``counted`` rows (``value``, ``n`` and any others)."""
    others = [c for c in counted.columns if c not in ("value", "n")]
    steps = [i / ranges for i in range(1, ranges)]
    # A fixed number of edges, whatever the data.
    edges = counted.agg(F.percentile_approx("value", steps, 10_000)).first()[0] or []
    listed = F.array(*[F.lit(float(e)) for e in sorted(set(edges))]).cast("array<double>")
    placed = counted.withColumn("bucket", F.size(F.filter(listed, lambda e: e <= F.col("value"))))
    totals = placed.groupBy("bucket").agg(F.sum("n").alias("bucket_n"))
    offsets = totals.select(
        "bucket", (F.sum("bucket_n").over(W.orderBy("bucket")) - F.col("bucket_n")).alias("before")
    )
    inner = W.partitionBy("bucket").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = F.sum("n").over(inner)
    return (
        placed.withColumn("upto", upto)
        .join(offsets, "bucket")
        .select(
            "value",
            *others,
            (F.col("before") + F.col("upto") - F.col("n")).alias("first"),
            (F.col("before") + F.col("upto") - 1).alias("last"),
        )
    )


def quantile_aggregates(size: Column, probs: Sequence[float], names: Sequence[str]) -> list[Column]:
    """Linear-interpolated quantiles as aggregates over ``placed_values``."""
    out = []
    for p, name in zip(probs, names):
        at = (size - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        below = F.max(F.when((F.col("first") <= low) & (low <= F.col("last")), F.col("value")))
        above = F.max(F.when((F.col("first") <= high) & (high <= F.col("last")), F.col("value")))
        share = F.max(at - low)
        out.append((below + (above - below) * share).alias(name))
    return out


def _sketch(value: Column, probs: Sequence[float]) -> list[Column]:
    """``size`` and the ends of a bracket around each quantile, as aggregates."""
    ends = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-REACH, REACH)]
    known = F.when(~F.isnan(value), value)
    return [F.count(known).alias("size"), F.percentile_approx(known, ends, ACCURACY).alias("ends")]


def _bracketed(df: DataFrame, col: str, ends: Sequence[float]) -> DataFrame:
    """Values inside the brackets and how many rows have them; ``gap`` marks the rows between."""
    value = F.col("value")
    inside = reduce(
        operator.or_, [value.between(F.lit(low), F.lit(high)) for low, high in zip(ends[::2], ends[1::2])]
    )
    passed = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= value))
    rows = df.na.drop(subset=[col]).select(F.col(col).cast("double").alias("value"))
    rows = rows.select("value", F.when(~inside, passed).alias("gap"), F.when(inside, value).alias("at"))
    # Summed up per task before the shuffle, so a gap sends one row a task.
    counted = rows.groupBy("gap", "at").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    return counted.select("value", "n", F.col("gap").isNotNull().alias("gap"))


def _from_sketch(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str], size: int, ends) -> DataFrame:
    if size > ACCURACY:
        ranked = _placed(settled(_bracketed(df, col, ends)))
        held = [
            (F.col("first") <= at) & (at <= F.col("last"))
            for p in probs
            for at in (F.floor(F.lit((size - 1) * p)), F.ceil(F.lit((size - 1) * p)))
        ]
        missed = F.max(F.col("gap") & reduce(operator.or_, held)).alias("_missed")
        found = settled(ranked.agg(*quantile_aggregates(F.lit(size), probs, names), missed))
        if not found.first()["_missed"]:
            return found.drop("_missed")
    # Tables below the sketch's accuracy, and a bracket that its quantile lies outside of.
    return placed_values(df, col).agg(*quantile_aggregates(F.lit(size), probs, names))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Linear-interpolated quantiles of the filled values, in two passes; nulls if there are none."""
    row = df.agg(*_sketch(F.col(col).cast("double"), probs)).first()
    return _from_sketch(df, col, probs, names, row["size"], row["ends"])


def delay_distribution(df: DataFrame, col: str = "DEP_DELAY") -> DataFrame:
    """Moments, shares above 0 and 15 and the five-number summary, in two passes."""
    value = F.col(col)
    names, probs = ("p25", "p50", "p75"), (0.25, 0.5, 0.75)
    base = settled(
        df.agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            (F.avg((value > 0).cast("double")) * 100).alias("pct_delayed"),
            (F.avg((value > 15).cast("double")) * 100).alias("pct_highly_delayed"),
            *_sketch(value.cast("double"), probs),
        )
    )
    row = base.first()
    quartiles = _from_sketch(df, col, probs, names, row["size"], row["ends"])
    packed = quartiles.select(F.struct(*names).alias("q")).scalar()
    return base.drop("size", "ends").withColumn("_q", packed).select(
        *[c for c in base.columns if c not in ("size", "ends")],
        *[F.col("_q").getField(c).alias(c) for c in names],
    )


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Cheaper form for exploration: one pass, relative rank error 1/accuracy."""
    return df.agg(F.percentile_approx(col, list(probs), accuracy).alias("quantiles"))
