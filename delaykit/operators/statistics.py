"""Correlation, regression, analysis of variance and effect size.

Each statistic is a formula over aggregates: one pass over the data, then
arithmetic on a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit.functions import moments
from delaykit.functions.tails import f_pvalue, t_pvalue
from delaykit.operators import wide
from delaykit.operators.lookups import lookup_join, settled

TARGET = "avg_delay_minutes"
FACTORS = (
    "month", "avg_late_aircraft_delay", "avg_weather_delay",
    "late_aircraft_delay_rate", "weather_delay_rate",
)
LINE_FACTORS = ("avg_weather_delay", "avg_late_aircraft_delay", "month")
SIGNIFICANCE = 0.05


def _long(totals: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = (TARGET,) + FACTORS) -> DataFrame:
    """Pearson correlation of every pair of columns, as (x, y, corr) rows."""
    names = sorted(cols)
    if len(names) > wide.WIDE:
        return wide.correlations(df, names)
    pairs = [(a, b) for a in names for b in names if a <= b]
    totals = df.agg(
        *[moments.correlation(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs]
    )
    return _long(
        totals,
        [
            F.struct(
                F.lit(a).alias("x"),
                F.lit(b).alias("y"),
                F.col(f"`{min(a, b)}|{max(a, b)}`").alias("corr"),
            )
            for a, b in product(names, names)
        ],
    )


def factor_significance(
    df: DataFrame, target: str = TARGET, factors: Sequence[str] = FACTORS
) -> DataFrame:
    """Correlation, R squared and t of each factor against the target."""
    y = F.col(target)
    totals = df.agg(
        *[moments.correlation(F.col(f), y).alias(f"r_{f}") for f in factors],
        *[moments.pair_count(F.col(f), y).alias(f"n_{f}") for f in factors],
    )
    rows = _long(
        totals,
        [
            F.struct(
                F.lit(f).alias("factor"), F.col(f"r_{f}").alias("corr"), F.col(f"n_{f}").alias("n")
            )
            for f in factors
        ],
    )
    return rows.select(
        "factor",
        "n",
        "corr",
        (F.col("corr") * F.col("corr")).alias("r2"),
        moments.correlation_t(F.col("corr"), F.col("n")).alias("t_stat"),
    )


def _judged(df: DataFrame, p: Column) -> DataFrame:
    return df.withColumn("p_value", p).withColumn(
        "significant", F.when(F.col("p_value") < SIGNIFICANCE, "Yes").otherwise("No")
    )


def factor_pvalues(significance: DataFrame) -> DataFrame:
    return _judged(significance, t_pvalue(F.col("t_stat"), (F.col("n") - 2).cast("double")))


def regression_params(
    df: DataFrame, target: str = TARGET, factors: Sequence[str] = LINE_FACTORS
) -> DataFrame:
    y = F.col(target)
    parts = []
    for f in factors:
        x = F.col(f)
        parts += [
            moments.slope(x, y).alias(f"s_{f}"),
            moments.intercept(x, y).alias(f"i_{f}"),
            moments.correlation(x, y).alias(f"r_{f}"),
        ]
    totals = df.agg(*parts)
    return _long(
        totals,
        [
            F.struct(
                F.lit(f).alias("factor"),
                F.col(f"s_{f}").alias("slope"),
                F.col(f"i_{f}").alias("intercept"),
                (F.col(f"r_{f}") * F.col(f"r_{f}")).alias("r2"),
            )
            for f in factors
        ],
    )


def regression_line(
    df: DataFrame, target: str = TARGET, factors: Sequence[str] = LINE_FACTORS
) -> DataFrame:
    """Every complete point with the fitted line's value at it."""
    params = regression_params(df, target, factors).select("factor", "slope", "intercept")
    points = (
        df.select(F.col(target).alias("y"), *[F.col(f).cast("double").alias(f) for f in factors])
        .unpivot(["y"], list(factors), "factor", "x")
        .na.drop(subset=["x", "y"])
    )
    return lookup_join(points, params, ["factor"]).select(
        "factor", "x", "y", (F.col("intercept") + F.col("slope") * F.col("x")).alias("predicted")
    )


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean and variance of the filled values of each group."""
    return (
        df.na.drop(subset=[group, value])
        .groupBy(F.col(group).alias("group"))
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.coalesce(F.var_samp(value), F.lit(0.0)).alias("var"),
        )
    )


def anova(df: DataFrame, group: str = "carrier_name", value: str = TARGET) -> DataFrame:
    """One-way F statistic with its degrees of freedom."""
    groups = settled(group_moments(df, group, value))
    total = F.sum("n")
    grand = F.try_divide(F.sum(F.col("n") * F.col("mean")), total)
    sums = groups.agg(
        F.count(F.lit(1)).alias("k"),
        total.alias("n"),
        F.sum((F.col("n") - 1) * F.col("var")).alias("within"),
        grand.alias("grand"),
    )
    spread = groups.withColumn("grand", sums.select("grand").scalar()).agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), F.lit(2))).alias("between")
    )
    return (
        sums.withColumn("between", spread.scalar())
        .withColumn("df_between", F.col("k") - 1)
        .withColumn("df_within", F.col("n") - F.col("k"))
        .select(
            "df_between",
            "df_within",
            F.try_divide(
                F.try_divide(F.col("between"), F.col("df_between")),
                F.try_divide(F.col("within"), F.col("df_within")),
            ).alias("f_stat"),
        )
    )


def anova_pvalue(result: DataFrame) -> DataFrame:
    return _judged(
        result,
        f_pvalue("f_stat", F.col("df_between").cast("double"), F.col("df_within").cast("double")),
    )


def _side(groups: DataFrame, mark: str) -> DataFrame:
    """Pooled n, mean and variance of the marked groups, from group moments."""
    chosen = groups.filter(F.col(mark))
    sums = chosen.agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"),
    )
    around = chosen.withColumn("centre", sums.select("mean").scalar()).agg(
        F.sum(
            (F.col("n") - 1) * F.col("var")
            + F.col("n") * F.pow(F.col("mean") - F.col("centre"), F.lit(2))
        ).alias("ss")
    )
    return sums.withColumn("ss", around.scalar())


def top_bottom_moments(
    df: DataFrame, group: str = "carrier_name", value: str = TARGET, n: int = 5
) -> DataFrame:
    """n, mean, sd and sum of squares of the top and bottom groups by mean."""
    groups = settled(group_moments(df, group, value))
    # Windows over one row per group.
    marked = groups.withColumns(
        {
            "_top": F.row_number().over(W.orderBy(F.desc("mean"), "group")) <= n,
            "_bottom": F.row_number().over(W.orderBy(F.asc("mean"), F.desc("group"))) <= n,
        }
    )
    sides = [_side(marked, m).withColumn("side", F.lit(m.strip("_"))) for m in ("_top", "_bottom")]
    return sides[0].unionByName(sides[1]).select(
        "side", "n", "mean", F.sqrt(F.try_divide(F.col("ss"), F.col("n") - 1)).alias("std"), "ss"
    )


def _sides_in_row(moments_table: DataFrame) -> DataFrame:
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    row = moments_table.agg(
        *[
            pick(side, c).alias(f"{side}_{c}")
            for side in ("top", "bottom")
            for c in ("n", "mean", "std", "ss")
        ]
    )
    pooled = F.try_divide(
        F.col("top_ss") + F.col("bottom_ss"), (F.col("top_n") + F.col("bottom_n") - 2).cast("double")
    )
    return row.withColumn("pooled_var", pooled).withColumn(
        "gap", F.col("top_mean") - F.col("bottom_mean")
    )


def top_bottom_ttest(moments_table: DataFrame) -> DataFrame:
    """Student t of the two sides with pooled variance."""
    row = _sides_in_row(moments_table)
    error = F.sqrt(F.col("pooled_var") * (1 / F.col("top_n") + 1 / F.col("bottom_n")))
    return row.select(
        "top_n", "top_mean", "top_std", "bottom_n", "bottom_mean", "bottom_std",
        (F.col("top_n") + F.col("bottom_n") - 2).alias("df"),
        F.try_divide(F.col("gap"), error).alias("t_stat"),
    )


def ttest_pvalue(result: DataFrame) -> DataFrame:
    return _judged(result, t_pvalue("t_stat", F.col("df").cast("double")))


def cohens_d(moments_table: DataFrame) -> DataFrame:
    row = _sides_in_row(moments_table).select(
        F.try_divide(F.col("gap"), F.sqrt("pooled_var")).alias("cohens_d")
    )
    size = F.abs("cohens_d")
    return row.withColumn(
        "effect", F.when(size > 0.8, "Large").when(size > 0.5, "Medium").otherwise("Small")
    )
