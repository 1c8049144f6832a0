"""Grouped summaries and lookups.

Means are unweighted means of the rows, as the tables have always been defined;
rollups of summaries are therefore means of means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes, labels
from delaykit.operators.lookups import rename_all
from delaykit.operators.selection import first_per_key


SKETCH_SIZE = 14


def total(col: str) -> Column:
    """Sum that is zero when every value is null."""
    return F.coalesce(F.sum(col), F.lit(0.0)).alias(col)


def _grouped(df: DataFrame, keys: Sequence[str], sums: Sequence[str], means: Sequence[str]) -> DataFrame:
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(*[total(c) for c in sums], *[F.avg(c).alias(c) for c in means])
    )


def airport_summary(metrics: DataFrame) -> DataFrame:
    return _grouped(metrics, ["airport", "year", "month"], K.SUMMED, K.AVERAGED)


def carrier_summary(metrics: DataFrame) -> DataFrame:
    return _grouped(metrics, ["carrier", "year", "month"], K.SUMMED, K.AVERAGED)


def monthly_trends(metrics: DataFrame) -> DataFrame:
    grouped = _grouped(
        metrics,
        ["year", "month"],
        ("arr_flights", "arr_del15", "arr_delay"),
        ("total_delay_rate", "avg_delay_minutes") + K.CAUSE_SHARES[:3],
    )
    return grouped.withColumn("date", codes.month_start(F.col("year"), F.col("month")))


def carrier_airport_month_lookup(history: DataFrame) -> DataFrame:
    return _grouped(
        history, ["carrier", "airport", "year", "month"], ("arr_flights",), K.HISTORY
    )


def airport_lookup(history: DataFrame) -> DataFrame:
    """Mean history by airport, in the column names scoring expects."""
    means = _grouped(history, ["airport"], (), K.HISTORY)
    return rename_all(means.withColumnRenamed("airport", "ORIGIN"), ["ORIGIN"], "_origin")


def carrier_lookup(history: DataFrame) -> DataFrame:
    means = _grouped(history, ["carrier"], (), K.HISTORY)
    return rename_all(means.withColumnRenamed("carrier", "OP_CARRIER"), ["OP_CARRIER"], "_origin")


def enriched_lookup(enriched: DataFrame, key: str) -> DataFrame | None:
    """The same means over enriched flights; nothing when they carry no history."""
    if not {"total_delay_rate_origin", "carrier_delay_rate_origin"} & set(enriched.columns):
        return None
    return _grouped(enriched, [key], (), K.HISTORY_ORIGIN)


def route_counts(flights: DataFrame) -> DataFrame:
    """Delay totals by carrier, origin and destination: enough for every
    target encoding, read from the flights once."""
    return (
        flights.na.drop(subset=["OP_CARRIER", "ORIGIN", "DEST"])
        .groupBy("OP_CARRIER", "ORIGIN", "DEST")
        .agg(F.sum("DEP_DELAY").alias("delay_sum"), F.count("DEP_DELAY").alias("delay_n"))
    )


def mean_from_counts(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return counts.groupBy(*keys).agg(
        F.try_divide(F.sum("delay_sum"), F.sum("delay_n")).alias(name)
    )


def group_mean_delays(flights: DataFrame) -> DataFrame:
    """Mean delay by route, origin and carrier in one long table."""
    counts = route_counts(flights).withColumn("route", codes.route(F.col("ORIGIN"), F.col("DEST")))
    keyed = counts.select(
        "delay_sum",
        "delay_n",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(kind).alias("group_type"), F.col(col).alias("group_key"))
                    for kind, col in (("route", "route"), ("origin", "ORIGIN"), ("airline", "OP_CARRIER"))
                ]
            )
        ),
    )
    return mean_from_counts(keyed, ["group_type", "group_key"], "avg_delay")


def flight_lookup_mode(flights: DataFrame) -> DataFrame:
    """Most frequent (origin, destination, hour) of each flight key."""
    counted = (
        flights.withColumn("flight_key", codes.flight_key(F.col("OP_CARRIER"), F.col("FL_NUM")))
        .withColumnRenamed("DEP_HOUR", "dep_hour")
        .na.drop(subset=["ORIGIN", "DEST", "dep_hour"])
        .groupBy("flight_key", "ORIGIN", "DEST", "dep_hour")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return first_per_key(
        counted, ["flight_key"], [F.col("count").desc(), "ORIGIN", "DEST", "dep_hour"]
    )


def cause_totals_share(metrics: DataFrame) -> DataFrame:
    """Total of each cause and its share of them all, largest first."""
    sums = metrics.agg(*[total(c) for c in K.CAUSE_COUNTS])
    every = F.lit(0.0)
    for c in K.CAUSE_COUNTS:
        every = every + F.col(c)
    rows = [
        F.struct(
            F.lit(cause).alias("cause"),
            F.col(f"{cause}_ct").alias("delays"),
            F.try_divide(F.col(f"{cause}_ct") * F.lit(100.0), every).alias("share_pct"),
        )
        for cause in K.CAUSES
    ]
    return sums.select(F.inline(F.array(*rows))).orderBy(F.desc("delays"), "cause")


def dataset_kpis(metrics: DataFrame) -> DataFrame:
    """Size, span and headline rates.

    Distinct counts come from the pairs table, so the rows are read once and
    not multiplied for them.
    """
    pairs = metrics.groupBy("airport", "carrier").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("year").alias("y0"),
        F.max("year").alias("y1"),
        F.min("month").alias("m0"),
        F.max("month").alias("m1"),
        F.sum("arr_flights").alias("flights"),
        F.sum("arr_del15").alias("delays"),
        F.sum("avg_delay_minutes").alias("minutes_sum"),
        F.count("avg_delay_minutes").alias("minutes_n"),
    )
    return pairs.agg(
        F.sum("n").alias("n_records"),
        F.count_distinct("airport").alias("n_airports"),
        F.count_distinct("carrier").alias("n_carriers"),
        F.min("y0").alias("min_year"),
        F.max("y1").alias("max_year"),
        F.min("m0").alias("min_month"),
        F.max("m1").alias("max_month"),
        F.sum("flights").alias("total_flights"),
        F.sum("delays").alias("total_delays"),
        F.try_divide(F.sum("delays") * F.lit(100.0), F.sum("flights")).alias("delay_rate_pct"),
        F.try_divide(F.sum("minutes_sum"), F.sum("minutes_n")).alias("mean_delay_minutes"),
    )


def monthly_sketches(metrics: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per month to be stored: sums, and sketches of its airports and carriers.

    Sketches are merged, so the distinct counts of any period follow from its months without the
    rows. With 2^14 registers the error is below 1 % for many codes, and a few thousand are
    counted all but exactly.
    """
    return metrics.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("arr_flights").alias("flights"),
        F.sum("arr_del15").alias("delays"),
        F.sum("avg_delay_minutes").alias("minutes_sum"),
        F.count("avg_delay_minutes").alias("minutes_n"),
        F.hll_sketch_agg("airport", size).alias("airports"),
        F.hll_sketch_agg("carrier", size).alias("carriers"),
    )


def kpis_from_sketches(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``dataset_kpis`` of all months given, or of each group of them; distinct counts are estimates."""
    return months.groupBy(*by).agg(
        F.sum("n").alias("n_records"),
        F.hll_sketch_estimate(F.hll_union_agg("airports")).alias("n_airports"),
        F.hll_sketch_estimate(F.hll_union_agg("carriers")).alias("n_carriers"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.min("month").alias("min_month"),
        F.max("month").alias("max_month"),
        F.sum("flights").alias("total_flights"),
        F.sum("delays").alias("total_delays"),
        F.try_divide(F.sum("delays") * F.lit(100.0), F.sum("flights")).alias("delay_rate_pct"),
        F.try_divide(F.sum("minutes_sum"), F.sum("minutes_n")).alias("mean_delay_minutes"),
    )


def kpis_of_period(months: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """KPIs of the months from ``first`` to ``last``, both (year, month) and included."""
    month = F.col("year") * 12 + F.col("month")
    return kpis_from_sketches(months.filter(month.between(first[0] * 12 + first[1], last[0] * 12 + last[1])))


def _group_means(df: DataFrame, key: str, value: str) -> DataFrame:
    return (
        df.na.drop(subset=[key])
        .groupBy(key)
        .agg(F.avg(value).alias("mean"), F.count(value).alias("count"), F.stddev_samp(value).alias("std"))
    )


def airport_ranking(df: DataFrame, value: str = "avg_delay_minutes") -> DataFrame:
    """Mean delay by airport, worst first."""
    return (
        df.na.drop(subset=["airport"])
        .groupBy("airport")
        .agg(F.avg(value).alias("mean_delay"))
        .orderBy(F.desc("mean_delay"), "airport")
    )


def ranking_statistics(ranking: DataFrame, key: str = "airport", value: str = "mean_delay", n: int = 5) -> DataFrame:
    """Figures over the group means: overall, span, count, worst and best n."""
    worst = F.row_number().over(W.orderBy(F.desc(value), key)) <= n
    best = F.row_number().over(W.orderBy(F.asc(value), F.desc(key))) <= n
    # One row per group: the window sorts group means, not data.
    marked = ranking.withColumn("_worst", worst).withColumn("_best", best)
    return marked.agg(
        F.avg(value).alias("overall_mean"),
        (F.max(value) - F.min(value)).alias("span"),
        F.count(F.lit(1)).alias("n_groups"),
        F.avg(F.when(F.col("_worst"), F.col(value))).alias("worst_mean"),
        F.avg(F.when(F.col("_best"), F.col(value))).alias("best_mean"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
    )


def carrier_ranking(df: DataFrame, value: str = "avg_delay_minutes", digits: int = 2) -> DataFrame:
    ranked = _group_means(df, "carrier_name", value)
    return ranked.select(
        "carrier_name",
        F.round("mean", digits).alias("mean"),
        "count",
        F.round("std", digits).alias("std"),
    ).orderBy(F.desc("mean"), "carrier_name")


def month_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    measures = (
        "avg_delay_minutes", "avg_weather_delay", "avg_late_aircraft_delay",
        "weather_delay_rate", "late_aircraft_delay_rate",
    )
    return (
        df.na.drop(subset=["month"])
        .groupBy("month")
        .agg(*[F.round(F.avg(c), digits).alias(c) for c in measures])
        .orderBy("month")
    )


def summary_rollup(summary: DataFrame, key: str) -> DataFrame:
    """Second level over a monthly summary, by airport or carrier."""
    return summary.groupBy(key).agg(
        F.avg("total_delay_rate").alias("total_delay_rate"),
        F.avg("avg_delay_minutes").alias("avg_delay_minutes"),
        F.sum("arr_flights").alias("arr_flights"),
        *[F.avg(c).alias(c) for c in K.CAUSE_SHARES[:3]],
    )


def top_groups(rollup: DataFrame, key: str, by: str, n: int = 15) -> DataFrame:
    return rollup.select(key, by).orderBy(F.desc(by), key).limit(n)


def top_causes(rollup: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Top groups by carrier share, one row per group and cause."""
    top = rollup.orderBy(F.desc(K.CAUSE_SHARES[0]), key).limit(n)
    return top.unpivot([key], list(K.CAUSE_SHARES[:3]), "cause", "pct")


def top_bottom_groups(ranking: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    """First and last n groups of a ranking by descending value."""
    top = ranking.orderBy(F.desc(value), key).limit(n).withColumn("side", F.lit("top"))
    bottom = ranking.orderBy(F.asc(value), F.desc(key)).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", key, value)


def volume_vs_rate(rollup: DataFrame, key: str) -> DataFrame:
    return rollup.select(key, "arr_flights", "total_delay_rate", "avg_delay_minutes")


def category_counts(flights: DataFrame, delay: str = "DEP_DELAY") -> DataFrame:
    return (
        flights.withColumn("delay_category", labels.delay_category(F.col(delay)))
        .na.drop(subset=["delay_category"])
        .groupBy("delay_category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sample_weight_report(flights: DataFrame, delay: str = "DEP_DELAY") -> DataFrame:
    weighted = flights.select(labels.sample_weight(F.col(delay)).alias("w"))
    return weighted.agg(
        F.min("w").alias("min_weight"), F.max("w").alias("max_weight"), F.avg("w").alias("mean_weight")
    )


def distinct_combinations(df: DataFrame, keys: Sequence[str] = ("carrier", "airport", "month")) -> DataFrame:
    return df.na.drop(subset=list(keys)).select(*keys).distinct()
