"""Train and test splits and samples of exact size.

Membership follows from the rows' content, so a split is the same on every run
and on every cluster size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit.functions import labels
from delaykit.operators.lookups import settled
from delaykit.operators.selection import digest, take_exact, take_exact_overall


def _named(df: DataFrame, flag: str = "picked") -> DataFrame:
    return df.withColumn("split", F.when(F.col(flag), "train").otherwise("test")).drop(flag)


def temporal_split(
    df: DataFrame, date: str = "FL_DATE", test_size: float = 0.2, base: DataFrame | None = None
) -> DataFrame:
    """Earliest rows train, the rest test; ``split`` says which.

    Rows per date place the cut on one date. Only that date is divided, by
    digest, so no date has to fit a task. ``base`` may give the same rows before
    other joins: its columns come out, and only the date that is divided is read
    from ``df``, for the digest.
    """
    dated = (df if base is None else base).na.drop(subset=[date])
    # One row per calendar day.
    per_date = settled(dated.groupBy(date).agg(F.count(F.lit(1)).alias("n")))
    running = per_date.withColumn("upto", F.sum("n").over(W.orderBy(date)))
    size = F.floor(F.sum("n").over(W.partitionBy()) * F.lit(1 - test_size))
    edge = settled(
        running.withColumn("size", size)
        .filter((F.col("size") > F.col("upto") - F.col("n")) & (F.col("size") <= F.col("upto")))
        .select(
            F.col(date).alias("edge"), (F.col("size") - F.col("upto") + F.col("n")).alias("need")
        )
    )
    on_edge = edge.select("edge").scalar()
    outside = dated.filter(F.coalesce(F.col(date) != on_edge, F.lit(True))).withColumn(
        "picked", F.coalesce(F.col(date) < on_edge, F.lit(False))
    )
    inside = take_exact_overall(
        df.filter(F.col(date) == on_edge), edge.select("need").scalar()
    )
    return _named(outside.unionByName(inside.select(*outside.columns)))


def split_size(n: Column, test_size: float) -> Column:
    """Training rows: what the rounded-up test part leaves."""
    return n - F.ceil(n * F.lit(test_size))


def random_split(df: DataFrame, test_size: float = 0.2) -> DataFrame:
    return _named(take_exact_overall(df, split_size(F.col("n"), test_size)))


def _stratum_sizes(df: DataFrame, stratum: str) -> DataFrame:
    return settled(df.na.drop(subset=[stratum]).groupBy(stratum).agg(F.count(F.lit(1)).alias("n")))


def stratified_split(df: DataFrame, stratum: str = "airport", test_size: float = 0.2) -> DataFrame:
    """Same shares in both parts, and exact sizes overall.

    Each stratum trains its whole-number share; rows left over go to the
    strata with the largest remainders.
    """
    sizes = _stratum_sizes(df, stratum)
    whole = W.partitionBy()
    total = F.sum("n").over(whole)
    shared = sizes.withColumn("_t", total).withColumn(
        "_exact", F.col("n") * split_size(F.col("_t"), test_size) / F.col("_t")
    )
    floors = shared.withColumn("_floor", F.floor("_exact"))
    left = split_size(F.col("_t"), test_size) - F.sum("_floor").over(whole)
    remainder = F.round(F.col("_exact") - F.col("_floor"), 9)
    order = F.row_number().over(W.orderBy(remainder.desc(), stratum))
    quota = floors.withColumn("_left", left).withColumn("_order", order).select(
        stratum,
        (F.col("_floor") + (F.col("_order") <= F.col("_left")).cast("bigint")).alias("quota"),
    )
    return _named(take_exact(df.na.drop(subset=[stratum]), quota, [stratum]))


def sample_quota(sizes: DataFrame, stratum: str, size: int) -> DataFrame:
    """Rows to draw from each stratum for a sample of about ``size``.

    Shares are rounded half to even; rows above ``size`` that rounding adds are
    taken back from the largest strata.
    """
    whole = W.partitionBy()
    frac = F.least(F.lit(1.0), F.lit(float(size)) / F.sum("n").over(whole))
    drawn = sizes.withColumn("_k", F.bround(F.col("n") * frac, 0).cast("bigint"))
    over = F.greatest(F.lit(0), F.sum("_k").over(whole) - F.lit(size))
    order = F.row_number().over(W.orderBy(F.desc("_k"), stratum))
    return drawn.withColumn("_over", over).withColumn("_order", order).select(
        stratum, (F.col("_k") - (F.col("_order") <= F.col("_over")).cast("bigint")).alias("quota")
    )


def stratified_sample(df: DataFrame, size: int = 15_000, delay: str = "DEP_DELAY") -> DataFrame:
    """Sample with the share of every delay category kept."""
    # Read for the sizes, the counts and both sides of the cut.
    tagged = settled(
        df.withColumn("delay_category", labels.delay_category(F.col(delay))).na.drop(subset=["delay_category"])
    )
    quota = sample_quota(_stratum_sizes(tagged, "delay_category"), "delay_category", size)
    picked = take_exact(tagged, quota, ["delay_category"])
    return picked.filter("picked").drop("picked", "delay_category")


def fast_sample(df: DataFrame, size: int, seed: int = 42, delay: str = "DEP_DELAY") -> DataFrame:
    """Approximate form: one pass, each row kept with the common fraction."""
    tagged = df.withColumn("delay_category", labels.delay_category(F.col(delay)))
    fraction = F.least(F.lit(1.0), F.lit(float(size)) / df.agg(F.count(F.lit(1))).scalar())
    return (
        tagged.na.drop(subset=["delay_category"])
        .filter(F.rand(seed) < fraction)
        .drop("delay_category")
    )


def sample_keys(df: DataFrame, keys: Sequence[str] = ("carrier", "airport"), n: int = 10_000) -> DataFrame:
    """n distinct key combinations, chosen by digest."""
    combos = df.na.drop(subset=list(keys)).select(*keys).distinct()
    return combos.orderBy(digest(combos), *keys).limit(n)


def hash_fold(df: DataFrame, cols: Sequence[str], folds: int = 5) -> Column:
    """Fold number from the content of the row."""
    return F.pmod(
        F.conv(F.substring(digest(df, cols), 1, 8), 16, 10).cast("bigint"), F.lit(folds)
    ).cast("int")
