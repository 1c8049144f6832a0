"""Exact, repeatable selection of rows by a digest of their content.

Sampling and splitting both mean "the first k rows of a group in some fixed
order". Ranking a whole group needs the group in one task, so the cut is found
from counts instead: rows are counted by the leading digits of their digest,
which shows the one bucket the cut falls into, and only that bucket is ranked.
Equal rows are ranked once and carry a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit.operators.lookups import lookup_join, settled

COPIES_PER_TASK = 10_000


def digest_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """The text the digest is taken of; fractions count to the sixth digit."""
    parts = []
    kinds = dict(df.dtypes)
    for c in cols:
        value = F.col(c)
        if kinds[c] in ("double", "float"):
            value = F.round(value * F.lit(1e6)).cast("bigint")
        parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat_ws("|", *parts)


def digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return F.md5(digest_text(df, cols or df.columns))


def take_exact(
    df: DataFrame,
    quota: DataFrame,
    strata: Sequence[str],
    flag: str = "picked",
    digits: int = 4,
) -> DataFrame:
    """Add ``flag``: true for exactly ``quota`` rows of each stratum.

    ``quota`` has the strata columns and a whole-number column ``quota``. The
    rows taken are the first by (digest of all columns, then the columns).
    Every input row comes out once.
    """
    strata, columns = list(strata), df.columns
    content = [c for c in columns if not c.startswith("_")]
    rows = df.withColumn("_h", digest(df, content)).withColumn("_p", F.substring("_h", 1, digits))

    counted = rows.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_n"))
    running = counted.withColumn(
        "_upto", F.sum("_n").over(W.partitionBy(*strata).orderBy("_p"))
    )
    edge = (
        lookup_join(running, quota.select(*strata, "quota"), strata, "inner")
        .filter((F.col("quota") > F.col("_upto") - F.col("_n")) & (F.col("quota") <= F.col("_upto")))
        .select(
            *strata,
            F.col("_p").alias("_edge"),
            (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_need"),
        )
    )
    # A quota above the group size takes everything, one of zero nothing.
    # Written first: by its size Spark then knows not to deal the rows out by a few strata.
    cut = lookup_join(rows, settled(_edges(quota, edge, strata)), strata)
    clear = cut.filter(
        F.col("_edge").isNull() | (F.col("_p") != F.col("_edge"))
    ).select(
        *columns,
        F.coalesce(F.col("_p") < F.col("_edge"), F.coalesce(F.col("_whole"), F.lit(False))).alias(flag),
    )
    inside = _rank_edge(cut.filter(F.col("_p") == F.col("_edge")), columns, strata, digits, flag)
    return clear.unionByName(inside)


def _edges(quota: DataFrame, edge: DataFrame, strata: list[str]) -> DataFrame:
    """One row per stratum: edge bucket and rows needed from it, or take all."""
    wanted = quota.select(*strata, (F.col("quota") > 0).alias("_positive"))
    return (
        lookup_join(wanted, edge, strata)
        .withColumn("_whole", F.col("_positive") & F.col("_edge").isNull())
        .drop("_positive")
    )


def _rank_edge(
    rows: DataFrame, columns: list[str], strata: list[str], digits: int, flag: str
) -> DataFrame:
    keys = strata + [c for c in columns if c not in strata]
    distinct = rows.groupBy(*keys, "_h", "_need").agg(F.count(F.lit(1)).alias("_n"))
    distinct = distinct.withColumn("_sub", F.substring("_h", digits + 1, 3))
    # Two-level running count: totals of the sub-buckets, then inside each.
    totals = distinct.groupBy(*strata, "_sub").agg(F.sum("_n").alias("_t"))
    before = totals.select(
        *strata,
        "_sub",
        (F.sum("_t").over(W.partitionBy(*strata).orderBy("_sub")) - F.col("_t")).alias("_before"),
    )
    inner = W.partitionBy(*strata, "_sub").orderBy("_h", *[c for c in columns if c not in strata])
    ranked = distinct.withColumn(
        "_ahead",
        F.sum("_n").over(inner.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n"),
    ).join(before, strata + ["_sub"])
    missing = F.col("_need") - F.col("_before") - F.col("_ahead")
    taken = F.greatest(F.lit(0), F.least(F.col("_n"), missing))
    sized = ranked.withColumn("_taken", taken)
    parts = sized.select(
        *columns,
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("f"), F.col("_taken").alias("n")),
                F.struct(F.lit(False).alias("f"), (F.col("_n") - F.col("_taken")).alias("n")),
            )
        ).alias("_part"),
    )
    return repeat_rows(
        parts.select(*columns, F.col("_part.f").alias(flag), F.col("_part.n").alias("_n")), "_n"
    )


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as its count says, in portions no task minds."""
    columns = [c for c in df.columns if c != count]
    portions = df.filter(F.col(count) > 0).withColumn(
        "_portion",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / COPIES_PER_TASK))),
    )
    size = F.least(
        F.lit(COPIES_PER_TASK).cast("bigint"), F.col(count) - F.col("_portion") * COPIES_PER_TASK
    )
    spread = portions.withColumn("_size", size).repartition(F.col("_portion"), *columns)
    return spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size")))
    ).select(*columns)


def quota_of_all(df: DataFrame, quota: Column) -> DataFrame:
    """Quota table for a selection without strata; ``quota`` may use ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("_all"), quota.cast("bigint").alias("quota")
    )


def take_exact_overall(df: DataFrame, quota: Column, flag: str = "picked") -> DataFrame:
    """``take_exact`` over the table as one group."""
    tagged = df.withColumn("_all", F.lit(0))
    return take_exact(tagged, quota_of_all(df, quota), ["_all"], flag).drop("_all")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    The rank limit is applied before the shuffle too, so a hot key sends one
    row per map task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= 1)
        .drop("_rank")
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
