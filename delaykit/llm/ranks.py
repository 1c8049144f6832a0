"""Ranks and running sums over any number of rows, without one task that holds them all.

Rows are dealt to buckets by a hash; the order is by bucket, then by hash. A bucket's
offset comes from the sizes of the buckets before it, so a window only ever holds one
bucket of one key, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 20_000


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, rows: int
) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` over the rows of the key that come before.

    The order is a fixed shuffle by the hash of the columns ``order``; rows that agree in
    them all are alike and take any order. ``rows`` is about the number of rows of ``df``
    and sets the number of buckets only. ``keys`` must not be null.
    """
    keys = list(keys)
    buckets = max(1, -(-rows // BUCKET_ROWS))
    dealt = df.withColumn("_order", F.xxhash64(*order)).withColumn("_value", value)
    dealt = dealt.withColumn("_bucket", F.pmod("_order", F.lit(buckets)))
    place = [*keys, "_bucket"]
    sizes = dealt.groupBy(*place).agg(F.sum("_value").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*place, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    before = Window.partitionBy(*place).orderBy("_order", *order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.join(offsets, place).withColumn(
        name, F.col("_offset") + F.coalesce(F.sum("_value").over(before), F.lit(0))
    )
    return summed.select(*df.columns, name)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows: int) -> DataFrame:
    """``df`` with ``name``, the rank from 0 of each row within its key; see ``running_sums``."""
    return running_sums(df, keys, order, F.lit(1).cast("long"), name, rows)
