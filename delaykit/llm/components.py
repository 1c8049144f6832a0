"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.shared import stored


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    ).first()
    return row[0], int(row[1])


def _stars(pairs: DataFrame, center: str, leaf: str) -> DataFrame:
    """Links the leaves of every center, and the center, to the smallest of them all.

    The smallest is an aggregate, so a center with any number of leaves is summed up
    before it is shuffled, and the join that follows can split it.
    """
    least = pairs.groupBy(center).agg(F.min(leaf).alias("least"))
    least = least.withColumn("least", F.least("least", center))
    leaves = pairs.join(least, center)
    return leaves.select(F.col(leaf).alias("a"), F.col("least").alias("b"), F.col(center).alias("via"))


def components(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (``a``, ``b``): the node and ``root``, the smallest reachable.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest one, then every node links its smaller neighbours and itself to it. The
    rounds grow with the logarithm of the longest path. No links give no rows; links of a
    node with itself and null ends are ignored.
    """
    links = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = stored(links.distinct(), "links")
    before = _state(links)
    while True:
        both = links.union(links.select("b", "a"))
        large = _stars(both, "a", "b").where("a > via").select("a", "b").where("a != b").distinct()
        small = _stars(large, "a", "b")
        small = small.select("a", "b").union(small.select("via", "b")).where("a != b").distinct()
        links = stored(small, "links")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(links.select("a", "b"))
