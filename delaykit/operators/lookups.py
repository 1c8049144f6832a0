"""Joining a table to a keyed lookup, and tables that are written once.

Which join runs is Spark's choice: adaptive execution broadcasts a lookup whose measured
bytes fit and splits a hot key's rows over tasks otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.session import shared_root


def settled(df: DataFrame) -> DataFrame:
    """The rows written below the session's checkpoint folder, without their history.

    A table used more than once is computed once this way, outlives the loss of
    executors, and keeps the plans built on it short. It is written as Parquet: a
    checkpointed table still has what the optimizer knows of its columns, and renaming the
    columns of an expression over all of them doubles that for each name.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to ``lookup`` (at most one row per key) on equal keys."""
    return facts.join(lookup, list(on), how)


def record_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], name: str, how: str = "left"
) -> DataFrame:
    """``lookup_join`` that adds the lookup's row as one struct, null if unknown.

    A wide lookup crosses the join as a single column, which keeps the code
    generated for the joins small enough to be compiled.
    """
    values = [c for c in lookup.columns if c not in on]
    packed = lookup.select(*on, F.struct(*values).alias(name))
    return lookup_join(facts, packed, on, how)


def rename_all(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Suffix every column that is not a key."""
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in keys})
