"""Removing repeated predictions from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_history_dedup(history: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first entry by time of every history key among those less than ``delay`` apart.

    Entries of a key belong together while the next one follows in less than ``delay``,
    whatever order they arrive in. Their first one, of equal times the least by the other
    columns as in ``history_dedup``, is given out with all its columns once the watermark
    is ``delay`` past the last, and the key is forgotten then. The state holds one entry
    per key and session. Entries that come more than ``delay`` behind the latest time of
    the batches before the last one are dropped, as are those without a time.
    """
    timed = history.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    others = [c for c in history.columns if c not in ("history_key", "timestamp")]
    sessions = timed.withWatermark("timestamp", delay).groupBy(
        "history_key", F.session_window("timestamp", delay).alias("_session")
    )
    first = sessions.agg(F.min(F.struct("timestamp", *others)).alias("_first"))
    return first.select(
        *[F.col(c) if c == "history_key" else F.col(f"_first.`{c}`").alias(c) for c in history.columns]
    )
