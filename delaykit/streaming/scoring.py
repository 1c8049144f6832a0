"""Scoring a stream of requests.

Scoring is row-local apart from joins to static lookups, so the batch operator
runs on a stream unchanged and keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from delaykit.operators.scoring import Scorer, score_batch


def stream_score(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame, path: str, checkpoint: str,
    routes: DataFrame | None = None, scorer: Scorer | None = None,
) -> StreamingQuery:
    """Score what is there now and stop; ``path`` and ``checkpoint`` are shared folders."""
    scored = score_batch(requests, airport, carrier, routes, scorer)
    return start(scored, path, checkpoint)


def start(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
