"""The two streaming forms, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.plans.catalog import CATALOG, query
from delaykit.plans.flight_queries import PAST, lookups, route_table
from delaykit.sources import testdata as data
from delaykit.streaming.files import parquet_stream, shared_folder
from delaykit.streaming.history import stream_history_dedup
from delaykit.streaming.scoring import start, stream_score


# The stream must give what the batch gives.
@query("stream_score", CATALOG["score_batch"].sql)
def _(spark, path):
    requests = data.requests(spark, path, lineitem=parquet_stream(spark, path, "lineitem"))
    folder = shared_folder(spark, "scores")
    stream_score(
        requests, *lookups(spark, path), f"{folder}/out", f"{folder}/state", route_table(spark, path)
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _closing(spark, path):
    """One event a week after the last, so that the stream's time passes every session."""
    events = data.table(spark, path, "events")
    last = events.agg(F.max("ts").alias("ts")).where("ts IS NOT NULL")
    columns = [
        (F.col("ts") + F.expr("INTERVAL 7 DAYS") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in events.schema
    ]
    folder = shared_folder(spark, "closing")
    last.select(*columns).write.parquet(folder)
    return spark.readStream.schema(events.schema).parquet(folder)


# The stream must give what the batch gives.
@query("stream_history_dedup", CATALOG["history_dedup"].sql)
def _(spark, path):
    events = parquet_stream(spark, path, "events").union(_closing(spark, path))
    folder = shared_folder(spark, "history")
    # A key holds its date, so equal keys are less than a day apart.
    unique = stream_history_dedup(data.history(spark, path, events).select(*PAST), "1 day")
    start(unique, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(*PAST)
