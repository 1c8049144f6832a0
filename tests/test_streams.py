"""Streams that end: what they give out and what they remember."""

import datetime as dt

import pytest

from delaykit.operators.history import history_dedup
from delaykit.streaming.files import shared_folder
from delaykit.streaming.history import stream_history_dedup

SCHEMA = "history_key string, timestamp timestamp, predicted_delay double, _first string, note string"


def at(day, hour, minute=0):
    return dt.datetime(2024, 5, day, hour, minute)


def run(spark, batches):
    """The rows given out for files that arrive one by one, and the stream's last progress."""
    root = shared_folder(spark, "arrivals")
    for i, rows in enumerate(batches):
        # Files are read in the order of their times.
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/in/{i}")
    stream = (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        .parquet(f"{root}/in")
    )
    query = (
        stream_history_dedup(stream, "1 day").writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(SCHEMA).parquet(f"{root}/out").collect(), query.lastProgress


def test_first_by_time_whatever_the_order(spark):
    batches = [
        [("a", at(1, 10), 5.0, "x", "late"), ("b", at(1, 9), 1.0, None, "only"), (None, at(1, 8), 1.0, "n", "no key")],
        [("a", at(1, 9), 7.0, "x", "first"), ("a", at(1, 9), 8.0, "x", "tie"), ("a", at(1, 9, 30), 0.0, "x", "mid")],
        [("b", at(1, 9), 1.0, None, "only"), ("c", None, 1.0, "x", "no time")],
        [("z", at(20, 0), 0.0, "x", "closing")],
        # The watermark that drops late entries is that of the batch before.
        [("z", at(20, 1), 0.0, "x", "closing")],
        [("a", at(1, 7), 0.0, "x", "too late"), ("z", at(20, 2), 0.0, "x", "closing")],
    ]
    found, progress = run(spark, batches)
    whole = spark.createDataFrame([r for rows in batches[:3] for r in rows if r[1]], SCHEMA)
    wanted = history_dedup(whole).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, wanted), key=str)
    assert {r["note"] for r in found} == {"first", "only", "no key"}
    # Only the closing key is remembered.
    assert progress.stateOperators[0].numRowsTotal <= 2


@pytest.mark.parametrize("reverse", [False, True])
def test_sessions_end_after_the_delay(spark, reverse):
    rows = [("a", at(1, 0), 1.0, "x", "one"), ("a", at(1, 20), 1.0, "x", "same"), ("a", at(3, 0), 1.0, "x", "two")]
    closing = [("z", at(20, 0), 0.0, "x", "closing")]
    found, _ = run(spark, [rows[::-1] if reverse else rows, closing])
    assert sorted(r["note"] for r in found) == ["one", "two"]
