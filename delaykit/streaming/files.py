"""File streams and the shared folder results go to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from delaykit.session import shared_root


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the folder that the whole cluster shares."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def parquet_stream(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``name``.parquet of a folder as a stream."""
    schema = spark.read.parquet(f"{path}/{name}.parquet").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(path)
    )
