"""Lookup tables and other saved results."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Lookups(NamedTuple):
    airport: DataFrame
    carrier: DataFrame
    route: DataFrame | None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system of ``path`` has it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def load_lookups(spark: SparkSession, path: str) -> Lookups:
    """Airport and carrier history are needed, the route table is optional.

    The saved route table has a row for each flight number; a request asks for its route,
    so each route is there once.
    """
    airport = spark.read.parquet(f"{path}/lookup_airport")
    carrier = spark.read.parquet(f"{path}/lookup_carrier")
    routes = f"{path}/flight_lookup"
    return Lookups(airport, carrier, once_per_route(spark.read.parquet(routes)) if exists(spark, routes) else None)


def once_per_route(routes: DataFrame) -> DataFrame:
    """ORIGIN and DEST once each, with the means of DISTANCE and avg_delay where the table has them."""
    means = [F.avg(c).alias(c) for c in ("DISTANCE", "avg_delay") if c in routes.columns]
    grouped = routes.na.drop(subset=["ORIGIN", "DEST"]).groupBy("ORIGIN", "DEST")
    return grouped.agg(*means) if means else grouped.agg(F.count(F.lit(1)).alias("n_flights"))
