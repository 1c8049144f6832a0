"""Feature tables for training, for serving and for gated serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes
from delaykit.operators.cleaning import fill_missing_features
from delaykit.operators.enrichment import (
    lookup_enrich_default,
    route_lookup_default,
    target_encode_join,
)
from delaykit.operators.lookups import lookup_join, record_join, settled


def temporal_features(df: DataFrame, date: str = "FL_DATE", hour: str = "DEP_HOUR") -> DataFrame:
    """Hour, weekday (Monday is 0), month and weekend flag."""
    return df.withColumns(
        {
            "dep_hour": F.col(hour).cast("int"),
            "dow": F.weekday(date),
            "month": F.month(date),
            "is_weekend": codes.is_weekend(F.col(date)),
        }
    )


def route_and_flight_key(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "route": codes.route(F.col("ORIGIN"), F.col("DEST")),
            "flight_key": codes.flight_key(F.col("OP_CARRIER"), F.col("FL_NUM")),
        }
    )


def training_features(
    flights: DataFrame, fit_on: DataFrame | None = None, keep: Sequence[str] = (),
    base: DataFrame | None = None,
) -> DataFrame:
    """The 36 features and the target of enriched, cleaned flights.

    ``base`` may give the same flights before enrichment, to count them from.
    """
    dated = (
        flights.na.drop(subset=["FL_DATE"])
        .transform(temporal_features)
        .transform(route_and_flight_key)
    )
    return (
        target_encode_join(dated, fit_on, None if base is None else base.na.drop(subset=["FL_DATE"]))
        .transform(fill_missing_features)
        .select(*K.FEATURES, F.col("DEP_DELAY").cast("double").alias("DEP_DELAY"), *keep)
    )


def serving_features(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame, routes: DataFrame | None = None
) -> DataFrame:
    """The same 36 features for requests (carrier, origin, dest, flight_date, dep_hour).

    Request columns stay in front of the features.
    """
    known = route_lookup_default(lookup_enrich_default(requests, airport, carrier), routes)
    timed = temporal_features(known, "flight_date", "dep_hour")
    features = {
        "DISTANCE": F.col("route_distance"),
        "route": codes.route(F.col("origin"), F.col("dest")),
        "ORIGIN": F.col("origin"),
        "DEST": F.col("dest"),
        "OP_CARRIER": F.col("carrier"),
        "origin_avg_delay": F.col("avg_delay_minutes_origin"),
        "airline_avg_delay": F.col("carrier_avg_delay"),
    }
    # Column names differ from the request's by case only, so they are chosen
    # in one select rather than added.
    chosen = [features.get(c, F.col(c)).cast("double" if c in _MEASURES else _kind(c)).alias(c) for c in K.FEATURES]
    context = ["carrier_avg_delay", "carrier_delay_rate"]
    others = [c for c in requests.columns if c not in ("carrier", "origin", "dest", "dep_hour")]
    return timed.select(*others, *chosen, *context)


_MEASURES = set(("DISTANCE",) + K.ENCODINGS + K.HISTORY_ORIGIN + K.HISTORY_DEST)


def _kind(name: str) -> str:
    return "string" if name in K.CATEGORICAL_FEATURES else "int"


def availability_features(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame
) -> DataFrame:
    """Which lookups know the request, and the defaulted features they override."""
    airport, carrier = settled(airport), settled(carrier)
    mine = carrier.select(
        F.col("OP_CARRIER").alias("carrier"),
        *_plain(("carrier_delay_rate", "avg_carrier_delay", "weather_delay_rate", "nas_delay_rate")),
    )
    ends = {
        end: airport.select(
            F.col("ORIGIN").alias(end),
            *_plain(("total_delay_rate", "avg_delay_minutes", "weather_delay_rate", "nas_delay_rate",
                     "security_delay_rate", "late_aircraft_delay_rate")),
        )
        for end in ("origin", "dest")
    }
    joined = record_join(requests, mine, ["carrier"], "_c")
    joined = record_join(joined, ends["origin"], ["origin"], "_o")
    joined = record_join(joined, ends["dest"], ["dest"], "_d")

    by_carrier = ("carrier_delay_rate", "avg_carrier_delay")
    by_origin = (
        "total_delay_rate", "weather_delay_rate", "nas_delay_rate", "security_delay_rate",
        "late_aircraft_delay_rate",
    )

    def value(name: str) -> Column:
        default = F.lit(K.REQUEST_DEFAULTS[name])
        for source, names in (("_c", by_carrier), ("_o", by_origin)):
            if name in names:
                return F.when(F.col(source).isNotNull(), F.col(f"{source}.{name}")).otherwise(default)
        return default

    # Known only when the lookup is there.
    extras = {
        "carrier_weather_delay_rate": "_c.weather_delay_rate",
        "carrier_nas_delay_rate": "_c.nas_delay_rate",
        "avg_delay_minutes": "_o.avg_delay_minutes",
        "dest_delay_rate": "_d.total_delay_rate",
        "dest_avg_delay": "_d.avg_delay_minutes",
        "dest_weather_delay_rate": "_d.weather_delay_rate",
        "dest_nas_delay_rate": "_d.nas_delay_rate",
    }
    flags = {"has_carrier": "_c", "has_origin": "_o", "has_dest": "_d"}
    return joined.select(
        *requests.columns,
        *[F.col(c).isNotNull().alias(n) for n, c in flags.items()],
        F.col("origin").alias("airport"),
        F.year("flight_date").alias("year"),
        F.month("flight_date").alias("month"),
        codes.is_weekend(F.col("flight_date")).alias("is_weekend"),
        *[value(n).alias(n) for n in K.REQUEST_DEFAULTS],
        *[F.col(c).alias(n) for n, c in extras.items()],
    )


def _plain(names: Sequence[str]) -> list[Column]:
    """Lookup columns under the names they have without the suffix."""
    return [F.col(f"{c}_origin").alias(c) for c in names]


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; constant columns become zero."""
    fitted = fit_scale(df, cols)
    return df.withColumns({c: scaled(F.col(c), *fitted[c]) for c in cols})


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column: two numbers each, in one pass."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def scaled(x: Column, mean: float | None, sd: float | None) -> Column:
    if mean is None or sd is None:
        return F.lit(None).cast("double")
    # Noise around a constant column is not variation.
    return (x - F.lit(mean)) / F.lit(sd if sd > 1e-12 * max(1.0, abs(mean)) else 1.0)


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """Alphabetical integer code of every value of a column.

    The distinct labels are dealt into ranges; a label's code is its rank in its range
    plus the labels of the ranges before, so no task holds them all.
    """
    labels = df.na.drop(subset=[col]).select(F.col(col).alias("label")).distinct()
    # Written once: where the ranges are cut depends on a sample.
    ranges = settled(labels.repartitionByRange("label").select("label", F.spark_partition_id().alias("range")))
    sizes = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # One row per range.
    offsets = sizes.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("range").orderBy("label")) - 1
    placed = ranges.withColumn("rank", rank).join(offsets, "range")
    return placed.select(F.col("label").alias(col), (F.col("before") + F.col("rank")).cast("int").alias(f"{col}_code"))


def label_encode(df: DataFrame, cols: Sequence[str], fitted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Codes of each column; a label that was not fitted gets 0."""
    out = df
    for c in cols:
        table = fitted[c] if fitted else label_codes(df, c)
        out = lookup_join(out, table, [c])
        out = out.withColumn(f"{c}_code", F.coalesce(f"{c}_code", F.lit(0)))
    return out


def one_hot_encoder(cols: Sequence[str] = K.CATEGORICAL_FEATURES) -> Pipeline:
    """Indicator vectors; a label that was not fitted becomes all zeros."""
    indexer = StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}_index" for c in cols],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_hot" for c in cols],
        dropLast=True,  # the indexer's slot for unknown labels is the last one
    )
    return Pipeline(stages=[indexer, encoder])


def one_hot_encode(df: DataFrame, cols: Sequence[str] = K.CATEGORICAL_FEATURES) -> DataFrame:
    """``{col}_index`` and indicator vectors ``{col}_hot``; null becomes all zeros.

    The same rows as from ``one_hot_encoder``, but labels are numbered by ``label_codes``
    and joined, so the driver only learns how many there are.
    """
    out = df
    for c in cols:
        codes = settled(label_codes(df, c).withColumnRenamed(f"{c}_code", f"{c}_index"))
        n = codes.count()
        index = F.coalesce(f"{c}_index", F.lit(n)).cast("double")
        # The slot of rows without a label is the last one, which the encoder drops.
        slots = {"ml_attr": {"type": "nominal", "num_vals": n + 1}}
        out = lookup_join(out, codes, [c]).withColumn(f"{c}_index", index).withMetadata(f"{c}_index", slots)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_hot" for c in cols], dropLast=True
    )
    return encoder.fit(out).transform(out)


def preprocessor_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Scaled numbers and indicator vectors, assembled into ``features``."""
    stages: list = [
        VectorAssembler(inputCols=list(numeric), outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
    ]
    inputs = ["scaled"]
    if categorical:
        stages += one_hot_encoder(categorical).getStages()
        inputs += [f"{c}_hot" for c in categorical]
    return stages + [VectorAssembler(inputCols=inputs, outputCol="features")]


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=preprocessor_stages(numeric, categorical)).fit(df)


def encoded_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """The rows with ``features``, as from ``fit_preprocessor``, for any number of labels."""
    hot = one_hot_encode(df, categorical) if categorical else df
    inputs = ["scaled", *[f"{c}_hot" for c in categorical]]
    stages = [*preprocessor_stages(numeric, ())[:2], VectorAssembler(inputCols=inputs, outputCol="features")]
    return Pipeline(stages=stages).fit(hot).transform(hot)
