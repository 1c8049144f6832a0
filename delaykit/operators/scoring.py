"""Scoring of flight requests in batches.

A scorer is a column over the feature table, or a fitted model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import labels, numbers
from delaykit.operators.enrichment import scenario_delay
from delaykit.operators.features import availability_features, serving_features
from delaykit.operators.trees import TreeModel

Scorer = Column | PipelineModel | TreeModel


def scenario_scorer() -> Column:
    """Deterministic scorer over the serving features."""
    return scenario_delay(
        F.col("origin_avg_delay"), F.col("airline_avg_delay"),
        F.col("is_weekend"), F.col("dep_hour"), F.col("DISTANCE"),
    )


def cause_mix_scorer() -> Column:
    """Deterministic scorer over the gated features: minutes weighted by cause rate."""
    rates = [F.col(c) for c in K.CAUSE_RATES]
    weighted = [F.col(r) * F.col(a) for r, a in zip(K.CAUSE_RATES, K.CAUSE_AVERAGES)]
    return F.coalesce(F.try_divide(numbers.row_sum(weighted), numbers.row_sum(rates)), F.lit(0.0))


def model_inputs(model: PipelineModel | TreeModel, features: DataFrame) -> list[str]:
    """The numeric columns of ``features`` that a fitted model reads."""
    if isinstance(model, TreeModel):
        return [c for c in model.numeric if c in features.columns]
    read = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    return [c for c in read if c in features.columns]


def _predicted(features: DataFrame, scorer: Scorer) -> DataFrame:
    """The features with ``_p``, null where the scorer lacks one of its inputs."""
    if isinstance(scorer, Column):
        return features.withColumn("_p", scorer)
    inputs = model_inputs(scorer, features)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs], F.lit(True))
    # A model ends the job at the first null: it sees zeros there and its answer is dropped.
    filled = features.select(
        F.struct(*features.columns).alias("_row"),
        complete.alias("_complete"),
        *[F.coalesce(c, F.lit(0).cast(features.schema[c].dataType)).alias(c) if c in inputs else F.col(c) for c in features.columns],
    )
    answered = scorer.transform(filled)
    return answered.select("_row.*", F.when(F.col("_complete"), F.col("prediction")).alias("_p"))


def _one_digit(col: Column) -> Column:
    return F.bround(col, 1)


def score_batch(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame, routes: DataFrame | None = None,
    scorer: Scorer | None = None, mae: float = K.DEFAULT_MAE,
) -> DataFrame:
    """Prediction, unclamped band and context of every request, to one digit.

    ``mae`` is the error that the scorer was measured with; a request that lacks an input
    of the scorer has no prediction and no band.
    """
    features = serving_features(requests, airport, carrier, routes)
    point = _predicted(features, scorer if scorer is not None else scenario_scorer()).withColumn(
        "_p", F.when(F.col("_p").isNotNull(), F.greatest(F.lit(0.0), F.col("_p")))
    )
    passed = [c for c in requests.columns if c not in ("carrier", "origin", "dest", "dep_hour")]
    half = F.when(F.col("_p").isNotNull(), F.lit(float(mae)))
    return point.select(
        *passed,
        "dep_hour",
        _one_digit(F.col("_p")).alias("predicted_delay"),
        _one_digit(half).alias("confidence_mae"),
        _one_digit(F.col("_p") - half).alias("lower_bound"),
        _one_digit(F.col("_p") + half).alias("upper_bound"),
        F.col("OP_CARRIER").alias("carrier"),
        F.col("ORIGIN").alias("origin"),
        F.col("DEST").alias("dest"),
        _one_digit(F.col("carrier_avg_delay")).alias("carrier_avg_delay"),
        _one_digit(F.col("origin_avg_delay")).alias("origin_avg_delay"),
        _one_digit(F.col("total_delay_rate_origin") * 100).alias("origin_delay_rate"),
        _one_digit(F.col("avg_delay_minutes_dest")).alias("dest_avg_delay"),
        _one_digit(F.col("total_delay_rate_dest") * 100).alias("dest_delay_rate"),
    )


def score_gated(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame,
    scorer: Scorer | None = None, mae: float = K.GATED_MAE,
) -> DataFrame:
    """Prediction only where some lookup knows the request, with what it rests on.

    ``mae`` is the error that the scorer was measured with. A known request that lacks an
    input of the scorer gets the row of a failed prediction.
    """
    features = availability_features(requests, airport, carrier)
    point = _predicted(features, scorer if scorer is not None else cause_mix_scorer())
    known = F.col("has_carrier") | F.col("has_origin") | F.col("has_dest")
    half = F.lit(float(mae))
    p = F.col("_p")
    answered = known & p.isNotNull()
    parts = F.concat_ws(
        ", ",
        *[F.when(F.col(f"has_{part}"), part) for part in ("carrier", "origin", "dest")],
    )
    shown = {
        "predicted_delay": p,
        "confidence_mae": half,
        "lower_bound": labels.band_lower(p, half),
        "upper_bound": labels.band_upper(p, half),
        "carrier_avg_delay": F.col("avg_carrier_delay"),
        "origin_delay_rate": F.col("total_delay_rate") * 100,
        "dest_delay_rate": F.coalesce(F.col("dest_delay_rate"), F.lit(0.0)) * 100,
    }
    return point.select(
        *requests.columns,
        *[F.when(answered, c).alias(n) for n, c in shown.items()],
        F.struct(
            F.col("has_carrier").alias("carrier"),
            F.col("has_origin").alias("origin"),
            F.col("has_dest").alias("dest"),
        ).alias("data_availability"),
        F.lit(False).alias("using_fallback_data"),
        answered.alias("prediction_available"),
        F.when(answered, F.concat(F.lit(K.AVAILABLE_PREFIX), parts))
        .when(known, F.lit(K.FAILED_MESSAGE))
        .otherwise(F.format_string(K.UNKNOWN_MESSAGE, "carrier", "origin", "dest"))
        .alias("message"),
    )


def confidence_band(df: DataFrame, point: str = "predicted_delay", mae: str = "confidence_mae") -> DataFrame:
    """Band whose lower end is not below zero."""
    p, h = F.col(point), F.col(mae)
    return df.withColumns(
        {"lower_bound": labels.band_lower(p, h), "upper_bound": labels.band_upper(p, h)}
    )


def confidence_band_unclamped(df: DataFrame, point: str = "predicted_delay", mae: str = "confidence_mae") -> DataFrame:
    """Point not below zero, band around it as it falls, all to one digit."""
    p, h = F.greatest(F.lit(0.0), F.col(point)), F.col(mae)
    values = {
        point: _one_digit(p), mae: _one_digit(h),
        "lower_bound": _one_digit(p - h), "upper_bound": _one_digit(p + h),
    }
    return df.withColumns(values)
