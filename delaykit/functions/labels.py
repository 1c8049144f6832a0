"""Bands, bins and labels over a delay or an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaykit import constants as K


def delay_category(delay: Column) -> Column:
    """Right-closed delay bins; a null delay has no category."""
    label = F.when(delay <= K.DELAY_EDGES[0], F.lit(K.DELAY_LABELS[0]))
    for edge, name in zip(K.DELAY_EDGES[1:], K.DELAY_LABELS[1:]):
        label = label.when(delay <= edge, F.lit(name))
    return label.when(delay.isNotNull(), F.lit(K.DELAY_LABELS[-1]))


def sample_weight(delay: Column) -> Column:
    """Training weight that grows with the delay."""
    weight = F.when(delay > K.DELAY_EDGES[3], F.lit(K.DELAY_WEIGHTS[3]))
    weight = weight.when(delay > K.DELAY_EDGES[2], F.lit(K.DELAY_WEIGHTS[2]))
    weight = weight.when(delay > K.DELAY_EDGES[1], F.lit(K.DELAY_WEIGHTS[1]))
    return weight.otherwise(F.lit(K.DELAY_WEIGHTS[0]))


def confidence_badge(mae: Column) -> Column:
    return (
        F.when(mae <= K.BADGE_LIMITS[0], "High")
        .when(mae <= K.BADGE_LIMITS[1], "Medium")
        .otherwise("Low")
    )


def severity_band(delay: Column) -> Column:
    return (
        F.when(delay < K.SEVERITY_LIMITS[0], "low")
        .when(delay < K.SEVERITY_LIMITS[1], "mid")
        .otherwise("high")
    )


def band_lower(point: Column, half_width: Column) -> Column:
    return F.greatest(F.lit(0.0), point - half_width)


def band_upper(point: Column, half_width: Column) -> Column:
    return point + half_width
