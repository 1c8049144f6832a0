"""Registered queries; importing the package fills the catalog."""

from delaykit.plans import (  # noqa: F401, I001 - streams reuse the SQL of the batch queries
    report_queries,
    flight_queries,
    statistics_queries,
    text_queries,
    feature_queries,
    model_queries,
    pca_queries,
    stream_queries,
)
from delaykit.plans.catalog import CATALOG

__all__ = ["CATALOG"]
