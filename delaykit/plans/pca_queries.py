"""Principal components of the training features and what they suggest."""

from __future__ import annotations

from delaykit import constants as K
from delaykit.operators import features, pca, suggestions
from delaykit.operators.lookups import settled
from delaykit.plans.catalog import query
from delaykit.plans.feature_queries import NUMERIC, feature_table
from delaykit.plans.views import with_views
from pyspark.sql import functions as F


def components(spark, path) -> pca.Components:
    return pca.pca_fit(feature_table(spark, path).select(*NUMERIC), NUMERIC)


def loadings(spark, path):
    return components(spark, path).loadings


def variance(spark, path):
    return components(spark, path).variance


@query("pca_fit")
def _(spark, path):
    return loadings(spark, path)


# The ratios add up to one, and each component has length one.
@query(
    "pca_invariants",
    with_views("cf", f"SELECT CAST(i AS INT) AS pc, 1.0E0 AS squared_length, 1.0E0 AS total_ratio FROM range(1, {len(NUMERIC) + 1}) r(i)"),
)
def _(spark, path):
    fitted = components(spark, path)
    lengths = fitted.loadings.groupBy("pc").agg(
        F.sum(F.col("loading") * F.col("loading")).alias("squared_length")
    )
    total = fitted.variance.agg(F.sum("ratio")).scalar()
    return lengths.withColumn("total_ratio", total)


@query("pca_report")
def _(spark, path):
    table = settled(feature_table(spark, path))
    return pca.pca_report(features.encoded_features(table, NUMERIC, K.CATEGORICAL_FEATURES))


@query("pca_scores")
def _(spark, path):
    table = feature_table(spark, path).select("route", "OP_CARRIER", *NUMERIC)
    scores = pca.pca_scores(table, pca.pca_fit(table.select(*NUMERIC), NUMERIC))
    return scores.select("route", "OP_CARRIER", *[f"PC{i}" for i in range(1, 6)])


@query("explained_variance")
def _(spark, path):
    return pca.explained_variance(variance(spark, path))


@query("components_needed")
def _(spark, path):
    return pca.components_needed(variance(spark, path))


@query("scree_table")
def _(spark, path):
    return pca.scree_table(variance(spark, path))


@query("high_influence_features")
def _(spark, path):
    return pca.high_influence_features(loadings(spark, path))


@query("feature_importance_matrix")
def _(spark, path):
    return pca.feature_importance_matrix(loadings(spark, path))


@query("loading_correlation")
def _(spark, path):
    return pca.loading_correlation(loadings(spark, path))


@query("feature_clusters")
def _(spark, path):
    return pca.feature_clusters(loadings(spark, path))


@query("cluster_counts")
def _(spark, path):
    return pca.cluster_counts(pca.feature_clusters(loadings(spark, path)))


@query("loading_heatmap_table")
def _(spark, path):
    return pca.loading_heatmap_table(loadings(spark, path))


@query("component_loadings")
def _(spark, path):
    return pca.component_loadings(loadings(spark, path))


@query("biplot_points")
def _(spark, path):
    table = feature_table(spark, path).select(*NUMERIC)
    return pca.biplot_points(pca.pca_scores(table, pca.pca_fit(table, NUMERIC), 2))


@query("biplot_arrows")
def _(spark, path):
    return pca.biplot_arrows(loadings(spark, path))


@query("correlated_subset")
def _(spark, path):
    return pca.correlated_subset(pca.loading_correlation(loadings(spark, path)))


for _name, _suggest in (
    ("suggest_interactions", suggestions.suggest_interactions),
    ("suggest_polynomials", suggestions.suggest_polynomials),
    ("suggest_aggregations", suggestions.suggest_aggregations),
    ("suggest_domain", suggestions.suggest_domain),
):

    @query(_name)
    def _(spark, path, suggest=_suggest):
        return suggest(loadings(spark, path))


@query("suggest_pca_derived")
def _(spark, path):
    return suggestions.suggest_pca_derived(variance(spark, path))


@query("suggestion_report")
def _(spark, path):
    fitted = components(spark, path)
    return suggestions.suggestion_report(fitted.loadings, fitted.variance)


@query("suggestion_counts")
def _(spark, path):
    fitted = components(spark, path)
    return suggestions.suggestion_counts(suggestions.suggestion_report(fitted.loadings, fitted.variance))
