"""Components from one pass over the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaykit.operators import pca

X = np.random.default_rng(8).normal(size=(300, 4)) @ np.array([[1, 2, 0, 1], [0, 1, 3, 1], [0, 0, 1, 0], [0, 0, 0, 0]]) + 1000.0
NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [tuple(float(v) if (i + j) % 9 else None for j, v in enumerate(x)) for i, x in enumerate(X)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)


def expected(table):
    """Means and deviations of all known values, components of the complete rows."""
    x = np.array([[np.nan if v is None else v for v in r] for r in table.collect()], dtype=np.float64)
    z = (x - np.nanmean(x, axis=0)) / np.nanstd(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(z[~np.isnan(z).any(axis=1)].T))
    return values[::-1] / values.sum(), vectors[:, ::-1]


def test_components_of_rows_with_gaps(table):
    fitted = pca.pca_fit(table, NAMES)
    ratios, vectors = expected(table)
    assert [r["ratio"] for r in fitted.variance.orderBy("pc").collect()] == pytest.approx(list(ratios), abs=1e-9)
    np.testing.assert_allclose(np.abs(fitted.matrix[:, :3]), np.abs(vectors[:, :3]), atol=1e-7)
    scores = pca.pca_scores(table, fitted, 2)
    assert scores.columns == [*NAMES, "PC1", "PC2"]
    assert scores.count() == table.na.drop().count()


def test_the_rows_are_read_once(spark, table):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    counted = table.select(seen("a").alias("a"), "b", "c", "d")
    pca.pca_fit(counted, NAMES)
    assert read.value == len(X)


def test_a_constant_column_has_no_part(spark):
    rows = spark.range(100).select((F.col("id") * 1.0).alias("a"), F.lit(0.1).alias("b"), (F.col("id") % 7 * 1.0).alias("c"))
    fitted = pca.pca_fit(rows, ["a", "b", "c"])
    assert [r["ratio"] for r in fitted.variance.orderBy("pc").collect()][2] == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        pca.pca_fit(rows.limit(0), ["a", "b", "c"])
