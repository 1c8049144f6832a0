"""Model operators judge and prepare on all rows, whatever bounds the fit."""

import pytest
from pyspark.sql import functions as F

from delaykit.operators import models


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(400).select(
        (F.col("id") % 7).cast("double").alias("x"), F.concat(F.lit("c"), F.col("id") % 40).alias("c"),
        (F.col("id") % 7 * 2).cast("double").alias(models.TARGET),
    )


def test_every_row_is_judged(table):
    learners = (models.pipeline(models.linear(), ["x"], ()), models.booster(numeric=("x",), categorical=()))
    for learner, error in zip(learners, (1e-6, 0.05)):
        found = models.cross_validated_mae(learner, table, folds=2, fold_on=["x", "c"]).first()
        assert found["n"] == 400 and found["cv_mae"] == pytest.approx(0, abs=error)


def test_importances_name_the_labels(table):
    only = table.withColumn(models.TARGET, F.when(F.col("c") == "c3", 5.0).otherwise(F.col("x")))
    model = models.forest("airport_month", numeric=("x",), categorical=("c",)).fit(only)
    found = {r["feature"]: r["importance"] for r in models.model_importance(model, only).collect()}
    assert found["x"] + found["c=c3"] > 0.95
