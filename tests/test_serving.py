"""Fitted models: against the historical mean, with their own band, and with missing inputs."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from test_scoring import tables

from delaykit import constants as K
from delaykit.operators import history as past
from delaykit.operators import models, scoring
from delaykit.plans import CATALOG
from delaykit.plans.model_queries import _predictions, airport_model
from delaykit.session import shared_root

SF = "/root/testdata/sf0.001"
REQUEST = "carrier string, origin string, dest string, flight_date date, dep_hour int"


@pytest.fixture(scope="module")
def mean_error(spark):
    return models.regression_metrics(_predictions(spark, SF)).first()["mae"]


@pytest.mark.parametrize("name", ["train_linear", "train_gbt", "train_gbt_weighted", "train_forest"])
def test_flight_models_beat_the_historical_mean(spark, mean_error, name):
    assert CATALOG[name].run(spark, SF).first()["mae"] <= mean_error


def test_airport_forest_beats_the_mean_and_gives_its_band(spark):
    model, train, test = airport_model(spark, SF)
    mean = models.historical_mean_predictor(train, test, ("airport",), "avg_delay_minutes")
    of_mean = models.regression_metrics(mean, "avg_delay_minutes").first()["mae"]
    own = models.regression_metrics(models.scored(model, test), "avg_delay_minutes").first()["mae"]
    assert own <= of_mean
    bands = CATALOG["score_gated_model"].run(spark, SF).where("prediction_available")
    assert [round(r["confidence_mae"], 5) for r in bands.select("confidence_mae").distinct().collect()] == [round(own, 5)]


def test_a_missing_input_gives_the_failed_row(spark):
    airport, carrier = tables(spark)
    gone = airport.withColumn("weather_delay_rate_origin", F.lit(None).cast("double"))
    names = [c for c in scoring.availability_features(
        spark.createDataFrame([("AA", "ATL", "ATL", dt.date(2025, 7, 5), 8)], REQUEST), airport, carrier
    ).columns if c in K.CAUSE_RATES]
    rows = spark.createDataFrame([(*[float(i + j) for j in range(len(names))], float(i)) for i in range(9)], [*names, "y"])
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), LinearRegression(labelCol="y", regParam=0.1)]).fit(rows)
    requests = spark.createDataFrame(
        [("ZZ", "ATL", "ATL", dt.date(2025, 7, 5), 8), ("ZZ", "QQQ", "QQQ", dt.date(2025, 7, 5), 8)], REQUEST
    )
    out = {r["origin"]: r for r in scoring.score_gated(requests, gone, carrier, scorer=model, mae=3.0).collect()}
    assert out["ATL"]["message"] == K.FAILED_MESSAGE and out["ATL"]["predicted_delay"] is None
    assert not out["ATL"]["prediction_available"] and out["ATL"]["confidence_mae"] is None
    assert out["QQQ"]["message"].startswith("No historical data found")


def test_one_flight_on_two_dates_is_two_predictions(spark):
    rows = [("AA1", "ATL", "DEN", dt.date(2025, 1, d), 8, f"2025-01-0{d} 08:00:00") for d in (1, 2, 2)]
    df = spark.createDataFrame(
        rows, "flight_number string, origin string, destination string, flight_date date, departure_hour int, timestamp string"
    )
    assert past.history_dedup(past.with_history_key(df)).count() == 2


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://machine:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
