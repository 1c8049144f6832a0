"""The whole way from CSV files to a model that scores."""

import datetime as dt
import json

import pytest
from delaykit.operators import models, scoring
from delaykit.plans.training import train_from_csv
from delaykit.sources import sinks, tables
from delaykit.sources import testdata as data

SF = "/root/testdata/sf0.001"


def test_csv_to_saved_model(spark, tmp_path):
    flights, causes, out = (str(tmp_path / n) for n in ("flights", "causes", "out"))
    data.flights(spark, SF).coalesce(1).write.option("header", True).csv(flights)
    data.delay_cause(spark, SF).coalesce(1).write.option("header", True).csv(causes)
    part = next((tmp_path / "causes").glob("*.csv"))
    part.rename(tmp_path / "causes" / "airline_delay_cause.csv")
    pipelines = {"linear": models.pipeline(models.linear()), "numbers": models.pipeline(models.linear(), categorical=())}
    done = train_from_csv(spark, flights, causes, out, pipelines)
    errors = {r["model"]: r["mae"] for r in done.metrics.collect()}
    assert errors[done.best] == min(errors.values()) and set(errors) == set(pipelines)
    written = json.loads(next((tmp_path / "out" / "metadata").glob("*.json")).read_text())
    assert written["best_model"] == done.best and written["n_train"] > written["n_test"] > 0
    saved = tables.load_lookups(spark, out)
    assert saved.airport.count() > 0 and saved.route.count() > 0
    known = saved.airport.first()["ORIGIN"]
    requests = spark.createDataFrame(
        [("CL", known, known, dt.date(2025, 7, 5), 8)],
        "carrier string, origin string, dest string, flight_date date, dep_hour int",
    )
    model = sinks.load_model(done.paths["model"])
    row = scoring.score_batch(requests, saved.airport, saved.carrier, scorer=model, mae=errors[done.best]).first()
    assert row["predicted_delay"] >= 0 and row["confidence_mae"] == pytest.approx(errors[done.best], abs=0.05)
