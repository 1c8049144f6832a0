"""From raw CSV files to a saved model, its lookups and a run summary, in one call."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators import cleaning, enrichment, features, metrics, models, splitting, summaries
from delaykit.operators.lookups import settled
from delaykit.operators.trees import TreeModel
from delaykit.sources import csv_files, sinks

FLIGHT = ["OP_CARRIER", "FL_NUM", "ORIGIN", "DEST", "DEP_HOUR", "DEP_DELAY", "FL_DATE", "DISTANCE"]


class Trained(NamedTuple):
    best: str
    model: PipelineModel | TreeModel
    metrics: DataFrame
    paths: dict[str, str]


def candidates() -> dict[str, Pipeline | models.TreeLearner]:
    return {
        "linear": models.pipeline(models.linear()),
        "gradient_boosting": models.booster("airport_month"),
    }


def feature_parts(flights: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of the early and of the late flights; encodings know the early ones only.

    The flights are written as they come, then with their part; only the features are written wide.
    """
    flights, history = settled(flights), settled(history)
    both = settled(splitting.temporal_split(enrichment.enrich_origin_dest(flights, history), base=flights))
    train = both.filter("split = 'train'")
    wide = enrichment.enrich_origin_dest(both, history)
    table = features.training_features(wide, fit_on=train, keep=["split"], base=both)
    # A key the training part never had gets its overall mean delay.
    overall = train.agg(F.avg(models.TARGET)).scalar()
    table = settled(table.withColumns({c: F.coalesce(F.col(c), overall) for c in K.ENCODINGS}))
    return table.filter("split = 'train'").drop("split"), table.filter("split = 'test'").drop("split")


def training_parts(flights: DataFrame, causes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``feature_parts`` of cleaned flights and a cleaned report."""
    return feature_parts(cleaning.parse_flight_date(flights), metrics.delay_history(causes))


def train_from_csv(
    spark: SparkSession, flights_dir: str, causes_dir: str, out: str,
    pipelines: Mapping[str, Pipeline | models.TreeLearner] | None = None,
) -> Trained:
    """Fits every learner to all early flights, keeps the one with the least MAE on the late ones.

    Written below ``out``: ``model``, ``lookup_airport``, ``lookup_carrier``,
    ``flight_lookup`` (usual route and hour of each flight number) and ``metadata``.
    """
    flights = cleaning.clean_flights(csv_files.scan_csv_dir(spark, flights_dir))
    flights = settled(flights.withColumn("DISTANCE", F.col("DISTANCE").try_cast("double")).select(*FLIGHT))
    raw = csv_files.scan_delay_cause(spark, causes_dir)
    if raw is None:
        raise FileNotFoundError(f"no delay-cause report below {causes_dir}")
    causes = settled(cleaning.clean_delay_cause(csv_files.typed_delay_cause(raw)))
    train, test = training_parts(flights, causes)
    fitted, measured = models.train_and_evaluate(pipelines or candidates(), train, test)
    measured = settled(measured)
    best = models.select_best(measured).first()["model"]
    history = settled(metrics.avg_delay_minutes_safe(metrics.delay_rates_safe(causes)))
    paths = sinks.write_tables(
        {
            "lookup_airport": summaries.airport_lookup(history),
            "lookup_carrier": summaries.carrier_lookup(history),
            "flight_lookup": summaries.flight_lookup_mode(flights),
        },
        out,
    )
    count = F.count(F.lit(1))
    sizes = train.agg(count.alias("n_train")).withColumn("n_test", test.agg(count).scalar())
    paths["metadata"] = sinks.write_metadata(sinks.training_summary(measured, sizes, K.MAJOR_HUBS), f"{out}/metadata")
    paths["model"] = sinks.save_model(fitted[best], f"{out}/model")
    return Trained(best, fitted[best], measured, paths)
