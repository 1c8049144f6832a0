"""Saved results: tables, run summaries, history exports and fitted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.operators import trees
from delaykit.sources.tables import exists


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Save one table.

    With partition columns the rows of one partition value are still written by
    many tasks, so a single hot month does not end in one writer.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_tables(
    tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    parts = partition_by or {}
    return {
        name: write_table(df, f"{path}/{name}", fmt, parts.get(name, ()))
        for name, df in tables.items()
    }


def write_metadata(summary: DataFrame, path: str) -> str:
    """One-row run summary, nested columns and all, as JSON."""
    summary.write.mode("overwrite").json(path)
    return path


def training_summary(metrics: DataFrame, sizes: DataFrame, hubs: Sequence[str], **labels: str) -> DataFrame:
    """Metrics per model, split sizes and labels as one nested row.

    ``metrics`` has one row per model and ``sizes`` a single row.
    """
    models = metrics.agg(
        F.sort_array(F.collect_list(F.struct("model", "mae", "rmse", "r2"))).alias("metrics"),
        F.min_by("model", F.struct("mae", "model")).alias("best_model"),
        F.min("mae").alias("selected_mae"),
    )
    row = models.select(
        "best_model",
        "selected_mae",
        "metrics",
        F.array(*[F.lit(h) for h in sorted(hubs)]).alias("major_hubs"),
        *[F.lit(v).alias(k) for k, v in labels.items()],
    )
    for c in sizes.columns:
        row = row.withColumn(c, sizes.select(c).scalar())
    return row


def write_history(history: DataFrame, path: str, fmt: str = "csv") -> str:
    return write_table(history, path, fmt)


def save_model(model: PipelineModel | trees.TreeModel, path: str) -> str:
    if isinstance(model, trees.TreeModel):
        return trees.save(SparkSession.active(), model, path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | trees.TreeModel:
    spark = SparkSession.active()
    return trees.load(spark, path) if exists(spark, f"{path}/trees") else PipelineModel.load(path)


def save_suggestions(report: DataFrame, path: str) -> str:
    report.write.mode("overwrite").json(path)
    return path


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    from delaykit.operators.suggestions import SCHEMA

    return spark.read.schema(SCHEMA).json(path)
