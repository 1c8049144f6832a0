"""Sums by blocks of columns against one expression for each pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaykit.operators import engineered, statistics, wide


def table(spark, rows=400, columns=6, seed=3):
    rng = np.random.default_rng(seed)
    values = rng.normal(1e6, 1.0, (rows, columns)) + rng.normal(0, 1, (rows, 1))
    data = [[None if rng.random() < 0.1 else float(v) for v in row] for row in values]
    names = [f"c{i:04d}" for i in range(columns)]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(3), names


def as_map(df):
    return {(r["x"], r["y"]): r["corr"] for r in df.collect()}


@pytest.mark.parametrize("panel, a_pass", [(256, 32), (2, 2)])
def test_blocks_equal_expressions(spark, monkeypatch, panel, a_pass):
    monkeypatch.setattr(wide, "PANEL", panel)
    monkeypatch.setattr(wide, "PASS_PAIRS", a_pass)
    df, names = table(spark)
    df = df.withColumn("flat", F.lit(0.1)).withColumn("odd.name", F.col("c0000") * -2).withColumn(
        # Constant where c0001 is known, though not everywhere.
        "part", F.when(F.col("c0001").isNull(), 7.25).otherwise(1e5)
    ).withColumn("gone", F.lit(None).cast("double"))
    cols = [*names, "flat", "part", "gone"]
    got, wanted = as_map(wide.correlations(df, cols)), as_map(statistics.correlation_matrix(df, cols))
    assert got.keys() == wanted.keys()
    for pair, value in wanted.items():
        assert got[pair] == (None if value is None else pytest.approx(value, abs=1e-9)), pair
    assert got["part", "c0001"] is None and got["gone", "gone"] is None
    assert as_map(wide.correlations(df, ["odd.name", "c0000"]))["c0000", "odd.name"] == pytest.approx(-1.0)


def test_missing_values(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (float("nan"), 1.0), (float("inf"), 1.0), (None, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = wide.pair_sums(df, ["a", "b"]).filter("i = 0 AND j = 1").first()
    assert got["n"] == 3
    assert as_map(wide.correlations(df, ["a", "b"]))["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    empty = as_map(wide.correlations(df.limit(0), ["a", "b"]))
    assert empty == {(x, y): None for x in "ab" for y in "ab"}


def test_a_thousand_columns(spark):
    df, names = table(spark, rows=60, columns=1000)
    got = as_map(statistics.correlation_matrix(df, names))
    assert len(got) == 1_000_000
    values = df.select("c0003", "c0777", "c0999").toPandas().corr()
    for x in values:
        for y in values:
            assert got[x, y] == got[y, x] == pytest.approx(values.loc[x, y], abs=1e-9)


def test_ranking_of_many_features(spark, monkeypatch):
    df, names = table(spark, columns=12)
    df = df.withColumn("flat", F.lit(3.0)).withColumn("DEP_DELAY", F.col("c0001") - F.col("c0002")).withColumn("_one", F.lit(2.0))
    features = [*names, "flat", "_one"]
    small = {r["feature"]: r for r in engineered.rank_new_features(df, features).collect()}
    monkeypatch.setattr(wide, "WIDE", 3)
    ranked = engineered.rank_new_features(df, features).collect()
    assert [r["importance_score"] for r in ranked] == sorted((r["importance_score"] for r in ranked), reverse=True)
    assert {r["feature"] for r in ranked} == set(features)
    for r in ranked:
        for value, other in zip(r[1:], small[r["feature"]][1:]):
            assert value == (None if other is None else pytest.approx(other, rel=1e-7, abs=1e-9)), r["feature"]
