"""Profiles of tables, sketches of months, and features from a table's own suggestions."""

import pytest
from pyspark.sql import functions as F

from delaykit.operators import cleaning, engineered, summaries

COUNTS = ("n_rows", "n_filled", "n_null", "n_distinct")


def profile(df, **how):
    return {r["column_name"]: tuple(r[c] for c in COUNTS) for r in cleaning.profile_table(df, **how).collect()}


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(spark, approximate):
    df = spark.createDataFrame(
        [("a", 0.0, [1, 2], None), ("a", -0.0, [1, 2], None), (None, float("nan"), [12], None), ("", 3.5, None, None)],
        "`odd.name` string, x double, list array<int>, gone string",
    ).repartition(3)
    got = profile(df, approximate=approximate)
    assert got == {"odd.name": (4, 3, 1, 2), "x": (4, 4, 0, 3), "list": (4, 3, 1, 2), "gone": (4, 0, 4, 0)}
    kinds = [tuple(r) for r in cleaning.profile_table(df).orderBy("position").select("position", "data_type").collect()]
    assert kinds == [(0, "string"), (1, "double"), (2, "array<int>"), (3, "string")]
    assert profile(df.limit(0), approximate=approximate) == dict.fromkeys(got, (0, 0, 0, 0))


def months(spark, rows):
    schema = "year int, month int, airport string, carrier string, arr_flights double, arr_del15 double, avg_delay_minutes double"
    return spark.createDataFrame(rows, schema)


def test_stored_sketches_give_any_period(spark, tmp_path):
    rows = [
        (2000 + m // 12, m % 12 + 1, f"P{m * 300 + i % 2000}", f"C{i % 7}", 2.0, 1.0, None if i % 3 else float(m))
        for m in range(30) for i in range(3000)
    ]
    table = months(spark, [*rows, (2001, 1, None, None, None, None, None)])
    summaries.monthly_sketches(table).write.parquet(str(tmp_path / "months"))
    stored = spark.read.parquet(str(tmp_path / "months"))
    assert stored.count() == 30
    for first, last in (((2000, 1), (2002, 6)), ((2000, 11), (2001, 2)), ((2002, 6), (2002, 6))):
        month = F.col("year") * 12 + F.col("month")
        part = table.filter(month.between(first[0] * 12 + first[1], last[0] * 12 + last[1]))
        wanted, got = summaries.dataset_kpis(part).first(), summaries.kpis_of_period(stored, first, last).first()
        for column in part.sparkSession.createDataFrame([wanted]).columns:
            share = 0.02 if column in ("n_airports", "n_carriers") else 1e-12
            assert got[column] == pytest.approx(wanted[column], rel=share), column
    assert summaries.kpis_from_sketches(stored, ["year"]).count() == 3


def test_sketches_of_nothing(spark):
    got = summaries.kpis_from_sketches(summaries.monthly_sketches(months(spark, []))).first()
    assert got["n_records"] is None and got["n_airports"] in (0, None)


def test_features_a_table_suggests_for_itself(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("up"), (F.col("id") % 7).cast("double").alias("week"),
        (F.col("id") * 3 % 11).cast("double").alias("other"), F.lit("x").alias("kept"),
    )
    features = ["up", "week", "other"]
    report = engineered.own_suggestions(df, features)
    built = engineered.engineer_from_report(df, features, "all")
    named = {s["new_feature_name"] for kind in ("interaction", "polynomial") for s in report[kind]}
    assert named and named <= set(built.columns) and built.count() == 200
    row = built.filter("up = 10").first()
    for s in report["interaction"]:
        if s["operation"] == "multiply":
            a, b = s["features"][:2]
            assert row[s["new_feature_name"]] == pytest.approx(row[a] * row[b])
