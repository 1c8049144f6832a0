import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators import engineered, scoring
from delaykit.operators import history as past


def lookup(spark, key, name, base):
    cols = ", ".join(f"{c} double" for c in K.HISTORY_ORIGIN)
    return spark.createDataFrame([(name, *[base + i for i in range(12)])], f"{key} string, {cols}")


def tables(spark):
    return lookup(spark, "ORIGIN", "ATL", 0.1), lookup(spark, "OP_CARRIER", "AA", 0.2)


def test_gate_for_every_combination(spark):
    cases = list(product(("AA", "ZZ"), ("ATL", "QQQ"), ("ATL", "QQQ")))
    rows = [(c, o, d, dt.date(2025, 7, 5), 8) for c, o, d in cases]
    requests = spark.createDataFrame(rows, "carrier string, origin string, dest string, flight_date date, dep_hour int")
    out = {(r["carrier"], r["origin"], r["dest"]): r for r in scoring.score_gated(requests, *tables(spark), mae=1e6).collect()}
    assert len(out) == 8
    for (c, o, d), r in out.items():
        known = [n for n, v in (("carrier", c == "AA"), ("origin", o == "ATL"), ("dest", d == "ATL")) if v]
        assert r["prediction_available"] == bool(known)
        if not known:
            assert r["predicted_delay"] is None and r["upper_bound"] is None
            assert r["message"].startswith("No historical data found for carrier ZZ, origin QQQ")
            continue
        assert r["message"] == "Prediction based on available data: " + ", ".join(known)
        assert r["lower_bound"] == 0.0
        assert r["origin_delay_rate"] == pytest.approx(10.0 if o == "ATL" else 20.0)
        assert r["dest_delay_rate"] == pytest.approx(10.0 if d == "ATL" else 0.0)
        assert r["carrier_avg_delay"] == pytest.approx(7.2 if c == "AA" else 50.0)


def test_published_band(spark):
    df = spark.createDataFrame([(43.58380488740287, 5.45624026913603)], "predicted_delay double, confidence_mae double")
    r = scoring.confidence_band(df).first()
    assert r["lower_bound"] == pytest.approx(38.12756461826684) and r["upper_bound"] == pytest.approx(49.0400451565389)


def test_batch_defaults(spark):
    requests = spark.createDataFrame(
        [("zz", "qqq", "atl", dt.date(2025, 7, 5), 8)],
        "carrier string, origin string, dest string, flight_date date, dep_hour int",
    )
    r = scoring.score_batch(requests, *tables(spark)).first()
    # Weekend rush hour over 500 miles from the two mean delays.
    assert r["predicted_delay"] == pytest.approx(round((6.1 + 6.2) / 2 * 1.2 * 1.3 * 1.025, 1))
    assert r["lower_bound"] < 0 and r["origin_delay_rate"] == 18.0 and r["dest_delay_rate"] == 10.0


def test_history_first_entry_and_filters(spark):
    rows = [("k", "2024-01-02 00:00:00", 20.0), ("k", "2024-01-01 00:00:00", 10.0), ("j", "2024-01-20 00:00:00", 20.5)]
    df = spark.createDataFrame(rows, "history_key string, timestamp string, predicted_delay double").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    assert sorted(r["predicted_delay"] for r in past.history_dedup(df).collect()) == [10.0, 20.5]
    assert past.history_filter(df, "high").count() == 1 and past.history_filter(df, "low").count() == 0
    assert past.history_filter(df, "week", "2024-01-21 00:00:00").count() == 1
    assert past.history_filter(df, "recent", n=2).count() == 2


def test_one_row_keeps_its_fitted_risk(spark):
    many = spark.createDataFrame([(float(i), float(i * 2)) for i in range(10)], "avg_delay_a double, avg_delay_b double")
    scale = engineered.fit_risk_scale(many)
    row = engineered.composite_delay_risk(many.filter("avg_delay_a = 9"), scale).first()
    assert row["composite_delay_risk_score"] == pytest.approx(4.5 / (sum((i - 4.5) ** 2 for i in range(10)) / 9) ** 0.5)
