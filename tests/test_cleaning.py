import pytest
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes, labels, numbers
from delaykit.operators import cleaning, metrics


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, hour",
    [("0", 0), ("59", 0), ("100", 1), ("2359", 23), ("2400", 23), ("-5", 0), ("13.0", None), ("abc", None), (None, None)],
)
def test_hour(spark, text, hour):
    assert one(spark, text, "string", lambda c: numbers.hhmm_to_hour(numbers.to_whole(c))) == hour


@pytest.mark.parametrize("text, value", [("1e3", 1000.0), (" 2.5 ", 2.5), ("1d", None), ("NaN", None), ("", None), (".5", 0.5)])
def test_number(spark, text, value):
    assert one(spark, text, "string", numbers.to_number) == value


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "arr_flights double")
    assert cleaning.coerce_numeric(df).agg(F.count("arr_flights")).first()[0] == 1


def test_clean_flights_range_and_codes(spark):
    rows = [
        (" aa ", "1", " atl ", "LAX", "100", d, "2024-01-05", 1.0) for d in ("-30", "300", "300.01", "-30.5", "x")
    ]
    kinds = ", ".join(f"{c} {'double' if c == 'DISTANCE' else 'string'}" for c in K.FLIGHT_COLUMNS)
    df = cleaning.clean_flights(spark.createDataFrame(rows, kinds))
    assert sorted(r["DEP_DELAY"] for r in df.collect()) == [-30.0, 300.0]
    assert df.first()["ORIGIN"] == "ATL" and df.first()["OP_CARRIER"] == "AA"
    assert cleaning.filter_hub_routes(df).count() == 2
    assert cleaning.filter_hub_routes(df, ["DEN"]).count() == 0


def test_required_columns(spark):
    df = spark.range(1)
    with pytest.raises(cleaning.MissingColumns, match="carrier"):
        cleaning.require_columns(df, K.REPORT_REQUIRED)
    assert cleaning.require_columns(df, ["id"]) is df


def test_no_hubs_is_no_filter(spark):
    df = spark.createDataFrame([("ATL",), ("XYZ",)], "airport string")
    assert cleaning.filter_hubs(df, []).count() == 2 and cleaning.filter_hubs(df).count() == 1


def test_zero_denominators(spark):
    cols = list(K.REPORT_NUMERIC)
    row = tuple(0.0 for _ in cols)
    df = spark.createDataFrame([row], ", ".join(f"{c} double" for c in cols))
    safe = metrics.delay_rates_safe(df).transform(metrics.avg_delay_minutes_safe).first()
    assert safe["total_delay_rate"] == 0.0 and safe["avg_nas_delay"] == 0.0
    strict = metrics.delay_cause_pct(metrics.avg_delay_minutes_strict(df)).first()
    assert strict["avg_delay_minutes"] == 0.0 and strict["nas_delay_pct"] == 0.0


def test_delay_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 15.0, 30.0, 60.0, 60.1)], "v double")
    got = [r[0] for r in df.orderBy("v").select(labels.delay_category(F.col("v"))).collect()]
    assert got == list(K.DELAY_LABELS)
    weights = [r[0] for r in df.orderBy("v").select(labels.sample_weight(F.col("v"))).collect()]
    assert weights == [1.0, 1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize(
    "text, upper, found",
    [("AA 123", False, ("AA", "123")), ("aa-1", False, ("AA", "1")), ("aa-1", True, (None, None)),
     ("A 1", False, (None, None)), ("AA12345", False, (None, None))],
)
def test_flight_number(spark, text, upper, found):
    df = spark.createDataFrame([(text,)], "v string")
    assert tuple(df.select(*codes.flight_number_parts(F.col("v"), upper)).first()) == found


def test_select_features(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "n int, s string, y double")
    assert cleaning.select_features(df, target="y") == (["n"], ["s"])
    assert cleaning.select_features(df, ["s", "gone"]) == ([], ["s"])
