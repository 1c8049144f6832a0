import math
import random

import pytest

from delaykit.functions.tails import f_pvalue, t_pvalue
from delaykit.operators import quantiles, statistics


def tails(spark, rows, column):
    df = spark.createDataFrame(rows, "x double, d1 double, d2 double")
    return [r[0] for r in df.select(column).collect()]


def test_t_tail_closed_forms(spark):
    values = [0.0, 0.3, 1.0, 5.0, 40.0]
    one, two = (tails(spark, [(t, d, None) for t in values], t_pvalue("x", "d1")) for d in (1.0, 2.0))
    for t, p, q in zip(values, one, two):
        assert p == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-10)
        assert q == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9, abs=1e-14)


def test_f_tail_closed_forms(spark):
    values = [0.1, 1.0, 9.0]
    upper = tails(spark, [(f, 2.0, 10.0) for f in values], f_pvalue("x", "d1", "d2"))
    assert upper == pytest.approx([(1 + 2 * f / 10) ** -5 for f in values], rel=1e-10)
    # With two upper degrees of freedom the tail is a power, also for many rows.
    many = tails(spark, [(f, 2.0, 1e6) for f in values], f_pvalue("x", "d1", "d2"))
    assert many == pytest.approx([(1 + 2 * f / 1e6) ** -5e5 for f in values], rel=1e-7)
    square = tails(spark, [(f * f, 1.0, 7.0) for f in values], f_pvalue("x", "d1", "d2"))
    assert square == pytest.approx(tails(spark, [(f, 7.0, None) for f in values], t_pvalue("x", "d1")), rel=1e-10)


def test_tails_without_a_statistic(spark):
    rows = [(None, 3.0, 3.0), (float("nan"), 3.0, 3.0), (1.0, None, 3.0), (1.0, 0.0, 3.0), (0.0, 0.0, 0.0)]
    assert tails(spark, rows, t_pvalue("x", "d1")) == [None] * 5
    assert tails(spark, rows, f_pvalue("x", "d1", "d2")) == [None] * 5
    assert tails(spark, [(float("inf"), 3.0, 3.0)], t_pvalue("x", "d1")) == [0.0]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    rows = {(r["x"], r["y"]): r["corr"] for r in statistics.correlation_matrix(df, ["a", "b"]).collect()}
    assert rows["a", "b"] is None and rows["a", "a"] is None and rows["b", "b"] == pytest.approx(1.0)


def test_anova_by_hand(spark):
    groups = {"p": [1.0, 2.0, 3.0], "q": [2.0, 4.0, 6.0], "r": [9.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "carrier_name string, avg_delay_minutes double")
    values = [v for _, v in rows]
    grand = sum(values) / len(values)
    between = sum(len(v) * (sum(v) / len(v) - grand) ** 2 for v in groups.values())
    within = sum((x - sum(v) / len(v)) ** 2 for v in groups.values() for x in v)
    got = statistics.anova_pvalue(statistics.anova(df)).first()
    assert got["f_stat"] == pytest.approx((between / 2) / (within / 4))
    assert got["p_value"] == pytest.approx((1 + 2 * got["f_stat"] / 4) ** -2)


def test_quantiles_with_copies(spark):
    random.seed(5)
    values = [1.0] * 400 + [random.random() * 1e6 for _ in range(700)] + [-3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = quantiles.exact_quantiles(df, "v", probs, [f"q{i}" for i in range(6)]).first()
    values.sort()
    for p, q in zip(probs, got):
        at = p * (len(values) - 1)
        low = math.floor(at)
        high = min(low + 1, len(values) - 1)
        assert q == pytest.approx(values[low] + (values[high] - values[low]) * (at - low))


def interpolated(values, p):
    at = p * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


@pytest.mark.parametrize("hot", [0, 20_000])
def test_quantiles_from_a_sketch(spark, hot):
    random.seed(6)
    values = [random.gauss(0, 50) for _ in range(40_000)] + [12.5] * hot
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(5)
    probs = (0.0, 0.25, 0.5, 0.501, 0.75, 1.0)
    names = [f"q{i}" for i in range(len(probs))]
    values.sort()
    wanted = [interpolated(values, p) for p in probs]
    assert list(quantiles.exact_quantiles(df, "v", probs, names).first()) == pytest.approx(wanted)
    counted = quantiles._bracketed(df, "v", df.agg(*quantiles._sketch(df["v"], probs)).first()["ends"])
    # What lies between the brackets is not counted value by value.
    assert counted.count() < 2_000 and counted.agg({"n": "sum"}).first()[0] == len(values)
    # A bracket beside its quantile is noticed.
    beside = [values[0], values[10]] * len(probs)
    found = quantiles._from_sketch(df, "v", probs, names, len(values), beside).first()
    assert list(found) == pytest.approx(wanted)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert list(quantiles.exact_quantiles(df, "v", (0.5,), ["q"]).first()) == [None]
    assert quantiles.delay_distribution(df, "v").first()["p50"] is None
