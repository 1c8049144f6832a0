"""Exact selection and salted joins against plain ways of doing the same."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from delaykit.operators import lookups, selection, splitting


def hot(spark):
    """A third of the rows are copies of one row."""
    return spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"),
        F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
    )


def by_hand(rows, quota):
    """Sorted by digest then columns; the first quota rows of each group."""
    out = []
    for g, k in quota.items():
        mine = sorted(
            (hashlib.md5(f"{v}|{s}".encode()).hexdigest(), v, s) for v, s in rows if s == g
        )
        out += [(v, s, i < k) for i, (_, v, s) in enumerate(mine)]
    return sorted(out)


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("quota", [{"a": 0, "b": 1}, {"a": 50, "b": 200}, {"a": 10_000, "b": 399}])
def test_take_exact(spark, quota, digits):
    df = hot(spark)
    table = spark.createDataFrame(list(quota.items()), "g string, quota long")
    got = selection.take_exact(df, table, ["g"], digits=digits)
    assert sorted(tuple(r) for r in got.collect()) == by_hand([tuple(r) for r in df.collect()], quota)


def test_repeat_rows(spark, monkeypatch):
    monkeypatch.setattr(selection, "COPIES_PER_TASK", 10)
    df = spark.createDataFrame([("x", 25), ("y", 10), ("z", 0), ("w", 1)], "k string, n long")
    counts = {r["k"]: r["count"] for r in selection.repeat_rows(df, "n").groupBy("k").count().collect()}
    assert counts == {"x": 25, "y": 10, "w": 1}


def test_temporal_split_with_one_hot_date(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 200, "2024-01-02").when(F.col("id") < 250, "2024-01-01")
        .otherwise("2024-01-03").cast("date").alias("FL_DATE"),
        (F.col("id") % 5).alias("v"),
    )
    out = splitting.temporal_split(df)
    assert out.count() == 300
    train = out.filter("split = 'train'")
    assert train.count() == 240
    assert train.filter("FL_DATE = date'2024-01-03'").count() == 0
    assert train.filter("FL_DATE = date'2024-01-01'").count() == 50


def test_random_and_stratified_sizes(spark):
    df = hot(spark)
    assert splitting.random_split(df).filter("split = 'train'").count() == 480
    out = splitting.stratified_split(df, "g")
    sizes = {(r["g"], r["split"]): r["count"] for r in out.groupBy("g", "split").count().collect()}
    assert sum(sizes.values()) == 600
    assert sizes["a", "train"] + sizes["b", "train"] == 480
    assert abs(sizes["a", "train"] - 0.8 * 200) < 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_that_cannot_broadcast(spark, how):
    facts = hot(spark)
    lookup = spark.createDataFrame([("b", 1.0), ("c", 2.0)], "g string, w double")
    key = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    small = key(lookups.lookup_join(facts, lookup, ["g"], how))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert key(lookups.lookup_join(facts, lookup, ["g"], how)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rank_limit_is_applied_before_the_shuffle(spark, capsys):
    selection.first_per_key(hot(spark), ["g"], ["v"]).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_rows_are_not_dealt_out_by_a_few_strata(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    quota = rows.groupBy("k").agg((F.count(F.lit(1)) / 3).cast("bigint").alias("quota"))
    # An estimate of the lookup from the rows it is counted from is far above the limit.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        picked = selection.take_exact(rows, quota, ["k"])
        plan = picked._jdf.queryExecution().sparkPlan().toString()
        found = {r["k"]: r["n"] for r in picked.where("picked").groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert found == {0: 333, 1: 333, 2: 333}
    assert not re.search(r"SortMergeJoin \[k#\w+\],", plan)
