"""Codes and indicator vectors of labels."""

import random

from pyspark.sql import functions as F

from delaykit.operators import features


def labels(n):
    r = random.Random(8)
    return ["".join(r.choice("abcXYZ09é ") for _ in range(r.randint(0, 6))) for _ in range(n)]


def test_codes_are_alphabetical(spark):
    values = labels(6000)
    df = spark.createDataFrame([(v, i) for i, v in enumerate([*values, *values[:900], None])], "label string, range int")
    codes = features.label_codes(df.repartition(6), "label").collect()
    wanted = {v: i for i, v in enumerate(sorted(set(values), key=lambda v: v.encode()))}
    assert len(codes) == len(wanted) and {r["label"]: r["label_code"] for r in codes} == wanted
    coded = features.label_encode(df, ["label"]).collect()
    assert len(coded) == df.count()
    assert all(r["label_code"] == (wanted[r["label"]] if r["label"] is not None else 0) for r in coded)
    assert features.label_codes(df.limit(0), "label").collect() == []


def test_vectors_equal_those_of_the_indexer(spark):
    rows = [(i, random.Random(i).choice(["b", "a", "é", "Z", None]), "q") for i in range(80)]
    df = spark.createDataFrame(rows, "id int, kind string, other string")
    cols = ["kind", "other"]
    picked = ["id", "kind_index", "kind_hot", "other_index", "other_hot"]
    ours = features.one_hot_encode(df, cols).select(picked).orderBy("id").collect()
    known = features.one_hot_encoder(cols).fit(df).transform(df).select(picked).orderBy("id").collect()
    assert ours == known
    # Empty labels are labels, which the indexer's names do not allow.
    empty = features.one_hot_encode(spark.createDataFrame([("",), ("a",)], "kind string"), ["kind"]).orderBy("kind")
    assert [r["kind_hot"].toArray().tolist() for r in empty.collect()] == [[1.0, 0.0], [0.0, 1.0]]


def test_encoded_features_equal_the_preprocessor(spark):
    rows = [(i, float(i * i % 7), ["x", "y", "z"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, v double, kind string")
    ours = features.encoded_features(df, ["v"], ["kind"]).orderBy("id")
    known = features.fit_preprocessor(df, ["v"], ["kind"]).transform(df).orderBy("id")
    assert [r[0].toArray().tolist() for r in ours.select("features").collect()] == [
        r[0].toArray().tolist() for r in known.select("features").collect()
    ]
    assert features.encoded_features(df, ["v"], []).where(F.col("features").isNull()).count() == 0
