"""The quality model learns from every labelled document."""

import numpy as np
from helpers import LABELS
from pyspark.sql import functions as F

from delaykit.llm import quality


def test_all_labelled_documents_count(spark):
    # 13,000 good documents of two kinds; the rare kind comes last by the hash of its id.
    ids = spark.range(30_000).where(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2).select("id")
    ids = ids.orderBy(F.xxhash64("id")).limit(20_000).toPandas()["id"].tolist()
    good, bad = ids[:13_000], ids[13_000:]
    plain, rare, poor = "several words make this line", "0123 4567 8901 2345 6789", "bad bad bad bad bad"
    rows = [(i, plain if n < 12_500 else rare) for n, i in enumerate(good)] + [(i, poor) for i in bad]
    marks = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad], LABELS)
    measured = quality.measured(spark.createDataFrame(rows, "doc_id long, text string"))
    model = quality.train(measured, marks)
    cuts = [k for k, c in zip(model.knots, quality.CLASSES, strict=False) if c[0] == "digit"]
    scores = model.scores(np.stack([quality.features(t) for t in (plain, rare, poor)]))
    assert cuts and scores[0] >= 0.7 and scores[1] >= 0.7 and scores[2] < 0.7


def test_each_document_is_in_a_pair():
    for good, bad in ((7, 3), (3, 7), (5, 5), (1, 4)):
        won, lost = quality._pairs(good, bad, 2, 1)
        assert set(won) == set(range(good)) and set(lost) == set(range(bad)) and len(won) == len(lost)
