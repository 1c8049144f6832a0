"""Classifiers, neighbours and the pipeline: held-out accuracy, brute force, awkward rows."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from delaykit.llm import ann, learning, pieces, quality, rules, toxicity
from delaykit.llm.queries import QUERIES
from helpers import AWKWARD, LABELS, SF, documents
from pyspark.sql import functions as F
from test_duplicates import groups_by_force

SF_LEARN = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_LEARN}/labels.parquet").collect()}


@pytest.mark.parametrize(
    ("name", "label", "cut", "least"), [("op5_quality_scores", "quality", 0.7, 0.95), ("op6_toxicity_scores", "toxic", 0.3, 0.93)]
)
def test_held_out_accuracy(spark, labels, name, label, cut, least):
    rows = QUERIES[name](spark, SF_LEARN).collect()
    assert len(rows) == spark.read.parquet(f"{SF_LEARN}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([labels[r.doc_id][label] == r.predicted for r in judged]) >= least


def test_held_out_rows(spark):
    import zlib

    df = spark.range(50).select(F.col("id").alias("doc_id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    for row in df.withColumn("held", learning.held_out("doc_id")).collect():
        assert row.held == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)


def test_labels_of_one_kind_teach_nothing(spark):
    df = documents(spark, AWKWARD)
    for rows in ([], [(1, 1, 0), (None, 0, 1), (2, None, None)]):
        known = spark.createDataFrame(rows, LABELS)
        scored = quality.score_documents(df, known).collect()
        assert len(scored) == len(AWKWARD) and {round(r.score, 9) for r in scored} == {0.7}
        assert all(r.predicted == 1 for r in scored)
        assert quality.keep_good(df, known).count() == len(AWKWARD)
        scored = toxicity.score_documents(df, known).collect()
        assert len(scored) == len(AWKWARD) and all(r.predicted == 0 for r in scored)
    assert quality.score_documents(df.limit(0), known).collect() == []
    assert toxicity.score_documents(df.limit(0), known).collect() == []


def test_strengths_follow_preferences():
    r = random.Random(2)
    good = [" ".join(f"w{r.randint(0, 500)}" for _ in range(60)) for _ in range(80)]
    bad = [" ".join(["same"] * r.randint(40, 80)) for _ in range(80)]
    x = np.stack([quality.features(t) for t in good + bad])
    model = quality.fit(x, np.array([1] * 80 + [0] * 80), {1: 800, 0: 80})
    scores = model.scores(x)
    assert (scores[:80] >= 0.7).all() and (scores[80:] < 0.7).all()


def test_folding():
    # Signs at the edge of a word are read both ways.
    assert toxicity.fold("  ІdІ0t!!  L0$er, ｓｃｕｍ st​upid $lime 5 5th") == " idiot loser scum stupid slime th sth "
    assert toxicity.fold("5tupid 1diot asshol3 as$! 2nd") == " tupid stupid diot idiot asshol asshole as ass nd "
    assert toxicity.fold("") == "  "


def test_disguised_edges_are_hits():
    lexicon = toxicity.Lexicon(((" stupid ", 1.0), (" idio", 2.0), (" asshole ", 3.0)))
    found = lambda t: sorted(w for _, w in toxicity.hits(toxicity.fold(t), lexicon))
    assert found("5tupid 1diot asshol3") == [1.0, 2.0, 3.0] and found("the 5th of 10 on 1st") == []


def test_held_out_toxic_documents_are_found(spark, labels):
    rows = QUERIES["op6_toxicity_scores"](spark, SF_LEARN).collect()
    judged = [(labels[r.doc_id]["toxic"], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(a == b == 1 for a, b in judged)
    # There are only 14 toxic ones here.
    assert right >= 0.9 * sum(a for a, _ in judged) and right >= 0.8 * sum(b for _, b in judged)


def test_repeated_ids_weigh_no_more(spark):
    good = [(i, f"calm words about place {i} and thing {i % 7}") for i in range(60)]
    bad = [(100 + i, f"you total grobnak number {i} of thing {i % 7}") for i in range(60)]
    marks = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 1) for i, _ in bad], LABELS)
    once = spark.createDataFrame(good + bad, "doc_id long, text string")
    often = spark.createDataFrame(good + bad + good[:1] * 500 + bad[:1] * 500, "doc_id long, text string")
    for part in (quality, toxicity):
        scores = [
            {r.doc_id: r.score for r in part.score_documents(df, marks).collect()} for df in (once, often)
        ]
        assert scores[0] == pytest.approx(scores[1])


def test_hits_and_harmless_phrases():
    lexicon = toxicity.Lexicon(((" bad ", 2.0), (" vil", 1.0), (" vile ", 3.0)), (" not bad ", " bad luck "))
    found = lambda t: sorted(w for _, w in toxicity.hits(toxicity.fold(t), lexicon))
    assert found("bad, b4d villain VILE badly") == [1.0, 2.0, 2.0, 3.0]
    assert found("not bad, bad luck") == [] and found("not bad bad") == [2.0]
    assert toxicity.hits(" bad ", toxicity.Lexicon(())) == []


def test_learned_lexicon(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):
        words = [f"{r.choice('bcdfgklmnprstv')}{r.choice('aeiou')}{r.choice('bcdfgklmnprstv')}{r.choice('aeiou')}" for _ in range(30)]
        toxic = i % 2
        words += [r.choice(["grobal", "zorkl" + r.choice("aeiouxyz") * 2])] if toxic else ["grobal salad"] * (i % 4 == 0)
        rows.append((i, toxicity.fold(" ".join(words)), toxic))
    learned = toxicity.learn_lexicon(spark.createDataFrame(rows, "_id long, folded string, label int"))
    assert any(t.startswith(" zork") and not t.endswith(" ") for t, _ in learned.terms)


def test_graph_recall():
    random_ = np.random.default_rng(0)
    vectors = ann._unit(random_.normal(size=(1500, 24)))
    graph = ann.build_graph(vectors)
    queries = vectors[:200]
    exact = np.argsort(-(queries @ vectors.T), axis=1)[:, :6]
    nodes, _ = ann.search_graph(graph, queries)
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(exact, nodes, strict=True)]) > 0.95
    for n in (0, 1, 2):
        nodes, _ = ann.search_graph(ann.build_graph(vectors[:n]), queries[:3])
        assert nodes.shape[0] == 3 and set(nodes.ravel()) <= set(range(n)) | {-1}


def exact_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        scores = []
        for i, w in rows:
            if i != q and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                scores.append((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i))
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_nearest_with_copies_and_unusable_vectors(spark):
    r = random.Random(5)
    good = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    good += [(100 + i, good[7][1]) for i in range(30)] + [(300, [1.0, 2.0]), (301, [2.0, 1.0])]
    nothing = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0])]
    rows = [*good, *nothing, (None, [1.0] * 4), good[3]]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, id int, hash int, score int")
    asked = df.where("vec_id % 10 = 0 OR vec_id IN (7, 203, 301) OR vec_id IS NULL")
    found = ann.nearest(df, asked, shard_rows=20).collect()
    vectors = {r.vec_id: r.embedding for r in df.collect() if r.vec_id is not None}
    usable = [(i, vectors[i]) for i in dict(good)]
    ids = {r.vec_id for r in asked.collect()} & {i for i, _ in usable}
    expected = exact_nearest(usable, [(i, vectors[i]) for i in ids], 5)
    mine = {q: [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] for q in ids}
    assert {r.query_id for r in found} == set(ids) and mine == expected
    assert ann.nearest(df.limit(0), df.limit(0)).collect() == []


def test_pipeline(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given, kept = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF).cache()
        assert docs.count() > 0
        if name != "encoding":
            assert docs.columns == columns
            given[name], kept[name] = before.collect(), docs.collect()
    assert set(docs.columns) == {"doc_id", "ids", "n_pieces", "ids_crc32"}
    assert corpus_pipeline.run(spark, SF).count() == docs.count()

    def ids(rows):
        return sorted(r.doc_id for r in rows)

    # What each stage keeps of its own input, worked out beside it.
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    good = quality.score_documents(whole, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1")
    assert ids(kept["quality classifier"]) == ids(good.collect())
    passed = rules.host_rules(spark.createDataFrame(given["quality rules"], whole.schema))
    assert ids(kept["quality rules"]) == ids(passed.where("kept").collect())
    groups = groups_by_force([(r.doc_id, r.text) for r in given["near duplicates"]])
    assert ids(kept["near duplicates"]) == sorted({c for _, _, c in groups})
    assert set(kept["source mix"]) == set(given["source mix"])
    coder = pieces.PieceCoder(pieces.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    wanted = sorted((r.doc_id, coder.encode(r.text or "")) for r in kept["source mix"])
    assert sorted((r.doc_id, bytes(r.ids)) for r in docs.collect()) == wanted


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
