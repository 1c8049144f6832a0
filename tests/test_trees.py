"""Trees from histograms against trees grown by trying every split of every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaykit.operators import trees
from delaykit.operators.trees import Rules

RNG = np.random.default_rng(3)
ROWS = [
    (float(a), float(b), c, float(3 * a - (2 if c == "x" else 0) + (a > 3) * b + e), float(w))
    for a, b, c, e, w in zip(
        RNG.integers(0, 8, 300), RNG.integers(0, 5, 300), RNG.choice(["x", "y", "z", "é"], 300),
        RNG.normal(0, 0.5, 300).round(3), RNG.choice([1, 2, 3], 300),
    )
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(*r, i % 4) for i, r in enumerate(ROWS)] + [(None, 1.0, None, 5.0, 1.0, 0), (2.0, 1.0, "x", None, 1.0, 0)]
    return spark.createDataFrame(rows, "a double, b double, c string, y double, w double, part int").repartition(5)


def pull(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0)


def brute_tree(rows, g, h, depth, rules):
    """Prediction function of a tree that tries every value of every column."""

    def score(i):
        return pull(g[i].sum(), rules.l1) ** 2 / (h[i].sum() + rules.l2) if h[i].sum() + rules.l2 > 0 else 0.0

    def grow(i, level):
        leaf = -pull(g[i].sum(), rules.l1) / (h[i].sum() + rules.l2) * rules.rate
        best = (1e-9, None)
        if level < depth and len(i) >= rules.split_rows:
            tests = [(f, v) for f in (0, 1) for v in sorted({rows[j][f] for j in i})]
            tests += [(2, v) for v in sorted({rows[j][2] for j in i})]
            for f, v in tests:
                goes = np.array([rows[j][f] <= v if f < 2 else rows[j][f] == v for j in i])
                left, right = i[goes], i[~goes]
                if min(len(left), len(right)) < rules.least_rows or min(h[left].sum(), h[right].sum()) < rules.least_weight:
                    continue
                gain = 0.5 * (score(left) + score(right) - score(i)) - rules.gamma
                if gain > best[0] + 1e-9:
                    best = (gain, (f, v, left, right))
        if best[1] is None:
            return lambda r: leaf
        f, v, left, right = best[1]
        to_left, to_right = grow(left, level + 1), grow(right, level + 1)
        return lambda r: to_left(r) if (r[f] <= v if f < 2 else r[f] == v) else to_right(r)

    return grow(np.arange(len(rows)), 0)


def brute_boost(rules):
    y, w = np.array([r[3] for r in ROWS]), np.array([r[4] for r in ROWS])
    start = (y * w).sum() / w.sum()
    margin, grown = np.full(len(y), start), []
    for _ in range(rules.trees):
        t = brute_tree(ROWS, w * (margin - y), w, rules.depth, rules)
        margin = margin + np.array([t(r) for r in ROWS])
        grown.append(t)
    return margin


RULES = Rules(trees=4, depth=3, rate=0.3, l1=0.4, l2=1.0, gamma=0.1, least_weight=3.0)


@pytest.mark.parametrize("finish_rows", [1, 60, 1 << 16])
def test_boosting_is_that_of_every_split(spark, table, finish_rows):
    known = table.where("y IS NOT NULL AND a IS NOT NULL")
    source = trees.blocks(known, ["a", "b"], ["c"], "y", weight="w")
    model = trees.boosted(source, RULES, finish_rows=finish_rows)[0]
    found = {tuple(r)[:5]: r["prediction"] for r in model.transform(known).collect()}
    for row, wanted in zip(ROWS, brute_boost(RULES)):
        assert found[row] == pytest.approx(wanted, abs=1e-9)


def test_margins_written_anew_change_nothing(spark, table, monkeypatch):
    source = trees.blocks(table, ["a", "b"], ["c"], "y", weight="w")
    whole = trees.boosted(source, RULES)[0]
    monkeypatch.setattr(trees, "KEPT_TREES", 2)
    again = trees.boosted(source, RULES)[0]
    assert [t.value for t in whole.trees] == [pytest.approx(t.value) for t in again.trees]


def test_a_part_left_out_is_not_learned_from(spark, table):
    source = trees.blocks(table, ["a", "b"], ["c"], "y", part="part")
    rules = Rules(trees=3, depth=3, rate=0.5)
    one, other = trees.boosted(source, rules, parts=(0, 3))
    alone = trees.blocks(table.where("part != 3"), ["a", "b"], ["c"], "y", edges=source.edges)
    assert source.rows == 301 and one.trees[0].value != other.trees[0].value
    single = trees.boosted(alone, rules)[0]
    # The same rows give the same first split; the start is that of all rows.
    assert other.trees[0].feature[0] == single.trees[0].feature[0]


def test_forests_of_a_depth_and_without(spark, table):
    source = trees.blocks(table, ["a", "b"], ["c"], "y", part="part")
    rules = Rules(trees=20, depth=8, bootstrap=True, least_rows=2, split_rows=5)
    model = trees.forests(source, rules, parts=(0,), at_once=7)[0]
    kept = {
        n: sorted((r["actual"], r["predicted"]) for r in
                  trees.forest_predictions(source, rules, 0, finish_rows=n, at_once=9).collect())
        for n in (20, 1 << 16)
    }
    judged = model.transform(table.where("part = 0 AND y IS NOT NULL")).select("y", "prediction").collect()
    direct = sorted((r["y"], r["prediction"]) for r in judged)
    for found in kept.values():
        assert np.array(found) == pytest.approx(np.array(direct), abs=1e-9)
    deep = trees.forest_predictions(source, Rules(trees=20, bootstrap=True, least_rows=2), 0).collect()
    mean = np.mean([r[3] for r in ROWS])
    error, base = (np.mean([abs(r["actual"] - p(r)) for r in deep]) for p in (lambda r: r["predicted"], lambda r: mean))
    assert len(deep) == 76 and error < base / 3


def test_missing_and_unknown_values_are_predicted(spark, table):
    model = trees.boosted(trees.blocks(table, ["a", "b"], ["c"], "y"), Rules(trees=2, depth=2))[0]
    odd = spark.createDataFrame([(None, None, None), (float("nan"), 1e9, "never")], "a double, b double, c string")
    assert all(r["prediction"] is not None for r in model.transform(odd).collect())
    assert sum(model.importances().values()) == pytest.approx(1)
    empty = trees.blocks(table.where("false"), ["a"], ["c"], "y")
    assert empty.rows == 0 and trees.boosted(empty, Rules(trees=1, depth=2))[0].transform(odd.select("a", "c")).count() == 2


@pytest.mark.parametrize("size", [3, 100_000])
def test_rows_of_equal_codes_go_through_the_trees_once(spark, table, size, monkeypatch):
    model = trees.boosted(trees.blocks(table, ["a", "b"], ["c"], "y"), Rules(trees=3, depth=4, rate=0.5))[0]
    draw = np.random.default_rng(5)
    bins, labels = draw.integers(0, 4, (2, 5000)).astype(np.uint8), draw.integers(0, 3, (1, 5000)) * (1 << 60)
    wanted, asked, margin = model.margin(bins, labels), [], trees.TreeModel.margin
    monkeypatch.setattr(trees.TreeModel, "margin", lambda self, b, c: asked.append(b.shape[1]) or margin(self, b, c))
    answers = trees.Answers(model, size)
    found = [answers.margin(bins[:, at : at + 1000], labels[:, at : at + 1000]) for at in range(0, 5000, 1000)]
    assert np.concatenate(found).tolist() == wanted.tolist()
    assert sum(asked) == len(np.unique(np.vstack([bins, labels]), axis=1).T) < 50
    assert len(answers.margin(bins[:, :0], labels[:, :0])) == 0


def test_a_saved_model_predicts_the_same(spark, table, tmp_path):
    model = trees.boosted(trees.blocks(table, ["a", "b"], ["c"], "y"), Rules(trees=2, depth=2))[0]
    again = trees.load(spark, trees.save(spark, model, str(tmp_path / "model")))
    first, second = (m.transform(table).agg(F.sum("prediction")).first()[0] for m in (model, again))
    assert first == pytest.approx(second)


def test_draws_of_a_tree():
    rows = np.arange(40_000)
    drawn = trees.row_weights(rows, 3, Rules(bootstrap=True))
    assert drawn.mean() == pytest.approx(1, abs=0.03) and drawn.var() == pytest.approx(1, abs=0.05)
    assert trees.row_weights(rows, 3, Rules(rows_share=0.8)).mean() == pytest.approx(0.8, abs=0.01)
