"""What growing a tree costs: work that is not done twice."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from delaykit.operators import trees


def _rows(n, seed):
    random = np.random.default_rng(seed)
    y = random.normal(size=n)
    return random.integers(0, 256, (3, n)).astype(np.uint8), random.integers(0, 9, (1, n)), np.column_stack([-y, np.ones(n), np.ones(n)])


def test_equal_columns_are_sorted_once(monkeypatch):
    bins, labels, sums = _rows(3_000, 7)
    seen, sort = [], trees._sorted_rows
    monkeypatch.setattr(trees, "_sorted_rows", lambda codes, *rest: seen.append(len(codes)) or sort(codes, *rest))
    alone = trees.grow_here(bins, labels, sums, None, 0, trees.Rules())
    again = trees.grow_here(np.vstack([bins, bins[::-1]]), labels, sums, None, 0, trees.Rules())
    assert seen == [4, 4]
    np.testing.assert_array_equal(alone.value, again.value)


def test_long_orders_are_read_in_parts_with_the_same_tree(monkeypatch):
    bins, labels, sums = _rows(3_000, 8)
    whole = trees.grow_here(bins, labels, sums, None, 0, trees.Rules(least_rows=2))
    for entries in (1, 1 << 20):
        monkeypatch.setattr(trees, "AT_ONCE", entries)
        assert trees.grow_here(bins, labels, sums, None, 0, trees.Rules(least_rows=2)) == whole


def test_sums_of_many_trees_are_handed_on_once():
    random = np.random.default_rng(9)
    n, members = 40, []
    blocks = [
        {"n": n, "bins": random.integers(0, 4, (2, n)).astype(np.uint8).tobytes(), "labels": b"", "y": random.normal(size=n).tobytes(),
         "w": np.ones(n).tobytes(), "part": np.zeros(n, dtype=np.int16).tobytes(), "block": block}
        for block in range(4)
    ]
    for number in range(300):
        members.append(trees.Member(number, number, None, 0.0, trees.Tree(), []))
        members[-1].tree.add()
        members[-1].open = {0: (4.0 * n, 0)}
    found = pd.concat(trees._cells(SimpleNamespace(value=members), trees.Rules(bootstrap=True), 2, 0, 0)(iter([pd.DataFrame(blocks)])))
    assert found["member"].nunique() == 300
    assert not found.duplicated(["member", "node", "feature", "key"]).any()


def test_a_pass_deals_out_its_sums_once(spark, monkeypatch):
    table = spark.range(4_000).select(
        (F.col("id") % 97).cast("double").alias("a"), F.concat(F.lit("c"), F.col("id") % 11).alias("c"),
        (F.col("id") * 7919 % 1009).cast("double").alias("y"),
    )
    source = trees.blocks(table, ["a"], ["c"], "y")
    passes, splits = [], trees._splits
    monkeypatch.setattr(trees, "_splits", lambda *x: passes.append(1) or splits(*x))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    trees.boosted(source, trees.Rules(trees=1, depth=4, rate=0.5), finish_rows=300)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - before
    # One job deals out the sums or rows of a pass, one reads them.
    assert len(passes) == 4 and jobs <= 2 * (len(passes) + 1)


def test_few_nodes_deal_out_their_rows():
    bins, labels, sums = _rows(4_000, 10)
    grown = trees.grow_here(bins, labels, sums, 5, 0, trees.Rules())
    at = np.concatenate([grown.nodes_of(bins[:, i : i + 50], labels[:, i : i + 50]) for i in range(0, 4_000, 50)])
    np.testing.assert_array_equal(grown.nodes_of(bins, labels), at)
    assert 16 * len(grown.feature) < 4_000


def test_rows_without_weight_do_not_hide_a_split():
    bins, labels, sums = _rows(2_000, 11)
    y = (bins[0] > 100) * 5.0 + (bins[1] > 40) * 1.0
    for weight in (np.arange(2_000) % 3 > 0, np.arange(2_000) % 3 + 0.25):
        h = weight.astype(float)
        grown = trees.grow_here(bins, labels, np.column_stack([-y * h, h, np.ones(2_000)]), None, 0, trees.Rules())
        found = np.array(grown.value)[grown.nodes_of(bins, labels)]
        np.testing.assert_allclose(found[h > 0], y[h > 0], atol=1e-6)


def test_labels_are_numbered_in_their_order():
    labels = np.array([5, -(1 << 63), 7, 5, (1 << 63) - 1, -1, 7])
    names, codes = trees._numbered(labels)
    wanted = np.unique(labels, return_inverse=True)
    assert names.tolist() == wanted[0].tolist() and codes.tolist() == wanted[1].tolist()
