"""A tree without a depth, grown from rows in memory."""

import numpy as np

from delaykit.operators import trees


def test_a_deep_tree_sorts_its_rows_once(monkeypatch):
    random = np.random.default_rng(5)
    n = 4_000
    bins = random.integers(0, 256, (3, n)).astype(np.uint8)
    labels = random.integers(0, 9, (1, n))
    y = random.normal(size=n)
    seen, cells_of = [], trees.cells_of

    def counted(node, *rest):
        seen.append(len(node))
        return cells_of(node, *rest)

    monkeypatch.setattr(trees, "cells_of", counted)
    sums = np.column_stack([-y, np.ones(n), np.ones(n)])
    grown = trees.grow_here(bins, labels, sums, None, 0, trees.Rules())
    # Every row has a leaf of its own, some twenty levels down; only the first levels add up all bins anew.
    np.testing.assert_allclose(np.array(grown.value)[grown.nodes_of(bins, labels)], y, atol=1e-6)
    assert sum(seen) <= 6 * 4 * n


def test_leaves_hold_the_means_of_their_rows():
    random = np.random.default_rng(6)
    n, rules = 3_000, trees.Rules(least_rows=2, split_rows=5)
    bins, labels = random.integers(0, 40, (2, n)).astype(np.uint8), random.integers(0, 5, (2, n))
    drawn, y = random.integers(1, 4, n).astype(float), random.normal(size=n)
    grown = trees.grow_here(bins, labels, np.column_stack([-y * drawn, drawn, np.ones(n)]), None, 0, rules)
    leaf = grown.nodes_of(bins, labels)
    weight, rows = np.bincount(leaf, drawn), np.bincount(leaf)
    ended = np.unique(leaf)
    np.testing.assert_allclose(np.array(grown.value)[ended], (np.bincount(leaf, y * drawn)[ended] / weight[ended]), atol=1e-8)
    assert rows[ended].min() >= 2 and (np.array(grown.feature)[ended] == -1).all()
