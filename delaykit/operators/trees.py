"""Regression trees grown from histograms: boosting with regularisation, and forests.

Rows are kept as blocks: numbers as bins between quantiles, labels as hashes. A pass over
the blocks sums gradient, hessian and rows by (member, node, feature, bin) for all open
nodes of all trees grown at once; Spark adds the sums up, one group per node picks its
best split, and the driver gets one row per node. A node that has become small
(``finish_rows``) is finished in one group from its rows, to any depth, so that no row is
left out and the passes do not grow with the depth. Members are trees of a forest, folds of
a cross-validation, or both; all share each pass.

A label splits as an indicator does: the rows that have it against the others. A missing
number goes with the smallest, a label that was never seen with the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.operators.lookups import settled

BINS = 256
FINISH_ROWS = 1 << 16
BLOCK_ROWS = 1 << 14
# Trees that a pass follows again before the margins are written anew.
KEPT_TREES = 20
# Boosted trees are shallow, so that their groups may be larger and their passes fewer.
BOOSTED_FINISH_ROWS = 1 << 18
# Rows of blocks that a task reads as one.
HELD_ROWS = 1 << 19
# Entries of sorted orders that are read in one go.
AT_ONCE = 1 << 14
NEVER = -1
TIE = 1e-9


@dataclass(frozen=True)
class Rules:
    """How trees are grown; the defaults are plain squared error without a limit."""

    trees: int = 100
    depth: int | None = None
    rate: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    gamma: float = 0.0
    least_weight: float = 0.0  # hessian of a child
    least_rows: int = 1  # rows of a child
    split_rows: int = 2  # rows of a node that is split
    rows_share: float = 1.0  # rows each tree sees
    columns_share: float = 1.0  # columns each tree sees, indicators included
    bootstrap: bool = False
    seed: int = 42


def _pull(g, l1: float):
    if not l1:
        return g
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g, h, rules: Rules):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + rules.l2 > 0, _pull(g, rules.l1) ** 2 / (h + rules.l2), 0.0)


def leaf_value(g, h, rules: Rules):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + rules.l2 > 0, -_pull(g, rules.l1) / (h + rules.l2), 0.0) * rules.rate


def _mix(x: np.ndarray) -> np.ndarray:
    """Evenly spread unsigned numbers from any numbers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _share(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each key, the same in every run."""
    spread = _mix(np.asarray(keys, dtype=np.int64).view(np.uint64) + _mix(np.array([salt + 1]))[0])
    return (spread >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def row_weights(rows: np.ndarray, tree: int, rules: Rules) -> np.ndarray:
    """How often each row is drawn for a tree."""
    salt = rules.seed * 1_000_003 + tree
    if rules.bootstrap:
        # Draws with replacement, as counts of a Poisson variable with mean 1.
        steps = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880]))
        share, drawn = _share(rows, salt), np.zeros(len(rows), dtype=np.int8)
        for step in steps.tolist():
            drawn += share >= step
        return drawn.astype(np.float64)
    if rules.rows_share < 1:
        return (_share(rows, salt) < rules.rows_share).astype(np.float64)
    return np.ones(len(rows))


def _column_kept(feature: int, keys: np.ndarray | None, tree: int, rules: Rules):
    if rules.columns_share >= 1:
        return True if keys is None else np.ones(len(keys), dtype=bool)
    salt = rules.seed * 7_368_787 + tree * 65_537 + feature
    if keys is None:
        return bool(_share(np.array([0]), salt)[0] < rules.columns_share)
    return _share(keys, salt) < rules.columns_share


@dataclass
class Tree:
    """Nodes in lists; a leaf has feature -1. ``key`` is the last bin, or the label, that goes left."""

    feature: list[int] = field(default_factory=list)
    key: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0) -> int:
        self.feature.append(NEVER), self.key.append(0), self.left.append(0)
        self.value.append(value), self.gain.append(0.0)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, key: int, gain: float) -> int:
        """The left child's number; the right one follows it."""
        left = self.add()
        self.add()
        self.feature[node], self.key[node], self.left[node], self.gain[node] = int(feature), int(key), left, float(gain)
        return left

    def graft(self, node: int, other: Tree) -> None:
        """Puts ``other`` in the place of a leaf."""
        at = len(self.feature) - 1  # node 1 of the other comes next
        self.feature[node], self.key[node], self.value[node], self.gain[node] = (
            other.feature[0], other.key[0], other.value[0], other.gain[0],
        )
        self.left[node] = other.left[0] + at
        self.feature += other.feature[1:]
        self.key += other.key[1:]
        self.left += [x + at for x in other.left[1:]]
        self.value += other.value[1:]
        self.gain += other.gain[1:]

    def nodes_of(self, bins: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The node each row ends in; ``bins`` and ``labels`` have a row for each feature."""
        n = bins.shape[1] if len(bins) else labels.shape[1]
        if 16 * len(self.feature) < n:
            return self._dealt_out(bins, labels, n)
        feature, key, left = np.array(self.feature), np.array(self.key), np.array(self.left)
        at = np.zeros(n, dtype=np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        numbers = len(bins)
        while len(inner):
            node = at[inner]
            f = feature[node]
            goes_left = np.zeros(len(inner), dtype=bool)
            of_number = f < numbers
            rows = inner[of_number]
            goes_left[of_number] = bins[f[of_number], rows] <= key[node[of_number]]
            rows = inner[~of_number]
            goes_left[~of_number] = labels[f[~of_number] - numbers, rows] == key[node[~of_number]]
            at[inner] = left[node] + ~goes_left
            inner = inner[feature[at[inner]] >= 0]
        return at

    def _dealt_out(self, bins: np.ndarray, labels: np.ndarray, n: int) -> np.ndarray:
        """``nodes_of`` for few nodes: each deals its rows out to its children."""
        at = np.zeros(n, dtype=np.int64)
        waiting: list[tuple[int, np.ndarray | None]] = [(0, None)]
        while waiting:
            node, rows = waiting.pop()
            f, key = self.feature[node], self.key[node]
            if f < 0:
                if rows is not None:
                    at[rows] = node
                continue
            of = bins[f] if f < len(bins) else labels[f - len(bins)]
            of = of if rows is None else np.take(of, rows)
            goes_left = of <= key if f < len(bins) else of == key
            for child, chosen in ((self.left[node], goes_left), (self.left[node] + 1, ~goes_left)):
                chosen = np.flatnonzero(chosen)
                if len(chosen):
                    waiting.append((child, chosen if rows is None else np.take(rows, chosen)))
        return at


@dataclass
class Best:
    """The best split found so far of each node."""

    gain: np.ndarray
    feature: np.ndarray
    key: np.ndarray
    left: np.ndarray  # gradient, hessian and rows of the left child

    @classmethod
    def none(cls, nodes: int) -> Best:
        return cls(np.zeros(nodes), np.full(nodes, NEVER), np.zeros(nodes, dtype=np.int64), np.zeros((nodes, 3)))

    def offer(self, feature: int, node, key, sums, totals, is_label: bool, tree: int, rules: Rules) -> None:
        """Tries all splits of a feature by its cells: one for each node and key, in this order."""
        if not len(node) or (not is_label and not _column_kept(feature, None, tree, rules)):
            return
        if is_label:
            left = sums
        else:
            upto = np.cumsum(sums, axis=0)
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            before = np.vstack([np.zeros((1, 3)), upto])[first]
            left = upto - np.repeat(before, np.diff(np.append(first, len(node))), axis=0)
        if is_label:
            kept = _column_kept(feature, key, tree, rules)
            node, key, left = node[kept], key[kept], left[kept]
        self.judge(feature, node, key, left.T, totals, rules)

    def judge(self, feature: int, node, key, left, totals, rules: Rules) -> None:
        """Tries splits of a feature by the sums of their left children, in the order of nodes and keys."""
        if not len(node):
            return
        lg, lh, ln = left
        score = _score(totals[:, 0], totals[:, 1], rules)
        g, h, n = (np.ascontiguousarray(x)[node] for x in totals.T)
        whole = score[node]
        rh, rn = h - lh, n - ln
        gain = 0.5 * (_score(lg, lh, rules) + _score(g - lg, rh, rules) - whole) - rules.gamma
        allowed = (
            (np.minimum(ln, rn) >= rules.least_rows) & (n >= rules.split_rows) & (np.minimum(lh, rh) >= rules.least_weight)
            # Rounding in sums is no gain.
            & (gain > (1e-10 * (1 + np.abs(score)))[node])
        )
        gain[~allowed] = 0.0
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        highest, owner = np.maximum.reduceat(gain, starts), node[starts]
        better = highest > self.gain[owner] * (1 + TIE)
        if not better.any():
            return
        # Equal gains may differ in rounding: the first feature and the first key win.
        least = np.full(len(self.gain), np.inf)
        least[owner[better]] = highest[better] * (1 - TIE)
        at_best = np.flatnonzero(gain >= least[node])
        owner = node[at_best]
        chosen = at_best[np.append(True, owner[1:] != owner[:-1])]
        owner = node[chosen]
        self.gain[owner], self.feature[owner], self.key[owner] = gain[chosen], feature, key[chosen]
        self.left[owner] = np.column_stack([lg[chosen], lh[chosen], ln[chosen]])


def cells_of(node: np.ndarray, key: np.ndarray, keys: int, nodes: int, sums: np.ndarray):
    """Sums of rows by node and key, keys from 0 to ``keys``; in order of both."""
    place = node * keys + key
    if nodes * keys <= 4 * len(place):
        whole = np.column_stack([np.bincount(place, s, nodes * keys) for s in sums.T])
        found = np.flatnonzero(whole[:, 2])
        return found // keys, found % keys, whole[found]
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return place[first] // keys, place[first] % keys, np.add.reduceat(sums[order], first, axis=0)


# An entry of a sorted order holds a code above a row's place in its level, where nodes are kept together.
_ROW_BITS = 32
_ROW = (1 << _ROW_BITS) - 1


def _fixed(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Whole numbers whose sums cannot overflow, and what one of them is worth; such sums are exact."""
    most = 2 * float(np.abs(x).sum())
    unit = 2.0 ** (np.ceil(np.log2(most)) - 61) if most > 0 else 1.0
    return np.rint(x / unit).astype(np.int64), unit


class _Level:
    """The open nodes of a level, their rows one node after the other, and what all features share of them."""

    def __init__(self, sizes, totals, g, h, h_fixed, tree: int, rules: Rules):
        self.rules, self.tree, self.sizes, self.totals = rules, tree, sizes, totals
        self.starts = np.cumsum(sizes) - sizes
        self.ends = self.starts + sizes - 1
        self.node = np.repeat(np.arange(len(sizes)), sizes)
        # Without penalties, a split gains the square of what the left gradient is beyond its share.
        self.plain = not (rules.l1 or rules.l2) and h_fixed[0].min() > 0
        self.g, self.g_unit = _fixed(g - h * (totals[:, 0] / totals[:, 1])[self.node] if self.plain else g)
        if self.plain:
            # What rounding leaves of a node's sum, which is zero.
            self.g[self.ends] -= np.add.reduceat(self.g, self.starts)
        self.h, self.h_unit = h_fixed
        self.whole = _score(totals[:, 0], totals[:, 1], rules)
        # Rounding in sums is no gain.
        self.least = 1e-10 * (1 + np.abs(self.whole))
        # Plain gains are found in units of the sums.
        self.units = (1.0, 1.0) if self.plain else (self.g_unit, self.h_unit)
        of = {"h": totals[:, 1] / self.h_unit} if self.plain else {"g": totals[:, 0], "h": totals[:, 1], "w": self.whole}
        self.of_node = {k: x[self.node] for k, x in of.items()}
        upto, fewest = np.arange(1, len(self.node) + 1) - self.starts[self.node], max(rules.least_rows, 1)
        n = sizes[self.node]
        # A cut after the row leaves enough rows on either side.
        self.cuttable = ((upto >= fewest) & (n - upto >= fewest) & (n >= rules.split_rows))[:-1]
        self.same = self.node[1:] == self.node[:-1]
        self.h_before = (np.cumsum(self.h)[self.starts] - self.h[self.starts])[self.node]
        # Nodes above the leading bits of a gain, so that a running maximum is one of each node.
        self.bits = len(sizes).bit_length()
        self.lead = self.node << (63 - self.bits)

    def gains(self, lg, lh, of: dict) -> np.ndarray:
        """What splits gain by sums of their left children, for plain rules by half the node's hessian; never below zero."""
        rules = self.rules
        lg, lh = (x.astype(np.float64) if unit == 1 else x * unit for x, unit in zip((lg, lh), self.units))
        rh = of["h"] - lh
        heavy = np.minimum(lh, rh) >= rules.least_weight / self.h_unit * self.units[1] if rules.least_weight > 0 else None
        if self.plain:
            lg *= lg
            lh *= rh
            with np.errstate(divide="ignore", invalid="ignore"):
                lg /= lh
            out = lg
        else:
            out = 0.5 * (_score(lg, lh, rules) + _score(of["g"] - lg, rh, rules) - of["w"]) - rules.gamma
            np.maximum(out, 0.0, out=out)
        if heavy is not None:
            out *= heavy
        return out

    def real(self, gain: np.ndarray, nodes=slice(None)) -> np.ndarray:
        return 0.5 * (self.g_unit / self.h_unit) ** 2 * self.totals[nodes, 1] * gain - self.rules.gamma if self.plain else gain

    def sums(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of gradient and hessian along the last axis."""
        row = order & _ROW
        return np.cumsum(np.take(self.g, row), axis=-1), np.cumsum(np.take(self.h, row), axis=-1)

    def tried(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gain of a cut after each entry of sorted orders, and which orders can be cut at all."""
        cuts = (order[:, 1:] ^ order[:, :-1]) > _ROW
        able = (cuts & self.same).any(axis=1)
        cuts &= self.cuttable
        lg, lh = self.sums(order)
        if not self.plain:
            before = lg[:, self.starts] - np.take(self.g, order[:, self.starts] & _ROW)
            lg -= before[:, self.node]
        lh -= self.h_before
        gain = self.gains(lg, lh, self.of_node)
        gain[:, self.ends] = 0.0
        gain[:, :-1] *= cuts
        return gain, able

    def highest(self, gain: np.ndarray) -> np.ndarray:
        """The most of each node; many small ones are told apart by their leading bits."""
        if 16 * len(self.sizes) < len(self.node):
            return np.maximum.reduceat(gain, self.starts, axis=-1)
        bits = gain.view(np.int64)
        bits >>= self.bits
        bits += self.lead
        np.maximum.accumulate(bits, axis=-1, out=bits)
        return ((bits[:, self.ends] - self.lead[self.ends]) << self.bits).view(np.float64)

    def take_better(self, best: Best, feature: int, gain: np.ndarray, nodes: np.ndarray | None = None) -> np.ndarray:
        """Notes the feature for the nodes that gain more by it; the first feature wins a tie."""
        now, least = (best.gain, self.least) if nodes is None else (best.gain[nodes], self.least[nodes])
        better = np.flatnonzero((gain > now * (1 + TIE)) & (gain > least))
        at = better if nodes is None else nodes[better]
        best.gain[at], best.feature[at] = gain[better], feature
        return better

    def by_numbers(self, best: Best, names: Sequence[int], orders: np.ndarray) -> np.ndarray:
        """Tries every cut of sorted orders; tells which of them can be cut at all."""
        gain, able = self.tried(orders)
        for feature, most in zip(names, self.highest(gain)):
            if _column_kept(feature, None, self.tree, self.rules):
                self.take_better(best, feature, self.real(most))
        return able

    def first_cuts(self, best: Best, names: np.ndarray, orders: np.ndarray) -> None:
        """Finds the cuts of the features that won; of equal gains, which may differ in rounding, the first."""
        won = np.flatnonzero(np.isin(best.feature, names))
        if not len(won):
            return
        sizes = self.sizes[won]
        place = np.full(max(names) + 1, -1)
        place[names] = np.arange(len(names))
        starts = np.cumsum(sizes) - sizes
        rows_of = np.repeat(self.starts[won] - starts, sizes) + np.arange(sizes.sum())
        picked = _Level.__new__(_Level)
        picked.__dict__ |= {**self.__dict__, "starts": starts, "ends": starts + sizes - 1, "node": np.repeat(np.arange(len(won)), sizes)}
        order = orders[np.repeat(place[best.feature[won]], sizes), rows_of]
        picked.of_node = {k: v[rows_of] for k, v in self.of_node.items()}
        picked.cuttable, picked.same = np.append(self.cuttable, False)[rows_of][:-1], picked.node[1:] == picked.node[:-1]
        before = np.cumsum(np.take(self.h, order & _ROW))[starts] - np.take(self.h, order[starts] & _ROW)
        picked.h_before = before[picked.node]
        gain = picked.tried(order[None, :])[0][0]
        hits = np.flatnonzero(gain >= (np.maximum.reduceat(gain, starts) * (1 - TIE))[picked.node])
        of = picked.node[hits]
        hits = hits[np.append(True, of[1:] != of[:-1])]
        best.key[won] = order[hits] >> _ROW_BITS

    def by_labels(self, best: Best, feature: int, order: np.ndarray, names: np.ndarray) -> bool:
        """Tries every label against the others; tells whether a node has two of them."""
        code = order >> _ROW_BITS
        cuts = (code[1:] != code[:-1]) & self.same
        if not cuts.any():
            return False
        last = np.flatnonzero(np.append(cuts | ~self.same, True))
        n = np.diff(last, prepend=-1)
        lg, lh = (np.diff(x[last], prepend=0) for x in self.sums(order))
        node, key, fewest = self.node[last], names[code[last]], max(self.rules.least_rows, 1)
        size = self.sizes[node]
        kept = (n >= fewest) & (size - n >= fewest) & (size >= self.rules.split_rows)
        if self.rules.columns_share < 1:
            kept &= _column_kept(feature, key, self.tree, self.rules)
        kept = np.flatnonzero(kept)
        if not len(kept):
            return True
        node, key, at = node[kept], key[kept], last[kept]
        gain = self.gains(lg[kept], lh[kept], {k: v[at] for k, v in self.of_node.items()})
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        highest, nodes = np.maximum.reduceat(gain, first), node[first]
        better = self.take_better(best, feature, self.real(highest, nodes), nodes)
        least = np.full(len(self.sizes), np.inf)
        least[nodes[better]] = highest[better] * (1 - TIE)
        hits = np.flatnonzero(gain >= least[node])
        of = node[hits]
        hits = hits[np.append(True, of[1:] != of[:-1])[: len(hits)]]
        best.key[node[hits]] = key[hits]
        return True


def _sorted_rows(codes: Sequence[np.ndarray], rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For each feature the rows by node and code, below the code; ``rows`` are in the order of their nodes."""
    node = node.astype(np.min_scalar_type(int(node[-1])))
    out = np.empty((len(codes), len(rows)), dtype=np.int64)
    for f, code in enumerate(codes):
        by_code = np.argsort(code[rows], kind="stable")
        order = by_code[np.argsort(node[by_code], kind="stable")]
        out[f] = (code[rows[order]].astype(np.int64) << _ROW_BITS) | order
    return out


def _cut(orders: np.ndarray, moves: np.ndarray, lefts: int, out: np.ndarray) -> None:
    """Of each order the rows that go left, then those that go right; ``moves`` has their new places, and -1 for no place."""
    at = orders & _ROW
    to = np.take(moves, at)
    at -= to
    moved = (orders - at).ravel()
    # Read without a sign, no place lies behind all others.
    left = to.ravel().view(np.uint64) < lefts
    to = to.ravel() >= lefts
    for goes, columns in ((left, slice(lefts)), (to, slice(lefts, None))):
        goes = np.flatnonzero(goes)
        if len(orders) == 1:
            np.take(moved, goes, out=out[0, columns], mode="clip")
        else:
            out[:, columns] = np.take(moved, goes).reshape(len(orders), -1)


def _numbered(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labels in order, and each row's place among them; only distinct ones are sorted."""
    codes, names = pd.factorize(labels)
    order = np.argsort(names)
    place = np.empty(len(names), dtype=np.int64)
    place[order] = np.arange(len(names))
    return names[order], place[codes]


def _distinct(columns: Sequence[np.ndarray]) -> list[int]:
    """The first of each set of equal columns; the others would lose every tie to it."""
    return list({x.tobytes(): f for f, x in reversed(list(enumerate(columns)))}.values())[::-1]


def grow_here(
    bins: np.ndarray, labels: np.ndarray, sums: np.ndarray, depth: int | None, tree: int, rules: Rules
) -> Tree:
    """A whole tree from rows in memory; ``sums`` holds gradient, hessian and count (one) of each row.

    Few nodes are split by sums over their bins. When there are many, the rows are sorted once by node
    and feature; a level then cuts every order into the rows that go left and those that go right,
    which keeps nodes together and their rows sorted, so that its cost follows the rows left.
    """
    g, h = (np.ascontiguousarray(sums[:, i]) for i in (0, 1))
    known = [_numbered(x) for x in labels]
    codes = [*bins, *(c.astype(np.min_scalar_type(len(names))) for names, c in known)]
    features = np.array(sorted(_distinct(bins)) + list(range(len(bins), len(codes))), dtype=np.int64)
    orders, uncut, moves, to_left = None, None, None, 0
    rows = np.arange(len(sums))

    most = 2 * len(sums) + 1
    feature, left_of = np.full(most, NEVER), np.zeros(most, dtype=np.int64)
    key_of, value, gain = np.zeros(most, dtype=np.int64), np.zeros(most), np.zeros(most)
    total = sums.sum(axis=0)
    value[0], made = float(leaf_value(total[0], total[1], rules)), 1
    least = max(rules.split_rows, 2 * rules.least_rows, 2)
    names, totals, sizes, level = np.array([0]), total[None, :], np.array([len(sums)]), 0
    if len(sums) < least or not np.isfinite(total).all():
        names = names[:0]
    h_fixed = _fixed(h) if len(names) else None
    while len(names) and len(features) and (depth is None or level < depth):
        best = Best.none(len(names))
        if orders is None and 2 * len(names) * BINS > len(rows):
            orders = _sorted_rows([codes[f] for f in features], rows, np.repeat(np.arange(len(names)), sizes))
        elif orders is not None:
            uncut, orders = orders, np.empty((len(features), len(rows)), dtype=np.int64)
        if orders is None:
            node = np.repeat(np.arange(len(names)), sizes)
            own = np.asfortranarray(sums[rows])
            for f in features.tolist():
                if f < len(bins):
                    best.offer(f, *cells_of(node, bins[f][rows], BINS, len(names), own), totals, False, tree, rules)
                else:
                    names_of = known[f - len(bins)][0]
                    at, code, cells = cells_of(node, codes[f][rows], len(names_of), len(names), own)
                    best.offer(f, at, names_of[code], cells, totals, True, tree, rules)
        else:
            here = _Level(sizes, totals, g[rows], h[rows], (h_fixed[0][rows], h_fixed[1]), tree, rules)
            node, able, many = here.node, np.zeros(len(features), dtype=bool), max(1, AT_ONCE // len(rows))
            for at in range(0, len(features), many):
                # Short orders are read many at once, long ones one by one in the processor's cache.
                some = slice(at, at + many)
                if uncut is not None:
                    _cut(uncut[some], moves, to_left, orders[some])
                numbers = int((features[some] < len(bins)).sum())
                if numbers:
                    able[at : at + numbers] = here.by_numbers(best, features[at : at + numbers].tolist(), orders[at : at + numbers])
                for i in range(at + numbers, min(at + many, len(features))):
                    able[i] = here.by_labels(best, int(features[i]), orders[i], known[features[i] - len(bins)][0])
            numbers = int((features < len(bins)).sum())
            if numbers:
                here.first_cuts(best, features[:numbers], orders)
            # A column that is the same in all of each node is so in all below.
            if not able.all():
                features, orders = features[able], orders[able]
        split = np.flatnonzero(best.feature >= 0)
        if not len(split):
            break
        on = names[split]
        lefts = made + 2 * np.arange(len(split))
        made += 2 * len(split)

        moves = np.full(len(rows), -1)
        of_split = np.flatnonzero(best.feature[node] >= 0)
        rows, node = rows[of_split], node[of_split]
        f, key = best.feature[node], best.key[node]
        goes_left = np.zeros(len(rows), dtype=bool)
        number = f < len(bins)
        goes_left[number] = bins[f[number], rows[number]] <= key[number]
        goes_left[~number] = labels[f[~number] - len(bins), rows[~number]] == key[~number]
        if orders is not None:
            to = np.flatnonzero(goes_left)
            at, to = node[to], rows[to]
            best.left = np.column_stack([np.bincount(at, x, len(names)) for x in (g[to], h[to], None)])
        feature[on], key_of[on], left_of[on], gain[on] = best.feature[split], best.key[split], lefts, best.gain[split]
        parts = best.left[split], totals[split] - best.left[split]
        for at, part in zip((lefts, lefts + 1), parts):
            value[at] = leaf_value(part[:, 0], part[:, 1], rules)
        # Children too small to be split are leaves; the other left ones come first, then the right ones.
        open_left, open_right = (part[:, 2] >= least for part in parts)
        place = np.zeros(len(names), dtype=np.int64)
        place[split] = np.arange(len(split))
        place = place[node]
        lefts_on, rights_on = np.flatnonzero(goes_left & open_left[place]), np.flatnonzero(~goes_left & open_right[place])
        to_left, stays = len(lefts_on), np.concatenate([lefts_on, rights_on])
        moves[of_split[stays]] = np.arange(len(stays))
        names = np.concatenate([lefts[open_left], lefts[open_right] + 1])
        totals = np.concatenate([parts[0][open_left], parts[1][open_right]])
        sizes, level, rows = totals[:, 2].astype(np.int64), level + 1, rows[stays]
    return Tree(*(x[:made].tolist() for x in (feature, key_of, left_of, value, gain)))


# ---- rows as blocks -----------------------------------------------------------


@dataclass(frozen=True)
class Blocks:
    """A stored table of blocks and what its bins and labels mean."""

    table: DataFrame
    edges: tuple[np.ndarray, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    rows: int
    mean: float


_BLOCK = "n long, bins binary, labels binary, y binary, w binary, part binary"


def bin_edges(df: DataFrame, numeric: Sequence[str], bins: int = BINS) -> tuple[np.ndarray, ...]:
    """Values between the bins of each column: quantiles of a mergeable sketch, in one pass."""
    if not numeric:
        return ()
    at = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 10_000).alias(f"q{i}") for i, c in enumerate(numeric)]).first()
    return tuple(np.unique(np.array([x for x in (q or []) if x == x], dtype=np.float64)) for q in row)


def _hashed(categorical: Sequence[str]) -> list:
    return [F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"c{i}") for i, c in enumerate(categorical)]


def _binned(frame: pd.DataFrame, edges: Sequence[np.ndarray]) -> np.ndarray:
    bins = np.zeros((len(edges), len(frame)), dtype=np.uint8)
    for i, e in enumerate(edges):
        values = frame[f"x{i}"].to_numpy(dtype=np.float64, na_value=np.nan)
        bins[i] = np.where(np.isnan(values), 0, np.searchsorted(e, values))
    return bins


def _labels(frame: pd.DataFrame, count: int) -> np.ndarray:
    return np.array([frame[f"c{i}"].to_numpy(dtype=np.int64) for i in range(count)]).reshape(count, len(frame))


def blocks(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
    weight: str | None = None, part: str | None = None, edges: Sequence[np.ndarray] | None = None,
) -> Blocks:
    """The rows of ``df`` whose target is known, as blocks; ``part`` is a small number kept with each."""
    rows = df.where(F.col(target).isNotNull())
    edges = tuple(edges) if edges is not None else bin_edges(rows, numeric)
    chosen = rows.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)], *_hashed(categorical),
        F.col(target).cast("double").alias("y"), F.lit(1.0).alias("w") if weight is None else F.col(weight).cast("double").alias("w"),
        F.lit(0).alias("part") if part is None else F.col(part).cast("int").alias("part"),
    )
    count = len(categorical)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), BLOCK_ROWS):
                frame = whole.iloc[at : at + BLOCK_ROWS]
                yield pd.DataFrame(
                    {
                        "n": [len(frame)], "bins": [_binned(frame, edges).tobytes()], "labels": [_labels(frame, count).tobytes()],
                        "y": [frame["y"].to_numpy(dtype=np.float64).tobytes()], "w": [frame["w"].to_numpy(dtype=np.float64).tobytes()],
                        "part": [frame["part"].to_numpy(dtype=np.int16).tobytes()],
                    }
                )

    packed = chosen.mapInPandas(pack, _BLOCK).withColumn("block", F.monotonically_increasing_id())
    # Blocks are dealt out evenly, since every pass reads them in the tasks that their files allow.
    table = settled(packed.repartition(2 * chosen.sparkSession.sparkContext.defaultParallelism))
    sized = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    mean = chosen.agg(F.try_divide(F.sum(F.col("y") * F.col("w")), F.sum("w"))).first()[0]
    return Blocks(table, edges, tuple(numeric), tuple(categorical), sized, mean or 0.0)


@dataclass
class _Opened:
    """One block in memory."""

    bins: np.ndarray
    labels: np.ndarray
    y: np.ndarray
    w: np.ndarray
    part: np.ndarray
    row: np.ndarray
    margins: np.ndarray | None


def _row_numbers(block: int, n: int) -> np.ndarray:
    """Numbers from the block's: 27 bits for the partition that made it, 22 for its place there."""
    partition, place = block >> 33, block & ((1 << 33) - 1)
    return (partition << 36) + place * BLOCK_ROWS + np.arange(n)


def _open(rows: Sequence, numbers: int, count: int) -> _Opened:
    n = [int(row.n) for row in rows]

    def joined(name: str, kind=np.float64, width: int = 1) -> np.ndarray:
        return np.concatenate([np.frombuffer(getattr(row, name), dtype=kind).reshape(width, k) for row, k in zip(rows, n)], axis=1)

    margins = getattr(rows[0], "margins", None)
    return _Opened(
        joined("bins", np.uint8, numbers), joined("labels", np.int64, count), joined("y")[0], joined("w")[0],
        joined("part", np.int16)[0], np.concatenate([_row_numbers(int(row.block), k) for row, k in zip(rows, n)]),
        None if margins is None else joined("margins", np.float64, len(margins) // (8 * n[0])),
    )


def _opened(frames: Iterator[pd.DataFrame], numbers: int, count: int) -> Iterator[_Opened]:
    """The blocks of a task, many read as one."""
    held, size = [], 0
    for frame in frames:
        for row in frame.itertuples():
            if held and size + row.n > HELD_ROWS:
                yield _open(held, numbers, count)
                held, size = [], 0
            held.append(row)
            size += row.n
    if held:
        yield _open(held, numbers, count)


@dataclass
class Member:
    """One tree being grown: ``left_out`` is the part it does not learn from."""

    number: int
    tree_number: int
    left_out: int | None
    start: float
    tree: Tree
    kept: list[Tree]  # earlier trees that the margins do not hold yet
    open: dict[int, tuple[float, int]] = field(default_factory=dict)  # node: rows, depth


def _gradients(m: Member, b: _Opened, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient and hessian of every row for a member, and which rows it learns from; others have none."""
    drawn = row_weights(b.row, m.tree_number, rules)
    if m.left_out is not None:
        drawn *= b.part != m.left_out
    margin = m.start if b.margins is None else b.margins[m.number]
    for t in m.kept:
        margin = margin + np.array(t.value)[t.nodes_of(b.bins, b.labels)]
    h = drawn * b.w
    return h * (margin - b.y), h, drawn > 0


def _of_nodes(m: Member, b: _Opened, nodes: Sequence[int], used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The used rows in some nodes, and the place of each one's node among them."""
    place = np.full(len(m.tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    owner = place[m.tree.nodes_of(b.bins, b.labels)]
    rows = np.flatnonzero(used & (owner >= 0))
    return rows, owner[rows]


_CELL = "member int, node int, feature int, key long, g double, h double, n double"
_PACKED = "member int, node int, feature binary, key binary, sums binary"


def _cells(members, rules: Rules, numbers: int, count: int, finish_rows: int):
    """Sums by member, node, feature and key, in this order, one frame for each member; a task adds up its blocks."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _opened(frames, numbers, count):
            known = [_numbered(x) for x in b.labels]
            for m in members.value:
                big = sorted(node for node, (rows, _) in m.open.items() if rows > finish_rows)
                if not big:
                    continue
                g, h, used = _gradients(m, b, rules)
                rows, owner = _of_nodes(m, b, big, used)
                if not len(rows):
                    continue
                parts = np.ones((len(rows), 3), order="F")
                parts[:, 0], parts[:, 1] = g[rows], h[rows]
                found = []
                # One column at least has the sums of the nodes, even if the tree does not see it.
                kept = [f for f in range(numbers) if _column_kept(f, None, m.tree_number, rules)]
                for f in kept or range(min(numbers, 1)):
                    found.append((f, *cells_of(owner, np.take(b.bins[f], rows), BINS, len(big), parts)))
                for f, (names, codes) in enumerate(known, start=numbers):
                    at, key, total = cells_of(owner, np.take(codes, rows), len(names), len(big), parts)
                    found.append((f, at, names[key], total))
                node = np.concatenate([x[1] for x in found])
                order = np.argsort(node, kind="stable")
                feature = np.repeat([x[0] for x in found], [len(x[1]) for x in found])
                key, total = np.concatenate([x[2] for x in found]), np.concatenate([x[3] for x in found])[order]
                yield pd.DataFrame(
                    {"member": m.number, "node": np.array(big)[node[order]], "feature": feature[order], "key": key[order],
                     "g": total[:, 0], "h": total[:, 1], "n": total[:, 2]}
                )

    return sums


def _packed_cells(members, rules: Rules, numbers: int, count: int, finish_rows: int):
    """The cells of ``_cells``, one row for each member and node."""
    sums = _cells(members, rules, numbers, count, finish_rows)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in sums(frames):
            node, feature, key = (cells[c].to_numpy() for c in ("node", "feature", "key"))
            total = cells[["g", "h", "n"]].to_numpy()
            edges = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist(), len(node)]
            whole = [slice(*x) for x in zip(edges, edges[1:])]
            yield pd.DataFrame(
                {"member": cells["member"].iloc[0], "node": [node[x.start] for x in whole],
                 "feature": [feature[x].astype(np.int32).tobytes() for x in whole],
                 "key": [key[x].astype(np.int64).tobytes() for x in whole],
                 "sums": [np.ascontiguousarray(total[x]).tobytes() for x in whole]}
            )

    return pack


_SPLIT = "member int, node int, feature int, key long, gain double, g double, h double, n double, lg double, lh double, ln double"


def _splits(members, rules: Rules, numbers: int):
    def choose(cells: pd.DataFrame) -> pd.DataFrame:
        member, node = int(cells["member"].iloc[0]), int(cells["node"].iloc[0])
        tree = next(m.tree_number for m in members.value if m.number == member)
        # Tasks in a fixed order, so that sums are the same in every run.
        parts = sorted(zip(cells["sums"], cells["feature"], cells["key"]))
        sums, feature, key = (
            np.concatenate([np.frombuffer(x[i], dtype=kind) for x in parts]) for i, kind in enumerate((np.float64, np.int32, np.int64))
        )
        order = np.lexsort((key, feature))
        feature, key, sums = feature[order], key[order], sums.reshape(-1, 3)[order]
        first = np.flatnonzero(np.append(True, (feature[1:] != feature[:-1]) | (key[1:] != key[:-1])))
        feature, key, sums = feature[first], key[first], np.add.reduceat(sums, first, axis=0)
        totals = sums[feature == feature[0]].sum(axis=0)[None, :]
        best = Best.none(1)
        edges = [0, *(np.flatnonzero(feature[1:] != feature[:-1]) + 1).tolist(), len(feature)]
        for lo, hi in zip(edges, edges[1:]):
            f = int(feature[lo])
            best.offer(f, np.zeros(hi - lo, dtype=np.int64), key[lo:hi], sums[lo:hi], totals, f >= numbers, tree, rules)
        return pd.DataFrame(
            [[member, node, int(best.feature[0]), int(best.key[0]), best.gain[0], *totals[0], *best.left[0]]],
            columns=[c.split()[0] for c in _SPLIT.split(", ")],
        )

    return choose


_ROWS = "member int, node int, n long, bins binary, labels binary, sums binary, row binary, y binary"


def _packed_rows(members, rules: Rules, numbers: int, count: int, finish_rows: int, with_part: int | None):
    """The rows of small nodes, packed by task; rows of the part ``with_part`` come along unweighted."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _opened(frames, numbers, count):
            for m in members.value:
                small = sorted(node for node, (rows, _) in m.open.items() if rows <= finish_rows)
                if not small:
                    continue
                g, h, used = _gradients(m, b, rules)
                rows, owner = _of_nodes(m, b, small, used if with_part is None else used | (b.part == with_part))
                rows = rows[np.argsort(owner.astype(np.min_scalar_type(len(small))), kind="stable")]
                ends = np.cumsum(np.bincount(owner, minlength=len(small))).tolist()
                sums = np.column_stack([g, h, used])
                for node, lo, hi in zip(small, [0, *ends], ends):
                    own = rows[lo:hi]
                    if len(own):
                        yield pd.DataFrame(
                            {"member": [m.number], "node": [node], "n": [len(own)], "bins": [np.take(b.bins, own, axis=1).tobytes()],
                             "labels": [np.take(b.labels, own, axis=1).tobytes()], "sums": [sums[own].tobytes()],
                             "row": [b.row[own].tobytes()], "y": [b.y[own].tobytes()]}
                        )

    return pack


def _unpacked(group: pd.DataFrame, numbers: int, count: int):
    parts = list(group.itertuples())
    n = [int(r.n) for r in parts]
    bins = np.hstack([np.frombuffer(r.bins, dtype=np.uint8).reshape(numbers, k) for r, k in zip(parts, n)])
    labels = np.hstack([np.frombuffer(r.labels, dtype=np.int64).reshape(count, k) for r, k in zip(parts, n)])
    sums = np.vstack([np.frombuffer(r.sums).reshape(k, 3) for r, k in zip(parts, n)])
    rows = np.concatenate([np.frombuffer(r.row, dtype=np.int64) for r in parts])
    y = np.concatenate([np.frombuffer(r.y) for r in parts])
    # Rows in a fixed order, so that sums are the same in every run.
    order = np.argsort(rows, kind="stable")
    return np.take(bins, order, axis=1), np.take(labels, order, axis=1), sums[order], rows[order], y[order]


def _finish(members, rules: Rules, group: pd.DataFrame, numbers: int, count: int):
    member, node = int(group["member"].iloc[0]), int(group["node"].iloc[0])
    m = next(x for x in members.value if x.number == member)
    bins, labels, sums, rows, y = _unpacked(group, numbers, count)
    left = None if rules.depth is None else rules.depth - m.open[node][1]
    learned = sums[:, 2] > 0
    own = np.flatnonzero(learned)
    tree = grow_here(np.take(bins, own, axis=1), np.take(labels, own, axis=1), sums[own], left, m.tree_number, rules)
    return member, node, tree, bins, labels, rows, y, learned


_SUBTREE = "member int, node int, feature array<int>, key array<long>, left array<int>, value array<double>, gain array<double>"


def _grow_top(source: Blocks, table: DataFrame, members: list[Member], rules: Rules, finish_rows: int):
    """Splits nodes with many rows, level by level, until only small ones are open. Gives the last broadcast."""
    numbers, count = len(source.numeric), len(source.categorical)
    context = table.sparkSession.sparkContext
    while True:
        for m in members:
            m.open = {k: v for k, v in m.open.items() if rules.depth is None or v[1] < rules.depth}
        sent = context.broadcast(members)
        if not any(rows > finish_rows for m in members for rows, _ in m.open.values()):
            return sent
        cells = table.mapInPandas(_packed_cells(sent, rules, numbers, count, finish_rows), _PACKED)
        # One row per open node: bounded by the rows over finish_rows, and by the depth.
        found = cells.groupBy("member", "node").applyInPandas(_splits(sent, rules, numbers), _SPLIT).collect()
        by_number = {m.number: m for m in members}
        for s in found:
            m = by_number[s["member"]]
            _, depth = m.open.pop(s["node"])
            m.tree.value[s["node"]] = float(leaf_value(s["g"], s["h"], rules))
            if s["feature"] < 0:
                continue
            left = m.tree.split(s["node"], s["feature"], s["key"], s["gain"])
            whole, part = np.array([s["g"], s["h"], s["n"]]), np.array([s["lg"], s["lh"], s["ln"]])
            for at, x in ((left, part), (left + 1, whole - part)):
                m.tree.value[at] = float(leaf_value(x[0], x[1], rules))
                m.open[at] = (float(x[2]), depth + 1)


def _members(source: Blocks, numbers: Sequence[tuple[int, int, int | None]], starts, kept=None) -> list[Member]:
    out = []
    for number, tree_number, left_out in numbers:
        m = Member(number, tree_number, left_out, starts[number], Tree(), kept[number] if kept else [])
        m.tree.add()
        m.open = {0: (float(source.rows), 0)}
        out.append(m)
    return out


def _grow(source: Blocks, table: DataFrame, members: list[Member], rules: Rules, finish_rows: int) -> None:
    """Grows the trees of all members; their depth must be bounded, since the driver keeps them."""
    numbers, count = len(source.numeric), len(source.categorical)
    sent = _grow_top(source, table, members, rules, finish_rows)
    if not any(m.open for m in members):
        return

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        member, node, t, *_ = _finish(sent, rules, group, numbers, count)
        return pd.DataFrame(
            {"member": [member], "node": [node], "feature": [t.feature], "key": [t.key], "left": [t.left], "value": [t.value], "gain": [t.gain]}
        )

    rows = table.mapInPandas(_packed_rows(sent, rules, numbers, count, finish_rows, None), _ROWS)
    by_number = {m.number: m for m in members}
    for r in rows.groupBy("member", "node").applyInPandas(finish, _SUBTREE).collect():
        m = by_number[r["member"]]
        m.tree.graft(r["node"], Tree(list(r["feature"]), list(r["key"]), list(r["left"]), list(r["value"]), list(r["gain"])))


_TREES = "number int, feature array<int>, key array<long>, left array<int>, value array<double>, gain array<double>"
_MEANING = "start double, mean_of_trees boolean, edges array<array<double>>, numeric array<string>, categorical array<string>"


# ---- fitted models ------------------------------------------------------------


@dataclass(frozen=True)
class TreeModel:
    """Trees of bounded depth; a prediction is ``start`` plus the sum (or mean) of the leaves."""

    trees: tuple[Tree, ...]
    start: float
    mean_of_trees: bool
    edges: tuple[np.ndarray, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    def margin(self, bins: np.ndarray, labels: np.ndarray) -> np.ndarray:
        total = np.zeros(bins.shape[1] if len(bins) else labels.shape[1])
        for t in self.trees:
            total += np.array(t.value)[t.nodes_of(bins, labels)]
        return self.start + (total / max(len(self.trees), 1) if self.mean_of_trees else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``; labels are compared by hash, nothing is joined."""
        # Bounded by the number of trees and their depth.
        sent = df.sparkSession.sparkContext.broadcast(self)
        count = len(self.categorical)

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            answers = Answers(sent.value)
            for rows in batches:
                yield pd.Series(answers.margin(_binned(rows, sent.value.edges), _labels(rows, count)))

        columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.numeric)] + _hashed(self.categorical)
        return df.withColumn("prediction", predict(F.struct(*columns)))

    def importances(self) -> dict[tuple[str, int | None], float]:
        """Share of all gain by column, and by label (as hash) for categorical ones."""
        gains: dict[tuple[str, int | None], float] = {}
        for t in self.trees:
            for f, key, gain in zip(t.feature, t.key, t.gain):
                if f >= 0:
                    number = f < len(self.numeric)
                    name = (self.numeric[f], None) if number else (self.categorical[f - len(self.numeric)], key)
                    gains[name] = gains.get(name, 0.0) + gain
        total = sum(gains.values()) or 1.0
        return {k: v / total for k, v in gains.items()}


class Answers:
    """The margins of a model, found once for rows of the same bins and labels.

    Inputs that come from lookups take few values together, and a row's way through all trees costs
    far more than looking up its codes. Two generations of answers bound the memory.
    """

    def __init__(self, model: TreeModel, size: int = 100_000):
        # Lists would be made arrays again for each batch.
        parts = [(t.feature, t.key, t.left, t.value, t.gain) for t in model.trees]
        self.model, self.size = replace(model, trees=tuple(Tree(*map(np.array, p)) for p in parts)), size
        self.young: dict[bytes, float] = {}
        self.old: dict[bytes, float] = {}

    def margin(self, bins: np.ndarray, labels: np.ndarray) -> np.ndarray:
        codes = np.hstack([bins.T, np.ascontiguousarray(labels.T).view(np.uint8)])
        width = codes.shape[1]
        if not width:
            return self.model.margin(bins, labels)
        whole = np.ascontiguousarray(codes).tobytes()
        keys = [whole[at : at + width] for at in range(0, len(whole), width)]
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        fresh: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            if key not in self.young:
                if key in self.old:
                    self.young[key] = self.old[key]
                else:
                    fresh.setdefault(key, i)
        if fresh:
            at = list(fresh.values())
            self.young.update(zip(fresh, self.model.margin(bins[:, at], labels[:, at]).tolist(), strict=True))
        return np.fromiter(map(self.young.__getitem__, keys), dtype=np.float64, count=len(keys))


def _model(source: Blocks, trees: Sequence[Tree], start: float, mean: bool) -> TreeModel:
    return TreeModel(tuple(trees), start, mean, source.edges, source.numeric, source.categorical)


def _with_margins(source: Blocks, table: DataFrame, starts: list[float], kept: list[list[Tree]]) -> DataFrame:
    """The blocks with the margins of all members, the kept trees included."""
    numbers, count = len(source.numeric), len(source.categorical)
    sent = table.sparkSession.sparkContext.broadcast((starts, kept))

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                b = _open([row], numbers, count)
                margins = np.empty((len(sent.value[0]), len(b.y)))
                for i, (start, trees) in enumerate(zip(*sent.value)):
                    margins[i] = start if b.margins is None else b.margins[i]
                    for t in trees:
                        margins[i] += np.array(t.value)[t.nodes_of(b.bins, b.labels)]
                yield pd.DataFrame([row]).assign(margins=[margins.tobytes()])[[*_names(_BLOCK), "block", "margins"]]

    return settled(table.mapInPandas(add, _BLOCK + ", block long, margins binary"))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def boosted(source: Blocks, rules: Rules, parts: Sequence[int | None] = (None,), finish_rows: int = BOOSTED_FINISH_ROWS) -> list[TreeModel]:
    """Boosted trees, one model for each part left out; all learn in the same passes."""
    starts = [source.mean] * len(parts)
    done: list[list[Tree]] = [[] for _ in parts]
    kept: list[list[Tree]] = [[] for _ in parts]
    table = source.table
    for t in range(rules.trees):
        members = _members(source, [(i, t, part) for i, part in enumerate(parts)], starts, kept)
        _grow(source, table, members, rules, finish_rows)
        for m in members:
            done[m.number].append(m.tree)
            kept[m.number].append(m.tree)
        if len(kept[0]) == KEPT_TREES and t + 1 < rules.trees:
            table = _with_margins(source, table, starts, kept)
            kept = [[] for _ in parts]
    return [_model(source, trees, source.mean, False) for trees in done]


def forests(
    source: Blocks, rules: Rules, parts: Sequence[int | None] = (None,), finish_rows: int = FINISH_ROWS, at_once: int = 50
) -> list[TreeModel]:
    """Forests of bounded depth, one for each part left out; ``at_once`` trees share a pass."""
    if rules.depth is None:
        raise ValueError("trees without a depth are as large as the data; see forest_predictions")
    jobs = [(i * rules.trees + t, t, part) for i, part in enumerate(parts) for t in range(rules.trees)]
    grown: dict[int, Tree] = {}
    for at in range(0, len(jobs), at_once):
        members = _members(source, jobs[at : at + at_once], dict.fromkeys(range(len(jobs)), 0.0))
        _grow(source, source.table, members, rules, finish_rows)
        grown |= {m.number: m.tree for m in members}
    return [
        _model(source, [grown[i * rules.trees + t] for t in range(rules.trees)], 0.0, True) for i in range(len(parts))
    ]


def _finished_values(members, rules: Rules, numbers: int, count: int):
    def predict(group: pd.DataFrame) -> pd.DataFrame:
        _, _, tree, bins, labels, rows, y, learned = _finish(members, rules, group, numbers, count)
        asked = ~learned
        value = np.array(tree.value)[tree.nodes_of(bins[:, asked], labels[:, asked])]
        return pd.DataFrame({"row": rows[asked], "actual": y[asked], "value": value})

    return predict


def _ended_values(members, numbers: int, count: int, test_part: int):
    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _opened(frames, numbers, count):
            asked = b.part == test_part
            bins, labels, rows, y = b.bins[:, asked], b.labels[:, asked], b.row[asked], b.y[asked]
            for m in members.value:
                node = m.tree.nodes_of(bins, labels)
                ended = ~np.isin(node, list(m.open))
                yield pd.DataFrame({"row": rows[ended], "actual": y[ended], "value": np.array(m.tree.value)[node[ended]]})

    return predict


def forest_predictions(
    source: Blocks, rules: Rules, test_part: int, finish_rows: int = FINISH_ROWS, at_once: int = 50
) -> DataFrame:
    """``actual`` and ``predicted`` for the rows of ``test_part``, by a forest grown on all others.

    Trees without a depth are as large as the data, so none is kept: the rows to predict travel
    with the rows of the node they fall into, and the group that finishes it predicts them.
    """
    numbers, count = len(source.numeric), len(source.categorical)
    schema = "row long, actual double, value double"
    out = None
    for at in range(0, rules.trees, at_once):
        jobs = [(t, t, test_part) for t in range(at, min(at + at_once, rules.trees))]
        members = _members(source, jobs, dict.fromkeys(range(rules.trees), 0.0))
        sent = _grow_top(source, source.table, members, rules, finish_rows)

        rows = source.table.mapInPandas(_packed_rows(sent, rules, numbers, count, finish_rows, test_part), _ROWS)
        found = rows.groupBy("member", "node").applyInPandas(_finished_values(sent, rules, numbers, count), schema)
        # Rows in nodes that ended before they were small.
        found = found.union(source.table.mapInPandas(_ended_values(sent, numbers, count, test_part), schema))
        found = settled(found.groupBy("row", "actual").agg(F.sum("value").alias("value")))
        out = found if out is None else out.unionByName(found)
    summed = out.groupBy("row", "actual").agg((F.sum("value") / rules.trees).alias("predicted"))
    return summed.select("actual", "predicted")


# ---- saving -------------------------------------------------------------------


def save(spark: SparkSession, model: TreeModel, path: str) -> str:
    """Two Parquet tables below ``path``: ``trees``, a row each, and ``meaning``, one row."""
    trees = [(i, t.feature, t.key, t.left, t.value, t.gain) for i, t in enumerate(model.trees)]
    spark.createDataFrame(trees, _TREES).write.mode("overwrite").parquet(f"{path}/trees")
    edges = [e.tolist() for e in model.edges]
    meaning = [(model.start, model.mean_of_trees, edges, list(model.numeric), list(model.categorical))]
    spark.createDataFrame(meaning, _MEANING).write.mode("overwrite").parquet(f"{path}/meaning")
    return path


def load(spark: SparkSession, path: str) -> TreeModel:
    rows = spark.read.schema(_TREES).parquet(f"{path}/trees").orderBy("number").collect()
    trees = [Tree(*(list(r[c]) for c in ("feature", "key", "left", "value", "gain"))) for r in rows]
    m = spark.read.schema(_MEANING).parquet(f"{path}/meaning").first()
    edges = tuple(np.array(e, dtype=np.float64) for e in m["edges"])
    return TreeModel(tuple(trees), m["start"], m["mean_of_trees"], edges, tuple(m["numeric"]), tuple(m["categorical"]))
