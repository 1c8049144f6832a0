"""Document quality by pairwise ranking (Bradley-Terry).

A document's strength is a weighted sum of features of its text. Of two labelled documents
the better one wins with the logistic of the difference of their strengths; the weights
minimise that loss over preference pairs. A quantile of the strengths is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.learning import known_labels, newton, one_per_id
from delaykit.llm.shared import held_out, stored, texts_of

THRESHOLD = 0.7
# Pairs of the fit at least, steps of each feature.
PAIRS, STEPS = 60_000, 12
# Documents that meet in one group, of the rarer class at least; steps of the threshold; merged sums.
GROUP_ROWS, GROUP_RARE, CUTS, MERGED = 4_000, 100, 1 << 16, 16
# Classes of bytes, by first fit.
CLASSES = (
    ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("lower", b"abcdefghijklmnopqrstuvwxyz"),
    ("digit", b"0123456789"),
    ("blank", b" \t\r\x0b\x0c"),
    ("line", b"\n"),
    ("stop", b".,;:?'\"()-"),
    ("shout", b"!"),
    ("symbol", b"#*$%&|<>@~^_=+/\\[]{}`"),
    ("high", bytes(range(128, 192))),
    ("lead", bytes(range(192, 256))),
)


def _byte_classes() -> np.ndarray:
    table = np.full(256, len(CLASSES), dtype=np.uint8)
    for number, (_, members) in enumerate(CLASSES):
        table[list(members)] = number
    return table


_CLASS_OF = _byte_classes()
N_FEATURES = len(CLASSES) + 1 + 9


def features(text: str) -> np.ndarray:
    """Shares of byte classes, and lengths and repetition of words and lines."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(CLASSES) + 1)
    n, w, m = max(len(data), 1), max(len(words), 1), max(len(lines), 1)
    distinct, pairs = len(set(words)), len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    rest = (
        np.log1p(len(words)),
        n / w,
        distinct / w,
        pairs / w,
        distinct / np.sqrt(w),
        same / w,
        len(set(lines)) / m,
        w / m,
        max(map(len, words), default=0) / 100,
    )
    return np.concatenate([counts / n, rest])


class Model(NamedTuple):
    """Bounded by the number of features and steps."""

    knots: list[np.ndarray]
    tables: list[np.ndarray]  # strength by step, for each feature
    threshold: float
    scale: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for f, (knots, table) in enumerate(zip(self.knots, self.tables, strict=True)):
            total += table[np.searchsorted(knots, x[:, f])]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the threshold of the strengths is where the score is 0.7."""
        z = (self.strengths(x) - self.threshold) * self.scale + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, sizes: dict[int, int], seed: int = 5) -> Model:
    """Fits the strengths to preference pairs of documents in memory; ``train`` does it for tables.

    Without documents of both labels there are no pairs: all strengths are equal and every
    score is the threshold. ``sizes`` are the numbers of all labelled documents by class;
    the threshold is the quantile of their strengths that errs least.
    """
    knots = []
    for f in range(N_FEATURES):
        column = np.unique(x[:, f]) if len(x) else np.zeros(0)
        inner = np.unique(np.quantile(x[:, f], np.linspace(0, 1, STEPS + 1)[1:-1])) if len(column) > 1 else column[:0]
        knots.append(inner)
    ends = np.cumsum([0] + [len(k) for k in knots])
    weights = np.zeros(ends[-1])
    tables = [np.zeros(len(k) + 1) for k in knots]
    winners, losers = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(winners) or not len(losers):
        return Model(knots, tables, 0.0, 1.0)
    steps = np.concatenate([x[:, f, None] > k[None, :] for f, k in enumerate(knots)], axis=1).astype(np.float32)
    random = np.random.default_rng(seed)
    # Each bad document meets as many good ones as the number of pairs allows.
    each = max(1, PAIRS // len(losers))
    lost = np.repeat(losers, each)
    won = random.choice(winners, size=len(lost))
    difference = steps[won] - steps[lost]
    weights = newton(difference, np.ones(len(lost)), np.full(len(lost), 1.0), ridge=len(lost) / 2000)
    tables = [
        np.concatenate([[0.0], np.cumsum(weights[a:b])]) for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]
    model = Model(knots, tables, 0.0, 1.0)
    strengths = model.strengths(x)
    weight = np.where(good == 1, sizes.get(1, 1) / len(winners), sizes.get(0, 1) / len(losers))
    order = np.argsort(strengths, kind="stable")
    # Errors when the first k are rejected: the good among them, and the bad above.
    wrong_below = np.concatenate([[0], np.cumsum((weight * (good == 1))[order])])
    wrong_above = (weight * (good == 0)).sum() - np.concatenate([[0], np.cumsum((weight * (good == 0))[order])])
    errors = wrong_below + wrong_above
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    cut = int(best[len(best) // 2])
    ranked = strengths[order]
    low, high = ranked[max(cut - 1, 0)], ranked[min(cut, len(ranked) - 1)]
    spread = max(float(np.std(strengths)), 1e-6)
    return Model(knots, tables, float(low + high) / 2, 2.0 / spread)


def _pairs(good: int, bad: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a good and a bad document; each document is in as many pairs as others, or one more."""
    random, each = np.random.default_rng(seed), max(good, bad)
    deal = lambda n: np.concatenate([np.resize(random.permutation(n), each) for _ in range(rounds)])
    return deal(good), deal(bad)


def _stepped(x: np.ndarray, knots: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([x[:, f, None] > k[None, :] for f, k in enumerate(knots)], axis=1).astype(np.float32)


def _groups(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Good and bad documents that meet: all of the larger class once, the rarer one as often as needed."""
    rare = 1 if sizes[1] < sizes[0] else 0
    groups = max(1, sum(sizes.values()) // GROUP_ROWS)
    copies = min(groups, -(-GROUP_RARE * groups // sizes[rare]))
    first = F.pmod(F.xxhash64("_id"), F.lit(groups))
    dealt = rows.withColumn("_copy", F.explode(F.when(F.col("_label") == rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))))
    dealt = dealt.select(F.pmod(first + F.col("_copy"), F.lit(groups)).alias("group"), F.xxhash64("_id").alias("place"), "_label", "x")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", kind="stable")
        x, good = np.stack(group["x"].to_list()), group["_label"].to_numpy() == 1
        return pd.DataFrame({"group": [int(group["group"].iloc[0])], "good": [x[good].tobytes()], "bad": [x[~good].tobytes()]})

    return stored(dealt.groupBy("group").applyInPandas(pack, "group long, good binary, bad binary"), "groups")


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' ``state``; ``MERGED`` of them reach the driver."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"state": [sum(np.frombuffer(s) for s in group["state"]).tobytes()]})

    dealt = parts.withColumn("_part", F.spark_partition_id() % MERGED).groupBy("_part").applyInPandas(merge, "state binary")
    return sum((np.frombuffer(r["state"]) for r in dealt.collect()), np.zeros(width))


def _fitted_weights(groups: DataFrame, knots: list[np.ndarray], rounds: int, seed: int, steps: int = 12) -> np.ndarray:
    """Newton's method over all pairs; a pass gives the slope and the curvature, whose size is that of the steps."""
    width = sum(map(len, knots))
    weights = np.zeros(width)
    for _ in range(steps):

        def sums(frames: Iterator[pd.DataFrame], weights=weights) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + width + width * width)
            for frame in frames:
                for row in frame.itertuples():
                    good, bad = (np.frombuffer(v).reshape(-1, N_FEATURES) for v in (row.good, row.bad))
                    if not len(good) or not len(bad):
                        continue
                    won, lost = _pairs(len(good), len(bad), rounds, seed + row.group)
                    up, down = _stepped(good, knots), _stepped(bad, knots)
                    for at in range(0, len(won), GROUP_ROWS):
                        d = (up[won[at : at + GROUP_ROWS]] - down[lost[at : at + GROUP_ROWS]]).astype(np.float64)
                        p = 1 / (1 + np.exp(-np.clip(d @ weights, -30, 30)))
                        total[0] += len(d)
                        total[1 : 1 + width] += d.T @ (p - 1)
                        total[1 + width :] += ((d * (p * (1 - p))[:, None]).T @ d).ravel()
            yield pd.DataFrame({"state": [total.tobytes()]})

        total = _added(groups.mapInPandas(sums, "state binary"), 1 + width + width * width)
        ridge = max(total[0], 1.0) / 2000
        slope = total[1 : 1 + width] + ridge * weights
        step = np.linalg.solve(total[1 + width :].reshape(width, width) + ridge * np.eye(width), slope)
        weights = weights - step
        if np.abs(step).max(initial=0.0) < 1e-6:
            break
    return weights


def _with_threshold(model: Model, rows: DataFrame) -> Model:
    """The cut of the strengths, in even steps of their range, at which all documents err least."""
    low, high = sum(t.min() for t in model.tables), sum(t.max() for t in model.tables)
    width = (high - low) / CUTS or 1.0

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(3 + 2 * CUTS)
        for frame in frames:
            if not len(frame):
                continue
            z = model.strengths(np.stack(frame["x"].to_list()))
            total[:3] += len(z), z.sum(), (z * z).sum()
            cell = np.clip((z - low) / width, 0, CUTS - 1).astype(np.int64)
            total[3:] += np.bincount(frame["_label"].to_numpy() * CUTS + cell, minlength=2 * CUTS)
        yield pd.DataFrame({"state": [total.tobytes()]})

    total = _added(rows.select("_label", "x").mapInPandas(sums, "state binary"), 3 + 2 * CUTS)
    n, mean = max(total[0], 1.0), total[1] / max(total[0], 1.0)
    bad, good = total[3:].reshape(2, CUTS)
    # Errors when the first cells are rejected: the good among them, and the bad above.
    errors = np.concatenate([[0], np.cumsum(good)]) + bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    best = np.flatnonzero(errors == errors.min())
    spread = max(float(np.sqrt(max(total[2] / n - mean * mean, 0.0))), 1e-6)
    return model._replace(threshold=float(low + best[len(best) // 2] * width), scale=2.0 / spread)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and the features ``x`` of every text; the texts are not moved."""

    @F.pandas_udf("array<double>")
    def measure(column: pd.Series) -> pd.Series:
        return pd.Series([features(texts_of(t)) for t in column], dtype=object)

    return stored(df.select(F.col(id_col).alias("_id"), measure(F.col(text_col)).alias("x")), "features")


def train(rows: DataFrame, labels: DataFrame, seed: int = 5) -> Model:
    """Learns from all labelled documents of ``measured`` that are not held out.

    Of the documents with one id one is taken, so a repeated id weighs no more than another.
    Every document is in at least one pair; the knots are quantiles of all of them, within
    a ten-thousandth of their number.
    """
    rows = stored(one_per_id(rows.join(known_labels(labels, "quality"), "_id").select("_id", "_label", "x"), "x"), "labelled")
    sizes = {0: 0, 1: 0} | {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes[0] or not sizes[1]:
        return Model([np.zeros(0)] * N_FEATURES, [np.zeros(1)] * N_FEATURES, 0.0, 1.0)
    at = [i / STEPS for i in range(STEPS + 1)]
    cuts = rows.agg(*[F.percentile_approx(F.col("x")[f], at, 10_000).alias(f"q{f}") for f in range(N_FEATURES)]).first()
    # A knot at the largest value would part nothing.
    knots = [np.unique([q for q in c[1:-1] if q < c[-1]]) for c in cuts]
    rounds = max(1, -(-PAIRS // max(sizes.values())))
    weights = _fitted_weights(_groups(rows, sizes), knots, rounds, seed)
    ends = np.cumsum([0] + [len(k) for k in knots])
    tables = [np.concatenate([[0.0], np.cumsum(weights[a:b])]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return _with_threshold(Model(knots, tables, 0.0, 1.0), rows)


def score_column(df: DataFrame, text_col: str, model: Model) -> Column:
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype="float64")
        return pd.Series(sent.value.scores(np.stack([features(texts_of(t)) for t in column])))

    return score(F.col(text_col))


def score_documents(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= 0.7).

    A null text is scored as an empty one; a very long one is scored whole, in memory.
    Rows with null ids are never held out; repeated rows get equal scores. Nothing but the text goes into a score. Without labels of both
    kinds nothing is learned: every score is 0.7 and no document is rejected.
    """
    rows = measured(df, id_col, text_col)
    model = train(rows, labels)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(np.stack(column.to_list())) if len(column) else [], dtype="float64")

    rows = rows.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), score("x").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with all their columns whose score reaches the threshold."""
    model = train(measured(df, id_col, text_col), labels)
    return df.where(score_column(df, text_col, model) >= THRESHOLD)
