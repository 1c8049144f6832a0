"""Toxicity by a weighted lexicon.

Texts are folded first: case, compatibility forms, look-alike letters of other scripts,
and digits or signs that stand for letters. One Aho-Corasick automaton then finds all
terms of the lexicon, and the phrases in which a term is harmless. The weights of the hits
are summed, set against the length of the text, and turned into a score.

The lexicon is learned from labelled documents: words, and beginnings of words, that are
far more frequent in toxic ones. How far is chosen by cross-validation among the documents
it is learned from.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from operator import add
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.learning import labelled_sample, newton, one_per_id
from delaykit.llm.shared import held_out, stored, texts_of

THRESHOLD = 0.3
# Labelled documents of each class to learn from; this bounds the lexicon, too.
MAX_LABELLED = 5_000
BEGINNINGS = (4, 5, 6)
# What a term needs: its log ratio, and the deviance (twice the log likelihood ratio) of its
# classes from those of all documents. The settings tried, each on every fold of the documents.
SETTINGS = ((2.0, 15.0), (2.0, 30.0), (3.0, 15.0), (3.0, 30.0))
FOLDS = 2
# A beginning is kept only if no single word makes up this share of its documents.
ONE_WORD = 0.8

# Letters that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
UNSEEN = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))

_LETTERS = str.maketrans(LOOKALIKES) | UNSEEN
_SIGNS = str.maketrans(SIGNS)
# Signs count as letters between letters; $ and @ also at the start of a word.
_SIGNED = re.compile(r"(?:(?<=[^\W\d_])[0134578@$!]+|(?<!\S)[@$]+)(?=[^\W\d_])")
# At the edges of a word they may be letters or not.
_EDGED = re.compile(r"(?<!\w)(?:[0134578]+[^\W\d_]+[0134578@$]*|[^\W\d_]+[0134578@$]+)(?!\w)")
_GAPS = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """The words of a text in plain letters, one space around each.

    A word with signs at an edge is given in both readings, without them and with letters.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(_LETTERS)
    else:
        text = text.lower()
    text = _SIGNED.sub(lambda m: m[0].translate(_SIGNS), text)
    text = _EDGED.sub(lambda m: f"{m[0]} {m[0].translate(_SIGNS)}", text)
    return f" {_GAPS.sub(' ', text).strip()} "


class Lexicon(NamedTuple):
    """Terms start with a space; those that end with one are whole words.

    ``phrases`` are words between spaces; hits inside them do not count. Both come from a
    bounded number of labelled documents.
    """

    terms: tuple[tuple[str, float], ...]
    phrases: tuple[str, ...] = ()


@lru_cache(maxsize=len(SETTINGS) * FOLDS)
def _automaton(lexicon: Lexicon):
    found = ahocorasick.Automaton()
    for term, weight in lexicon.terms:
        found.add_word(term, (len(term), weight))
    for phrase in lexicon.phrases:
        found.add_word(phrase, (len(phrase), None))
    found.make_automaton()
    return found


def hits(folded: str, lexicon: Lexicon) -> list[tuple[int, float]]:
    """Start and weight of every term in a folded text, outside harmless phrases.

    Of terms that start at the same place the longest counts.
    """
    if not lexicon.terms:
        return []
    found: dict[int, tuple[int, float]] = {}
    harmless: list[tuple[int, int]] = []
    for last, (length, weight) in _automaton(lexicon).iter(folded):
        start = last - length + 1
        if weight is None:
            harmless.append((start, last))
        elif length > found.get(start, (0, 0.0))[0]:
            found[start] = (length, weight)
    if harmless:
        # Phrases come by their ends; of those that start no later, how far they reach.
        harmless.sort()
        starts = np.array([a for a, _ in harmless])
        reach = np.maximum.accumulate([b for _, b in harmless])
        at = np.array(list(found), dtype=np.int64)
        before = np.searchsorted(starts, at, side="right") - 1
        ends = np.array([s + found[s][0] - 1 for s in found], dtype=np.int64)
        inside = (before >= 0) & (reach[np.maximum(before, 0)] >= ends)
        return [(s, found[s][1]) for s, hidden in zip(found, inside, strict=True) if not hidden]
    return [(start, weight) for start, (_, weight) in found.items()]


def measure_folded(folded: str, lexicon: Lexicon) -> tuple[float, float]:
    """Two views of the weight of a text's hits: the sum, and per hundred words."""
    total = sum(w for _, w in hits(folded, lexicon))
    return float(np.log1p(total)), float(np.log1p(100 * total / max(folded.count(" ") - 1, 1)))


def measure(text: str, lexicon: Lexicon) -> tuple[float, float]:
    return measure_folded(fold(text), lexicon)


def terms_of(folded: str) -> Iterator[str]:
    for word in set(folded.split()):
        yield f" {word} "
        for n in BEGINNINGS:
            if len(word) > n:
                yield f" {word[:n]}"


def phrases_of(folded: str, lexicon: Lexicon) -> set[str]:
    """The two-word phrases around each hit."""
    out = set()
    for start, _ in hits(folded, lexicon):
        end = folded.index(" ", start + 1)
        after = folded.find(" ", end + 1)
        if after > 0:
            out.add(folded[start : after + 1])
        if start > 0:
            out.add(folded[folded.rindex(" ", 0, start) : end + 1])
    return out


def _log_ratio(more: Column, n_more: int, less: Column, n_less: int) -> Column:
    """Of two shares of documents, smoothed by half a document."""
    return F.log((more + 0.5) / (n_more + 1)) - F.log((less + 0.5) / (n_less + 1))


def _sure(weight: Column, more: Column, less: Column, share: float, setting: tuple[float, float]) -> Column:
    n = more + less
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    least_ratio, least_deviance = setting
    return (weight >= least_ratio) & (2 * (part(more, share) + part(less, 1 - share)) >= least_deviance)


def _counted(rows: DataFrame, of) -> DataFrame:
    """Documents of each class and fold by term; summed up per task before the shuffle."""

    @F.pandas_udf("array<string>")
    def each(folded: pd.Series) -> pd.Series:
        return pd.Series([list(of(t)) for t in folded], dtype=object)

    terms = rows.select("label", "fold", F.explode(each("folded")).alias("term"))
    is_of = lambda c, f: (F.col("label") == c) & (F.col("fold") == f)
    return terms.groupBy("term").agg(
        *[F.sum(is_of(c, f).cast("long")).alias(f"n_{c}_{f}") for c in (0, 1) for f in range(FOLDS)]
    )


def _significant(
    counted: DataFrame, label: int, sizes: dict[tuple[int, int], int], setting: tuple[float, float],
    left_out: int | None = None, limit: int | None = None,
) -> list[tuple[str, int, float]]:
    """Terms of a class with their documents and weights, by weight, from the folds that are not left out."""
    folds = [f for f in range(FOLDS) if f != left_out]
    n = {c: sum(sizes.get((c, f), 0) for f in folds) for c in (0, 1)}
    if not n[0] or not n[1]:
        return []
    more, less = (reduce(add, [F.col(f"n_{c}_{f}") for f in folds]) for c in (label, 1 - label))
    found = counted.select("term", more.alias("more"), less.alias("less"))
    more, less = F.col("more"), F.col("less")
    found = found.withColumn("weight", _log_ratio(more, n[label], less, n[1 - label]))
    found = found.where(_sure(F.col("weight"), more, less, n[label] / (n[0] + n[1]), setting))
    best = found.orderBy(F.desc("weight"), "term")
    return [(r["term"], r["more"], r["weight"]) for r in (best.limit(limit) if limit else best).collect()]


def _drop_covered(found: list[tuple[str, int, float]]) -> list[tuple[str, float]]:
    """Words and beginnings that say something of their own, shortest first."""
    words = [(t, n) for t, n, _ in found if t.endswith(" ")]
    kept: dict[str, float] = {}
    for term, n, weight in sorted(found, key=lambda x: (len(x[0]), x[0])):
        if any(term[:i] in kept for i in range(2, len(term))):
            continue
        if not term.endswith(" "):
            most = max((m for t, m in words if t.startswith(term)), default=0)
            if most >= ONE_WORD * n:
                continue
        kept[term] = weight
    return list(kept.items())


def _fitted(x: np.ndarray, y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    # The sample holds the classes in other shares than the labels do.
    weight = _class_weights(y, sizes)
    return newton(x, y, weight / weight.mean(), ridge=0.1, steps=40)


def _class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    toxic = y == 1
    return np.where(toxic, sizes.get(1, 1) / max(toxic.sum(), 1), sizes.get(0, 1) / max((~toxic).sum(), 1))


def _chosen(rows: DataFrame, counted: DataFrame, sizes, settings, limit: int | None) -> tuple[float, float]:
    """The setting whose lexicons, each learned without a fold, judge that fold best."""
    if len(settings) == 1:
        return settings[0]
    found = [_significant(counted, 1, sizes, s, f, limit) for s in settings for f in range(FOLDS)]
    lexicons = [Lexicon(tuple(_drop_covered(f))) for f in found]

    @F.pandas_udf("array<double>")
    def measured(column: pd.Series) -> pd.Series:
        return pd.Series([[v for x in lexicons for v in measure_folded(t, x)] for t in column], dtype=object)

    seen = rows.select("_id", "label", "fold", measured("folded").alias("x")).toPandas()
    seen = seen.sort_values("_id", kind="stable")
    y, fold, x = seen["label"].to_numpy(), seen["fold"].to_numpy(), np.stack(seen["x"].to_list())
    classes = {c: sum(n for (label, _), n in sizes.items() if label == c) for c in (0, 1)}
    losses = []
    for i in range(len(settings)):
        loss = 0.0
        for f in range(FOLDS):
            at = 2 * (i * FOLDS + f)
            both = np.column_stack([x[:, at : at + 2], np.ones(len(y))])
            out = fold == f
            z = both[out] @ _fitted(both[~out], y[~out], classes)
            loss += float(np.logaddexp(0, np.where(y[out] == 1, -z, z)).sum())
        losses.append(loss)
    return settings[int(np.argmin(losses))]


def learn_lexicon(
    rows: DataFrame, settings: Sequence[tuple[float, float]] = SETTINGS,
    max_terms: int | None = None, max_phrases: int | None = None,
) -> Lexicon:
    """From rows of ``_id``, ``folded`` texts and a ``label``, a bounded number of them.

    The setting with the least loss over the folds is taken, the first of equal ones.
    Copies of a text are in one fold. ``max_terms`` and ``max_phrases`` keep those of
    the largest weights; by default none are left out.
    """
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("folded"), F.lit(FOLDS)).cast("int"))
    sizes = {
        (r["label"], r["fold"]): r["n"]
        for r in rows.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if len({label for label, _ in sizes}) < 2:
        return Lexicon(())
    counted = stored(_counted(rows, terms_of), "terms")
    setting = _chosen(rows, counted, sizes, list(settings), max_terms)
    lexicon = Lexicon(tuple(_drop_covered(_significant(counted, 1, sizes, setting, limit=max_terms))))
    # Harmless phrases: around a hit, and far more frequent in clean documents.
    around = _counted(rows, lambda t: phrases_of(t, lexicon))
    phrases = _significant(around, 0, sizes, setting, limit=max_phrases)
    return lexicon._replace(phrases=tuple(term for term, _, _ in phrases))


class Model(NamedTuple):
    lexicon: Lexicon
    weights: tuple[float, float, float]

    def score(self, text: str) -> float:
        a, b = measure(text, self.lexicon)
        z = self.weights[0] * a + self.weights[1] * b + self.weights[2]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[str] = (),
    max_labelled: int = MAX_LABELLED,
    **options,
) -> Model:
    """Learns from at most ``max_labelled`` labelled documents of each class that are not held out.

    ``phrases`` are harmless ones known beforehand, ``options`` those of ``learn_lexicon``.
    Without toxic and clean rows nothing is learned and every score is near 0. Of the
    documents with one id one is taken, so a repeated id weighs no more than another.
    """
    picked, sizes = labelled_sample(labels, "toxic", max_labelled)

    @F.pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        return pd.Series([fold(texts_of(t)) for t in texts], dtype=object)

    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # At most two times max_labelled small rows are broadcast.
    known = texts.join(F.broadcast(picked), "_id")
    one = one_per_id(known.select("_id", "_label", folded("_text").alias("folded")), "folded")
    rows = stored(one.withColumnRenamed("_label", "label"), "labelled")
    lexicon = learn_lexicon(rows, **options)
    lexicon = lexicon._replace(phrases=lexicon.phrases + tuple(fold(p) for p in phrases))

    @F.pandas_udf("array<double>")
    def measured(column: pd.Series) -> pd.Series:
        return pd.Series([list(measure_folded(t, lexicon)) for t in column], dtype=object)

    seen = rows.select("_id", "label", measured("folded").alias("x")).toPandas().sort_values("_id", kind="stable")
    y = seen["label"].to_numpy()
    if not len(lexicon.terms) or len(set(y)) < 2:
        return Model(lexicon, (0.0, 0.0, -5.0))
    x = np.column_stack([np.stack(seen["x"].to_list()), np.ones(len(y))])
    return Model(lexicon, tuple(float(v) for v in _fitted(x, y, sizes)))


def score_documents(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= 0.3).

    A null text is scored as an empty one; a very long one is scored whole, in memory.
    Rows with null ids are never held out; repeated rows get equal scores. Nothing but the
    text goes into a score. ``options`` are those of ``train``.
    """
    sent = df.sparkSession.sparkContext.broadcast(train(df, labels, id_col, text_col, phrases, **options))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(texts_of(t)) for t in texts], dtype="float64")

    rows = df.select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
