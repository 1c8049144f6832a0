"""Phrases against counts taken from the words themselves."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from delaykit.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, id long, shard long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 3, 4, 5) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def brute(rows, least, longest=5, share=100):
    counts, sizes = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        text = (text or "").translate(lower)
        for end in collocations.PIECE_ENDS:
            text = text.replace(end, ".")
        for piece in text.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            sizes[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    candidates = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    dropped = set()
    for (lang, words), f in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                held = lang, words[i : i + k]
                if 100 * f >= share * counts[held]:
                    dropped.add(held)
    out = []
    for (lang, words), a in candidates.items():
        if (lang, words) in dropped:
            continue
        n = sizes[lang]
        cuts = [(1000 * a * n // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], n, score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks = Counter()
    placed = []
    for r in out:
        ranks[r[0]] += 1
        placed.append((r[0], ranks[r[0]], *r[1:]))
    return placed


def mined(spark, rows, **options):
    found = collocations.mine(table(spark, rows), top=None, **options)
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[1]))


RNG = np.random.default_rng(5)
VOCABULARY = ["New", "york", "a", "b", "the", "é", "日本", "x\x85y", "　", "A"]


def texts(n):
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ";", "\r\n"]
    for _ in range(n):
        words = RNG.choice(VOCABULARY, RNG.integers(0, 60))
        text = "".join(w + ends[RNG.integers(len(ends))] for w in words)
        lang = [None, "und", "en", "de"][RNG.integers(4)]
        yield text + "new york city hall today" * int(RNG.integers(2)), lang


@pytest.mark.parametrize("shard_words", [50, 1 << 20])
def test_phrases_are_those_of_the_words(spark, shard_words):
    rows = list(texts(200)) + [(None, "en"), ("", None), (" .;\t", "de"), ("a b c " * 3_000, "fr")]
    assert mined(spark, rows, least=4, shard_words=shard_words) == brute(rows, 4)
    assert mined(spark, rows, least=6, longest=3, share=90, shard_words=shard_words) == brute(rows, 6, 3, 90)


def test_ranks_end_at_the_top(spark):
    rows = list(texts(100))
    found = collocations.mine(table(spark, rows), least=3, top=2).collect()
    assert sorted(tuple(r) for r in found) == [r for r in brute(rows, 3) if r[1] <= 2]


def test_no_words(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), (" . ", "en")]) == []
    assert mined(spark, [("a b", "en")]) == []


@given(st.lists(st.integers(0, 4), max_size=80))
def test_an_index_extends_to_both_sides(ids):
    index = collocations.PhraseIndex.build(np.array(ids, dtype=np.int64))
    known = collocations.single_words(index)
    for length, left in ((2, False), (3, True), (4, False), (5, True)):
        known = collocations.extended(index, known, left)
        wanted = Counter(
            tuple(ids[i : i + length]) for i in range(len(ids) - length + 1) if 0 not in ids[i : i + length]
        )
        assert dict(zip(map(tuple, known.words.tolist()), known.times.tolist())) == dict(wanted)
