"""Alignment of two tokenizers against cuts found byte by byte."""

from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, SF, documents
from hypothesis import given
from hypothesis import strategies as st

from delaykit.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(FILES[0], encoding="utf-8") as a, open(FILES[1], "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


def groups_of(both, text):
    encoded = both.encode(text or "")
    if encoded is None:
        return []
    a, b = (x.tolist() for x in encoded)
    ends_a = list(accumulate(len(both.a.tokens[i]) for i in a))
    ends_b = list(accumulate(len(both.b.tokens[i]) for i in b))
    upto_a, upto_b = ({e: i + 1 for i, e in enumerate(ends)} for ends in (ends_a, ends_b))
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        m, n = upto_a[cut], upto_b[cut]
        groups.append((a[i:m], b[j:n]))
        i, j = m, n
    return groups


def brute(both, rows):
    per_text = []
    for key, text in rows:
        groups = groups_of(both, text)
        per_text.append((key, groups, Counter((x, y) for ga, gb in groups for x in ga for y in gb)))
    counts = Counter(pair for _, _, links in per_text for pair in links)
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [
        (
            key, sum(len(ga) for ga, _ in groups), sum(len(gb) for _, gb in groups), len(groups), sum(links.values()),
            sum(n for pair, n in links.items() if counts[pair] == best[pair[0]]),
            sum(n * counts[pair] for pair, n in links.items()),
            ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups),
        )
        for key, groups, links in per_text
    ]


def aligned(spark, rows):
    return sorted((tuple(r) for r in alignment.align_documents(documents(spark, rows), *FILES).collect()), key=repr)


def test_awkward_rows(spark, both):
    rows = [r[:2] for r in AWKWARD] + [
        (20, "Hello  world it's"), (21, "tab\tnew\n\n\nline   x"), (22, "a▁b"), (23, "日本語🙂 é́ ﬁ Ａ　x" * 30),
        (24, "<|endoftext|> <s> <0x41>"), (25, "ab" * 3_000 + " " * 4_000), (26, "\x00"), (27, "Hello  world it's"),
    ]
    assert aligned(spark, rows) == sorted(brute(both, rows), key=repr)
    assert aligned(spark, [(1, None), (None, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
    assert aligned(spark, []) == []


def test_documents(spark, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert aligned(spark, rows) == sorted(brute(both, rows), key=repr)


@given(st.lists(st.tuples(st.integers(1, 5), st.booleans(), st.booleans()), min_size=1, max_size=60))
def test_pointers_lead_to_the_last_token_of_a_group(steps):
    at, ends_a, ends_b = 0, [], []
    for step, in_a, in_b in steps:
        at += step
        ends_a += [at] * in_a
        ends_b += [at] * in_b
    total = at + 1
    a, b = np.array([*ends_a, total]), np.array([*ends_b, total])
    cuts = np.intersect1d(a, b)
    wanted = [len(a) + np.searchsorted(b, cuts[np.searchsorted(cuts, e)]) for e in [*a, *b]]
    assert alignment.terminals(a, b).tolist() == wanted


def test_a_group_of_many_pairs_is_counted_by_its_ids(both):
    # Tokens of two bytes against the same from the second byte on: only the last ends meet.
    two_a = [i for i, t in enumerate(both.a.tokens) if len(t) == 2][:7]
    two_b = [i for i, t in enumerate(both.b.tokens) if len(t) == 2][:5]
    one_b = next(i for i, t in enumerate(both.b.tokens) if len(t) == 1)
    a, b = np.array(two_a * 30), np.array([one_b, *(two_b * 42)[:209], one_b])
    found = alignment.align([(a, b)], both)
    wanted = Counter(x * len(both.b.tokens) + y for x in a.tolist() for y in b.tolist())
    assert len(a) * len(b) > alignment.MANY and found.n_groups.tolist() == [1]
    assert dict(zip(found.pair.tolist(), found.times.tolist())) == dict(wanted)
    assert found.n_links.tolist() == [len(a) * len(b)]
