"""Shards of tables where every text has a copy, and the moves between full shards."""

import collections

import pytest
from delaykit.llm import sharding
from helpers import documents


@pytest.mark.parametrize("copies", [2, 3, 30])
def test_every_text_has_copies(spark, copies):
    rows = [(i, f"text {i // copies}") for i in range(480)]
    found = sharding.shard_documents(documents(spark, rows)).collect()
    counts = collections.Counter(r.shard for r in found)
    assert len(found) == 480 and set(counts.values()) == {20}
    parts = collections.defaultdict(set)
    for r in found:
        parts[r.doc_id // copies].add(r.shard)
    extra = sum(len(p) - 1 for p in parts.values())
    # Shards of 20 hold pairs whole; of triples 2 of 3 shards cut one at least, of thirties each is cut.
    assert extra <= {2: 6, 3: 30, 30: 32}[copies]


def test_flows():
    room = dict.fromkeys(range(4), 0)
    assert sharding.flows({(0, 1): 5, (1, 0): 3}, room) == {(0, 1): 3, (1, 0): 3}
    assert sharding.flows({(0, 1): 5, (1, 2): 4, (2, 0): 6}, room) == {(0, 1): 4, (1, 2): 4, (2, 0): 4}
    # The place that a mover leaves goes to the next.
    assert sharding.flows({(0, 1): 5, (1, 2): 4}, room | {2: 2}) == {(0, 1): 2, (1, 2): 2}
    assert sharding.flows({}, room) == {}
