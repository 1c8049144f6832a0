"""Rules, mixing and sharding against plain Python."""

import collections
import math
import random
import re

import pytest
from delaykit.llm import mixing, ranks, rules, sharding
from delaykit.llm.queries import ORACLE_SQL, QUERIES
from helpers import AWKWARD, SF, documents, plain
from oracle import compare, connect
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_measures(spark):
    r = random.Random(1)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 30))) + "\n" * r.randint(0, 3) for _ in range(60)]
    rows = [*AWKWARD, *[(100 + i, t + r.choice(["", "\nx", "\n|#\n \nx"]) * 2, "d") for i, t in enumerate(texts)]]
    found = rules.host_rules(documents(spark, rows)).collect()
    expected = [(d, *base(t)) for d, t, _ in rows]
    assert plain(tuple(x)[:7] for x in found) == plain(expected)
    assert all(not x.kept for x in found if x.base_failed)
    assert rules.host_rules(documents(spark, rows).limit(0)).collect() == []


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(400)]
    rows += [(1000 + 400 * h + i, "short" if i % 20 == 0 else f"{good} {i}", f"h{h}") for h in range(8) for i in range(40)]
    # One document is no reason to condemn its host; no host is no host.
    rows += [(9000, "short", "new"), (9001, good, None), (9002, None, None)]
    df = documents(spark, rows)
    kept = {r.doc_id for r in rules.host_rules(df).where("kept").collect()}
    assert kept == {d for d, t, s in rows if s != "bad" and t and t != "short"}
    passed = rules.keep_passed(df)
    assert passed.columns == df.columns and {r.doc_id for r in passed.collect()} == kept


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BUCKET_ROWS", 7)
    df = spark.range(200).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 5).alias("v"))
    for key in (0, 1, 2):
        rows = ranks.running_sums(df, ["k"], ["id"], F.col("v"), "before", 200).where(F.col("k") == key).collect()
        total = 0
        for row in sorted(rows, key=lambda r: (r.before, r.v > 0)):
            assert row.before == total
            total += row.v
    places = [r.place for r in ranks.ranked(df, [], ["id"], "place", 200).collect()]
    assert sorted(places) == list(range(200))


def sources(spark, sizes):
    return documents(spark, [(1000 * i + j, "w " * 10, s) for i, (s, n) in enumerate(sizes) for j in range(n)])


def test_exponent_meets_its_target(spark):
    t = [400.0, 100.0, 25.0]
    table = spark.createDataFrame([(s, int(n)) for s, n in zip("abc", t, strict=True)], "source string, tokens long")
    a, z = mixing.find_exponent(table, max_epochs=2.0, budget=sum(t))
    assert max(n ** (a - 1) for n in t) / z * sum(t) == pytest.approx(2.0, abs=1e-6)
    a, z = mixing.find_exponent(table, entropy=1.0)
    assert -sum(n**a / z * math.log(n**a / z) for n in t) == pytest.approx(1.0, abs=1e-6)
    assert mixing.find_exponent(table, entropy=9.0)[0] == 0.0
    assert mixing.find_exponent(table, max_epochs=0.5, budget=sum(t))[0] == 1.0
    assert mixing.find_exponent(table, max_epochs=99.0, budget=sum(t))[0] == 0.0


def test_mix_keeps_budgets(spark):
    df = sources(spark, [("a", 60), ("b", 20), (None, 8)])
    rows = mixing.mix(df, max_epochs=2.0, block_tokens=100).collect()
    drawn = collections.Counter(r.source for r in rows)
    tokens = {"a": 600, "b": 200, None: 80}
    a, z = mixing.find_exponent(mixing.source_tokens(df.withColumn("n_tokens", F.lit(10))), max_epochs=2.0, budget=880.0)
    for source, total in tokens.items():
        share = total**a / z * 880
        assert share - 10 <= drawn[source] * 10 <= share + 1e-3
    copies = collections.Counter((r.source, r.doc_id) for r in rows)
    for source in tokens:
        own = [n for (s, _), n in copies.items() if s == source]
        assert max(own) - min(own) <= 1 and max(own) <= 2
    # Every block holds the sources in their proportion and is numbered without gaps.
    blocks = collections.defaultdict(list)
    for r in rows:
        blocks[r.block].append(r)
    for own in list(blocks.values())[:-1]:
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.source == "a" for r in own) - 10 * 600**a / z) <= 2


def test_mixed_documents_draw_all(spark):
    df = sources(spark, [("a", 30), ("b", 5), (None, 3)])
    mixed = mixing.mixed_documents(df, max_epochs=1.5, budget=None)
    assert mixed.columns == df.columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies) == {r.doc_id for r in df.collect()} and max(copies.values()) == 2


def test_mix_of_awkward_rows(spark):
    df = documents(spark, AWKWARD)
    rows = mixing.mix(df, max_epochs=4.0).collect()
    assert {r.doc_id for r in rows} <= {d for d, _, _ in AWKWARD} and all(r.epoch <= 4 for r in rows)
    assert mixing.mix(df.limit(0), max_epochs=4.0).collect() == []
    assert mixing.mixed_documents(df.limit(0), max_epochs=4.0).columns == df.columns


@pytest.mark.parametrize("hot", [0, 40])
def test_shards_are_even_and_gapless(spark, hot):
    rows = [(i, "hot" if i < hot else f"text {i // 2 if i < 90 else i}") for i in range(121)] + [(None, None), (None, None)]
    found = sharding.shard_documents(documents(spark, rows), shards=6).collect()
    assert len(found) == len(rows)
    counts = collections.Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) <= set(range(6))
    for shard, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    texts = dict(rows)
    parts = collections.defaultdict(set)
    for r in found:
        parts[texts[r.doc_id]].add(r.shard)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.grown_shard is None
    # Nearly all pairs stay together; a group beyond a shard leaves some shards alone.
    split = [t for t, s in parts.items() if len(s) > 1 and t != "hot"]
    assert len(split) <= 3 and len(parts.get("hot", ())) <= 4


def test_all_rows_equal_and_none(spark):
    found = sharding.shard_documents(documents(spark, [(i, "x") for i in range(50)])).collect()
    counts = collections.Counter(r.shard for r in found)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    assert sharding.shard_documents(documents(spark, AWKWARD).limit(0)).collect() == []
