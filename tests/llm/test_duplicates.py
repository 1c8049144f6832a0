"""SimHash groups, Golay keys and components against brute force."""

import numpy as np
from delaykit.llm import components, golay, simhash
from helpers import AWKWARD, SF, documents, plain


def groups_by_force(rows):
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, format(p, "016x"), least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))]


def test_fingerprint_of_known_words():
    import xxhash

    assert simhash.fingerprint("") == simhash.fingerprint(" \n\t") == 0
    assert simhash.fingerprint("Ab cD") == xxhash.xxh64_intdigest(b"ab cd", 42)
    assert simhash.fingerprint("É x\xa0y") == xxhash.xxh64_intdigest("É x\xa0y".encode(), 42)


def test_golay_words_share_keys():
    random = np.random.default_rng(0)
    words = random.integers(0, 1 << 23, 300)
    near = golay.codewords(words)
    for bits in (0, 1, 2):
        other = words.copy()
        for i in range(len(other)):
            for b in random.choice(23, bits, replace=False):
                other[i] ^= 1 << int(b)
        shared = [set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(near, golay.codewords(other), strict=True)]
        assert all(shared)


def test_keys_miss_no_pair():
    random = np.random.default_rng(1)
    a = random.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in random.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = zip(simhash.link_keys(a), simhash.link_keys(b), strict=True)
    assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in keys)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    roots = dict(map(tuple, components.components(df).collect()))
    assert roots == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components.components(df.limit(0)).collect() == []


def test_near_duplicates_of_awkward_rows(spark):
    df = documents(spark, AWKWARD)
    expected = groups_by_force([(d, t) for d, t, _ in AWKWARD])
    assert plain(simhash.near_duplicates(df).collect()) == plain(expected)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in expected})
    assert simhash.near_duplicates(df.limit(0)).collect() == [] and simhash.keep_one(df.limit(0)).collect() == []


def test_only_null_ids_keep_one(spark):
    df = documents(spark, [(None, "a b c"), (None, "a b c"), (None, "x y z w")])
    assert sorted(r.text for r in simhash.keep_one(df).collect()) == ["a b c", "x y z w"]


def test_near_duplicates_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = simhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert plain(found) == plain(groups_by_force(rows))


def test_one_of_rows_that_differ_elsewhere_whatever_the_names(spark):
    rows = [(1, "a b c", "en", 9, 8, 7), (1, "a b c", "de", 1, 2, 3), (2, "a b c", "fr", 0, 0, 0), (3, "x y z w", "en", 5, 5, 5)]
    names = "doc_id long, text string, lang string, _id int, _copy int, _text_hash int"
    kept = simhash.keep_one(spark.createDataFrame(rows, names))
    assert sorted(tuple(r) for r in kept.collect()) == [rows[1], rows[3]]
    hot = spark.range(3_000).selectExpr("if(id % 3 = 0, 0, id) AS doc_id", "if(id % 3 = 0, 'one two three', concat('w', id, ' x y', id)) AS text", "id AS copy", "id AS row")
    found = simhash.keep_one(hot)
    assert found.where("doc_id = 0").collect() == [(0, "one two three", 0, 0)] and found.columns == hot.columns
