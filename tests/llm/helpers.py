"""Small tables with every awkward case, and the test data's place."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
# ``score``, ``print``, ``n``, ``key`` and the like are names operators use inside.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, print long, key string"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, rows):
    """Rows of (id, text) or (id, text, source), with clashing columns besides."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, 1.5, 7, "k") for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


LONG = "word other thing " * 20_000
AWKWARD = [
    (1, "one two three four", "a"),
    (2, None, "a"),
    (3, "", None),
    (None, "one two three four", "b"),
    (5, " \t\n ", "b"),
    (6, "one two three four", "a"),
    (6, "one two three four", "a"),
    (7, LONG, None),
    (8, "ünï 漢字 🙂 \x00 x́ ▁", "c"),
]


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)
