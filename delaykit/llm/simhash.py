"""Near-duplicates by SimHash fingerprints and Golay-code keys.

A 64-bit fingerprint has segments of 23, 23 and 18 bits. If two fingerprints differ in
at most 3 bits, then either some segment is equal and the next one (in a ring) differs
in at most 2 bits, or each segment differs in exactly one. For the first case a key
holds the bits of a segment and a codeword number of the next; words within 2 bits
share such a number. For the second case a key holds codeword numbers of the first two
segments: the parities of all segments differ, and of the two fingerprints the one with
even parity in the first segment gives its nearest codeword there and all those of the
second segment, the other the reverse. Pairs with a common key are compared in the join.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.components import components
from delaykit.llm.golay import codewords
from delaykit.llm.shared import stored, texts_of

SEED = 42
WIDTHS = (23, 23, 18)
MAX_BITS = 3
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Bits are counted in blocks of hashes, so that a long text needs no more memory.
_BLOCK = 1 << 14


def word_shingles(text: str, words: int) -> Iterable[bytes]:
    """Runs of ``words`` words in lower case; a shorter text is one, no words give none."""
    # Splitting bytes parts them at \x20 and \x09 to \x0D only.
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(found) > words:
        return map(b" ".join, zip(*(found[i:] for i in range(words))))
    return [b" ".join(found)] if found else []


def fingerprint(text: str, words: int = 3) -> int:
    """Bits set in more than half of the hashes of a text's shingles; no words give 0."""
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in word_shingles(text, words)), dtype="<u8")
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    kept = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(kept.view("<u8")[0])


def fingerprint_column(text_col: str, words: int = 3) -> Column:
    """The fingerprint as a signed 64-bit number; a null text is one without words."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(texts_of(t), words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return fingerprints(F.col(text_col))


def _parts(prints: np.ndarray) -> list[np.ndarray]:
    parts, shift = [], 0
    for width in WIDTHS:
        parts.append((prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    return parts


def link_keys(prints: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint, a row each with -1 where there are fewer."""
    parts = _parts(prints)
    near = [codewords(p) for p in parts]
    keys = []
    for i in range(3):
        after = near[(i + 1) % 3]
        exact = np.int64(i) << 36 | parts[i][:, None] << 12
        keys.append(np.where(after < 0, -1, exact | after))
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    # Equal for opposite parities in all three segments, else different.
    parity = (odd[0] ^ odd[1]) << 1 | (odd[0] ^ odd[2])
    even = odd[0][:, None] == 0
    first = np.where(even, near[0][:, :1], near[0])
    second = np.where(even, near[1], near[1][:, :1])
    pair = np.int64(3) << 36 | parity[:, None] << 24 | first << 12 | second
    keys.append(np.where((first < 0) | (second < 0), -1, pair))
    return np.concatenate(keys, axis=1)


def links(prints: DataFrame, col: str = "fingerprint", max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most ``max_bits`` (up to 3)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"keys are complete for up to {MAX_BITS} bits")

    @F.pandas_udf("array<long>")
    def keys(values: pd.Series) -> pd.Series:
        found = link_keys(values.to_numpy(dtype=np.int64).view(np.uint64))
        return pd.Series([row[row >= 0] for row in found], dtype=object)

    keyed = prints.select(F.col(col).alias("print")).withColumn("key", F.explode(keys("print")))
    a, b = keyed.alias("a"), keyed.alias("b")
    differ = F.bit_count(F.col("a.print").bitwiseXOR(F.col("b.print")))
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.print") < F.col("b.print")) & (differ <= max_bits)
    pairs = a.join(b, near).select(F.col("a.print").alias("a"), F.col("b.print").alias("b"))
    return pairs.distinct()


def _grouped(df: DataFrame, id_col: str, text_col: str, words: int, max_bits: int) -> DataFrame:
    """Per row: ``id``, ``text_hash``, ``print``, ``component`` (a fingerprint), ``component_id``."""
    rows = stored(
        df.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text_col).alias("text_hash"),
            fingerprint_column(text_col, words).alias("print"),
        ),
        "fingerprints",
    )
    nodes = stored(rows.groupBy("print").agg(F.min("id").alias("least_id")), "nodes")
    roots = stored(components(links(nodes, "print", max_bits)), "roots")
    # The smallest id of each component that has links.
    inner = nodes.join(roots, nodes["print"] == roots["node"])
    least = inner.groupBy("root").agg(F.min("least_id").alias("linked_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("print"), "root", "linked_id")
    named = nodes.join(linked, "print", "left").select(
        "print",
        F.coalesce("root", "print").alias("component"),
        F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("linked_id")).alias("component_id"),
    )
    return rows.join(named, "print")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows whose fingerprints differ in at most ``max_bits`` are linked; ``component_id`` is
    the smallest id that links lead to, the row's own included. One row per input row,
    repeated rows included. Rows without words have fingerprint zero and are linked like
    any other. A row with a null id takes part, but is never a component's smallest id;
    the component of null ids alone is null. Other columns are not read.

    Equal fingerprints are one node, so copies make no pairs; only distinct fingerprints
    are compared.
    """
    return _grouped(df, id_col, text_col, words, max_bits).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``df`` with all their columns, one for each component of near-duplicates.

    The row with the smallest id stays, null ids last; of several rows with that id the one
    with the smallest text hash, and of those the smallest by all columns.
    """
    return keep_first(df, _grouped(df, id_col, text_col, words, max_bits), id_col, text_col)


def keep_first(df: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that come first in each component of ``rows`` (``id``, ``text_hash``, ``component``).

    Rows of ``df`` travel as one struct, so their columns' names cannot clash.
    """
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("text_hash"))).alias("first")
    kept = rows.groupBy("component").agg(first)
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    whole = df.select(
        F.struct(*df.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    copies = Window.partitionBy("kept_id", "kept_hash").orderBy("row")
    matched = whole.join(kept, same).withColumn("copy", F.row_number().over(copies))
    return matched.where("copy = 1").select("row.*")
