"""Alignment of the tokens that two tokenizers make of one text.

Both token sequences cover the bytes of the text. Every token points to the token that
overlaps it and ends farthest to the right; following the pointers leads to the last
token of a group, the smallest stretch of bytes that both tokenizers end at once.
Pointers are followed by doubling, for all tokens of a batch together: each round
replaces a pointer by the pointer of its target, so the rounds grow with the logarithm
of the longest way.

A pair of ids is linked in a text when they occur in one group. The corpus counts the
texts that link each pair. A block of texts (``BLOCK_BYTES``) names its distinct pairs
once and keeps each text as numbers into that list, so what is shuffled is one row per
block and pair, and a pair that every text has is summed before it leaves a block.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.llm.shared import stored, texts_of
from delaykit.llm.token_counts import WORDS, byte_letters

MARK = "▁"
# Texts are aligned together up to the first bound and kept together up to the second.
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 1 << 23
# A group with more pairs than this is paired by its distinct ids.
MANY = 1 << 12
# Words remembered in a generation, and the longest of them.
REMEMBERED, LONGEST = 200_000, 48


class Side(NamedTuple):
    """The bytes of every token of a vocabulary."""

    tokens: list[bytes]
    lengths: np.ndarray


def _side(tokens: list[bytes]) -> Side:
    return Side(tokens, np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)))


class Tokenizers:
    """A byte-level tokenizer file (A) and a SentencePiece model (B)."""

    def __init__(self, tokenizer_json: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        import sentencepiece
        from tokenizers import Tokenizer

        self.a_model = Tokenizer.from_str(tokenizer_json)
        self.a_model.encode_special_tokens = True
        value = {letter: b for b, letter in enumerate(byte_letters())}
        names = [self.a_model.id_to_token(i) or "" for i in range(self.a_model.get_vocab_size(True))]
        # Special tokens are never emitted; their names may hold other letters.
        self.a = _side([bytes(value.get(c, 0) for c in name) for name in names])
        # A word of the pattern is split into itself, so words can be encoded one by one.
        self.words = regex.compile(WORDS)
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.b_model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b = _side([self._piece(i) for i in range(self.b_model.get_piece_size())])
        widest = max(len(names), len(self.b.tokens))
        # An id with the separator that follows it: number of the separator times widest + id.
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(widest)]
        self.widest = widest

    def _piece(self, i: int) -> bytes:
        piece = self.b_model.id_to_piece(i)
        if self.b_model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(MARK, " ").encode()

    def _ids_of(self, text: str) -> list[int]:
        """Ids of A; words seen lately are remembered, in two generations."""
        found = self.words.findall(text)
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old, fresh = self.young, self.old, []
        for word in set(found).difference(young):
            ids = old.get(word)
            if ids is None:
                fresh.append(word)
            else:
                young[word] = ids
        for word, e in zip(fresh, self.a_model.encode_batch_fast(fresh, add_special_tokens=False)):
            young[word] = e.ids
        out = list(chain.from_iterable(map(young.__getitem__, found)))
        for word in fresh:
            if len(word) > LONGEST:
                del young[word]
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both; None for no text and where either does not give the text's bytes."""
        if not text:
            return None
        whole = " " + text
        data = whole.encode()
        a = self._ids_of(whole)
        b = self.b_model.encode(text)
        for ids, side in ((a, self.a), (b, self.b)):
            if b"".join(map(side.tokens.__getitem__, ids)) != data:
                return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


@lru_cache(maxsize=2)
def _tokenizers(tokenizer_json: str, model: bytes) -> Tokenizers:
    return Tokenizers(tokenizer_json, model)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For every token, those of A first: the last token of its group.

    Both sides cover the same bytes without gaps. The token of the other side that holds a
    token's last byte ends farthest to the right of all that overlap it; of tokens that end
    together the one of B comes last.
    """
    n = len(a_ends)
    after_a = n + np.searchsorted(b_ends, a_ends)
    found = np.searchsorted(a_ends, b_ends)
    own = n + np.arange(len(b_ends))
    after_b = np.where(a_ends[found] > b_ends, found, own) if n else own
    after = np.concatenate([after_a, after_b])
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after
        after = further


class Aligned(NamedTuple):
    """Texts aligned together; the first four have a number for each text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]  # a1,a2|b1;a3|b2,b3
    text: np.ndarray  # the text, the pair of ids and how often it links them, sorted
    pair: np.ndarray
    times: np.ndarray


def _per_text(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the ``ends``."""
    sums = np.concatenate([[0], np.cumsum(values)])[ends]
    return np.diff(sums, prepend=0)


def align(encoded: list[tuple[np.ndarray, np.ndarray] | None], both: Tokenizers) -> Aligned:
    """Aligns the two id sequences of every text."""
    none = np.zeros(0, dtype=np.int64)
    a_of, b_of = zip(*[e or (none, none) for e in encoded]) if encoded else ((), ())
    n_a = np.array([len(x) for x in a_of], dtype=np.int64)
    n_b = np.array([len(x) for x in b_of], dtype=np.int64)
    a, b = np.concatenate([none, *a_of]), np.concatenate([none, *b_of])
    # Offsets run on from text to text, and every text ends a group.
    last = terminals(np.cumsum(both.a.lengths[a]), np.cumsum(both.b.lengths[b]))
    ends_group = last[len(a) :] == len(a) + np.arange(len(b))
    number = np.cumsum(ends_group) - 1
    of_a, of_b = number[last[: len(a)] - len(a)], number[last[len(a) :] - len(a)]
    count = int(ends_group.sum())
    p, q = np.bincount(of_a, minlength=count), np.bincount(of_b, minlength=count)
    first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
    a_end, b_end = np.cumsum(n_a), np.cumsum(n_b)
    groups_end = np.concatenate([[0], np.cumsum(ends_group)])[b_end]
    text_of_group = np.repeat(np.arange(len(n_a)), np.diff(groups_end, prepend=0))

    width = len(both.b.tokens)
    space = len(both.a.tokens) * width
    small = (p * q <= MANY)[of_a]
    times_a = np.where(small, q[of_a], 0)
    at_a = np.repeat(np.arange(len(a)), times_a)
    within = np.arange(len(at_a)) - np.repeat(np.cumsum(times_a) - times_a, times_a)
    linked = a[at_a] * width + b[first_b[of_a[at_a]] + within]
    keys, times = np.unique(text_of_group[of_a[at_a]] * space + linked, return_counts=True)
    if not small.all():
        more_keys, more_times = [keys], [times]
        for g in np.flatnonzero(p * q > MANY):
            ids_a, ca = np.unique(a[first_a[g] : first_a[g] + p[g]], return_counts=True)
            ids_b, cb = np.unique(b[first_b[g] : first_b[g] + q[g]], return_counts=True)
            more_keys.append((text_of_group[g] * space + ids_a[:, None] * width + ids_b[None, :]).ravel())
            more_times.append((ca[:, None] * cb[None, :]).ravel())
        keys, places = np.unique(np.concatenate(more_keys), return_inverse=True)
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, places, np.concatenate(more_times))
        times = sums

    # The written form: in each group the ids of A, then those of B.
    written = np.zeros(len(a) + len(b), dtype=np.int64)
    written[np.arange(len(a)) + first_b[of_a]] = a
    written[np.arange(len(b)) + (first_a + p)[of_b]] = b
    written[first_a + p + first_b - 1] += both.widest
    written[first_a + p + first_b + q - 1] += 2 * both.widest
    names, at, groups = both.written, 0, []
    for size in (n_a + n_b).tolist():
        groups.append("".join(map(names.__getitem__, written[at : at + size].tolist()))[:-1])
        at += size
    return Aligned(
        n_a, n_b, np.diff(groups_end, prepend=0), _per_text(groups_end, p * q), groups,
        keys // space, keys % space, times.astype(np.int64),
    )


def _batches(frames: Iterable[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, up to ``BATCH_BYTES`` characters at a time or one longer text."""
    ids, texts, size = [], [], 0
    for frame in frames:
        for i, t in zip(frame["id"].astype(object), frame["text"]):
            t = texts_of(t)
            if texts and size + len(t) > BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(None if pd.isna(i) else i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the fewest bytes; their number of bytes tells which."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _wide(packed: bytes, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, dtype=np.int64)
    return np.frombuffer(packed, dtype=f"<u{len(packed) // count}").astype(np.int64)


def _block(parts: list[tuple[list, Aligned]]) -> pd.DataFrame:
    ids = [i for part, _ in parts for i in part]
    begins = np.cumsum([0, *[len(part) for part, _ in parts]])
    text = np.concatenate([x.text + at for (_, x), at in zip(parts, begins)])
    pairs, codes = np.unique(np.concatenate([x.pair for _, x in parts]), return_inverse=True)
    sizes = np.bincount(text, minlength=len(ids))
    joined = {
        name: np.concatenate([getattr(x, name) for _, x in parts])
        for name in ("n_a", "n_b", "n_groups", "n_links", "times")
    }
    groups = [g for _, x in parts for g in x.groups]
    return pd.DataFrame(
        {
            "ids": [ids],
            **{name: [joined[name]] for name in ("n_a", "n_b", "n_groups", "n_links")},
            "groups": [groups],
            "sizes": [sizes],
            "codes": [_narrow(codes).tobytes()],
            "times": [_narrow(joined["times"]).tobytes()],
            "pairs": [pairs],
            # A text names a pair once, so this counts texts.
            "texts": [np.bincount(codes, minlength=len(pairs))],
        }
    )


def aligned_blocks(
    df: DataFrame, tokenizer_path: str, model_path: str, id_col: str, text_col: str, digest: bool
) -> tuple[DataFrame, int]:
    """One stored row per block of texts, and the number of ids of B.

    ``digest`` keeps the SHA-256 of the written groups in place of the groups.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        # Bounded by the vocabularies, whatever the data.
        sent = spark.sparkContext.broadcast((f.read(), g.read()))
    width = len(_tokenizers(*sent.value).b.tokens)
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("ids", T.ArrayType(df.schema[id_col].dataType))])
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, longs)
    schema = schema.add("groups", T.ArrayType(T.StringType())).add("sizes", longs)
    schema = schema.add("codes", "binary").add("times", "binary").add("pairs", longs).add("texts", ints)

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = _tokenizers(*sent.value)
        parts, size = [], 0
        for ids, texts in _batches(frames):
            done = align([both.encode(t) for t in texts], both)
            if digest:
                hashed = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in done.groups]
                done = done._replace(groups=hashed)
            batch = sum(map(len, texts))
            if parts and size + batch > BLOCK_BYTES:
                yield _block(parts)
                parts, size = [], 0
            parts.append((ids, done))
            size += batch
        if parts:
            yield _block(parts)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(blocks, schema)
    return stored(rows.withColumn("block", F.monotonically_increasing_id()), "blocks"), width


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """``pair`` (id of A times ``width`` plus id of B), ``count`` of texts that link it, ``best``.

    ``best``: no other pair with the same id of A has a higher count. An id of A has at most
    ``width`` pairs, which bounds the window.
    """
    seen = blocks.select(F.inline(F.arrays_zip("pairs", "texts"))).toDF("pair", "texts")
    counts = seen.groupBy("pair").agg(F.sum("texts").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / width))
    highest = F.max("count").over(Window.partitionBy("a"))
    return counts.select("pair", "count", (F.col("count") == highest).alias("best"))


def align_documents(
    df: DataFrame, tokenizer_path: str, model_path: str,
    id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
) -> DataFrame:
    """Per row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    A (a byte-level tokenizer file) encodes a space and the text, B (a SentencePiece model)
    the text, to which it adds the space itself. ``groups`` writes the groups in order as
    ``a1,a2|b1;a3|b2,b3``; with ``digest`` its SHA-256 in lower case, and '' where there is none.
    ``n_links`` counts pairs of occurrences in one group, ``count_sum`` adds up the pairs'
    corpus counts over them, ``n_best`` counts those with the highest count of their id of A.

    One row per input row, null ids and repeated rows included; each row counts as a text.
    Texts that are null, empty, or not given back byte by byte by both tokenizers have no
    tokens, no groups and zeros. A very long text is aligned whole, in memory, in one task. An
    empty table gives no rows. Other columns are not read, so their names cannot clash.
    """
    blocks, width = aligned_blocks(df, tokenizer_path, model_path, id_col, text_col, digest)
    seen = blocks.select(F.col("block").alias("holder"), F.explode("pairs").alias("pair"))
    told = seen.join(pair_counts(blocks, width), "pair")
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups", T.StringType()),
    ]

    def summed(own: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for row in own.itertuples():
            ends = np.cumsum(row.sizes).astype(np.int64)
            total = int(ends[-1])
            known = pairs.sort_values("pair")
            codes, times = _wide(row.codes, total), _wide(row.times, total)
            frames.append(
                pd.DataFrame(
                    {
                        id_col: pd.Series(list(row.ids), dtype=object),
                        "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": row.n_links,
                        "n_best": _per_text(ends, times * known["best"].to_numpy(dtype=np.int64)[codes]),
                        "count_sum": _per_text(ends, times * known["count"].to_numpy(dtype=np.int64)[codes]),
                        "groups": list(row.groups),
                    }
                )
            )
        return pd.concat(frames)

    return blocks.drop("pairs", "texts").groupBy("block").cogroup(told.groupBy("holder")).applyInPandas(
        summed, T.StructType(fields)
    )
