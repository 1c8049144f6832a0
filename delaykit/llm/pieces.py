"""Encoding texts to pieces of a SentencePiece model, and back.

Segmentation is the unigram one: among all ways to cover a text with pieces, Viterbi
finds the one with the largest sum of the model's log scores. The pieces lie in a
double-array trie over their UTF-8 bytes. A character that no piece covers becomes
pieces of its bytes. A space is written as the marker U+2581, and one stands before
the text, so that decoding gives the text back.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.llm.shared import texts_of

MARK = "▁"
# Fixed value: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")
# Parts of up to so many bytes are stepped through together, and how many at once.
WIDTHS, TOGETHER = (8, 16, 48), 1 << 14
# Characters of the texts encoded together, and parts remembered in a generation.
BATCH_CHARACTERS, REMEMBERED = 1 << 21, 250_000


class Vocabulary(NamedTuple):
    """What the executors need of a model; its size is that of the vocabulary."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]  # may be matched in a text
    first_byte: int  # id of the piece of byte 0; the others follow
    unknown: int


def read_vocabulary(model_path: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    plain = [
        not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in ids
    ]
    first = model.piece_to_id("<0x00>")
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in ids),
        tuple(float(model.get_score(i)) for i in ids),
        tuple(plain),
        first if model.is_byte(first) else -1,
        model.unk_id(),
    )


class DoubleArrayTrie:
    """Bytes lead from state ``s`` to ``base[s] + byte`` where ``check`` there is ``s``."""

    def __init__(self, keys: list[bytes]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        base, check, value = [0], [0], [-1]
        queue = deque([(0, 0, len(order), 0)] if keys else [])
        single, several = 1, 1  # where to look for room, for one child and for more
        while queue:
            state, low, high, depth = queue.popleft()
            if len(keys[order[low]]) == depth:
                value[state] = order[low]
                low += 1
            spans: list[tuple[int, int, int]] = []
            while low < high:
                byte, start = keys[order[low]][depth], low
                while low < high and keys[order[low]][depth] == byte:
                    low += 1
                spans.append((byte, start, low))
            if not spans:
                continue
            first = at = max((single if len(spans) == 1 else several) - spans[0][0], 1)
            while True:
                while len(check) <= at + 256:
                    base.append(0), check.append(-1), value.append(-1)
                if all(check[at + byte] < 0 for byte, _, _ in spans):
                    break
                at += 1
            # Places that took long to look through are full enough to be left behind.
            if len(spans) == 1:
                single = at + spans[0][0]
            elif at - first > 64:
                several = at + spans[0][0]
            base[state] = at
            for byte, start, end in spans:
                check[at + byte] = state
                queue.append((at + byte, start, end, depth + 1))
        self.base, self.check, self.value = base, check, value


class PieceCoder:
    """Encodes and decodes with one vocabulary; markers are spaces here, one byte each."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.matched = [i for i, usable in enumerate(vocabulary.usable) if usable and vocabulary.pieces[i]]
        names = [vocabulary.pieces[i].replace(MARK, " ") for i in self.matched]
        self.trie = DoubleArrayTrie([n.encode() for n in names])
        scores = [vocabulary.scores[i] for i in self.matched]
        # By state of the trie: the score and the id of the piece that ends there.
        self.scores = [scores[v] if v >= 0 else None for v in self.trie.value]
        self.ids = [self.matched[v] if v >= 0 else -1 for v in self.trie.value]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        # The best cover of a text is made of those of its parts where no piece spans two
        # parts: before a run of markers, and around a line feed.
        if any(" " in n.lstrip(" ") or "\n" in n for n in names):
            self.parts = re.compile(r"(?s).+")
        else:
            self.parts = re.compile(" *[^ \n]+| +|\n")
        self.base, self.check = np.array(self.trie.base, dtype=np.int32), np.array(self.trie.check, dtype=np.int32)
        self.score_of = np.array([NEVER if x is None else x for x in self.scores])
        self.id_of = np.array(self.ids, dtype=np.int32)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        first = vocabulary.first_byte
        self.byte_ids = range(first, first + 256) if first >= 0 else range(0)
        self.written = [
            bytes([i - first]) if i in self.byte_ids else p.replace(MARK, " ").encode() if u else b""
            for i, (p, u) in enumerate(zip(vocabulary.pieces, vocabulary.usable, strict=True))
        ]

    def part(self, part: str) -> bytes:
        """The ids of the best cover, as unsigned 32-bit little-endian integers."""
        base, check, scores = self.trie.base, self.trie.check, self.scores
        data = part.replace(MARK, " ").encode()
        end = len(data)
        plain = end == len(part)
        best = [NEVER] * (end + 1)
        origin = [0] * (end + 1)
        ending = [-1] * (end + 1)
        best[0] = 0.0
        at = 0
        while at < end:
            here, lead = best[at], data[at]
            width = 1 if plain or lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            state, stop, character = 0, at, at + width
            covered = False
            for byte in data[at:]:
                following = base[state] + byte
                if check[following] != state:
                    break
                state = following
                stop += 1
                score = scores[state]
                if score is not None:
                    if stop == character:
                        covered = True
                    total = here + score
                    if total > best[stop]:
                        best[stop] = total
                        origin[stop] = at
                        ending[stop] = state
            if not covered:
                total = here + self.unknown_score
                if total > best[character]:
                    best[character] = total
                    origin[character] = at
                    ending[character] = -1
            at = character
        ids: list[int] = []
        while at > 0:
            start, state = origin[at], ending[at]
            if state >= 0:
                ids.append(self.ids[state])
            elif self.byte_ids:
                unknown = data[start:at].replace(b" ", MARK.encode())
                ids.extend(self.byte_ids[b] for b in reversed(unknown))
            else:
                ids.append(self.vocabulary.unknown)
            at = start
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def covers(self, parts: list[bytes], width: int) -> list[bytes | None]:
        """``part`` for parts of at most ``width`` bytes, all stepped through together.

        The same steps in the same order, so ties fall alike. None where the best cover has
        an unknown character.
        """
        n = len(parts)
        sizes = np.fromiter(map(len, parts), dtype=np.int32, count=n)
        data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), dtype=np.uint8)
        data = np.ascontiguousarray(data.reshape(n, width).T).astype(np.int32)
        best = np.full((width + 1, n), NEVER)
        best[0] = 0.0
        origin = np.zeros((width + 1, n), dtype=np.int16)
        ending = np.full((width + 1, n), -1, dtype=np.int32)
        for at in range(width):
            alive = np.flatnonzero((best[at] > NEVER) & (sizes > at))
            if not len(alive):
                continue
            here, lead = best[at, alive], data[at, alive]
            after = at + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            covered = np.zeros(len(alive), dtype=bool)
            place = np.arange(len(alive))
            state = np.zeros(len(alive), dtype=np.int32)
            for stop in range(at + 1, width + 1):
                rows = alive[place]
                following = self.base[state] + data[stop - 1, rows]
                kept = np.flatnonzero((self.check[following] == state) & (sizes[rows] >= stop))
                if not len(kept):
                    break
                place, state, rows = place[kept], following[kept], rows[kept]
                score = self.score_of[state]
                covered[place[(score > NEVER) & (after[place] == stop)]] = True
                total = here[place] + score
                better = np.flatnonzero(total > best[stop, rows])
                rows = rows[better]
                best[stop, rows], origin[stop, rows], ending[stop, rows] = total[better], at, state[better]
            rows, stop = alive[~covered], after[~covered]
            total = here[~covered] + self.unknown_score
            better = total > best[stop, rows]
            rows, stop = rows[better], stop[better]
            best[stop, rows], origin[stop, rows], ending[stop, rows] = total[better], at, -1
        # From the ends of the parts back to their beginnings.
        every, at, steps = np.arange(n), sizes.astype(np.int64), []
        known, counts = np.ones(n, dtype=bool), np.zeros(n, dtype=np.int64)
        while (at > 0).any():
            state = ending[at, every]
            inside = at > 0
            known &= (state >= 0) | ~inside
            steps.append(self.id_of[state])
            counts += inside
            at = np.where(inside, origin[at, every], 0)
        deepest = len(steps)
        whole = np.column_stack(steps[::-1]).astype("<u4").tobytes()
        return [
            whole[4 * (i * deepest + deepest - c) : 4 * (i + 1) * deepest] if k else None
            for i, (c, k) in enumerate(zip(counts.tolist(), known.tolist()))
        ]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """``part`` of each: short ones together, the others one by one."""
        data = [p.encode() for p in parts]
        found: list[bytes | None] = [None] * len(parts)
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        low = 0
        for width in WIDTHS:
            own = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            for start in range(0, len(own), TOGETHER):
                group = own[start : start + TOGETHER]
                for i, ids in zip(group, self.covers([data[i] for i in group], width)):
                    found[i] = ids
            low = width
        return [self.part(p) if ids is None else ids for p, ids in zip(parts, found)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Parts seen lately are remembered, in two generations."""
        rows = [self.parts.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old, fresh = self.young, self.old, []
        for part in set().union(*rows).difference(young):
            ids = old.get(part)
            if ids is None:
                fresh.append(part)
            else:
                young[part] = ids
        young.update(zip(fresh, self.encode_parts(fresh)))
        out = [b"".join(map(young.__getitem__, row)) for row in rows]
        for part in fresh:
            if len(part) > WIDTHS[-1]:
                del young[part]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> str:
        if not packed:
            return ""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _coder(vocabulary: Vocabulary) -> PieceCoder:
    # One per Python worker: its memo serves all tasks of the worker.
    return PieceCoder(vocabulary)


def _sent(spark: SparkSession, model_path: str):
    # Bounded by the vocabulary, whatever the data.
    return spark.sparkContext.broadcast(read_vocabulary(model_path))


def encoded(spark: SparkSession, text_col: str, model_path: str) -> Column:
    """The ids of ``text_col`` as packed unsigned 32-bit little-endian integers."""
    sent = _sent(spark, model_path)

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        coder = _coder(sent.value)
        out, batch, size = [], [], 0
        for t in map(texts_of, texts):
            if batch and size + len(t) > BATCH_CHARACTERS:
                out += coder.encode_all(batch)
                batch, size = [], 0
            batch.append(t)
            size += len(t)
        return pd.Series(out + coder.encode_all(batch), dtype=object)

    return encode(F.col(text_col))


def decoded(spark: SparkSession, ids_col: str, model_path: str) -> Column:
    """The text of packed ids."""
    sent = _sent(spark, model_path)

    @F.pandas_udf("string")
    def decode(packed: pd.Series) -> pd.Series:
        coder = _coder(sent.value)
        return pd.Series([coder.decode(p or b"") for p in packed], dtype=object)

    return decode(F.col(ids_col))


def encode_documents(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, the text, ``ids`` (packed), ``n_pieces`` and ``ids_crc32``.

    One row per input row, repeated rows and null ids included. Null and empty texts have
    no pieces. Other columns of the input are not read. Nothing is shuffled.
    """
    rows = df.select(
        F.col(id_col),
        F.col(text_col),
        encoded(df.sparkSession, text_col, model_path).alias("ids"),
    )
    return rows.withColumns(
        {
            "n_pieces": (F.octet_length("ids") / 4).cast("long"),
            "ids_crc32": F.crc32("ids"),
        }
    )


def round_trip(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes every text, decodes its ids and compares.

    Per row: the id, ``n_pieces``, ``ids_crc32``, ``decoded_crc32`` (unsigned, UTF-8) and
    ``same``: whether the decoded text is the text. The marker character itself decodes
    to a space and counts as one; a null text counts as empty.
    """
    rows = encode_documents(df, model_path, id_col, text_col)
    back = rows.withColumn("_decoded", decoded(df.sparkSession, "ids", model_path))
    return back.select(
        F.col(id_col),
        "n_pieces",
        "ids_crc32",
        F.crc32(F.col("_decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("_decoded") == F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, " ")).alias("same"),
    )
