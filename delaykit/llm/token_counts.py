"""Token counts of texts by byte-pair merging, without any identifiers.

Each word of a text is a linked list of symbols; a heap gives the adjacent pair of the
lowest rank, which is merged until no ranked pair is left. The count of a word is the
number of its first symbols less the number of merges.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.caches import WordMemo
from delaykit.llm.shared import texts_of

# Fixed value: the word pattern of byte-level BPE tokenizers.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts tokens as a tokenizer file with a byte-level BPE model does."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        letters = byte_letters()
        # Symbols are numbered: bytes by value, then merged strings as they first appear.
        number = {letter: b for b, letter in enumerate(letters)}
        self.ranks, self.made = {}, []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = number.setdefault(left + right, len(number))
            self.ranks[number[left] << 32 | number[right]] = rank
            self.made.append(made)
        self.words = regex.compile(WORDS)
        self.gaps = re.compile(r"\s\s")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.word_memo = WordMemo(self.word, 200_000)
        self.lead_memo = WordMemo(self.spelt, 100_000)
        self.chunk_memo = WordMemo(lambda chunk: self.spelt(" " + chunk), 600_000)

    def word(self, word: str) -> int:
        rank_of, made = self.ranks.get, self.made
        symbols = list(word.encode())
        count = end = len(symbols)
        heap = []
        for i in range(end - 1):
            rank = rank_of(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                heap.append((rank, i))
        if not heap:
            return count
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while heap:
            rank, i = pop(heap)
            j = after[i]
            # An entry is stale when either symbol has since been merged away or grown.
            if j == end or symbols[i] < 0 or rank_of(symbols[i] << 32 | symbols[j]) != rank:
                continue
            symbols[i] = symbol = made[rank]
            symbols[j] = -1
            count -= 1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                rank = rank_of(symbol << 32 | symbols[k])
                if rank is not None:
                    push(heap, (rank, i))
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << 32 | symbol)
                if rank is not None:
                    push(heap, (rank, h))
        return count

    def spelt(self, text: str) -> int:
        return sum(map(self.word_memo.__getitem__, self.words.findall(text)))

    def plain(self, text: str) -> int:
        if self.gaps.search(text):
            return self.spelt(text)
        # Where no white space follows white space, a space begins a word of its own
        # and a line feed is one.
        lines = [line.split(" ") for line in text.split("\n")]
        total = (len(lines) - 1) * self.word("\n")
        total += sum(map(self.lead_memo.__getitem__, [line[0] for line in lines]))
        return total + sum(sum(map(self.chunk_memo.__getitem__, line[1:])) for line in lines)

    def text(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        # A special string is one token and parts the text around it.
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self.plain, pieces))


@lru_cache(maxsize=2)
def _counter(tokenizer_json: str) -> MergeCounter:
    # One per Python worker: its memo serves all tasks of the worker.
    return MergeCounter(tokenizer_json)


def token_count(df: DataFrame, text_col: str, tokenizer_path: str) -> Column:
    """The number of tokens of ``text_col`` as a column; a null text has 0.

    The tokenizer file is read on the driver and sent to the executors once; its size
    is that of the vocabulary, whatever the data.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counter = _counter(spec.value)
        return pd.Series([counter.text(texts_of(t)) for t in texts], dtype="int64")

    return count(F.col(text_col))


def count_tokens(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    One row per input row, repeated rows and null ids included. Null and empty texts have
    no bytes and no tokens. Other columns of the input are not read. Nothing is shuffled.
    """
    rows = df.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(df, text_col, tokenizer_path).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
