"""Collocations: phrases of words that occur together more often than apart.

The words of each language are dealt to shards; a shard is an index over word ids that
can extend a phrase on either side. The index is that of the Burrows-Wheeler transform
of the shard and of its reverse, with rows sorted by their first eight words, which is
enough for phrases of up to eight. A phrase is an interval of rows in both. All words
before (after) a phrase are the transform's symbols inside its interval, and each gives
the interval of the longer phrase, so counts and extensions need no look at the text.

Levels go from words to longer phrases. Each shard extends the phrases that are frequent
in the whole language, to the left and to the right in turn, and the counts are summed
over the shards. Shards know the frequent phrases as marked bits, ``MARK_BITS`` at most:
a bit may be shared, so a shard may extend a rare phrase in vain, but never misses a
frequent one, and counts are exact. Words that are rare in their language part the
text, since no frequent phrase holds one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.ranks import ranked
from delaykit.llm.shared import stored, texts_of

# What parts pieces, and the language of texts without one.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"
_TABLE = bytearray(range(256))
_TABLE[ord("A") : ord("Z") + 1] = bytes(range(ord("a"), ord("z") + 1))
for _end in PIECE_ENDS:
    _TABLE[ord(_end)] = ord(".")
_TABLE = bytes(_TABLE)

# Words of one language in a shard, and how many such shards a task gathers at once.
SHARD_WORDS, GATHERED_SHARDS = 1 << 20, 4
SORTED_WORDS = 8
# 16 MB for each length of phrases; more phrases than a sixteenth of it share bits more often.
MARK_BITS = 1 << 27
ROWS = 1 << 17


def pieces(text: str) -> list[bytes]:
    """The words of a text in lower case, with ``.`` between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(b".", b" . ").split()


class _Gathered:
    """Words of one language on their way to a shard; number 0 ends a piece."""

    def __init__(self):
        following = count()
        self.numbers = defaultdict(following.__next__)
        self.numbers[b"."]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        part = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.uint32, count=len(words))
        self.parts += [part, np.zeros(1, dtype=np.uint32)]
        self.size += len(words)

    def row(self, lang: str) -> pd.DataFrame:
        numbers = np.concatenate(self.parts)
        words = [w.decode("utf-8", "surrogatepass") for w in self.numbers]
        counts = np.bincount(numbers, minlength=len(words))
        # The upper halves are nearly all zero and take little room.
        return pd.DataFrame(
            {
                "lang": [lang], "words": [words[1:]], "counts": [counts[1:]],
                "low": [numbers.astype("<u2").tobytes()], "high": [(numbers >> 16).astype("<u2").tobytes()],
            }
        )


def _to_shards(shard_words: int):
    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered: dict[str, _Gathered] = {}
        total = 0
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                words = pieces(texts_of(text))
                if not words:
                    continue
                own = gathered.setdefault(lang, _Gathered())
                own.add(words)
                total += len(words)
                full = [lang] if own.size >= shard_words else list(gathered) if total >= GATHERED_SHARDS * shard_words else []
                for name in full:
                    total -= gathered[name].size
                    yield gathered.pop(name).row(name)
        for name, own in gathered.items():
            yield own.row(name)

    return gather


class PhraseIndex(NamedTuple):
    """The transforms of a shard and of its reverse over dense word numbers, 0 between pieces."""

    names: np.ndarray  # the id of each word number; names[0] is no word
    before: np.ndarray  # the word before each row of the text
    after: np.ndarray  # the word after each row of the reversed text

    @classmethod
    def build(cls, ids: np.ndarray) -> PhraseIndex:
        """Of word ids from 1 in text order, with 0 for what no phrase may hold."""
        # One part between two pieces, one at each end.
        kept = np.concatenate([[0], ids, [0]])
        kept = np.concatenate([kept[:1], kept[1:][(kept[1:] > 0) | (kept[:-1] > 0)]])
        names, dense = np.unique(kept, return_inverse=True)
        return cls(names, _transform(dense), _transform(dense[::-1]))


def _transform(text: np.ndarray) -> np.ndarray:
    """The word before each row, rows in the order of their first ``SORTED_WORDS`` words."""
    rank, width = text.astype(np.int64), 1
    while width < SORTED_WORDS:
        joined = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        rank = np.unique(joined, return_inverse=True)[1]
        width *= 2
    return text[np.argsort(rank, kind="stable") - 1]


class Phrases(NamedTuple):
    """Phrases of one length with their interval of rows in both directions."""

    words: np.ndarray  # a row of word ids for each
    at: np.ndarray  # first row in the text
    back: np.ndarray  # first row in the reversed text
    times: np.ndarray

    def of(self, chosen: np.ndarray) -> Phrases:
        return Phrases(*(x[chosen] for x in self))


def single_words(index: PhraseIndex) -> Phrases:
    times = np.bincount(index.before, minlength=len(index.names))
    first = np.cumsum(times) - times
    every = np.arange(1, len(times))
    return Phrases(index.names[every, None], first[every], first[every], times[every])


def extended(index: PhraseIndex, known: Phrases, left: bool) -> Phrases:
    """All phrases of the shard one word longer than ``known``, whose other part is known too."""
    symbols = index.before if left else index.after
    at, other = (known.at, known.back) if left else (known.back, known.at)
    rows = np.repeat(at - np.cumsum(known.times) + known.times, known.times) + np.arange(known.times.sum())
    owner = np.repeat(np.arange(len(at)), known.times)
    width = len(index.names)
    keys, times = np.unique(owner * width + symbols[rows], return_counts=True)
    owner, symbol = keys // width, keys % width
    # Rows of the other direction lie by the word that extends them.
    upto = np.cumsum(times) - times
    inside = upto - (np.cumsum(known.times) - known.times)[owner]
    # Rows by symbol: how many come before the interval's first is the first of the longer one.
    size = len(symbols)
    places = np.argsort(symbols, kind="stable")
    first = np.searchsorted(symbols[places].astype(np.int64) * size + places, symbol * size + at[owner])
    made = Phrases(
        np.hstack([index.names[symbol, None], known.words[owner]] if left else [known.words[owner], index.names[symbol, None]]),
        first if left else other[owner] + inside,
        other[owner] + inside if left else first,
        times,
    )
    # The part without the old phrase's far word has an interval around the new one.
    order = np.argsort(at)
    around = order[np.searchsorted(at[order], first, side="right") - 1]
    within = (first >= at[around]) & (first < at[around] + known.times[around])
    return made.of((symbol > 0) & within)


def _keys(words: np.ndarray) -> list[np.ndarray]:
    """A phrase as long numbers of two word ids each; the last of an odd length has one."""
    shifted = words.astype(np.int64)
    columns = [shifted[:, i] for i in range(words.shape[1])]
    pairs = [a << 32 | b for a, b in zip(columns[::2], columns[1::2])]
    return pairs + columns[-1:] if len(columns) % 2 else pairs


def _key_names(length: int) -> list[str]:
    return [f"p{i}" for i in range((length + 1) // 2)]


def _bits(keys: list[np.ndarray], size: int) -> np.ndarray:
    """The place of each phrase among ``size`` bits, a power of two."""
    mixed = np.zeros(len(keys[0]), dtype=np.uint64)
    for key in keys:
        mixed = (mixed ^ key.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)).astype(np.int64) & (size - 1)


class Marks(NamedTuple):
    """A set of phrases as marked bits: knows each of them, and some others."""

    size: int
    packed: bytes

    def known(self, found: Phrases) -> Phrases:
        at = _bits(_keys(found.words), self.size)
        bits = np.frombuffer(self.packed, dtype=np.uint8)
        return found.of((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))


def marks_of(phrases: DataFrame, length: int) -> Marks:
    """The bits of stored ``phrases``, at most ``MARK_BITS`` of them, whatever the data."""
    rows = phrases.count()
    size = max(1 << 15, min(MARK_BITS, 1 << (16 * rows).bit_length()))
    names = _key_names(length)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits([batch.column(n).to_numpy() for n in names], size)
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["bit"])

    # Spark's bitmaps have 32,768 bits; the first is numbered 1.
    bit = phrases.select(*names).mapInArrow(places, "bit long").select(F.col("bit") + 1)
    bit = bit.toDF("bit")
    rows = bit.groupBy(F.bitmap_bucket_number("bit").alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")
    )
    packed = bytearray(size // 8)
    for row in rows.toLocalIterator():
        at = (row["number"] - 1) * 4096
        packed[at : at + 4096] = row["bitmap"]
    return Marks(size, bytes(packed))


def _index_of(row) -> PhraseIndex:
    names = np.frombuffer(row.names, dtype="<u4").astype(np.int64)
    form = f"<u{row.width}"
    return PhraseIndex(
        names, np.frombuffer(row.before, dtype=form).astype(np.int64), np.frombuffer(row.after, dtype=form).astype(np.int64)
    )


def _build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            numbers = np.frombuffer(row.low, "<u2").astype(np.int64) | np.frombuffer(row.high, "<u2").astype(np.int64) << 16
            ids = np.zeros(int(numbers.max()) + 1, dtype=np.int64)
            ids[np.asarray(row.places, dtype=np.int64) + 1] = np.asarray(row.ids, dtype=np.int64)
            index = PhraseIndex.build(ids[numbers])
            width = 2 if len(index.names) <= 1 << 16 else 4
            yield pd.DataFrame(
                {
                    "shard": [row.shard], "names": [index.names.astype("<u4").tobytes()], "width": [width],
                    "before": [index.before.astype(f"<u{width}").tobytes()],
                    "after": [index.after.astype(f"<u{width}").tobytes()],
                }
            )


def _level(length: int, marks):
    """Finds the phrases of ``length`` words in a shard by way of the marked shorter ones."""
    names = _key_names(length)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pandas().itertuples():
                index = _index_of(row)
                found = extended(index, single_words(index), left=False)
                for step, known in enumerate(marks.value, start=3):
                    found = extended(index, known.known(found), left=step % 2 == 1)
                for at in range(0, len(found.times), ROWS):
                    part = found.of(slice(at, at + ROWS))
                    columns = [*_keys(part.words), part.times.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*names, "times"])

    return find


def shards(df: DataFrame, text_col: str, lang_col: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The words of every language in rows of about ``shard_words``; a text is never cut."""
    rows = df.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    made = rows.mapInPandas(
        _to_shards(shard_words), "lang string, words array<string>, counts array<long>, low binary, high binary"
    )
    return stored(made.withColumn("shard", F.monotonically_increasing_id()), "shards")


def indexes(parts: DataFrame, words: DataFrame) -> DataFrame:
    """The index of every shard over the words of ``words`` (``lang``, ``word``, ``id`` from 1)."""
    listed = parts.select(F.col("shard").alias("of"), "lang", F.posexplode("words").alias("place", "word"))
    known = listed.join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("of").agg(F.collect_list("place").alias("places"), F.collect_list("id").alias("ids"))
    joined = parts.select("shard", "low", "high").join(known, parts["shard"] == known["of"])
    built = joined.select("shard", "low", "high", "places", "ids").mapInPandas(
        _build, "shard long, names binary, width int, before binary, after binary"
    )
    return stored(built, "indexes")


def phrase_counts(index: DataFrame, least: int, longest: int) -> DataFrame:
    """``phrase`` (ids of four bytes) and ``f`` of all phrases of 2 to ``longest`` words with ``f >= least``."""
    marks, whole = [], None
    for length in range(2, longest + 1):
        names = _key_names(length)
        schema = ", ".join(f"{n} long" for n in [*names, "times"])
        sent = index.sparkSession.sparkContext.broadcast(tuple(marks))
        sums = index.mapInArrow(_level(length, sent), schema).groupBy(*names).agg(F.sum("times").alias("f"))
        frequent = stored(sums.where(F.col("f") >= least), f"phrases-{length}")
        digits = [16] * (length // 2) + [8] * (length % 2)
        packed = F.concat(*[F.unhex(F.lpad(F.hex(n), d, "0")) for n, d in zip(names, digits)])
        table = frequent.select(packed.alias("phrase"), "f")
        whole = table if whole is None else whole.unionByName(table)
        if length < longest:
            marks.append(marks_of(frequent, length))
    return whole


def _head(words: Column | int) -> Column:
    return F.expr(f"substring(phrase, 1, 4 * ({words}))")


def mine(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5,
    top: int | None = 2000, share: int = 100, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per language the best phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Candidates are phrases of 2 to ``longest`` (at most 8) words that occur ``a >= least``
    times in the pieces of the language's texts. A cut into two parts that occur ``l`` and ``r``
    times scores ``floor(1000 * a * n / (l * r))``, ``n`` being all words of the language; the
    lowest cut counts, of equal ones the one with the shortest first part. A candidate is
    dropped when a longer candidate that holds it occurs at least ``share`` percent as
    often. Ranks go by score, then ``a``, both descending, then by the phrase; ``top`` is the
    number of rows per language, all without one.

    Null texts count as empty and null languages as ``und``; ids are not read, so repeated
    rows count each time. Texts without words, or an empty table, give no rows. A very long
    text stays in one shard, in the memory of one task. Other columns are not read.
    """
    if not 2 <= longest <= SORTED_WORDS:
        raise ValueError(f"phrases have 2 to {SORTED_WORDS} words")
    parts = shards(df, text_col, lang_col, shard_words)
    listed = parts.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("f"))))
    every = stored(listed.groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    sizes = every.groupBy("lang").agg(F.sum("f").alias("n"))
    common = every.where(F.col("f") >= least)
    words = ranked(common, [], ["lang", "word"], "id", common.count())
    words = stored(words.withColumn("id", F.col("id") + 1), "common")
    counts = phrase_counts(indexes(parts, words), least, longest)
    single = words.select(F.expr("unhex(lpad(hex(id), 8, '0'))").alias("phrase"), "f")
    counts = stored(single.unionByName(counts), "counts")

    # A longer candidate that holds another holds one that is a word longer, as frequent or more.
    length = F.floor(F.octet_length("phrase") / 4).cast("int")
    sized = counts.withColumn("words", length)
    longer = sized.where("words > 2")
    around = longer.select(_head("words - 1").alias("phrase"), "f").union(
        longer.select(F.expr("substring(phrase, 5)").alias("phrase"), "f")
    )
    around = around.groupBy("phrase").agg(F.max("f").alias("held"))
    candidates = sized.where("words > 1").join(around, "phrase", "left")
    candidates = candidates.where(F.coalesce(F.col("held"), F.lit(0)) * 100 < F.col("f") * share)

    cuts = candidates.select("phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("phrase", "a", "k", _head("k").alias("first"), F.expr("substring(phrase, 4 * k + 1)").alias("rest"))
    cuts = cuts.join(counts.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest")

    spelt = candidates.select("phrase", F.posexplode(F.expr("transform(sequence(0, words - 1), i -> substring(phrase, 4 * i + 1, 4))")))
    names = words.select(F.expr("unhex(lpad(hex(id), 8, '0'))").alias("col"), "lang", "word")
    spelt = spelt.join(names, "col").groupBy("phrase").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w")
    )
    spelt = spelt.select("phrase", "lang", F.array_join("w.word", " ").alias("spelt")).join(sizes, "lang")

    exact = F.expr(
        "(cast(1000 AS decimal(4,0)) * cast(a AS decimal(19,0)) * cast(n AS decimal(19,0)))"
        " div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"
    )
    scored = cuts.join(spelt, "phrase").withColumn("score", exact)
    scored = scored.groupBy("phrase", "lang", "spelt", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select(
        "lang", F.col("spelt").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = scored.withColumn("rank", F.row_number().over(best).cast("long"))
    if top is not None:
        placed = placed.where(F.col("rank") <= top)
    return placed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
