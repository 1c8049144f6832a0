"""Mixing sources to target weights.

A source's weight is its token share to a power, normalised. The exponent is bisected
between 0 (equal weights) and 1 (shares as they are) to meet a target entropy or a limit
on repetition. Each source's budget of tokens is then drawn from whole permutations of
its documents, one per epoch, and laid out in blocks that each hold the sources in their
target proportions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.ranks import running_sums
from delaykit.llm.shared import stored

# One pass over the sources halves the interval of the exponent this many times.
HALVINGS, PASSES = 5, 8


def word_count(text_col: str):
    """Words of a text, the tokens of a mix unless others are given; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    """Per source with tokens: ``source``, ``tokens``. A null source is a source."""
    return rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")


def find_exponent(
    sources: DataFrame, max_epochs: float | None = None, entropy: float | None = None, budget: float | None = None
) -> tuple[float, float]:
    """The exponent and the sum of tokens to that power.

    With ``max_epochs``: the smallest exponent under which no source is drawn more often
    from a ``budget`` of tokens (None: the least budget that draws every document). With
    ``entropy`` (in nats): the largest exponent whose weights have at least that entropy.
    An unreachable target gives the nearer end of 0 to 1. Sources are summed up by Spark;
    only a few sums for each tried exponent reach the driver.
    """
    if (max_epochs is None) == (entropy is None):
        raise ValueError("give either max_epochs or entropy")
    t = F.col("tokens").cast("double")

    def tried(exponents: list[float]) -> list[tuple[bool, float]]:
        sums = []
        for i, a in enumerate(exponents):
            p = F.pow(t, F.lit(a))
            # Draws of a source are proportional to tokens ** (a - 1).
            draws = F.pow(t, F.lit(a - 1))
            sums += [
                F.sum(p).alias(f"z{i}"),
                F.sum(p * F.log(t)).alias(f"l{i}"),
                F.max(draws).alias(f"most{i}"),
                F.min(draws).alias(f"least{i}"),
            ]
        row = sources.agg(*sums).first()
        out = []
        for i, a in enumerate(exponents):
            z = row[f"z{i}"]
            if max_epochs is not None:
                spent = z / row[f"least{i}"] if budget is None else budget
                out.append((row[f"most{i}"] * spent / z <= max_epochs, z))
            else:
                # Larger exponents have less entropy; the search is for where it falls short.
                out.append((math.log(z) - a * row[f"l{i}"] / z < entropy, z))
        return out

    low, high = 0.0, 1.0
    (at_low, z_low), (at_high, z_high) = tried([low, high])
    if at_low:
        return low, z_low
    if not at_high:
        return high, z_high
    for _ in range(PASSES):
        step = (high - low) / (1 << HALVINGS)
        ladder = [low + step * i for i in range(1, 1 << HALVINGS)]
        met = [i for i, (ok, _) in enumerate(tried(ladder)) if ok]
        first = met[0] if met else len(ladder)
        low, high = (ladder[first - 1] if first else low), (ladder[first] if first < len(ladder) else high)
    chosen = high if max_epochs is not None else low
    return chosen, tried([chosen])[0][1]


def _drawn(
    df: DataFrame, id_col: str, text_col: str, source_col: str, n_tokens, options: dict, block_tokens: int, seed: int,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """Per drawn copy: ``id``, ``text_hash``, ``source``, ``n_tokens``, ``epoch``, ``block``.

    The hash tells rows with one id apart: that of the text, or of the columns ``hashed``.
    """
    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.xxhash64(*(hashed or [text_col])).alias("text_hash"),
        (word_count(text_col) if n_tokens is None else n_tokens).alias("n_tokens"),
    )
    # Null and a real name must not meet in a key: a struct tells them apart.
    rows = stored(rows.withColumn("key", F.to_json(F.struct("source"))), "tokens")
    sources = stored(source_tokens(rows), "sources")
    count = rows.count()
    totals = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    if totals[0] is None:
        return rows.select("*", F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("block")).limit(0)
    budget = options.get("budget", totals[0])
    limits = {k: v for k, v in options.items() if k != "budget"}
    exponent, z = find_exponent(sources, budget=budget, **limits)
    if budget is None:
        # The least budget that draws every document at least once.
        budget = math.ceil(z * float(totals[1]) ** (1 - exponent) - 1e-6)
    weight = F.pow(F.col("tokens").cast("double"), F.lit(exponent)) / F.lit(z)
    share = F.floor(weight * F.lit(float(budget)) + 1e-6).cast("long")
    if options.get("budget", 0) is None:
        # The budget was rounded; the largest source must not miss a token by it.
        share = F.greatest(share, F.col("tokens"))
    plan = sources.select(
        F.to_json(F.struct("source")).alias("key"),
        "tokens",
        share.alias("share"),
        F.greatest(F.lit(1), F.floor(weight * block_tokens)).cast("long").alias("per_block"),
    )
    planned = rows.join(plan, "key")
    # Whole epochs draw every document; the last one draws until the budget is met.
    whole = F.floor(F.col("share") / F.col("tokens")).cast("int")
    partly = F.when(F.col("share") % F.col("tokens") > 0, 1).otherwise(0)
    copies = planned.withColumn("epoch", F.explode(F.sequence(F.lit(0), whole + partly - 1))).where("share > 0")
    order = copies.withColumn("_seed", F.lit(seed))
    placed = running_sums(
        order, ["key", "epoch"], ["epoch", "_seed", "id", "text_hash"], F.col("n_tokens"), "before", 2 * count
    )
    at = F.col("epoch") * F.col("tokens") + F.col("before")
    fits = (F.col("epoch") < F.floor(F.col("share") / F.col("tokens"))) | (
        at + F.col("n_tokens") <= F.col("share")
    )
    return placed.where(fits).select(
        "id", "text_hash", "source", "n_tokens", "epoch", F.floor(at / F.col("per_block")).alias("block")
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    n_tokens=None,
    block_tokens: int = 1_000_000,
    seed: int = 17,
    **options,
) -> DataFrame:
    """The mixed stream: ``doc_id``, ``source``, ``n_tokens``, ``epoch``, ``block``, ``slot``.

    ``options``: ``max_epochs`` or ``entropy``, and ``budget`` in tokens (left out: as many
    as there are; None: as many as draw every document). Every source is drawn in whole
    permutations of its documents, then in part of one more until the next document would
    exceed its budget. ``block`` and ``slot`` give the order of the stream: a block holds
    about ``block_tokens``, each source in its proportion, shuffled.

    A null source is a source of its own; a null text has no tokens; a source without
    tokens has no weight and is not drawn. Rows with null ids and repeated rows are drawn
    like others. No rows give no rows.
    """
    drawn = _drawn(df, id_col, text_col, source_col, n_tokens, options, block_tokens, seed)
    shuffled = F.xxhash64(F.lit(seed), "block", "id", "text_hash", "epoch")
    slot = F.row_number().over(Window.partitionBy("block").orderBy(shuffled, "id", "text_hash", "epoch")) - 1
    return drawn.select(F.col("id").alias(id_col), "source", "n_tokens", "epoch", "block", slot.alias("slot"))


def mixed_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    **options,
) -> DataFrame:
    """The rows of ``df`` with all their columns, each as often as ``mix`` draws it.

    Rows with one id that differ in any column are drawn each for itself; rows travel as
    one struct, so their columns' names cannot clash.
    """
    drawn = _drawn(df, id_col, text_col, source_col, None, options, 1_000_000, seed, df.columns)
    draws = drawn.groupBy(F.col("id").alias("drawn_id"), F.col("text_hash").alias("drawn_hash")).agg(
        F.count(F.lit(1)).alias("draws")
    )
    whole = df.select(
        F.struct(*df.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(*df.columns).alias("hash")
    )
    same = F.col("id").eqNullSafe(F.col("drawn_id")) & (F.col("hash") == F.col("drawn_hash"))
    # Rows alike in all columns share their draws: one of them stands for all.
    copies = Window.partitionBy("drawn_id", "drawn_hash").orderBy("row")
    matched = whole.join(draws, same).withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    return matched.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("draws")))).select("row.*")
