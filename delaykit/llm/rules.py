"""Quality rules with host verdicts.

Every document is measured and tested by rules of its own. Failures are then summed by
host; a host's failure rate is shrunk towards that of all hosts by a beta prior fitted to
them, so that a host with few documents is not judged by chance. The documents of a host
that fails are dropped with those that fail themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.shared import stored

# White space, and the characters that count as symbols.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_LINE_PERCENT = 30
MAX_HOST_RATE = 0.5
RULES = ("short", "repeats", "symbols", "lines")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeats(words: Column) -> Column:
    """How many words lie in 3-word windows that the text has twice or more.

    Windows are known by 64-bit hashes. Where all differ nothing more is done; else they
    are sorted with their places, and the places of equal ones cover three words each.
    """
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def places(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda p: F.sort_array(
                F.filter(
                    F.transform(
                        p,
                        lambda x, k: F.when(
                            (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]), x["i"]
                        ),
                    ),
                    lambda i: i.isNotNull(),
                )
            ),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda i, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), i - F.get(at, k - 1))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places(h), covered)),
    )


def measures(text: Column) -> Column:
    """A struct of the measures of a text and of the rules it fails; null counts as empty.

    One expression, so that a plan that repeats a field does not measure again.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    counted = F.struct(
        let(words, lambda w: F.struct(F.size(w).alias("n"), _repeats(w).alias("repeats"))).alias("words"),
        let(
            lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
        ).alias("lines"),
        F.length(F.translate(text, BLANKS, "")).alias("chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("symbols"),
    )

    def tested(c: Column) -> Column:
        n_words, repeats, n_lines, dup = (c["words"]["n"], c["words"]["repeats"], c["lines"]["n"], c["lines"]["dup"])
        return F.struct(
            n_words.cast("long").alias("n_words"),
            c["chars"].cast("long").alias("word_chars"),
            c["symbols"].cast("long").alias("n_symbols"),
            dup.cast("long").alias("n_dup_lines"),
            repeats.cast("long").alias("n_repeat_words"),
            (n_words < MIN_WORDS).alias("short"),
            (repeats * 100 > n_words * MAX_REPEAT_PERCENT).alias("repeats"),
            (c["symbols"] * 100 > c["chars"] * MAX_SYMBOL_PERCENT).alias("symbols"),
            (dup * 100 > n_lines * MAX_LINE_PERCENT).alias("lines"),
        )

    return let(counted, tested)


def host_rates(rows: DataFrame, host_col: str) -> DataFrame:
    """Per host: ``n`` and, by rule, the failure rate shrunk by an empirical beta prior.

    The prior has the mean of all documents and the precision that the spread of the host
    rates leaves after binomial chance (moments). A host with n documents and x failures
    has the rate (x + mean * precision) / (n + precision). Rows without a host are left
    out. Failures are summed per task first, so a host may hold any share of the rows.
    """
    failed = [F.sum(F.col(r).cast("long")).alias(f"{r}_failed") for r in RULES]
    hosts = stored(
        rows.where(F.col(host_col).isNotNull()).groupBy(host_col).agg(F.count(F.lit(1)).alias("n"), *failed), "hosts"
    )
    totals = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.coalesce(F.sum(f"{r}_failed"), F.lit(0)).alias(r) for r in RULES],
        *[
            F.coalesce(F.sum(F.pow(f"{r}_failed", F.lit(2)) / F.col("n")), F.lit(0.0)).alias(f"{r}_squares")
            for r in RULES
        ],
    ).first()
    rates = []
    for rule in RULES:
        n = max(totals["n"], 1)
        mean = totals[rule] / n
        within = mean * (1 - mean)
        # Spread of the host rates around the mean, weighted by their documents.
        spread = totals[f"{rule}_squares"] / n - mean * mean - within * max(totals["hosts"] - 1, 0) / n
        precision = min(max(within / spread - 1, 1.0), 1e6) if spread > 1e-12 else 1e6
        shrunk = (F.col(f"{rule}_failed") + mean * precision) / (F.col("n") + precision)
        rates.append(shrunk.alias(f"{rule}_rate"))
    return hosts.select(host_col, "n", *rates)


def _host_failed() -> Column:
    return F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > MAX_HOST_RATE


def host_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Per row: the id, the measures, ``base_failed`` and ``kept``.

    A row fails by itself with fewer than 50 words or with more than half of its words in
    repeated 3-word windows. ``kept`` is false for those and for all rows of a host where
    the shrunk failure rate of any rule exceeds one half. Rows without a host are judged
    by themselves alone; a null text counts as empty; repeated rows and null ids stay.
    """
    rows = df.select(F.col(id_col), F.col(host_col).alias("_host"), measures(F.col(text_col)).alias("_m"))
    rows = stored(rows.select(id_col, "_host", "_m.*"), "measures")
    hosts = host_rates(rows, "_host").select("_host", _host_failed().alias("_host_failed"))
    joined = rows.join(hosts, "_host", "left")
    base = F.col("short") | F.col("repeats")
    return joined.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~F.coalesce("_host_failed", F.lit(False))).alias("kept"),
    )


def keep_passed(df: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``df`` that ``host_rules`` keeps, with all their columns.

    Texts are read twice, once for the hosts and once for the documents, and never moved:
    only the hosts that failed are joined.
    """
    rows = df.select(F.col(host_col).alias("_host"), measures(F.col(text_col)).alias("_m"))
    hosts = host_rates(rows.select("_host", "_m.*"), "_host").where(_host_failed()).select("_host")
    passed = df.where(let(measures(F.col(text_col)), lambda m: ~(m["short"] | m["repeats"])))
    return passed.join(hosts, passed[host_col] == hosts["_host"], "left_anti")
