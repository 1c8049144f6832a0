"""Secret spans in texts, and weak credential parts linked to the parts that complete them.

Spans of the three strong kinds stand by themselves. The parts of a credential that prove
nothing alone (a user name, an opaque string, an address) are candidates. Candidates and
strong spans are intervals of a text; an interval join brings together those that begin
within ``window`` code points of each other in one scope, a run of lines without an empty
line. A candidate is reported only when the join finds the parts that complete it: an
identifier for an opaque string, a secret for a user name, both for an address.

Everything here is column expressions and joins; no Python worker runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.shared import stored

# The strong kinds. A match of the first with a short value is dropped after
# matching, since it hides what it covers; the runs of the others match only when long.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

# The weak kinds, searched together with the strong ones so that none lies in a strong span.
USER = r"""(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ADDRESS = (
    r"""(?:https?|ftp|s3|postgres|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
    r"""|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}(?::[0-9]+)?"""
)
OPAQUE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
_PLAIN_ASSIGN = ASSIGN.removeprefix("(?i)").replace("(password", "(?:password").replace("([A-Za-z0-9", "(?:[A-Za-z0-9")
WEAK = f"(?:(?i:{_PLAIN_ASSIGN})|{ACCESS}|{HEX})|((?i:{USER}))|((?i:{ADDRESS}))|({OPAQUE})"
BLANK = r"\n[\x20\x09\r]*\n"

KINDS = ("assign", "access", "hex", "user", "opaque", "endpoint")
STRONG = KINDS[:3]
IDENTIFIERS, SECRETS = ("access", "user"), ("assign", "hex", "opaque")
WINDOW = 300

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _sums(values: Column) -> Column:
    """Running sums of a short array."""
    begin = F.array().cast("array<int>")
    return F.aggregate(
        values, begin, lambda done, v: F.concat(done, F.array(v + F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))
    )


def running_totals(values: Column) -> Column:
    """Running sums of an array: within parts of about the square root of its size, then over them."""
    size = F.size(values)
    part = F.ceil(F.sqrt(size)).cast("int")
    inner = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / part).cast("int")),
        lambda i: _sums(F.slice(values, i * part + 1, part)),
    )
    totals = F.transform(inner, lambda p: F.element_at(p, -1))
    whole = F.flatten(
        F.transform(
            F.arrays_zip(inner.alias("part"), totals.alias("total"), _sums(totals).alias("upto")),
            lambda z: F.transform(z["part"], lambda v: v + z["upto"] - z["total"]),
        )
    )
    return F.when(size > 0, whole).otherwise(F.array().cast("array<int>"))


def _places(text: Column, gaps: Column, pattern: str) -> Column:
    """Ends and lengths of all matches, from the text between them."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(hits, F.char_length)
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(hits)), lengths, lambda gap, n: F.char_length(gap) + n
    )
    return F.arrays_zip(running_totals(steps).alias("end"), lengths.alias("n"))


def _spans(places: Column, kind: Column | int, keep: Column | None = None) -> Column:
    """Spans of a kind number, or of a kind for each match; matches not kept are dropped."""
    if keep is not None:
        zipped = F.arrays_zip(places.alias("p"), keep.alias("k"))
        places = F.transform(F.filter(zipped, lambda z: z["k"]), lambda z: z["p"])
    made = F.transform(
        places,
        lambda p: F.struct(
            (p["end"] - p["n"]).alias("start"), F.lit(kind).cast("int").alias("kind"), p["end"].alias("end")
        ),
    )
    return made.cast(_SPAN)


def _none() -> Column:
    return F.array().cast(_SPAN)


def _found(text: Column, gaps: str, pattern: str, kind: int, keep: Column | None = None) -> Column:
    made = _spans(_places(text, F.col(gaps), pattern), kind, keep)
    return F.when(F.size(gaps) > 1, made).otherwise(_none())


def _weak(text: Column) -> Column:
    """Candidates of the weak kinds where ``g_weak`` has been cut; an opaque string has digits and letters of both cases."""

    def group(i: int) -> Column:
        return F.regexp_extract_all(text, F.lit(WEAK), F.lit(i))

    mixed = F.transform(
        group(3), lambda s: s.rlike("[a-z]") & s.rlike("[A-Z]") & s.rlike("[0-9]")
    )
    kinds = F.zip_with(
        F.zip_with(
            group(1), group(2),
            lambda u, a: F.when(u != "", KINDS.index("user")).when(a != "", KINDS.index("endpoint")),
        ),
        mixed,
        lambda k, m: F.coalesce(k, F.when(m, KINDS.index("opaque"))),
    )
    zipped = F.arrays_zip(_places(text, F.col("g_weak"), WEAK).alias("p"), kinds.alias("k"))
    made = F.transform(
        F.filter(zipped, lambda z: z["k"].isNotNull()),
        lambda z: F.struct(
            (z["p"]["end"] - z["p"]["n"]).alias("start"), z["k"].alias("kind"), z["p"]["end"].alias("end")
        ),
    )
    return F.when(F.size("g_weak") > 1, made.cast(_SPAN)).otherwise(_none())


def _holds(kinds: tuple[str, ...]) -> Column:
    numbers = [KINDS.index(k) for k in kinds]
    return F.exists(F.concat("base", "weak"), lambda s: s["kind"].isin(numbers))


def linked_parts(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """The weak rows of ``parts`` that are complete: ``key``, ``start``, ``kind``, ``end``.

    ``parts`` holds the intervals of each text ``key`` with their ``scope``. Intervals meet in
    buckets as wide as the window, so a row meets only what begins near it; strong
    intervals of a kind do not overlap, so the pairs of a row are bounded by the window.
    """
    near = parts.withColumn("bucket", F.floor(F.col("start") / window))
    weak = near.where(F.col("kind") >= len(STRONG)).withColumn(
        "bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1))
    )
    other = near.select("key", "scope", "bucket", F.col("start").alias("at"), F.col("kind").alias("with"))
    met = weak.join(other, ["key", "scope", "bucket"]).where(F.abs(F.col("start") - F.col("at")) <= window)

    def meets(kinds: tuple[str, ...]) -> Column:
        return F.bool_or(F.col("with").isin([KINDS.index(k) for k in kinds]))

    sides = met.groupBy("key", "start", "kind", "end").agg(
        meets(IDENTIFIERS).alias("identifier"), meets(SECRETS).alias("secret")
    )
    kind = F.col("kind")
    complete = (
        F.when(kind == KINDS.index("opaque"), F.col("identifier"))
        .when(kind == KINDS.index("user"), F.col("secret"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return sides.where(complete).select("key", "start", "kind", "end")


def _scoped(texts: DataFrame) -> DataFrame:
    """The intervals of each text with their scope: the number of empty lines before them."""
    blank = F.lit(len(KINDS)).cast("int")
    rows = texts.select("key", F.inline(F.concat("base", "weak", F.coalesce("blanks", _none()))))
    before = Window.partitionBy("key").orderBy("start", F.desc("kind"))
    scope = F.sum((F.col("kind") == blank).cast("int")).over(before)
    return rows.withColumn("scope", scope).where(F.col("kind") < blank)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: the id, ``base`` and ``linked``, arrays of (``start``, ``kind``, ``end``) by start.

    ``kind`` numbers ``KINDS``. Offsets count code points, ends are exclusive. ``base`` holds
    the strong spans, leftmost and not overlapping within a kind; ``linked`` the weak
    parts whose complement lies within ``window`` code points in the same scope.

    One row per input row, repeated rows and null ids included: links depend on the text
    alone and are worked out once for equal texts (told apart by SHA-256). Null and empty
    texts, and an empty table, have no spans. A very long text is searched whole; its parts
    are joined as rows. Other columns are not read, so their names cannot clash.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    cut = rows.select(
        "id", "text",
        *[F.split(text, p, -1).alias(n) for n, p in (("g_assign", ASSIGN), ("g_access", ACCESS), ("g_hex", HEX))],
    )
    # Nothing is complete without an identifier, so other texts need no search for candidates.
    identified = (F.size("g_access") > 1) | text.rlike(f"(?i){USER}")
    cut = cut.withColumn("g_weak", F.when(identified, F.split(text, WEAK, -1)))
    long_enough = F.transform(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE
    )
    spans = cut.select(
        "id", "text",
        F.array_sort(
            F.concat(
                _found(text, "g_assign", ASSIGN, 0, long_enough),
                _found(text, "g_access", ACCESS, 1),
                _found(text, "g_hex", HEX, 2),
            )
        ).alias("base"),
        _weak(text).alias("weak"),
    )
    open_text = (F.size("weak") > 0) & _holds(IDENTIFIERS) & _holds(SECRETS)
    # Only texts whose candidates have a chance need their scopes and a key.
    marked = spans.withColumn("open", open_text).withColumn("g_blank", F.when(F.col("open"), F.split(text, BLANK, -1)))
    found = stored(
        marked.select(
            "id", "base",
            F.when(F.col("open"), F.sha2(text, 256)).alias("key"),
            F.when(F.col("open"), F.col("weak")).alias("weak"),
            F.when(F.size("g_blank") > 1, _spans(_places(text, F.col("g_blank"), BLANK), len(KINDS))).alias("blanks"),
        ),
        "spans",
    )
    texts = found.where("key IS NOT NULL").select("key", "base", "weak", "blanks").dropDuplicates(["key"])
    complete = linked_parts(_scoped(texts), window)
    linked = complete.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("linked"))
    plain = found.where("key IS NULL").select("id", "base", _none().alias("linked"))
    joined = found.where("key IS NOT NULL").join(linked, "key", "left")
    return plain.union(
        joined.select("id", "base", F.coalesce("linked", _none()).alias("linked"))
    ).withColumnRenamed("id", id_col)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def span_digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``scan``: counts of the strong kinds, the SHA-256 of their list, and all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        id_col,
        *[count(i).alias(f"n_{k}") for i, k in enumerate(STRONG)],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "linked"))).alias("spans"),
    )
