"""Balanced label propagation: documents to shards of equal size with few cut links.

Documents with equal texts are linked. They start scattered: the documents of a group are dealt around
over all shards. In each round,
the documents of a group that lie in a smaller part move to the largest part of their
group. A shard admits as many as it has room for and as leave it in the same round, so
full shards exchange documents; groups that are whole, and parts that wait in vain, change places with movers that found no room. When nothing moves any more, documents without links fill up each shard, so that the counts
differ by one at most.

The state of a round is one row per group and shard that it touches, with a count: linked
documents of a group are alike, so a group of any size has at most as many rows as there
are shards, and no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.ranks import ranked, running_sums
from delaykit.llm.shared import stored

SHARDS = 24
# Turns in a row without a move, each with other ties, after which nothing moves any more.
QUIET_TURNS = 4


def _scattered(groups: DataFrame, shards: int) -> DataFrame:
    """The documents of all groups dealt around over the shards, so that a group starts in as many as it can.

    A lap gives every shard one document and begins at a shard of its own; the last one, which ends early,
    at shard 0. ``home`` is where a group's first document lies.
    """
    n_groups, n_linked = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("members"), F.lit(0))).first()
    dealt = running_sums(groups, [], ["g1", "g2"], F.col("members"), "ahead", n_groups)

    def lap(place):
        return F.floor(place / F.lit(shards))

    def shard(place):
        begin = F.when(lap(place) < n_linked // shards, F.xxhash64(lap(place))).otherwise(0)
        return F.pmod(F.pmod(begin, F.lit(shards)) + place, F.lit(shards)).cast("int")

    start, end = F.col("ahead"), F.col("ahead") + F.col("members")
    first, last = lap(start), lap(end - 1)
    single = F.lit(1).cast("long")
    # A group has one document in every shard for each lap between its first and its last.
    head = F.sequence(start, F.least(end, (first + 1) * shards) - 1)
    tail = F.when(last > first, F.sequence(last * shards, end - 1)).otherwise(F.array().cast("array<bigint>"))
    laps = F.greatest(last - first - 1, F.lit(0)).cast("long")
    all_shards = F.when(laps > 0, F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array().cast("array<int>"))
    pieces = F.concat(
        F.transform(F.concat(head, tail), lambda p: F.struct(shard(p).alias("shard"), single.alias("k"))),
        F.transform(all_shards, lambda s: F.struct(s.alias("shard"), laps.alias("k"))),
    )
    each = dealt.select("g1", "g2", "members", shard(start).alias("home"), F.inline(pieces))
    return each.groupBy("g1", "g2", "members", "home", "shard").agg(F.sum("k").alias("n"))


def flows(wanted: dict[tuple[int, int], int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the ``wanted`` moves between shards take place.

    Movers around a ring of shards exchange places, then those that are left fill the room,
    and the places they leave. No shard takes in more than its room and what leaves it.
    """
    left = {move: n for move, n in wanted.items() if n > 0}
    done: dict[tuple[int, int], int] = {}

    def take(move, k):
        done[move] = done.get(move, 0) + k
        left[move] -= k
        if not left[move]:
            del left[move]

    room, order, seen = dict(room), [], set()
    for start in room:
        path = [start] if start not in seen else []
        while path:
            onward = next((t for s, t in sorted(left) if s == path[-1] and t not in seen), None)
            if onward is None:
                # All targets of the shard come before it in the order.
                order.append(path.pop())
                seen.add(order[-1])
            elif onward in path:
                ring = path[path.index(onward) :]
                moves = list(zip(ring, [*ring[1:], onward], strict=True))
                k = min(left[m] for m in moves)
                for m in moves:
                    take(m, k)
                del path[path.index(onward) + 1 :]
            else:
                path.append(onward)
    for t in order:
        for move in sorted(m for m in left if m[1] == t):
            if (k := min(left[move], room[t])) > 0:
                take(move, k)
                room[t] -= k
                room[move[0]] += k
    return done


def _movers(
    parts: DataFrame, target: dict[int, int], open_shards: list[int], turn: int, shards: int
) -> DataFrame:
    """Parts that would move, with the ``target``: the largest part of their group in ``open_shards``.

    A part that fills its shard is no target. Ties go to the part
    farthest around from the group's home at first, so that all move the same way round and exchange
    places; later they are broken anew in every turn, so that movers that found no partner try another.
    """
    full = F.element_at(F.create_map(*[F.lit(x) for s in target for x in (s, target[s])]), F.col("shard"))
    by_group = Window.partitionBy("g1", "g2")
    around = F.pmod(F.col("shard") - F.col("home"), F.lit(shards)).cast("long")
    fair = around if turn == 0 else F.xxhash64("g1", "g2", "shard", F.lit(turn))
    size = F.struct(F.col("n"), fair, F.col("shard"))
    fits = (F.col("n") < full) & F.col("shard").isin(open_shards)
    aimed = parts.withColumn("best", F.max(F.when(fits, size)).over(by_group))
    aimed = aimed.withColumn("target", F.col("best.shard"))
    return aimed.where(F.col("target").isNotNull() & (size < F.col("best"))).drop("best")


def _admitted(queued: DataFrame, admits: dict[tuple[int, int], int]) -> DataFrame:
    """``queued`` with ``k``, how many of a mover's documents the places of its shard and target take."""
    pair = F.concat_ws(">", "shard", "target")
    places = F.create_map(*[F.lit(x) for (s, t), k in admits.items() for x in (f"{s}>{t}", k)])
    quota = F.coalesce(F.try_element_at(places, pair), F.lit(0)) if admits else F.lit(0)
    k = F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), quota - F.col("ahead")))
    return queued.withColumn("k", k)


def _makeway(
    parts: DataFrame, waiting: DataFrame, unmet: dict[tuple[int, int], int], turn: int, rows: int
) -> DataFrame:
    """Parts of full shards that change places with movers (``unmet``) from another shard, whole.

    Whole groups may go, and movers that wait in vain (``waiting``), for neither adds a part to a group. Each
    source of movers has a span of the shard's candidates, as long as its movers are many; those
    that lie within a span go to that source. Waiting movers of one half of the shards only go to the
    other half, so that none is taken twice in a round.
    """
    spans: dict[int, list[tuple[int, int, int]]] = {}
    for (source, target), n in sorted(unmet.items()):
        low = spans[target][-1][2] if target in spans else 0
        spans.setdefault(target, []).append((source, low, low + n))
    schema = "source int, target int, low long, high long"
    rows_of_spans = [(s, t, low, high) for t, each in spans.items() for s, low, high in each]
    wanted = parts.sparkSession.createDataFrame(rows_of_spans, schema)

    def half(shard):
        return F.pmod(F.xxhash64(shard, F.lit(turn)), F.lit(2))

    full = F.col("shard").isin(list(spans))
    candidates = parts.where((F.col("n") == F.col("members")) & full).unionByName(
        waiting.where((half("shard") == 1) & full).select(*parts.columns)
    )
    queued = running_sums(candidates, ["shard"], ["g1", "g2"], F.col("n"), "ahead", rows)
    queued = queued.withColumnRenamed("shard", "held_by")
    within = (
        (F.col("held_by") == F.col("target"))
        & (F.col("ahead") >= F.col("low"))
        & (F.col("ahead") + F.col("n") <= F.col("high"))
        & ((F.col("n") == F.col("members")) | (half("source") == 0))
    )
    # A part lies in one span at most; there is a span per pair of shards.
    gone = queued.join(F.broadcast(wanted), within)
    return stored(
        gone.select("g1", "g2", "members", "home", F.col("held_by").alias("shard"), F.col("source").alias("target"), "n"),
        "swaps",
    )


def _round(
    parts: DataFrame, queued: DataFrame, admits: dict[tuple[int, int], int], swaps: DataFrame | None
) -> DataFrame:
    """One round of moves; ``admits`` has the places for each shard and target, ``swaps`` parts that go whole.

    Movers queue by the hash of their group; the part at the end of the places is split.
    """
    taken = _admitted(queued, admits).withColumn("n", F.col("k")).where("n > 0").drop("ahead", "k")
    if swaps is not None:
        taken = taken.unionByName(swaps)
    group = ["g1", "g2", "members", "home"]
    change = taken.select(*group, "shard", (-F.col("n")).alias("n")).unionByName(
        taken.select(*group, F.col("target").alias("shard"), "n")
    )
    moved = parts.unionByName(change).groupBy(*group, "shard").agg(F.sum("n").alias("n"))
    return stored(moved.where("n > 0"), "parts")


def _held(parts: DataFrame, shards: int) -> tuple[dict[int, int], int]:
    """Linked documents per shard (one number for each), and rows."""
    rows = parts.groupBy("shard").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    held = dict.fromkeys(range(shards), 0) | {r["shard"]: r["n"] for r in rows}
    return held, sum(r["rows"] for r in rows)


def shard_documents(
    df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: shard counts differ by one at most. ``size`` is the UTF-8 bytes of
    the text plus 8; null texts have no bytes and are equal to each other. Slots number
    the rows of a shard from 0 without gaps. ``grown_shard`` is null under this law. Rows
    with null ids and repeated rows count like others. No rows give no rows.
    """
    rows = stored(
        df.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
            # Two hashes of different seeds: 128 bits stand for the text.
            F.xxhash64(text_col).alias("g1"),
            F.xxhash64(F.lit(1), F.coalesce(F.col(text_col), F.lit(""))).alias("g2"),
        ),
        "rows",
    )
    total = rows.count()
    groups = rows.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("members"))
    linked_groups = stored(groups.where("members > 1"), "groups")
    linked = stored(rows.join(linked_groups, ["g1", "g2"]), "linked")
    target = {s: total // shards + (s < total % shards) for s in range(shards)}

    parts = stored(_scattered(linked_groups, shards), "parts")
    held, n_parts = _held(parts, shards)
    # Every move makes the larger part of a group larger, so this ends.
    turn = quiet = 0
    closed: set[int] = set()
    while quiet < QUIET_TURNS:
        room = {s: target[s] - held[s] for s in target}
        # In odd turns only shards with room are targets, if there are any.
        spare = [s for s in target if room[s] > 0 or turn % 2 == 0 or not any(room.values())]
        movers = _movers(parts, target, [s for s in spare if s not in closed], turn, shards)
        queued = stored(running_sums(movers, ["shard", "target"], ["g1", "g2"], F.col("n"), "ahead", n_parts), "movers")
        found = queued.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        wanted = {(r["shard"], r["target"]): r["n"] for r in found}
        admits = flows(wanted, room)
        unmet = {move: n - admits.get(move, 0) for move, n in wanted.items() if n > admits.get(move, 0)}
        swaps = None
        if unmet:
            waiting = _admitted(queued, admits).where("k = 0")
            swaps = _makeway(parts, waiting, unmet, turn, n_parts)
            for r in swaps.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect():
                admits[r["target"], r["shard"]] = admits.get((r["target"], r["shard"]), 0) + r["n"]
        # A shard that took in nobody is no target for the time being: its movers try the next largest part.
        refused = {t for _, t in unmet} - {t for _, t in admits}
        if refused:
            closed |= refused
        elif not admits:
            closed, quiet = set(), quiet + 1
        if admits:
            quiet = 0
            parts = _round(parts, queued, admits, swaps)
            held, n_parts = _held(parts, shards)
        turn += 1

    # Which of a group's documents lie where is free: they follow their rank in the group.
    ends = Window.partitionBy("g1", "g2").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = parts.select("g1", "g2", "shard", "n", F.sum("n").over(ends).alias("end"))
    n_linked = sum(held.values())
    within = ranked(linked, ["g1", "g2"], ["id", "size"], "rank", n_linked).alias("d")
    placed = within.join(
        spans.alias("s"),
        (F.col("d.g1") == F.col("s.g1"))
        & (F.col("d.g2") == F.col("s.g2"))
        & (F.col("d.rank") < F.col("s.end"))
        & (F.col("d.rank") >= F.col("s.end") - F.col("s.n")),
    ).select("d.id", "d.size", "d.text_crc32", "s.shard")

    free = rows.join(linked_groups.select("g1", "g2"), ["g1", "g2"], "left_anti")
    filled, limits = 0, []
    for s in range(shards):
        filled += target[s] - held[s]
        limits.append(F.lit(filled).cast("long"))
    numbered = ranked(free, [], ["id", "g1", "g2"], "rank", total)
    shard = F.size(F.filter(F.array(*limits), lambda end: end <= F.col("rank"))).cast("int")
    singles = numbered.select("id", "size", "text_crc32", shard.alias("shard"))

    both = stored(placed.unionByName(singles), "placed")
    slots = ranked(both, ["shard"], ["id", "text_crc32", "size"], "slot", total)
    return slots.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
