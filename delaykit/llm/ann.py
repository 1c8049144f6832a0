"""Approximate nearest neighbours with one navigable small-world graph per shard.

A shard is a bounded number of vectors. Its graph has layers: every node is in the lowest,
and each layer above holds a share of the one below. All neighbours of a layer lie in one
flat array, a fixed number of places per node. A query descends from the top, then keeps
the best nodes found in the lowest layer. Blocks of queries meet every shard, and the
results of the shards are merged. Many queries walk a graph at once, so that a step is a
few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.shared import stored

SHARD_ROWS, QUERY_BLOCK = 4_096, 512
LINKS, BREADTH_BUILD, BREADTH_SEARCH = 16, 48, 96
BATCH = 256


class Graph(NamedTuple):
    vectors: np.ndarray  # unit length, float32, a row per node
    layers: list[tuple[np.ndarray, np.ndarray]]  # nodes of a layer, and their neighbours by node
    entry: int


def _walk(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, breadth: int, step: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``breadth`` nearest nodes met, nearest first, and their cosines.

    ``start`` holds nodes for each query, -1 where fewer. Every round opens the ``step``
    best nodes not yet opened of each query that has any.
    """
    n_queries, n = len(queries), len(vectors)
    seen = np.zeros((n_queries, n + 1), dtype=bool)
    seen[:, n] = True  # stands for no neighbour
    row = np.arange(n_queries)[:, None]
    start = np.where(start < 0, n, start)
    near = np.where(
        start < n, np.einsum("qd,qkd->qk", queries, vectors[np.minimum(start, n - 1)]), np.float32(-9)
    )
    seen[row, start] = True
    size = max(breadth, start.shape[1])
    nodes = np.full((n_queries, size), n, dtype=np.int64)
    close = np.full((n_queries, size), -9, dtype=np.float32)
    opened = np.ones((n_queries, size), dtype=bool)
    nodes[:, : start.shape[1]], close[:, : start.shape[1]] = start, near
    opened[:, : start.shape[1]] = start == n
    active = np.arange(n_queries)
    while len(active):
        waiting = np.where(opened[active], np.float32(-9), close[active])
        pick = np.argpartition(-waiting, min(step, size) - 1, axis=1)[:, :step]
        ready = np.take_along_axis(waiting, pick, 1) > -9
        busy = ready.any(axis=1)
        active, pick, ready = active[busy], pick[busy], ready[busy]
        if not len(active):
            break
        at = active[:, None]
        opened[at, pick] = True
        chosen = np.where(ready, nodes[at, pick], n)
        found = np.where(chosen[:, :, None] < n, links[np.minimum(chosen, n - 1)], n).reshape(len(active), -1)
        found = np.where(found < 0, n, found)
        found.sort(axis=1)
        fresh = ~seen[at, found]
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        seen[at, found] = True
        found = np.where(fresh, found, n)
        # Only new nodes are compared: their places are few after the first rounds.
        reached = np.full(found.shape, -9, dtype=np.float32)
        q, k = np.nonzero(fresh)
        reached[q, k] = np.einsum("nd,nd->n", queries[active[q]], vectors[found[q, k]])
        all_close = np.concatenate([close[active], reached], axis=1)
        best = np.argpartition(-all_close, size - 1, axis=1)[:, :size]
        close[active] = np.take_along_axis(all_close, best, 1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], found], axis=1), best, 1)
        opened[active] = np.take_along_axis(np.concatenate([opened[active], ~fresh], axis=1), best, 1)
    order = np.argsort(-close, axis=1, kind="stable")[:, :breadth]
    nodes = np.take_along_axis(nodes, order, 1)
    return np.where(nodes == n, -1, nodes), np.take_along_axis(close, order, 1)


def _spread(vectors: np.ndarray, node: int, near: np.ndarray, limit: int) -> np.ndarray:
    """Of nodes in order of nearness, those nearer to ``node`` than to any chosen before.

    Links then lead in different directions; left-over places go to the nearest rest.
    """
    if len(near) <= limit:
        return near
    to_node = vectors[near] @ vectors[node]
    among = vectors[near] @ vectors[near].T
    chosen: list[int] = []
    for i in range(len(near)):
        if len(chosen) == limit:
            break
        if not chosen or among[i, chosen].max() < to_node[i]:
            chosen.append(i)
    if len(chosen) < limit:
        rest = [i for i in range(len(near)) if i not in set(chosen)]
        chosen += rest[: limit - len(chosen)]
    return near[chosen]


def build_graph(vectors: np.ndarray, links: int = LINKS, breadth: int = BREADTH_BUILD, seed: int = 3) -> Graph:
    """Inserts the nodes in batches that double up to ``BATCH``.

    The nodes of a batch look for neighbours in the graph so far and among each other, then
    link both ways; a node with too many links keeps a spread choice. A node's top layer
    is drawn with a share of 1 / ``links`` per layer.
    """
    n = len(vectors)
    random = np.random.default_rng(seed)
    tops = np.floor(-np.log(1 - random.random(n)) / np.log(links)).astype(int)
    layers = []
    for level in range(tops.max(initial=0) + 1):
        nodes = np.flatnonzero(tops >= level)
        layers.append((nodes, _layer(vectors, nodes, 2 * links if level == 0 else links, breadth)))
    return Graph(vectors, layers, int(layers[-1][0][0]) if n else -1)


def _layer(vectors: np.ndarray, nodes: np.ndarray, limit: int, breadth: int) -> np.ndarray:
    """Neighbours of every node of a layer, -1 where fewer; rows of other nodes stay empty."""
    n = len(vectors)
    table = np.full((n, limit), -1, dtype=np.int32)
    done = 0
    while done < len(nodes):
        batch = nodes[done : done + max(1, min(BATCH, done))]
        inside = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(inside, -9)
        peers = np.argsort(-inside, axis=1, kind="stable")[:, : min(limit, len(batch) - 1)]
        if done:
            # A few spread nodes to start from serve as the layers above do in a search.
            start = nodes[np.linspace(0, done - 1, min(8, done)).astype(int)]
            found, _ = _walk(vectors, table, vectors[batch], np.tile(start, (len(batch), 1)), breadth)
        else:
            found = np.zeros((len(batch), 0), dtype=np.int64)
        back: dict[int, list[int]] = {}
        for i, node in enumerate(batch):
            near = np.concatenate([found[i][found[i] >= 0], batch[peers[i]]])
            near = near[np.argsort(-(vectors[near] @ vectors[node]), kind="stable")]
            own = _spread(vectors, node, near, limit // 2)
            back.setdefault(int(node), []).extend(own.tolist())
            for other in own.tolist():
                back.setdefault(other, []).append(int(node))
        for node, new in back.items():
            old = table[node][table[node] >= 0]
            every = np.unique(np.concatenate([old, np.array(new, dtype=np.int64)]))
            every = every[np.argsort(-(vectors[every] @ vectors[node]), kind="stable")]
            kept = _spread(vectors, node, every, limit)
            table[node] = -1
            table[node, : len(kept)] = kept
        done += len(batch)
    return table


def search_graph(graph: Graph, queries: np.ndarray, breadth: int = BREADTH_SEARCH) -> tuple[np.ndarray, np.ndarray]:
    """The nodes met nearest to each query and their cosines; see ``_walk``."""
    if not len(graph.vectors):
        return np.zeros((len(queries), 0), dtype=np.int64), np.zeros((len(queries), 0), dtype=np.float32)
    at = np.full((len(queries), 1), graph.entry, dtype=np.int64)
    for _, links in reversed(graph.layers[1:]):
        at = _walk(graph.vectors, links, queries, at, 4, step=1)[0]
    return _walk(graph.vectors, graph.layers[0][1], queries, at, breadth)


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def usable(vector: Column) -> Column:
    """Not null, with a component other than zero, and all of them finite."""
    number = vector.cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(number, lambda x: x != 0)


INDEX = "shard int, dim int, n int, row_ids binary, vectors binary, layers array<struct<nodes: binary, links: binary>>"


def build_index(distinct: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per shard and dimension one row with the graph as flat arrays.

    ``distinct`` has ``row_id`` and ``vector`` (no two alike). A shard is the vectors of one
    hash, about ``shard_rows`` of them, so its memory does not grow with the data.
    """
    shards = max(1, -(-distinct.count() // shard_rows))
    dealt = distinct.select("row_id", "vector", F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int").alias("shard"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        pdf = pdf.sort_values("row_id", kind="stable")
        lengths = pdf["vector"].map(len)
        for dim, own in pdf.groupby(lengths):
            vectors = np.stack(own["vector"].to_list()).astype(np.float64)
            graph = build_graph(_unit(vectors))
            layers = [
                {"nodes": nodes.astype("<i4").tobytes(), "links": links[nodes].astype("<i4").tobytes()}
                for nodes, links in graph.layers
            ]
            ids = own["row_id"].to_numpy(dtype="<i8")
            out.append((pdf["shard"].iloc[0], dim, len(ids), ids.tobytes(), vectors.astype("<f8").tobytes(), layers))
        return pd.DataFrame(out, columns=["shard", "dim", "n", "row_ids", "vectors", "layers"])

    return stored(dealt.groupBy("shard").applyInPandas(build, INDEX), "index")


def _opened(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row.vectors, "<f8").reshape(row.n, row.dim)
    layers = []
    for layer in row.layers:
        nodes = np.frombuffer(layer["nodes"], "<i4")
        table = np.full((row.n, len(layer["links"]) // 4 // max(len(nodes), 1)), -1, dtype=np.int32)
        table[nodes] = np.frombuffer(layer["links"], "<i4").reshape(len(nodes), -1)
        layers.append((nodes, table))
    return Graph(_unit(vectors), layers, int(layers[-1][0][0])), vectors, np.frombuffer(row.row_ids, "<i8")


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """For each row of ``queries`` its ``k`` nearest rows of ``df`` but itself.

    Columns: ``query_id``, ``rank`` from 1, the id, ``score`` (cosine of the original
    vectors in double precision), nearest first, ties to smaller ids. Vectors that are null
    or zero or hold null or non-finite components, and rows with null ids, take part on
    neither side; vectors of other lengths than the query's are no candidates. Equal vectors
    are one node of a graph and are told apart again by the merge, which needs the k + 1
    smallest ids of each only. A repeated id with one vector is one row. Every row is
    indexed.
    """
    rows = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    same = Window.partitionBy("hash", "vector").orderBy("id")
    rows = rows.withColumn("hash", F.xxhash64("vector")).distinct()
    # Spark keeps the first k + 1 of each vector before the shuffle, however many there are.
    members = stored(rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1), "members")
    distinct = members.where("place = 1").select(F.col("id").alias("row_id"), "vector")
    alike = members.select("id", "hash", "vector")
    index = build_index(distinct, shard_rows)
    own = members.where("place = 1").select(F.col("id").alias("row_id"), "hash", "vector")
    groups = alike.join(own, ["hash", "vector"]).select("row_id", "id")

    asked = queries.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    asked = stored(asked.dropDuplicates(["query_id", "vector"]), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = (
        asked.withColumn("dim", F.size("vector"))
        .groupBy("dim", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("query_id", "vector")).alias("asked"))
    )
    keep = k + 1

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                graph, vectors, ids = _opened(row)
                query_ids = np.array([a["query_id"] for a in row.asked], dtype=np.int64)
                wide = np.stack([np.asarray(a["vector"], dtype=np.float64) for a in row.asked])
                nodes, _ = search_graph(graph, _unit(wide))
                # The walk ranks in single precision; the score and the choice are exact.
                q, place = np.nonzero(nodes >= 0)
                node = nodes[q, place]
                dots = np.einsum("nd,nd->n", wide[q], vectors[node])
                score = dots / (np.linalg.norm(wide, axis=1)[q] * np.linalg.norm(vectors, axis=1)[node])
                order = np.lexsort((ids[node], -score, q))
                q, node, score = q[order], node[order], score[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
                best = rank < keep
                yield pd.DataFrame({"query_id": query_ids[q[best]], "row_id": ids[node[best]], "score": score[best]})

    # The stated queries meet all rows in blocks: an equal join of shards and blocks by size.
    pairs = index.join(packed, "dim").repartition("shard", "block")
    found = pairs.mapInPandas(search, "query_id long, row_id long, score double")
    # A vector's copies follow its first one; of k + 1 vectors, k copies besides the query do.
    rivals = found.join(groups, "row_id").where("id != query_id")
    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    merged = rivals.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
