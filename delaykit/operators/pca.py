"""Principal components and what they say about the features.

The pass over the data sums up moments and products of the columns, or for the wide
encoded matrix those products that are not zero. Everything
after it works on loadings, one row per feature and component: their number
depends on the columns of the table, never on its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import moments
from delaykit.operators.features import scaled
from delaykit.operators.lookups import settled
from delaykit.operators.selection import top_per_key

TOP_COMPONENTS = 5
LEVELS = (90, 95, 99)
# Entries multiplied at a time, and the widest space searched, in blocks of directions.
BLOCK_ENTRIES, WIDEST = 1 << 18, 6
# Rows of up to so many entries have these paired; sums of products that a task keeps.
PAIRED_ENTRIES, HELD_PRODUCTS = 512, 1 << 20
# Groups that the tasks' moments are merged in before they reach the driver.
MERGED = 64
# Below this a row of loadings is rounding noise, not a direction.
NOISE = 1e-20


class Components(NamedTuple):
    features: list[str]
    matrix: np.ndarray  # a column for each component, signs as in the loadings
    scale: dict[str, tuple[float, float]]
    loadings: DataFrame
    variance: DataFrame


class _Moments(NamedTuple):
    """Of each column over the values it has, and of all columns over the rows that have them all."""

    known: np.ndarray
    means: np.ndarray
    squares: np.ndarray  # of the differences from the mean
    rows: np.ndarray  # one number
    centre: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> _Moments:
        there = ~np.isnan(x)
        known = there.sum(axis=0).astype(np.float64)
        means = np.where(there, x, 0.0).sum(axis=0) / np.maximum(known, 1)
        squares = np.where(there, x - means, 0.0)
        whole = x[there.all(axis=1)]
        centre = whole.mean(axis=0) if len(whole) else np.zeros(x.shape[1])
        off = whole - centre
        return cls(known, means, (squares * squares).sum(axis=0), np.array([float(len(whole))]), centre, off.T @ off)

    def merged(self, other: _Moments) -> _Moments:
        known, rows = self.known + other.known, self.rows + other.rows
        gap, apart = other.means - self.means, other.centre - self.centre
        share = other.known / np.maximum(known, 1)
        part = other.rows / np.maximum(rows, 1)
        return _Moments(
            known, self.means + gap * share, self.squares + other.squares + gap * gap * self.known * share,
            rows, self.centre + apart * part, self.products + other.products + np.outer(apart, apart) * self.rows * part,
        )

    def packed(self) -> bytes:
        return np.concatenate([x.ravel() for x in self]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, columns: int) -> _Moments:
        at = np.cumsum([columns, columns, columns, 1, columns])
        parts = np.split(np.frombuffer(data), at)
        return cls(*parts[:5], parts[5].reshape(columns, columns))


def _moments(df: DataFrame, features: Sequence[str]) -> _Moments:
    """One pass over the rows; the driver merges ``MERGED`` results, whatever the number of tasks."""
    columns = len(features)
    nothing = _Moments.of(np.zeros((0, columns)))
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = nothing
        for frame in frames:
            found = found.merged(_Moments.of(frame.to_numpy(dtype=np.float64, na_value=np.nan)))
        if found.known.any():
            yield pd.DataFrame({"state": [found.packed()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        found = nothing
        for state in group["state"]:
            found = found.merged(_Moments.unpacked(state, columns))
        return pd.DataFrame({"state": [found.packed()]})

    parts = numbers.mapInPandas(sums, "state binary").withColumn("_part", F.spark_partition_id() % MERGED)
    found = nothing
    for row in parts.groupBy("_part").applyInPandas(merge, "state binary").collect():
        found = found.merged(_Moments.unpacked(row["state"], columns))
    return found


def pca_fit(df: DataFrame, features: Sequence[str], k: int | None = None) -> Components:
    """Components of the standardised features; the largest loading of each is positive.

    Rows without one of the features are left out, but count for the scale of the others.
    The rows are read once.
    """
    features = list(features)
    found = _moments(df, features)
    if not found.rows[0]:
        raise ValueError("no row has all of the features")
    scale = {
        f: (float(found.means[i]), float(np.sqrt(found.squares[i] / found.known[i]))) for i, f in enumerate(features)
    }
    # As ``scaled``: noise around a constant column is not variation.
    sd = np.array([s if s > 1e-12 * max(1.0, abs(m)) else 1.0 for m, s in scale.values()])
    values, matrix = np.linalg.eigh(found.products / np.outer(sd, sd))
    count = min(k or len(features), len(features))
    values, matrix = np.maximum(values[::-1], 0.0), matrix[:, ::-1][:, :count]
    ratios = values[:count] / (values.sum() or 1.0)
    matrix = matrix * np.where(matrix[np.abs(matrix).argmax(axis=0), np.arange(count)] >= 0, 1.0, -1.0)
    spark = df.sparkSession
    loadings = spark.createDataFrame(
        [(f, i, pc + 1, float(matrix[i, pc])) for i, f in enumerate(features) for pc in range(count)],
        "feature string, position int, pc int, loading double",
    )
    variance = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(ratios)], "pc int, ratio double")
    return Components(features, matrix, scale, loadings, variance)


def _total(terms: list[Column]) -> Column:
    """Their sum, added in pairs, so that many columns make no deep expression."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def pca_scores(df: DataFrame, components: Components, n: int = TOP_COMPONENTS) -> DataFrame:
    """The rows with PC1..n, their coordinates on the first components."""
    names = [f"_z{i}" for i in range(len(components.features))]
    ready = df.select(
        "*",
        *[scaled(F.col(f"`{c}`").cast("double"), *components.scale[c]).alias(z) for z, c in zip(names, components.features)],
    ).na.drop(subset=names)
    n = min(n, components.matrix.shape[1])
    return ready.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[_total([F.col(z) * F.lit(float(v)) for z, v in zip(names, components.matrix[:, i])]).alias(f"PC{i + 1}") for i in range(n)],
    )


def pca_report(encoded: DataFrame, k: int = 10, features: str = "features") -> DataFrame:
    """Ratios and their total for the encoded training matrix; see ``leading_variances``."""
    leading, total = leading_variances(encoded, k, features)
    rows = [(i + 1, float(v) / total if total > 0 else None) for i, v in enumerate(leading)]
    table = encoded.sparkSession.createDataFrame(rows, "pc int, ratio double")
    return table.withColumn("n_components", F.lit(len(rows))).withColumn(
        "total_explained", F.sum("ratio").over(W.partitionBy())
    )


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of vectors, and the row, position and value of each of their entries."""
    for frame in frames:
        values = [np.asarray(v, dtype=np.float64) for v in frame["values"]]
        places = [np.arange(len(v)) if i is None else i for i, v in zip(frame["indices"], values)]
        lengths = np.array([len(v) for v in values], dtype=np.int64)
        # Entries of whole rows, about ``BLOCK_ENTRIES`` at a time.
        block = np.cumsum(lengths) // BLOCK_ENTRIES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(values)]
        for start, end in pairwise(cuts):
            if start < end:
                row = np.repeat(np.arange(end - start), lengths[start:end])
                at = np.concatenate(places[start:end]).astype(np.int64)
                yield end - start, row, at, np.concatenate(values[start:end])


def _summed(entries: DataFrame, width: int, columns: int, add) -> np.ndarray:
    """``add`` fills a matrix of ``width`` rows from each task's blocks; tasks are summed by Spark.

    What reaches the driver is the sum: ``width`` times ``columns`` numbers, whatever the rows.
    """
    names = [f"c{i}" for i in range(columns)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros((width, columns))
        for block in _blocks(frames):
            add(out, *block)
        used = np.flatnonzero(out.any(axis=1))
        yield pd.DataFrame(out[used], columns=names).assign(place=used)

    return _added_up(entries.mapInPandas(partial, _place_schema(names)), names, width)


def _place_schema(names: list[str]) -> str:
    return ", ".join([*[f"{n} double" for n in names], "place long"])


def _added_up(parts: DataFrame, names: list[str], width: int) -> np.ndarray:
    sums = parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros((width, len(names)))
    out[sums["place"].to_numpy(dtype=np.int64)] = sums[names].to_numpy(dtype=np.float64)
    return out


class _Square(NamedTuple):
    """The centred rows' square matrix, known by its products with thin matrices."""

    width: int
    total: float  # of all variances, times the rows
    image: Callable[[np.ndarray], np.ndarray]


def _square_of_rows(entries: DataFrame) -> _Square | None:
    """Each product reads all rows; for rows with too many entries to pair."""
    entries = settled(entries)
    n, width = entries.agg(F.count(F.lit(1)), F.max("width")).first()
    entries = entries.drop("width")
    if not n:
        return None

    def powers(out, rows, row, at, value):
        out[:, 0] += np.bincount(at, value, minlength=width)
        out[:, 1] += np.bincount(at, value * value, minlength=width)

    sums = _summed(entries, width, 2, powers)
    mean = sums[:, 0] / n
    total = float((sums[:, 1] - n * mean * mean).sum())

    def image(block: np.ndarray) -> np.ndarray:
        sent = entries.sparkSession.sparkContext.broadcast((block, mean @ block))

        def multiply(out, rows, row, at, value):
            thin, shift = sent.value
            for j in range(thin.shape[1]):
                seen = np.bincount(row, value * thin[at, j], minlength=rows) - shift[j]
                out[:, j] += np.bincount(at, value * seen[row], minlength=width)

        found = _summed(entries, width, block.shape[1], multiply)
        sent.destroy()
        return found

    return _Square(width, total, image)


def _added(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, places = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(places, np.concatenate(sums), minlength=len(every))


def _paired(rows: int, row: np.ndarray, at: np.ndarray, value: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums over the rows of the products of two entries, by ``first << 32 | second``, first <= second.

    A column of ones stands before the others, as number 0. Columns that a quarter of the rows
    have are multiplied as a matrix, the others entry by entry.
    """
    counts = np.bincount(at)
    used = np.flatnonzero(counts)
    number = np.zeros(len(counts), dtype=np.int64)
    number[used] = np.arange(len(used))
    at = number[at]
    often = counts[used] * 4 >= rows
    slot = np.cumsum(often)
    dense = np.zeros((rows, 1 + int(often.sum())))
    dense[:, 0] = 1.0
    here = often[at]
    dense[row[here], slot[at[here]]] = value[here]
    names = np.concatenate([[0], used[often] + 1])
    i, j = np.triu_indices(len(names))
    keys, sums = [names[i] << 32 | names[j]], [(dense.T @ dense)[i, j]]
    seldom = used[~often] + 1
    if len(seldom):
        row, value = row[~here], value[~here]
        at = (np.cumsum(~often) - 1)[at[~here]]
        for name, column in zip(names, dense.T):
            keys.append(np.minimum(name, seldom) << 32 | np.maximum(name, seldom))
            sums.append(np.bincount(at, value * column[row], minlength=len(seldom)))
        size = len(seldom)
        codes, products = [at * size + at], [value * value]
        for step in range(1, int(np.bincount(row).max())):
            near = np.flatnonzero(row[:-step] == row[step:])
            codes.append(at[near] * size + at[near + step])
            products.append(value[near] * value[near + step])
        if size * size <= BLOCK_ENTRIES * 4:
            code, product = np.concatenate(codes), np.concatenate(products)
            codes = np.flatnonzero(np.bincount(code, minlength=size * size))
            products = np.bincount(code, product, minlength=size * size)[codes]
        else:
            codes, products = _added(codes, products)
        keys.append(seldom[codes // size] << 32 | seldom[codes % size])
        sums.append(products)
    return keys, sums


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task, handed on when there are ``HELD_PRODUCTS`` of them."""
    keys, sums, held, width = [], [], 0, 0

    def handed() -> pa.RecordBatch:
        columns = [keys[0] >> 32, keys[0] & 0xFFFFFFFF, sums[0], np.full(len(keys[0]), width)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "v", "width"])

    for batch in batches:
        if not batch.num_rows:
            continue
        width = max(width, pc.max(batch.column("width")).as_py())
        values, indices = batch.column("values"), batch.column("indices")
        lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        value = values.flatten().to_numpy(zero_copy_only=False)
        # A dense vector has no indices.
        at = np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at[indices.is_valid().to_numpy(zero_copy_only=False)[row]] = indices.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        block = ends // BLOCK_ENTRIES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(lengths)]
        for start, end in pairwise(cuts):
            own = slice(int(ends[start - 1]) if start else 0, int(ends[end - 1]))
            more_keys, more_sums = _paired(end - start, row[own] - start, at[own], value[own])
            keys, sums, held = keys + more_keys, sums + more_sums, held + sum(map(len, more_keys))
            if held > HELD_PRODUCTS:
                keys, sums = ([x] for x in _added(keys, sums))
                held = len(keys[0])
                if held > HELD_PRODUCTS // 2:
                    yield handed()
                    keys, sums, held = [], [], 0
    if keys:
        keys, sums = ([x] for x in _added(keys, sums))
        yield handed()


def _square_of_products(entries: DataFrame) -> _Square | None:
    """The rows are read once; what is kept has a row for each two columns that a row has both of."""
    parts = entries.mapInArrow(_products, "i long, j long, v double, width long")
    pairs = settled(parts.groupBy("i", "j").agg(F.sum("v").alias("v"), F.max("width").alias("width")))
    ones = pairs.where("i = 0").toPandas()
    if not len(ones):
        return None
    width = int(ones["width"].max())
    sums = np.zeros(width + 1)
    sums[ones["j"].to_numpy()] = ones["v"].to_numpy()
    n, mean = sums[0], sums[1:] / sums[0]
    pairs = pairs.where("i > 0").select((F.col("i") - 1).alias("i"), (F.col("j") - 1).alias("j"), "v")
    squares = pairs.where("i = j").agg(F.sum("v")).first()[0] or 0.0

    def image(block: np.ndarray) -> np.ndarray:
        columns = block.shape[1]
        names = [f"c{i}" for i in range(columns)]
        sent = entries.sparkSession.sparkContext.broadcast(block)

        def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros((width, columns))
            for frame in frames:
                i, j, v = (frame[c].to_numpy() for c in "ijv")
                twice = i != j
                into, other, times = np.concatenate([i, j[twice]]), np.concatenate([j, i[twice]]), np.concatenate([v, v[twice]])
                for c in range(columns):
                    out[:, c] += np.bincount(into, times * sent.value[other, c], minlength=width)
            used = np.flatnonzero(out.any(axis=1))
            yield pd.DataFrame(out[used], columns=names).assign(place=used)

        found = _added_up(pairs.mapInPandas(multiply, _place_schema(names)), names, width)
        sent.destroy()
        return found - n * np.outer(mean, mean @ block)

    return _Square(width, float(squares - n * (mean * mean).sum()), image)


def leading_variances(
    encoded: DataFrame, k: int = 10, features: str = "features", tolerance: float = 1e-7, passes: int = 100
) -> tuple[np.ndarray, float]:
    """The ``k`` largest variances of the principal components, and the sum of all.

    Block iteration from a random start: a pass multiplies the centred rows' square matrix by a thin
    matrix, and the next block is what the best directions so far leave over. Of the square
    matrix only what is not zero before centring is made, by one pass over the rows, and it stays
    with the tasks; where the first row has more than ``PAIRED_ENTRIES`` entries, nothing of it is made and
    each pass reads the rows. The number of columns may be large; a thin
    matrix is broadcast in each pass, ``columns * (k + 8)`` numbers. Rows without a vector are
    left out; fewer columns than ``k`` give as many variances; no rows give none.
    """
    vector = F.unwrap_udt(features)
    entries = encoded.where(F.col(features).isNotNull()).select(
        F.coalesce(vector["size"], F.size(vector["values"])).alias("width"), vector["indices"].alias("indices"),
        vector["values"].alias("values"),
    )
    first = entries.select(F.size("values")).first()
    if first is None:
        return np.zeros(0), 0.0
    square = (_square_of_products if first[0] <= PAIRED_ENTRIES else _square_of_rows)(entries)
    if square is None:
        return np.zeros(0), 0.0
    width, total, image = square
    k = min(k, width)
    block_width = min(k + 8, width)

    block = np.linalg.qr(np.random.default_rng(0).normal(size=(width, block_width)))[0]
    basis = images = np.zeros((width, 0))
    for _ in range(passes):
        basis, images = np.hstack([basis, block]), np.hstack([images, image(block)])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:block_width], turn[:, ::-1][:, :block_width]
        best, moved = basis @ turn, images @ turn
        left = moved - best * values
        if np.linalg.norm(left[:, :k], axis=0).max() <= tolerance * max(values[0], 0.0):
            break
        if basis.shape[1] + block_width > WIDEST * block_width:
            basis, images = best, moved
        for _ in range(2):
            left -= basis @ (basis.T @ left)
        block, size, _ = np.linalg.svd(left, full_matrices=False)
        block = block[:, size > 1e-13 * values[0]]
        if not block.shape[1]:
            break
        block -= basis @ (basis.T @ block)
        block = np.linalg.qr(block)[0]
    else:
        raise RuntimeError(f"the components have not settled after {passes} passes")
    return np.maximum(values[:k], 0.0), total


def explained_variance(variance: DataFrame) -> DataFrame:
    """Ratio, cumulative share and whether each level is reached, per component."""
    # One row per component.
    cumulative = variance.withColumn("cumulative", F.sum("ratio").over(W.orderBy("pc")))
    return cumulative.withColumns(
        {f"reaches_{p}": F.round("cumulative", 12) >= p / 100 for p in LEVELS}
    )


def components_needed(variance: DataFrame) -> DataFrame:
    """Fewest components for each level; 1 when the level is never reached."""
    reached = explained_variance(variance)
    return reached.agg(
        *[
            F.coalesce(F.min(F.when(F.col(f"reaches_{p}"), F.col("pc"))), F.lit(1)).alias(f"n_{p}pct")
            for p in LEVELS
        ]
    )


def scree_table(variance: DataFrame, n: int = 20) -> DataFrame:
    return explained_variance(variance).orderBy("pc").limit(n).drop("reaches_99")


def _top(loadings: DataFrame, n_pcs: int = TOP_COMPONENTS) -> DataFrame:
    return loadings.filter(F.col("pc") <= n_pcs)


def high_influence_features(loadings: DataFrame, n: int = 10, n_pcs: int = TOP_COMPONENTS) -> DataFrame:
    """Largest loadings of each of the first components, ranked."""
    strong = _top(loadings, n_pcs).withColumn("abs_loading", F.abs("loading"))
    order = [F.desc("abs_loading"), F.asc("position")]
    ranked = top_per_key(strong, ["pc"], order, n)
    return ranked.withColumn("rank", F.row_number().over(W.partitionBy("pc").orderBy(*order)))


def feature_importance_matrix(loadings: DataFrame, n_pcs: int = TOP_COMPONENTS) -> DataFrame:
    """Sum of absolute loadings over the first components."""
    return (
        _top(loadings, n_pcs)
        .groupBy("feature", "position")
        .agg(F.sum(F.abs("loading")).alias("overall_importance"))
        .orderBy(F.desc("overall_importance"), "position")
    )


def loading_correlation(loadings: DataFrame, n_pcs: int = TOP_COMPONENTS) -> DataFrame:
    """Correlation of features by their loadings on the first components.

    Pairs of features, so columns squared; rows of loadings that are noise give
    null.
    """
    left = _top(loadings, n_pcs).select("pc", F.col("feature").alias("x"), F.col("position").alias("px"), F.col("loading").alias("lx"))
    right = _top(loadings, n_pcs).select("pc", F.col("feature").alias("y"), F.col("position").alias("py"), F.col("loading").alias("ly"))
    steady = (F.var_samp("lx") > NOISE) & (F.var_samp("ly") > NOISE)
    return (
        left.join(right, "pc")
        .groupBy("x", "px", "y", "py")
        .agg(F.when(steady, moments.correlation(F.col("lx"), F.col("ly"))).alias("corr"))
    )


def _classes() -> list[tuple[str, Column]]:
    name = F.lower("feature")
    return [
        ("delay", name.contains("delay")),
        ("temporal", F.col("feature").isin(*K.TIME_FEATURES)),
        ("airport", name.contains("origin") | name.contains("dest")),
        ("carrier", name.contains("carrier") | name.contains("airline")),
    ]


def feature_clusters(loadings: DataFrame, n: int = 5, at_least: int = 2) -> DataFrame:
    """Name classes that hold at least two of a component's top features."""
    top = high_influence_features(loadings, n)
    classed = top.withColumn(
        "class",
        F.explode(F.array_compact(F.array(*[F.when(test, c) for c, test in _classes()]))),
    )
    members = F.sort_array(F.collect_list(F.struct("rank", "feature", "loading")))
    return (
        classed.groupBy("pc", "class")
        .agg(F.count(F.lit(1)).alias("size"), members.alias("_m"))
        .filter(F.col("size") >= at_least)
        .select(
            "pc", "class", "size",
            F.transform("_m", lambda m: m["feature"]).alias("features"),
            F.transform("_m", lambda m: m["loading"]).alias("loadings"),
        )
    )


def cluster_counts(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("class", "pc").agg(F.sum("size").alias("n_features"))


def loading_heatmap_table(loadings: DataFrame, n_features: int = 30, n_pcs: int = 10) -> DataFrame:
    """Most important features against the first components, one column each."""
    top = feature_importance_matrix(loadings).limit(n_features).select("feature", "overall_importance")
    wide = (
        _top(loadings, n_pcs)
        .join(top, "feature", "left_semi")
        .groupBy("feature")
        .pivot("pc", list(range(1, n_pcs + 1)))
        .agg(F.first("loading"))
    )
    return wide.withColumnsRenamed({str(i): f"PC{i}" for i in range(1, n_pcs + 1)}).join(top, "feature")


def component_loadings(loadings: DataFrame, n: int = 15, n_pcs: int = 3) -> DataFrame:
    return high_influence_features(loadings, n, n_pcs).select("pc", "rank", "feature", "loading")


def biplot_points(scores: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """Up to n sampled coordinates on the first two components."""
    return scores.select("PC1", "PC2").orderBy(F.rand(seed)).limit(n)


def biplot_arrows(loadings: DataFrame, n: int = 10) -> DataFrame:
    length = F.sqrt(F.sum(F.col("loading") * F.col("loading")))
    pick = lambda pc: F.sum(F.when(F.col("pc") == pc, F.col("loading")))
    return (
        _top(loadings, 2)
        .groupBy("feature", "position")
        .agg(pick(1).alias("PC1"), pick(2).alias("PC2"), length.alias("length"))
        .orderBy(F.desc("length"), "position")
        .limit(n)
    )


def correlated_subset(correlation: DataFrame, n: int = 20) -> DataFrame:
    """Features whose correlations vary most, and the matrix among them."""
    top = (
        correlation.groupBy(F.col("y").alias("f"), F.col("py").alias("pf"))
        .agg(F.var_samp("corr").alias("spread"))
        .filter(F.col("spread").isNotNull())
        .orderBy(F.desc("spread"), "pf")
        .limit(n)
        .select("f")
    )
    return (
        correlation.join(top.withColumnRenamed("f", "x"), "x", "left_semi")
        .join(top.withColumnRenamed("f", "y"), "y", "left_semi")
        .select("x", "y", "corr")
    )
