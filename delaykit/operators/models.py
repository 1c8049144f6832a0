"""Training, evaluation and comparison of delay models: Spark ML's linear one, and trees.

Trees are those of ``operators.trees``; every learner reads all training rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import labels
from delaykit.operators.features import preprocessor_stages
from delaykit.operators.lookups import lookup_join, settled
from delaykit.operators.splitting import hash_fold
from delaykit.operators.trees import Blocks, Rules, TreeModel, bin_edges, blocks, boosted, forest_predictions, forests

TARGET = "DEP_DELAY"

# The model settings in use.
FORESTS = {
    "flights": Rules(trees=300, bootstrap=True, least_rows=2, split_rows=5),
    "airport_month": Rules(trees=100, depth=10, bootstrap=True, least_rows=2, split_rows=5),
    "grid": Rules(trees=100, depth=15, bootstrap=True, least_rows=2, split_rows=5),
    "engineered": Rules(trees=200, depth=20, bootstrap=True),
}
BOOSTERS = {
    "airport_month": Rules(trees=100, depth=6, rate=0.1),
    "engineered": Rules(trees=200, depth=10, rate=0.1),
    "weighted": Rules(
        trees=200, depth=6, rate=0.1, rows_share=0.8, columns_share=0.8, least_weight=3.0,
        gamma=0.1, l1=0.1, l2=1.0,
    ),
}
# Deeper trees are about as large as their data and are not kept as a model.
KEPT_DEPTH = 10

# Columns the flight models read: every numeric feature once.
FLIGHT_NUMERIC = K.NUMERIC_FEATURES + tuple(
    c
    for c in K.HISTORY_ORIGIN + K.HISTORY_DEST
    if "delay_rate" in c or "avg_delay" in c
)


def _settings(base: Mapping, changes: Mapping) -> dict:
    return {"labelCol": TARGET, "featuresCol": "features", **base, **changes}


def linear(**changes) -> LinearRegression:
    return LinearRegression(**_settings({}, changes))


@dataclass(frozen=True)
class TreeLearner:
    """Boosted trees or a forest over the named columns."""

    rules: Rules
    boosting: bool
    numeric: tuple[str, ...] = FLIGHT_NUMERIC
    categorical: tuple[str, ...] = K.CATEGORICAL_FEATURES
    target: str = TARGET
    weight: str | None = None

    @property
    def kept(self) -> bool:
        return self.rules.depth is not None and self.rules.depth <= KEPT_DEPTH

    def prepared(self, df: DataFrame, part: str | None = None, fit_on: DataFrame | None = None) -> Blocks:
        edges = None if fit_on is None else bin_edges(fit_on.where(F.col(self.target).isNotNull()), self.numeric)
        return blocks(df, self.numeric, self.categorical, self.target, self.weight, part, edges)

    def fit_parts(self, source: Blocks, parts: Sequence[int | None]) -> list[TreeModel]:
        """One model for each part left out, all grown in the same passes."""
        return (boosted if self.boosting else forests)(source, self.rules, parts)

    def fit(self, df: DataFrame) -> TreeModel:
        return self.fit_parts(self.prepared(df), (None,))[0]

    def predictions(self, train: DataFrame, test: DataFrame) -> DataFrame:
        """``actual`` and ``predicted`` of the test rows; for trees that are not kept."""
        read = list(dict.fromkeys([*self.numeric, *self.categorical, self.target, *([self.weight] if self.weight else [])]))
        both = train.select(*read, F.lit(0).alias("_part")).unionByName(test.select(*read, F.lit(1).alias("_part")))
        return forest_predictions(self.prepared(both, "_part", train), self.rules, 1)


def forest(kind: str = "flights", **columns) -> TreeLearner:
    return TreeLearner(FORESTS[kind], False, **columns)


def booster(kind: str = "airport_month", **columns) -> TreeLearner:
    return TreeLearner(BOOSTERS[kind], True, **columns)


def weighted_booster(weight: str = "weight", **columns) -> TreeLearner:
    return booster("weighted", weight=weight, **columns)


def with_weights(df: DataFrame, target: str = TARGET, name: str = "weight") -> DataFrame:
    return df.withColumn(name, labels.sample_weight(F.col(target)))


def pipeline(
    estimator: Estimator,
    numeric: Sequence[str] = FLIGHT_NUMERIC,
    categorical: Sequence[str] = K.CATEGORICAL_FEATURES,
) -> Pipeline:
    return Pipeline(stages=[*preprocessor_stages(numeric, categorical), estimator])


def scored(model: PipelineModel | TreeModel, df: DataFrame) -> DataFrame:
    """Predictions beside the input columns."""
    out = model.transform(df)
    return out.select(*df.columns, F.col("prediction").alias("predicted"))


def historical_mean_predictor(
    train: DataFrame, test: DataFrame, keys: Sequence[str] = ("route",), target: str = TARGET
) -> DataFrame:
    """Mean of the training rows with the same key, of all of them if there are none."""
    sums = settled(
        train.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    )
    overall = sums.agg(F.try_divide(F.sum("_s"), F.sum("_n"))).scalar()
    means = sums.select(*keys, F.try_divide("_s", "_n").alias("_mean"))
    joined = lookup_join(test, means, list(keys))
    return joined.withColumn("predicted", F.coalesce("_mean", overall)).drop("_mean")


def regression_metrics(
    df: DataFrame, actual: str = TARGET, predicted: str = "predicted", by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R squared in one pass, per group if asked."""
    error = F.col(actual) - F.col(predicted)
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(F.when(error.isNotNull(), F.col(actual))))).alias("r2"),
    )


def prediction_stats(df: DataFrame, actual: str = TARGET, predicted: str = "predicted") -> DataFrame:
    """Spread of predictions and actuals, and how many predictions are zero."""
    p, a = F.col(predicted), F.col(actual)
    return df.agg(
        F.avg(p).alias("pred_mean"), F.stddev_pop(p).alias("pred_std"),
        F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
        F.avg(a).alias("actual_mean"), F.stddev_samp(a).alias("actual_std"),
        F.min(a).alias("actual_min"), F.max(a).alias("actual_max"),
        F.count_if(p == 0).alias("zero_predictions"),
        (F.avg((p == 0).cast("double")) * 100).alias("zero_pct"),
    )


def cv_mae(
    df: DataFrame, keys: Sequence[str] = ("route",), folds: int = 5, target: str = TARGET,
    fold_on: Sequence[str] | None = None,
) -> DataFrame:
    """MAE per fold of the historical mean, every fold predicted by the others.

    Sums by key and fold are enough: a fold's training sum is the total less
    its own, so the rows are read twice and never copied per fold.
    """
    tagged = df.withColumn("fold", hash_fold(df, fold_on or df.columns, folds))
    sums = settled(
        tagged.groupBy(*keys, "fold")
        .agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    )
    per_key = W.partitionBy(*keys)
    means = sums.select(
        *keys,
        "fold",
        F.try_divide(F.sum("s").over(per_key) - F.col("s"), F.sum("n").over(per_key) - F.col("n")).alias("_mean"),
    )
    per_fold = sums.groupBy("fold").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    every = W.partitionBy()
    overall = per_fold.select(
        "fold",
        F.try_divide(F.sum("s").over(every) - F.col("s"), F.sum("n").over(every) - F.col("n")).alias("_overall"),
    )
    placed = lookup_join(lookup_join(tagged, means, [*keys, "fold"]), overall, ["fold"])
    predicted = F.coalesce("_mean", "_overall")
    return placed.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(target) - predicted)).alias("mae")
    )


def cross_validated_mae(
    learner: Pipeline | TreeLearner, df: DataFrame, folds: int = 5, fold_on: Sequence[str] | None = None
) -> DataFrame:
    """Mean over the folds of the MAE on the rows of the fold; every row is learned from and judged.

    The fold comes from the content of the row. Trees of all folds are grown in the same
    passes: a fold is a number in the key of their sums.
    """
    tagged = settled(df.withColumn("_fold", hash_fold(df, fold_on or df.columns, folds)))
    used = sorted(r[0] for r in tagged.select("_fold").distinct().collect())
    if isinstance(learner, TreeLearner):
        fitted = dict(zip(used, learner.fit_parts(learner.prepared(tagged, "_fold"), used)))
    else:
        fitted = {fold: learner.fit(tagged.where(F.col("_fold") != fold).drop("_fold")) for fold in used}
    target = learner.target if isinstance(learner, TreeLearner) else TARGET
    rows, means = 0, []
    for fold, model in fitted.items():
        judged = regression_metrics(scored(model, tagged.where(F.col("_fold") == fold)), target).first()
        if judged["n"]:
            means.append(judged["mae"])
            rows += judged["n"]
    mean = sum(means) / len(means) if means else None
    return df.sparkSession.createDataFrame([(folds, mean, rows)], "folds int, cv_mae double, n long")


def train_and_evaluate(
    models: Mapping[str, Pipeline | TreeLearner], train: DataFrame, test: DataFrame
) -> tuple[dict[str, PipelineModel | TreeModel], DataFrame]:
    """Fit every learner to all training rows and measure each on the test part.

    Trees deeper than ``KEPT_DEPTH`` are measured, but give no model to keep.
    """
    fitted, tables = {}, []
    for i, (name, learner) in enumerate(models.items()):
        if isinstance(learner, TreeLearner) and not learner.kept:
            metrics = regression_metrics(learner.predictions(train, test), "actual")
        else:
            fitted[name] = learner.fit(train)
            target = learner.target if isinstance(learner, TreeLearner) else TARGET
            metrics = regression_metrics(scored(fitted[name], test), target)
        tables.append(metrics.select(F.lit(i).alias("position"), F.lit(name).alias("model"), "n", "mae", "rmse", "r2"))
    return fitted, reduce(lambda a, b: a.unionByName(b), tables)


def select_best(metrics: DataFrame) -> DataFrame:
    """Model with the least MAE; the first one wins a tie."""
    best = F.min(F.struct("mae", "position", "model", "rmse", "r2")).alias("b")
    return metrics.agg(best).select("b.model", "b.mae", "b.rmse", "b.r2")


def model_importance(model: TreeModel, df: DataFrame, top_n: int = 20) -> DataFrame:
    """Columns, and labels of categorical ones, by their share of all gain; new ones marked.

    ``df`` names the labels, which the model knows by their hash.
    """
    shares = [(name, key, float(v)) for (name, key), v in model.importances().items()]
    table = df.sparkSession.createDataFrame(shares, "column string, label_hash long, importance double")
    for c in model.categorical:
        known = df.select(F.col(c).cast("string").alias("label")).na.drop().distinct()
        known = known.select(F.lit(c).alias("column"), F.xxhash64("label").alias("label_hash"), F.col("label").alias(f"_{c}"))
        table = table.join(known, ["column", "label_hash"], "left")
    label = F.coalesce(F.lit(None).cast("string"), *[F.col(f"_{c}") for c in model.categorical])
    named = table.withColumn("feature", F.concat("column", F.when(F.col("label_hash").isNotNull(), F.concat(F.lit("="), F.coalesce(label, F.lit("")))).otherwise("")))
    is_new = reduce(lambda a, b: a | b, [F.col("feature").contains(m) for m in K.NEW_FEATURE_MARKS])
    return (
        named.select("feature", "importance", is_new.alias("is_new"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top_n)
    )


def family(name: Column) -> Column:
    """Kind of engineered feature by its name."""
    out = None
    for kind, marks in K.FAMILY_MARKS.items():
        test = reduce(lambda a, b: a | b, [name.contains(m) for m in marks])
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out


def engineered_impact(ranking: DataFrame) -> DataFrame:
    """Number of new features and the best one, by family."""
    best = F.max_by("feature", "importance_score")
    return (
        ranking.withColumn("family", family(F.col("feature")))
        .na.drop(subset=["family"])
        .groupBy("family")
        .agg(
            F.count(F.lit(1)).alias("n_features"),
            best.alias("top_feature"),
            F.max("importance_score").alias("top_score"),
        )
    )


def compare_baseline(metrics: DataFrame, baseline_mae: float | Column = K.BASELINE_MAE) -> DataFrame:
    """Minutes and percent by which each MAE beats the baseline."""
    base = baseline_mae if isinstance(baseline_mae, Column) else F.lit(float(baseline_mae))
    return metrics.withColumns(
        {
            "baseline_mae": base,
            "improvement": base - F.col("mae"),
            "improvement_pct": F.try_divide((base - F.col("mae")) * 100, base),
        }
    )


def residual_table(df: DataFrame, actual: str = TARGET, predicted: str = "predicted") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def density_histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Counts and densities in equal bins between each column's extremes.

    The last bin holds the maximum. Columns are counted in one pass after one
    pass for the extremes; empty bins have no row.
    """
    cols = list(cols)
    bounds = df.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(c) for c in cols])
    ).scalar()
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("v")) for c in cols]))
    ).na.drop(subset=["v"])
    pick = lambda field: reduce(
        lambda acc, c: acc.when(F.col("series") == c, bounds[c][field]), cols[1:],
        F.when(F.col("series") == cols[0], bounds[cols[0]][field]),
    )
    ranged = long.withColumns({"lo": pick("lo"), "hi": pick("hi"), "total": pick("n")})
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0))
    binned = ranged.withColumns(
        {"width": width, "bin": F.least(F.lit(bins - 1).cast("bigint"), at) + 1}
    )
    return binned.groupBy("series", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.col("lo") + F.col("width") * (F.col("bin") - 1)).alias("bin_start"),
        F.try_divide(F.count(F.lit(1)), F.min(F.col("total") * F.col("width"))).alias("density"),
    )
