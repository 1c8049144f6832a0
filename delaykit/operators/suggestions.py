"""New features suggested by the loadings of a principal component analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators.pca import TOP_COMPONENTS, feature_importance_matrix, loading_correlation

SCHEMA = (
    "type string, position int, operation string, features array<string>, "
    "new_feature_name string, rationale string, priority string, implementation string"
)
STRONG = 0.2
REACH = 4          # a feature pairs with the next four of its side
RATIO_SIDE = 5     # ratios use the first five of either side
CORRELATED = 0.7
HIGH_SHARE = 15.0


def _record(
    kind: str, position: Column, operation: Column, features: Column, name: Column,
    rationale: Column, priority: Column, implementation: Column | None = None,
) -> list[Column]:
    return [
        F.lit(kind).alias("type"),
        position.cast("int").alias("position"),
        operation.alias("operation"),
        features.alias("features"),
        name.alias("new_feature_name"),
        rationale.alias("rationale"),
        priority.alias("priority"),
        (implementation if implementation is not None else F.lit(None).cast("string")).alias("implementation"),
    ]


def _side(loadings: DataFrame, test: Column) -> DataFrame:
    """Strong loadings of one sign, numbered in feature order within a component."""
    return loadings.filter((F.col("pc") <= 3) & test).select(
        "pc",
        "feature",
        "loading",
        (F.row_number().over(W.partitionBy("pc").orderBy("position")) - 1).alias("i"),
    )


def suggest_interactions(loadings: DataFrame, top_n: int = 15) -> DataFrame:
    """Products of features that load together, ratios of those that oppose.

    Joins loadings of the first three components with themselves: a few rows
    per column of the analysed table.
    """
    up = _side(loadings, F.col("loading") > STRONG)
    down = _side(loadings, F.col("loading") < -STRONG)
    a, b, c = up.alias("a"), up.alias("b"), down.alias("c")
    gap = F.col("b.i") - F.col("a.i")
    products = a.join(b, (F.col("a.pc") == F.col("b.pc")) & gap.between(1, REACH)).select(
        F.col("a.pc").alias("pc"), F.lit(0).alias("step"),
        F.col("a.i").alias("i"), F.col("b.i").alias("j"),
        F.col("a.feature").alias("f1"), F.col("b.feature").alias("f2"),
        F.format_string(
            "both load positively on PC%d (%.3f and %.3f)", F.col("a.pc"), F.col("a.loading"), F.col("b.loading")
        ).alias("rationale"),
    )
    ratios = a.join(
        c,
        (F.col("a.pc") == F.col("c.pc")) & (F.col("a.i") < RATIO_SIDE) & (F.col("c.i") < RATIO_SIDE),
    ).select(
        F.col("a.pc").alias("pc"), F.lit(1).alias("step"),
        F.col("a.i").alias("i"), F.col("c.i").alias("j"),
        F.col("a.feature").alias("f1"), F.col("c.feature").alias("f2"),
        F.format_string("opposite loadings on PC%d", F.col("a.pc")).alias("rationale"),
    )
    order = W.orderBy("pc", "step", "i", "j")
    listed = (
        products.unionByName(ratios)
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") <= top_n)
    )
    product = F.col("step") == 0
    return listed.select(
        *_record(
            "interaction",
            F.col("_at"),
            F.when(product, "multiply").otherwise("divide"),
            F.array("f1", "f2"),
            F.concat("f1", F.when(product, "_X_").otherwise("_DIV_"), "f2"),
            F.col("rationale"),
            F.when(product & (F.col("pc") == 1), "high").otherwise("medium"),
        )
    )


def suggest_polynomials(loadings: DataFrame, top_n: int = 10) -> DataFrame:
    """Square and logarithm of the most important features."""
    importance = feature_importance_matrix(loadings)
    limit = importance.agg(F.percentile("overall_importance", 0.9)).scalar()
    order = W.orderBy(F.desc("overall_importance"), "position")
    top = (
        importance.withColumn("_high", F.col("overall_importance") > limit)
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") <= top_n)
    )
    steps = F.array(
        F.struct(F.lit(0).alias("k"), F.lit("square").alias("op"), F.lit("").alias("pre"), F.lit("_squared").alias("post")),
        F.struct(F.lit(1).alias("k"), F.lit("log").alias("op"), F.lit("log_").alias("pre"), F.lit("").alias("post")),
    )
    each = top.withColumn("s", F.explode(steps))
    return each.select(
        *_record(
            "polynomial",
            (F.col("_at") - 1) * 2 + F.col("s.k") + 1,
            F.col("s.op"),
            F.array("feature"),
            F.concat("s.pre", "feature", "s.post"),
            F.format_string("overall importance %.3f", F.col("overall_importance")),
            F.when((F.col("s.op") == "square") & F.col("_high"), "high").otherwise("medium"),
        )
    )


def suggest_aggregations(loadings: DataFrame) -> DataFrame:
    """Mean and sum of groups of correlated features.

    Groups are taken greedily in feature order. The correlation table has
    columns squared rows, so the loop runs over it directly.
    """
    close = (
        loading_correlation(loadings)
        .filter(F.abs("corr") > CORRELATED)
        .groupBy("x", "px")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("py", "y"))), lambda m: m["y"]).alias("near"))
        .orderBy("px")
    )
    used: set[str] = set()
    rows: list[tuple] = []
    for row in close.collect():
        if row["x"] in used or len(row["near"]) < 3:
            continue
        stem = "_".join(row["near"][:2])
        for operation, prefix, priority in (("mean", "avg", "medium"), ("sum", "sum", "low")):
            rows.append(
                (
                    "aggregation", len(rows) + 1, operation, row["near"], f"{prefix}_{stem}_group",
                    f"{len(row['near'])} features correlate above {CORRELATED}", priority, None,
                )
            )
        used.update(row["near"])
    return loadings.sparkSession.createDataFrame(rows, SCHEMA)


def suggest_domain(loadings: DataFrame, top_n: int = 20) -> DataFrame:
    """Composite features for the kinds of name found among the top features."""
    order = W.orderBy(F.desc("overall_importance"), "position")
    top = (
        feature_importance_matrix(loadings)
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") <= top_n)
    )
    name = F.lower("feature")
    has = lambda words: reduce(lambda x, y: x | y, [name.contains(w) for w in words])
    members = lambda test: F.transform(
        F.sort_array(F.collect_list(F.when(test, F.struct("_at", "feature")))), lambda m: m["feature"]
    )
    found = top.agg(
        members(has(["delay"])).alias("delay"),
        members(has(["hour", "dow", "month"])).alias("time"),
        members(has(["origin"])).alias("origin"),
        members(has(["dest"])).alias("dest"),
        members(has(K.ENTROPY_WORDS)).alias("kinds"),
    )
    rules = [
        (F.size("delay") >= 2, "weighted_average", F.col("delay"), "composite_delay_risk_score", "high",
         "mean of the standardised delay features"),
        (F.size("time") >= 2, "categorical_encoding", F.col("time"), "temporal_risk_category", "high",
         "risk classes by hour and weekday"),
        ((F.size("origin") > 0) & (F.size("dest") > 0), "route_risk",
         F.array(F.lit("origin delay features"), F.lit("dest delay features")), "route_congestion_score", "high",
         "larger end plus half the smaller"),
        (F.size("kinds") >= 3, "delay_type_balance", F.col("kinds"), "delay_type_diversity_score", "medium",
         "entropy of the cause rates"),
    ]
    entries = [
        F.when(
            test,
            F.struct(
                F.lit(i).alias("at"), F.lit(op).alias("op"), feats.alias("feats"), F.lit(new).alias("new"),
                F.lit(priority).alias("priority"), F.lit(how).alias("how"),
            ),
        )
        for i, (test, op, feats, new, priority, how) in enumerate(rules, 1)
    ]
    return found.select(F.inline(F.array_compact(F.array(*entries)))).select(
        *_record(
            "domain_composite",
            F.row_number().over(W.orderBy("at")),
            F.col("op"),
            F.col("feats"),
            F.col("new"),
            F.format_string("%d features of this kind among the top", F.size("feats")),
            F.col("priority"),
            F.col("how"),
        )
    )


def suggest_pca_derived(variance: DataFrame) -> DataFrame:
    share = F.col("ratio") * 100
    pc = F.concat(F.lit("PC"), F.col("pc"))
    return variance.filter(F.col("pc") <= TOP_COMPONENTS).select(
        *_record(
            "pca_derived",
            F.col("pc"),
            F.lit("principal_component"),
            F.array(pc),
            F.concat(F.lit("principal_component_"), F.col("pc")),
            F.format_string("PC%d explains %.1f%% of the variance", F.col("pc"), share),
            F.when(share > HIGH_SHARE, "high").otherwise("medium"),
            F.concat(F.lit("scores on "), pc),
        )
    )


def suggestion_report(loadings: DataFrame, variance: DataFrame) -> DataFrame:
    """Every suggestion of every kind."""
    parts = [
        suggest_interactions(loadings),
        suggest_polynomials(loadings),
        suggest_aggregations(loadings),
        suggest_domain(loadings),
        suggest_pca_derived(variance),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def suggestion_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
