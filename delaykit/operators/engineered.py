"""Features built from other features, driven by a list of suggestions.

A suggestion is a mapping with ``operation``, ``features``, ``new_feature_name``
and ``priority``. Every step is one projection, whatever the number of
suggestions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import moments, numbers
from delaykit.operators import pca, suggestions, wide

Suggestion = Mapping
CHANCE = 1e-20


def _wanted(suggestions: Sequence[Suggestion], priority: str) -> list[Suggestion]:
    return [s for s in suggestions if priority in ("all", s["priority"])]


def _num(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def _ready(present: Sequence[str], suggestion: Suggestion) -> bool:
    return all(f in present for f in suggestion["features"])


def interaction_columns(present: Sequence[str], suggestions: Sequence[Suggestion], priority: str) -> dict[str, Column]:
    """A name suggested twice is built once, from its last suggestion."""
    out: dict[str, Column] = {}
    for s in _wanted(suggestions, priority):
        if not _ready(present, s):
            continue
        left, right = (_num(f) for f in s["features"][:2])
        if s["operation"] == "multiply":
            out[s["new_feature_name"]] = left * right
        elif s["operation"] == "divide":
            out[s["new_feature_name"]] = F.try_divide(left, right + F.lit(K.EPSILON))
    return out


def polynomial_columns(present: Sequence[str], suggestions: Sequence[Suggestion], priority: str) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for s in _wanted(suggestions, priority):
        if not _ready(present, s):
            continue
        x = _num(s["features"][0])
        floor = F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))
        if s["operation"] == "square":
            out[s["new_feature_name"]] = x * x
        elif s["operation"] == "log":
            out[s["new_feature_name"]] = F.log1p(floor)
        elif s["operation"] == "sqrt":
            out[s["new_feature_name"]] = F.sqrt(floor)
    return out


def aggregate_columns(present: Sequence[str], suggestions: Sequence[Suggestion], priority: str) -> dict[str, Column]:
    build = {
        "mean": numbers.row_mean, "sum": numbers.row_sum,
        "max": numbers.row_max, "min": numbers.row_min,
    }
    out: dict[str, Column] = {}
    for s in _wanted(suggestions, priority):
        members = [f for f in s["features"] if f in present]
        if len(members) >= 2 and s["operation"] in build:
            out[s["new_feature_name"]] = build[s["operation"]]([_num(f) for f in members])
    return out


def interaction_features(df: DataFrame, suggestions: Sequence[Suggestion], priority: str = "high") -> DataFrame:
    return df.withColumns(interaction_columns(df.columns, suggestions, priority))


def polynomial_features(df: DataFrame, suggestions: Sequence[Suggestion], priority: str = "high") -> DataFrame:
    return df.withColumns(polynomial_columns(df.columns, suggestions, priority))


def group_aggregate_features(df: DataFrame, suggestions: Sequence[Suggestion], priority: str = "medium") -> DataFrame:
    return df.withColumns(aggregate_columns(df.columns, suggestions, priority))


def risk_columns(cols: Sequence[str]) -> list[str]:
    return [c for c in cols if "delay" in c.lower() and "avg" in c.lower()]


class RiskScale(NamedTuple):
    """Mean and sample deviation of the columns of the composite risk."""

    stats: dict[str, tuple[float | None, float | None]]


def fit_risk_scale(df: DataFrame, cols: Sequence[str] | None = None) -> RiskScale:
    """Two numbers per column, in one pass; keep them for scoring."""
    names = list(cols) if cols is not None else risk_columns(df.columns)
    row = df.agg(
        *[F.avg(_num(c)).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_samp(_num(c)).alias(f"s{i}") for i, c in enumerate(names)],
    ).first()
    return RiskScale({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(names)})


def risk_scale_table(scale: RiskScale, like: DataFrame) -> DataFrame:
    """The fitted numbers as a table, to be saved beside the model."""
    rows = [(c, m, s) for c, (m, s) in scale.stats.items()]
    return like.sparkSession.createDataFrame(rows, "feature string, mean double, std double")


def composite_delay_risk(df: DataFrame, scale: RiskScale, name: str = "composite_delay_risk_score") -> DataFrame:
    """Mean z-score of the average-delay columns."""
    scores = [
        (_num(c) - F.lit(m)) / F.lit(s + K.EPSILON)
        for c, (m, s) in scale.stats.items()
        if m is not None and s is not None
    ]
    return df.withColumn(name, numbers.row_mean(scores)) if scores else df


def temporal_risk_category(df: DataFrame, name: str = "temporal_risk_category") -> DataFrame:
    if not {"dep_hour", "dow"} <= set(df.columns):
        return df
    rush = F.col("dep_hour").isin(*K.RUSH_HOURS)
    weekend = F.col("dow").isin(*K.WEEKEND)
    return df.withColumn(name, F.when(weekend, 1).when(rush, 2).otherwise(0))


def route_congestion_score(df: DataFrame, name: str = "route_congestion_score") -> DataFrame:
    """Larger of the two ends' mean delay measures plus half the smaller."""
    low = {c: c.lower() for c in df.columns}
    ends = [
        [c for c, l in low.items() if end in l and "delay" in l] for end in ("origin", "dest")
    ]
    if not all(ends):
        return df
    o, d = (numbers.row_mean([_num(c) for c in cols]) for cols in ends)
    both = o.isNotNull() & d.isNotNull()
    return df.withColumn(name, F.when(both, F.greatest(o, d) + 0.5 * F.least(o, d)))


def delay_type_diversity(df: DataFrame, name: str = "delay_type_diversity_score") -> DataFrame:
    """Entropy of the cause rates, each at least a small positive number."""
    cols = [
        c for c in df.columns
        if "rate" in c.lower() and any(word in c.lower() for word in K.ENTROPY_WORDS)
    ]
    if len(cols) < 3:
        return df
    rates = [F.greatest(_num(c), F.lit(K.EPSILON)) for c in cols]
    total = rates[0]
    for r in rates[1:]:
        total = total + r
    entropy = F.lit(0.0)
    for r in rates:
        share = r / total
        entropy = entropy - share * F.log(share)
    # A missing rate leaves the entropy unknown.
    known = F.lit(True)
    for c in cols:
        known = known & _num(c).isNotNull()
    return df.withColumn(name, F.when(known, entropy))


def domain_features(df: DataFrame, suggestions: Sequence[Suggestion], scale: RiskScale | None = None) -> DataFrame:
    """The suggested domain features, each over the columns given at the call."""
    base = df
    out = df
    for s in suggestions:
        name = s["new_feature_name"]
        if "composite_delay_risk_score" in name:
            fitted = scale or fit_risk_scale(base)
            step = lambda d, n=name, f=fitted: composite_delay_risk(d, f, n)
        elif "temporal_risk_category" in name:
            step = lambda d, n=name: temporal_risk_category(d, n)
        elif "route_congestion_score" in name:
            step = lambda d, n=name: route_congestion_score(d, n)
        elif "delay_type_diversity_score" in name:
            step = lambda d, n=name: delay_type_diversity(d, n)
        else:
            continue
        out = _from_base(base, out, step, name)
    return out


def _from_base(base: DataFrame, out: DataFrame, step, name: str) -> DataFrame:
    """Apply a step that looks at the columns of ``base`` only."""
    hidden = [c for c in out.columns if c not in base.columns and c != name]
    renamed = out.withColumnsRenamed({c: f"_new{i}" for i, c in enumerate(hidden)})
    return step(renamed).withColumnsRenamed({f"_new{i}": c for i, c in enumerate(hidden)})


def engineer_all(
    df: DataFrame, report: Mapping[str, Sequence[Suggestion]], priority: str = "high",
    scale: RiskScale | None = None,
) -> DataFrame:
    """Interactions, then polynomials, then domain features, then aggregates."""
    return (
        df.transform(interaction_features, report.get("interaction", ()), priority)
        .transform(polynomial_features, report.get("polynomial", ()), priority)
        .transform(domain_features, report.get("domain_composite", ()), scale)
        .transform(group_aggregate_features, report.get("aggregation", ()), "medium")
    )


def suggestions_by_type(report: DataFrame) -> dict[str, list[dict]]:
    """A suggestion table as mappings by type; it has a few dozen rows at most."""
    out: dict[str, list[dict]] = {}
    for row in report.orderBy("type", "position").collect():
        out.setdefault(row["type"], []).append(row.asDict())
    return out


def own_suggestions(df: DataFrame, features: Sequence[str]) -> dict[str, list[dict]]:
    """What the components of the table's own columns suggest, by type."""
    fitted = pca.pca_fit(df.select(*[f"`{f}`" for f in features]), list(features))
    return suggestions_by_type(suggestions.suggestion_report(fitted.loadings, fitted.variance))


def engineer_from_report(
    df: DataFrame, features: Sequence[str], priority: str = "high", scale: RiskScale | None = None
) -> DataFrame:
    """``engineer_all`` with the suggestions of ``own_suggestions``."""
    return engineer_all(df, own_suggestions(df, features), priority, scale)


def rank_new_features(df: DataFrame, features: Sequence[str], target: str = "DEP_DELAY") -> DataFrame:
    """Variance times absolute correlation with the target, largest first."""
    names = [f for f in features if f in df.columns]
    if len(names) > wide.WIDE:
        facts = wide.with_target(df, names, target).select(
            "feature",
            "variance",
            F.abs("correlation").alias("correlation_with_target"),
            (F.col("variance") * F.coalesce(F.abs("correlation"), F.lit(1.0))).alias("importance_score"),
        )
        return facts.orderBy(F.desc("importance_score"), "feature")
    totals = df.agg(
        *[F.var_samp(_num(f)).alias(f"v{i}") for i, f in enumerate(names)],
        *[F.abs(moments.correlation(_num(f), F.col(target))).alias(f"c{i}") for i, f in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"v{i}").alias("variance"),
            F.col(f"c{i}").alias("correlation_with_target"),
            (F.col(f"v{i}") * F.coalesce(F.col(f"c{i}"), F.lit(1.0))).alias("importance_score"),
        )
        for i, f in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows))).orderBy(F.desc("importance_score"), "feature")


def simple_composites(df: DataFrame) -> DataFrame:
    """The short list of products, squares and means over a delay-cause table."""
    c = F.col
    products = {
        "avg_delay_minutes_x_carrier_delay_rate": c("avg_delay_minutes") * c("carrier_delay_rate"),
        "total_delay_rate_x_weather_delay_rate": c("total_delay_rate") * c("weather_delay_rate"),
        "nas_delay_rate_x_late_aircraft_delay_rate": c("nas_delay_rate") * c("late_aircraft_delay_rate"),
        "volume_delay_interaction": c("arr_flights") * c("total_delay_rate"),
        "temporal_delay_pattern": c("month") * c("avg_delay_minutes"),
        "delay_risk_score": (
            c("total_delay_rate") + c("carrier_delay_rate") + c("weather_delay_rate")
        ) / 3,
    }
    squares = {
        f"{n}_squared": c(n) * c(n)
        for n in ("total_delay_rate", "carrier_delay_rate", "avg_delay_minutes", "weather_delay_rate")
    }
    return df.withColumns({**products, **squares})
