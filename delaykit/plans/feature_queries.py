"""Feature tables and engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators import engineered, features, statistics
from delaykit.operators.lookups import settled
from delaykit.plans.catalog import ROW_DIGITS, query
from delaykit.plans.flight_queries import clean, enriched, lookups, route_table
from delaykit.plans.views import each, with_views
from delaykit.sources import testdata as data

_FEATURES = ", ".join(K.FEATURES)
NUMERIC = list(K.NUMERIC_FEATURES + K.HISTORY_ORIGIN + K.HISTORY_DEST)
_DOUBLES = ["DISTANCE", *K.ENCODINGS, *K.HISTORY_ORIGIN, *K.HISTORY_DEST]


def feature_table(spark, path):
    return features.training_features(enriched(spark, path), base=clean(spark, path))


@query("training_features", with_views("feat", f"SELECT {_FEATURES}, DEP_DELAY FROM feat"), [*_DOUBLES, "DEP_DELAY"], digits=ROW_DIGITS)
def _(spark, path):
    return feature_table(spark, path)


@query(
    "training_features_fit_on_train",
    with_views(
        "cf",
        """SELECT f.ORIGIN, f.DEST, f.OP_CARRIER, f.DEP_DELAY, f.FL_DATE, r.m AS route_avg_delay, o.m AS origin_avg_delay,
          a.m AS airline_avg_delay FROM cf f
        LEFT JOIN (SELECT ORIGIN, DEST, avg(DEP_DELAY) AS m FROM t GROUP BY 1, 2) r ON f.ORIGIN = r.ORIGIN AND f.DEST = r.DEST
        LEFT JOIN (SELECT ORIGIN, avg(DEP_DELAY) AS m FROM t GROUP BY 1) o ON f.ORIGIN = o.ORIGIN
        LEFT JOIN (SELECT OP_CARRIER, avg(DEP_DELAY) AS m FROM t GROUP BY 1) a ON f.OP_CARRIER = a.OP_CARRIER""",
        t="SELECT * FROM cf WHERE FL_DATE < DATE '1998-01-01'",
    ),
    ["DEP_DELAY", *K.ENCODINGS],
    digits=ROW_DIGITS,
)
def _(spark, path):
    flights = enriched(spark, path)
    train = flights.filter(F.col("FL_DATE") < F.lit("1998-01-01").cast("date"))
    out = features.training_features(flights, fit_on=train, keep=["FL_DATE"])
    return out.select("ORIGIN", "DEST", "OP_CARRIER", "DEP_DELAY", "FL_DATE", *K.ENCODINGS)


@query(
    "serving_features",
    with_views("serv", f"SELECT query_id, rank, flight_date, {_FEATURES}, carrier_avg_delay, carrier_delay_rate FROM serv"),
    [*_DOUBLES, "carrier_avg_delay", "carrier_delay_rate"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return features.serving_features(data.requests(spark, path), *lookups(spark, path), route_table(spark, path))


_AVAIL_DOUBLES = [
    *K.REQUEST_DEFAULTS, "carrier_weather_delay_rate", "carrier_nas_delay_rate", "avg_delay_minutes",
    "dest_delay_rate", "dest_avg_delay", "dest_weather_delay_rate", "dest_nas_delay_rate",
]


@query("availability_features", with_views("avail", "SELECT * FROM avail"), _AVAIL_DOUBLES, digits=ROW_DIGITS)
def _(spark, path):
    return features.availability_features(data.requests(spark, path), *lookups(spark, path))


# ---- suggested features -----------------------------------------------------


def _say(operation: str, inputs: list[str], name: str, priority: str) -> dict:
    return {"operation": operation, "features": inputs, "new_feature_name": name, "priority": priority}


SUGGESTED = {
    "interaction": [
        _say("multiply", ["dow", "is_weekend"], "dow_X_is_weekend", "high"),
        _say("multiply", ["dow", "airline_avg_delay"], "dow_X_airline_avg_delay", "high"),
        _say("multiply", ["is_weekend", "airline_avg_delay"], "is_weekend_X_airline_avg_delay", "high"),
        _say("divide", ["dow", "dep_hour"], "dow_DIV_dep_hour", "medium"),
        _say("divide", ["airline_avg_delay", "dep_hour"], "airline_avg_delay_DIV_dep_hour", "medium"),
        _say("multiply", ["dow", "airline_avg_delay"], "dow_X_airline_avg_delay", "medium"),
        _say("multiply", ["dow", "not_a_column"], "dow_X_not_a_column", "high"),
    ],
    "polynomial": [
        _say("square", ["dow"], "dow_squared", "high"),
        _say("log", ["airline_avg_delay"], "log_airline_avg_delay", "medium"),
        _say("sqrt", ["DEP_DELAY"], "sqrt_DEP_DELAY", "medium"),
    ],
    "domain_composite": [
        _say("weighted_average", [], "composite_delay_risk_score", "high"),
        _say("categorical_encoding", [], "temporal_risk_category", "high"),
        _say("route_risk", [], "route_congestion_score", "high"),
        _say("delay_type_balance", [], "delay_type_diversity_score", "medium"),
    ],
    "aggregation": [
        _say("mean", ["total_delay_rate_origin", "carrier_delay_rate_origin", "nas_delay_rate_origin", "gone"],
             "avg_rates_group", "medium"),
        _say("sum", ["total_delay_rate_origin", "carrier_delay_rate_origin"], "sum_rates_group", "low"),
        _say("max", ["origin_avg_delay", "route_avg_delay"], "max_delays_group", "medium"),
        _say("min", ["origin_avg_delay", "route_avg_delay"], "min_delays_group", "medium"),
    ],
}
_ID = "route, OP_CARRIER, dep_hour, dow, DEP_DELAY"
_ID_COLS = ["route", "OP_CARRIER", "dep_hour", "dow", "DEP_DELAY"]


@query(
    "interaction_features",
    with_views(
        "feat",
        f"""SELECT {_ID}, CAST(dow * is_weekend AS DOUBLE) AS dow_X_is_weekend, dow * airline_avg_delay AS dow_X_airline_avg_delay,
          is_weekend * airline_avg_delay AS is_weekend_X_airline_avg_delay, dow / (dep_hour + 1.0E-8) AS dow_DIV_dep_hour,
          airline_avg_delay / (dep_hour + 1.0E-8) AS airline_avg_delay_DIV_dep_hour FROM feat""",
    ),
    ["DEP_DELAY", "dow_X_is_weekend", "dow_X_airline_avg_delay", "is_weekend_X_airline_avg_delay",
     "dow_DIV_dep_hour", "airline_avg_delay_DIV_dep_hour"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    base = feature_table(spark, path)
    out = engineered.interaction_features(base, SUGGESTED["interaction"], "all")
    return out.select(*_ID_COLS, *[c for c in out.columns if c not in base.columns])


@query(
    "polynomial_features",
    with_views(
        "feat",
        f"""SELECT {_ID}, CAST(dow * dow AS DOUBLE) AS dow_squared, ln(1 + greatest(airline_avg_delay, 0)) AS log_airline_avg_delay,
        sqrt(greatest(DEP_DELAY, 0)) AS sqrt_DEP_DELAY FROM feat""",
    ),
    ["DEP_DELAY", "dow_squared", "log_airline_avg_delay", "sqrt_DEP_DELAY"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    base = feature_table(spark, path)
    out = engineered.polynomial_features(base, SUGGESTED["polynomial"], "all")
    return out.select(*_ID_COLS, *[c for c in out.columns if c not in base.columns])


# The names the SQL uses are written out, so that it does not lean on the operators.
_AVERAGES = (
    "avg_delay_minutes", "avg_carrier_delay", "avg_weather_delay", "avg_nas_delay", "avg_security_delay",
    "avg_late_aircraft_delay",
)
_RATES = (
    "carrier_delay_rate", "weather_delay_rate", "nas_delay_rate", "security_delay_rate", "late_aircraft_delay_rate",
)
_RISK = [
    "route_avg_delay", "origin_avg_delay", "airline_avg_delay",
    *[f"{c}_origin" for c in _AVERAGES], *[f"{c}_dest" for c in _AVERAGES],
]
_RISK_SUM = each(
    "({} - (SELECT avg({}) FROM feat)) / ((SELECT stddev_samp({}) FROM feat) + 1.0E-8)", _RISK, " + "
)


@query(
    "composite_delay_risk",
    with_views("feat", f"SELECT {_ID}, ({_RISK_SUM}) / {len(_RISK)} AS composite_delay_risk_score FROM feat"),
    ["DEP_DELAY", "composite_delay_risk_score"],
    # A mean over all rows is in every value: its last bits differ by some 1e-11.
    digits=4,
)
def _(spark, path):
    base = feature_table(spark, path)
    scale = engineered.fit_risk_scale(base)
    return engineered.composite_delay_risk(base, scale).select(*_ID_COLS, "composite_delay_risk_score")


@query(
    "temporal_risk_category",
    with_views(
        "feat",
        f"""SELECT {_ID}, CASE WHEN dow >= 5 THEN 1 WHEN dep_hour IN (6, 7, 8, 16, 17, 18, 19) THEN 2 ELSE 0 END
        AS temporal_risk_category FROM feat""",
    ),
    ["DEP_DELAY"],
)
def _(spark, path):
    return engineered.temporal_risk_category(feature_table(spark, path)).select(*_ID_COLS, "temporal_risk_category")


_O = ["origin_avg_delay", *[f"{c}_origin" for c in ("total_delay_rate", *_RATES, *_AVERAGES)]]
_D = [f"{c}_dest" for c in ("total_delay_rate", *_RATES, *_AVERAGES)]
_o_mean, _d_mean = (f"(({' + '.join(cols)}) / {len(cols)})" for cols in (_O, _D))


@query(
    "route_congestion_score",
    with_views(
        "feat",
        f"SELECT {_ID}, greatest({_o_mean}, {_d_mean}) + 0.5E0 * least({_o_mean}, {_d_mean}) AS route_congestion_score FROM feat",
    ),
    ["DEP_DELAY", "route_congestion_score"],
)
def _(spark, path):
    base = feature_table(spark, path)
    return engineered.route_congestion_score(base).select(*_ID_COLS, "route_congestion_score")


_R = [*[f"{c}_origin" for c in _RATES], *[f"{c}_dest" for c in _RATES]]
_clip = [f"greatest({c}, 1.0E-8)" for c in _R]
_sum = " + ".join(_clip)


@query(
    "delay_type_diversity",
    with_views(
        "feat",
        f"SELECT {_ID}, -({' + '.join(f'({c} / s) * ln({c} / s)' for c in _clip)}) AS delay_type_diversity_score "
        f"FROM (SELECT *, {_sum} AS s FROM feat) t",
    ),
    ["DEP_DELAY", "delay_type_diversity_score"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    base = feature_table(spark, path)
    return engineered.delay_type_diversity(base).select(*_ID_COLS, "delay_type_diversity_score")


@query(
    "group_aggregate_features",
    with_views(
        "feat",
        f"""SELECT {_ID}, (total_delay_rate_origin + carrier_delay_rate_origin + nas_delay_rate_origin) / 3 AS avg_rates_group,
          total_delay_rate_origin + carrier_delay_rate_origin AS sum_rates_group,
          greatest(origin_avg_delay, route_avg_delay) AS max_delays_group,
          least(origin_avg_delay, route_avg_delay) AS min_delays_group FROM feat""",
    ),
    ["DEP_DELAY", "avg_rates_group", "sum_rates_group", "max_delays_group", "min_delays_group"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    base = feature_table(spark, path)
    out = engineered.group_aggregate_features(base, SUGGESTED["aggregation"], "all")
    return out.select(*_ID_COLS, *[c for c in out.columns if c not in base.columns])


def engineered_table(spark, path):
    """The feature table with what its own components suggest, and the names of the new columns."""
    table = settled(feature_table(spark, path))
    built = engineered.engineer_from_report(table, NUMERIC)
    return built, [c for c in built.columns if c not in table.columns]


@query("engineer_all", digits=ROW_DIGITS)
def _(spark, path):
    built, new = engineered_table(spark, path)
    return built.select(*_ID_COLS, *new)


def _known(a: str, b: str) -> str:
    return f"""CASE WHEN var_samp({a}) FILTER ({b} IS NOT NULL) > 0 AND var_samp({b}) FILTER ({a} IS NOT NULL) > 0
      THEN corr({a}, {b}) END"""


@query(
    "feature_correlations",
    with_views(
        "feat",
        "SELECT unnest(["
        + ", ".join(
            f"{{'x': '{a}', 'y': '{b}', 'corr': {_known(min(a, b), max(a, b))}}}" for a in NUMERIC for b in NUMERIC
        )
        + "], recursive := true) FROM feat",
    ),
    ["corr"],
)
def _(spark, path):
    return statistics.correlation_matrix(feature_table(spark, path), NUMERIC)


_RANKED = {
    "dow_X_airline_avg_delay": "dow * airline_avg_delay",
    "dow_squared": "CAST(dow * dow AS DOUBLE)",
    "route_congestion_score": f"greatest({_o_mean}, {_d_mean}) + 0.5E0 * least({_o_mean}, {_d_mean})",
    "sum_rates_group": "total_delay_rate_origin + carrier_delay_rate_origin",
}


@query(
    "rank_new_features",
    with_views(
        "feat",
        " UNION ALL ".join(
            f"SELECT '{n}' AS feature, var_samp(x) AS variance, abs(corr(x, y)) AS correlation_with_target, "
            f"var_samp(x) * abs(corr(x, y)) AS importance_score FROM (SELECT {e} AS x, DEP_DELAY AS y FROM feat) t{i}"
            for i, (n, e) in enumerate(_RANKED.items())
        ),
    ),
    ["variance", "correlation_with_target", "importance_score"],
)
def _(spark, path):
    built = engineered.engineer_all(
        feature_table(spark, path), {k: v for k, v in SUGGESTED.items() if k != "domain_composite"}, "all"
    )
    built = engineered.group_aggregate_features(
        engineered.route_congestion_score(built.select(*K.FEATURES, "DEP_DELAY")), SUGGESTED["aggregation"], "all"
    )
    built = engineered.interaction_features(built, SUGGESTED["interaction"], "all")
    built = engineered.polynomial_features(built, SUGGESTED["polynomial"], "all")
    return engineered.rank_new_features(built, list(_RANKED))


# ---- encodings --------------------------------------------------------------

_NUM = list(K.NUMERIC_FEATURES)


@query(
    "standardize",
    with_views(
        "feat",
        f"SELECT route, OP_CARRIER, {each('({} - avg({}) OVER ()) / stddev_pop({}) OVER () AS {}', _NUM)} FROM feat",
    ),
    _NUM,
    digits=ROW_DIGITS,
)
def _(spark, path):
    base = feature_table(spark, path).select("route", "OP_CARRIER", *_NUM)
    return features.standardize(base, _NUM)


@query(
    "label_encode",
    with_views(
        "feat",
        """SELECT ORIGIN, DEST, OP_CARRIER, route, CAST(dense_rank() OVER (ORDER BY ORIGIN) - 1 AS INT) AS ORIGIN_code,
          CAST(dense_rank() OVER (ORDER BY DEST) - 1 AS INT) AS DEST_code,
          CAST(dense_rank() OVER (ORDER BY OP_CARRIER) - 1 AS INT) AS OP_CARRIER_code,
          CAST(dense_rank() OVER (ORDER BY route) - 1 AS INT) AS route_code FROM feat""",
    ),
)
def _(spark, path):
    base = feature_table(spark, path).select("ORIGIN", "DEST", "OP_CARRIER", "route")
    return features.label_encode(base, ["ORIGIN", "DEST", "OP_CARRIER", "route"])


@query(
    "label_encode_unseen",
    with_views(
        "cf",
        """SELECT c.OP_CARRIER, CAST(coalesce(k.code, 0) AS INT) AS OP_CARRIER_code FROM cf c LEFT JOIN (
          SELECT OP_CARRIER, row_number() OVER (ORDER BY OP_CARRIER) - 1 AS code FROM (
            SELECT DISTINCT OP_CARRIER FROM cf WHERE OP_CARRIER < 'SM') d) k ON c.OP_CARRIER = k.OP_CARRIER""",
    ),
)
def _(spark, path):
    base = feature_table(spark, path).select("OP_CARRIER")
    fitted = {"OP_CARRIER": features.label_codes(base.filter(F.col("OP_CARRIER") < "SM"), "OP_CARRIER")}
    return features.label_encode(base, ["OP_CARRIER"], fitted)


_SLOTS = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) AS INT) AS {c}_slot" for c in ("route", "ORIGIN", "DEST", "OP_CARRIER")
)


@query("one_hot_encode", with_views("feat", f"SELECT route, ORIGIN, DEST, OP_CARRIER, {_SLOTS} FROM feat"))
def _(spark, path):
    from pyspark.ml.functions import vector_to_array

    columns = list(K.CATEGORICAL_FEATURES)
    # Read for the labels of each column and for the rows.
    table = settled(feature_table(spark, path).select(*columns))
    hot = features.one_hot_encode(table, columns)
    # The place of the one in each vector; 0 for none.
    place = [F.array_position(vector_to_array(f"{c}_hot"), 1.0).cast("int").alias(f"{c}_slot") for c in columns]
    return hot.select(*columns, *place)
