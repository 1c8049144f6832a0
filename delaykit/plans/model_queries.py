"""Models, their evaluation, and scoring.

Every model runs with the published settings of ``operators.models`` and all of its
inputs, is fitted to all training rows and measured on the whole test part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators import engineered, models, scoring, splitting
from delaykit.operators.lookups import settled
from delaykit.plans.catalog import ROW_DIGITS, query
from delaykit.plans.feature_queries import engineered_table, feature_table
from delaykit.plans.flight_queries import FLIGHT, clean, lookups, route_table
from delaykit.plans.report_queries import history_report, report
from delaykit.plans.training import feature_parts
from delaykit.plans.views import digest_sql, scenario, with_views
from delaykit.sources import testdata as data

# ---- the historical mean, which SQL can check -------------------------------

_LIST = ", ".join(FLIGHT)
_KEY = digest_sql(FLIGHT, ("DEP_DELAY", "DISTANCE"))
_SPLIT = f"""SELECT {_LIST}, row_number() OVER (ORDER BY FL_DATE, {_KEY}, {_LIST})
  <= floor((SELECT count(*) FROM cf) * (1 - 0.2E0)) AS train FROM cf"""


def _predicted_sql(keys: str) -> str:
    on = " AND ".join(f"t.{k} = m.{k}" for k in keys.split(", "))
    return f"""SELECT t.{_LIST.replace(', ', ', t.')}, coalesce(m.m, (SELECT avg(DEP_DELAY) FROM sp WHERE train)) AS predicted
      FROM sp t LEFT JOIN (SELECT {keys}, avg(DEP_DELAY) AS m FROM sp WHERE train GROUP BY {keys}) m ON {on} WHERE NOT t.train"""


_BY_ROUTE = {"sp": _SPLIT, "pr": _predicted_sql("ORIGIN, DEST")}
_METRICS = """count(*) AS n, avg(abs(DEP_DELAY - predicted)) AS mae,
  sqrt(avg((DEP_DELAY - predicted) * (DEP_DELAY - predicted))) AS rmse,
  1 - avg((DEP_DELAY - predicted) * (DEP_DELAY - predicted)) / var_pop(DEP_DELAY) AS r2"""


def _split(spark, path):
    both = settled(splitting.temporal_split(clean(spark, path)))
    return both.filter("split = 'train'").drop("split"), both.filter("split = 'test'").drop("split")


def _predictions(spark, path, keys=("ORIGIN", "DEST")):
    train, test = _split(spark, path)
    return models.historical_mean_predictor(train, test, keys)


@query(
    "historical_mean_predictor",
    with_views("cf", f"SELECT {_LIST}, predicted FROM pr", **_BY_ROUTE),
    ["DEP_DELAY", "DISTANCE", "predicted"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return _predictions(spark, path).select(*FLIGHT, "predicted")


@query("regression_metrics", with_views("cf", f"SELECT {_METRICS} FROM pr", **_BY_ROUTE), ["mae", "rmse", "r2"])
def regression_metrics(spark, path):
    return models.regression_metrics(_predictions(spark, path))


_STATS = [
    "pred_mean", "pred_std", "pred_min", "pred_max", "actual_mean", "actual_std", "actual_min", "actual_max", "zero_pct",
]


@query(
    "prediction_stats",
    with_views(
        "cf",
        """SELECT avg(predicted) AS pred_mean, stddev_pop(predicted) AS pred_std, min(predicted) AS pred_min, max(predicted) AS pred_max,
          avg(DEP_DELAY) AS actual_mean, stddev_samp(DEP_DELAY) AS actual_std, min(DEP_DELAY) AS actual_min, max(DEP_DELAY) AS actual_max,
          count(*) FILTER (WHERE predicted = 0) AS zero_predictions,
          avg(CASE WHEN predicted = 0 THEN 1.0E0 ELSE 0.0E0 END) * 100 AS zero_pct FROM pr""",
        **_BY_ROUTE,
    ),
    _STATS,
)
def _(spark, path):
    return models.prediction_stats(_predictions(spark, path))


_FOLD = f"CAST('0x' || substr({_KEY}, 1, 8) AS BIGINT) % 5"


@query(
    "cv_mae",
    with_views(
        "cf",
        """SELECT t.fold, count(*) AS n, avg(abs(t.DEP_DELAY - coalesce((k.ks - f.fs) / nullif(k.kn - f.fn, 0), (a.s - g.s) / (a.n - g.n)))) AS mae
        FROM t JOIN (SELECT ORIGIN, DEST, sum(DEP_DELAY) AS ks, count(*) AS kn FROM t GROUP BY 1, 2) k
            ON t.ORIGIN = k.ORIGIN AND t.DEST = k.DEST
          JOIN (SELECT ORIGIN, DEST, fold, sum(DEP_DELAY) AS fs, count(*) AS fn FROM t GROUP BY 1, 2, 3) f
            ON t.ORIGIN = f.ORIGIN AND t.DEST = f.DEST AND t.fold = f.fold
          JOIN (SELECT fold, sum(DEP_DELAY) AS s, count(*) AS n FROM t GROUP BY 1) g ON t.fold = g.fold,
          (SELECT sum(DEP_DELAY) AS s, count(*) AS n FROM t) a
        GROUP BY t.fold""",
        t=f"SELECT *, CAST({_FOLD} AS INT) AS fold FROM cf",
    ),
    ["mae"],
)
def _(spark, path):
    return models.cv_mae(clean(spark, path), ["ORIGIN", "DEST"])


_KEYED = {"by_route": ("ORIGIN", "DEST"), "by_origin": ("ORIGIN",), "by_carrier": ("OP_CARRIER",)}
_CANDIDATES = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS model, {_METRICS} FROM ({_predicted_sql(', '.join(keys))}) p{i}"
    for i, (name, keys) in enumerate(_KEYED.items())
)


def _candidates(spark, path):
    train, test = _split(spark, path)
    out = None
    for i, (name, keys) in enumerate(_KEYED.items()):
        row = models.regression_metrics(models.historical_mean_predictor(train, test, keys)).select(
            F.lit(i).alias("position"), F.lit(name).alias("model"), "n", "mae", "rmse", "r2"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "select_best",
    with_views(
        "cf", "SELECT model, mae, rmse, r2 FROM c ORDER BY mae, position LIMIT 1", sp=_SPLIT, c=_CANDIDATES
    ),
    ["mae", "rmse", "r2"],
)
def _(spark, path):
    return models.select_best(_candidates(spark, path))


@query(
    "compare_baseline",
    with_views(
        "cf",
        """SELECT model, mae, 15.0E0 AS baseline_mae, 15.0E0 - mae AS improvement, (15.0E0 - mae) * 100 / 15.0E0 AS improvement_pct FROM c""",
        sp=_SPLIT, c=_CANDIDATES,
    ),
    ["mae", "baseline_mae", "improvement", "improvement_pct"],
)
def _(spark, path):
    compared = models.compare_baseline(_candidates(spark, path))
    return compared.select("model", "mae", "baseline_mae", "improvement", "improvement_pct")


@query(
    "residual_table",
    with_views(
        "cf", "SELECT ORIGIN, DEST, DEP_DELAY, predicted, DEP_DELAY - predicted AS residual FROM pr", **_BY_ROUTE
    ),
    ["DEP_DELAY", "predicted", "residual"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return models.residual_table(_predictions(spark, path)).select(
        "ORIGIN", "DEST", "DEP_DELAY", "predicted", "residual"
    )


def _histogram_sql(bins: int) -> str:
    each = " UNION ALL ".join(
        f"""SELECT '{c}' AS series, CAST(least({bins - 1}, floor(({c} - lo) / ((hi - lo) / {bins}))) + 1 AS BIGINT) AS bin,
          lo, (hi - lo) / {bins} AS width, total FROM pr,
          (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS total FROM pr) b"""
        for c in ("DEP_DELAY", "predicted")
    )
    return f"""SELECT series, bin, count(*) AS n, min(lo + width * (bin - 1)) AS bin_start,
      count(*) / min(total * width) AS density FROM ({each}) h GROUP BY series, bin"""


for _bins in (20, 50):

    @query(f"density_histogram_{_bins}", with_views("cf", _histogram_sql(_bins), **_BY_ROUTE), ["bin_start", "density"])
    def _(spark, path, bins=_bins):
        """Actual and predicted delays of the test part."""
        return models.density_histogram(settled(_predictions(spark, path)), [models.TARGET, "predicted"], bins)


# ---- scoring ----------------------------------------------------------------


def _r1(e: str) -> str:
    return f"round_even({e}, 1)"


_P = scenario("origin_avg_delay", "airline_avg_delay", "is_weekend", "dep_hour", "DISTANCE")
_BATCH = [
    "predicted_delay", "confidence_mae", "lower_bound", "upper_bound", "carrier_avg_delay", "origin_avg_delay",
    "origin_delay_rate", "dest_avg_delay", "dest_delay_rate",
]


@query(
    "score_batch",
    with_views(
        "serv",
        f"""SELECT query_id, rank, flight_date, dep_hour, {_r1('p')} AS predicted_delay, 12.5E0 AS confidence_mae,
          {_r1('p - 12.5E0')} AS lower_bound, {_r1('p + 12.5E0')} AS upper_bound, OP_CARRIER AS carrier, ORIGIN AS origin, DEST AS dest,
          {_r1('carrier_avg_delay')} AS carrier_avg_delay, {_r1('origin_avg_delay')} AS origin_avg_delay,
          {_r1('total_delay_rate_origin * 100')} AS origin_delay_rate, {_r1('avg_delay_minutes_dest')} AS dest_avg_delay,
          {_r1('total_delay_rate_dest * 100')} AS dest_delay_rate FROM (SELECT *, {_P} AS p FROM serv) s""",
    ),
    _BATCH,
)
def score_batch(spark, path):
    return scoring.score_batch(data.requests(spark, path), *lookups(spark, path), route_table(spark, path))


_mix = (
    "(" + " + ".join(f"{r} * {a}" for r, a in zip(K.CAUSE_RATES, K.CAUSE_AVERAGES)) + ") / ("
    + " + ".join(K.CAUSE_RATES) + ")"
)
_GATED = [
    "predicted_delay", "confidence_mae", "lower_bound", "upper_bound", "carrier_avg_delay", "origin_delay_rate", "dest_delay_rate",
]


@query(
    "score_gated",
    with_views(
        "avail",
        """SELECT query_id, rank, carrier, origin, dest, flight_date, dep_hour,
          CASE WHEN k THEN p END AS predicted_delay, CASE WHEN k THEN 5.0E0 END AS confidence_mae,
          CASE WHEN k THEN greatest(0.0E0, p - 5.0E0) END AS lower_bound, CASE WHEN k THEN p + 5.0E0 END AS upper_bound,
          CASE WHEN k THEN avg_carrier_delay END AS carrier_avg_delay, CASE WHEN k THEN total_delay_rate * 100 END AS origin_delay_rate,
          CASE WHEN k THEN coalesce(dest_delay_rate, 0.0E0) * 100 END AS dest_delay_rate,
          has_carrier AS knows_carrier, has_origin AS knows_origin, has_dest AS knows_dest,
          false AS using_fallback_data, k AS prediction_available,
          CASE WHEN k THEN 'Prediction based on available data: ' || concat_ws(', ', CASE WHEN has_carrier THEN 'carrier' END,
              CASE WHEN has_origin THEN 'origin' END, CASE WHEN has_dest THEN 'dest' END)
            ELSE 'No historical data found for carrier ' || carrier || ', origin ' || origin || ', or destination ' || dest
              || '. Cannot generate prediction.' END AS message FROM s""",
        s=f"SELECT *, has_carrier OR has_origin OR has_dest AS k, {_mix} AS p FROM avail",
    ),
    _GATED,
    digits=ROW_DIGITS,
)
def _(spark, path):
    out = scoring.score_gated(data.requests(spark, path), *lookups(spark, path))
    known = F.col("data_availability")
    return out.withColumns({f"knows_{p}": known[p] for p in ("carrier", "origin", "dest")}).drop("data_availability")


def _points(spark, path):
    return data.history(spark, path).select("history_key", "predicted_delay", "confidence_mae")


@query(
    "confidence_band",
    with_views(
        "keyed",
        """SELECT history_key, predicted_delay, confidence_mae, greatest(0.0E0, predicted_delay - confidence_mae) AS lower_bound,
          predicted_delay + confidence_mae AS upper_bound FROM keyed""",
    ),
    ["predicted_delay", "lower_bound", "upper_bound"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return scoring.confidence_band(_points(spark, path))


@query(
    "confidence_band_unclamped",
    with_views(
        "keyed",
        f"""SELECT history_key, {_r1('p')} AS predicted_delay, {_r1('h')} AS confidence_mae, {_r1('p - h')} AS lower_bound,
          {_r1('p + h')} AS upper_bound FROM (SELECT history_key, greatest(0.0E0, sqrt(predicted_delay) - 3) AS p, 7.3E0 AS h FROM keyed) t""",
    ),
    ["predicted_delay", "lower_bound", "upper_bound"],
)
def _(spark, path):
    shifted = _points(spark, path).withColumns(
        {"predicted_delay": F.sqrt("predicted_delay") - 3, "confidence_mae": F.lit(7.3)}
    )
    return scoring.confidence_band_unclamped(shifted)


# ---- fitted models ----------------------------------------------------------


def _training_parts(spark, path):
    """Features split by date; encodings fitted on the training part only."""
    return feature_parts(clean(spark, path), history_report(spark, path))


def _measured(name, learner, spark, path, weight=False):
    train, test = _training_parts(spark, path)
    if weight:
        train = models.with_weights(train)
    _, metrics = models.train_and_evaluate({name: learner}, train, test)
    return metrics


@query("train_linear")
def _(spark, path):
    return _measured("linear", models.pipeline(models.linear()), spark, path)


@query("train_forest")
def _(spark, path):
    return _measured("random_forest", models.forest("flights"), spark, path)


@query("train_gbt")
def _(spark, path):
    return _measured("gradient_boosting", models.booster("airport_month"), spark, path)


@query("train_gbt_weighted")
def _(spark, path):
    return _measured("weighted_boosting", models.weighted_booster(), spark, path, weight=True)


AIRPORT = {
    "numeric": tuple(K.AIRPORT_MODEL_NUMERIC), "categorical": tuple(K.AIRPORT_MODEL_CATEGORICAL),
    "target": "avg_delay_minutes",
}


def airport_model(spark, path, causes=None):
    """Forest over carrier, airport and month, split within each airport."""
    table = report(spark, path, causes).select(*AIRPORT["numeric"], *AIRPORT["categorical"], AIRPORT["target"])
    parts = settled(splitting.stratified_split(settled(table), "airport"))
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    return models.forest("airport_month", **AIRPORT).fit(train), train, test


@query("train_airport_forest")
def _(spark, path):
    model, _, test = airport_model(spark, path)
    return models.regression_metrics(models.scored(model, test), "avg_delay_minutes")


@query("model_importance")
def _(spark, path):
    model, train, _ = airport_model(spark, path)
    return models.model_importance(model, train)


@query("score_gated_model")
def _(spark, path):
    # The report is summed up from the facts once, for the model and the lookups.
    causes = settled(data.delay_cause(spark, path))
    model, _, test = airport_model(spark, path, causes)
    mae = models.regression_metrics(models.scored(model, test), "avg_delay_minutes").first()["mae"]
    out = scoring.score_gated(data.requests(spark, path), *lookups(spark, path, causes), scorer=model, mae=mae)
    return out.drop("data_availability")


@query("score_batch_model")
def _(spark, path):
    train, test = _training_parts(spark, path)
    model = models.pipeline(models.linear()).fit(train)
    mae = models.regression_metrics(models.scored(model, test)).first()["mae"]
    return scoring.score_batch(
        data.requests(spark, path), *lookups(spark, path), route_table(spark, path), scorer=model, mae=mae
    )


@query("cv_mae_model")
def _(spark, path):
    """Forest and booster over carrier, airport and month, each over folds of the rows' content."""
    columns = [*AIRPORT["numeric"], *AIRPORT["categorical"], AIRPORT["target"]]
    rows = settled(report(spark, path).select(*columns).na.drop())
    out = None
    for name, make in (("forest", models.forest), ("booster", models.booster)):
        row = models.cross_validated_mae(make("airport_month", **AIRPORT), rows).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("engineered_impact")
def _(spark, path):
    built, new = engineered_table(spark, path)
    numeric, _ = select_numeric(built.select(*new))
    return models.engineered_impact(engineered.rank_new_features(built, numeric))


@query("retrain_with_engineered")
def _(spark, path):
    """Forest on every numeric column with the new features, against the plain ones."""
    built, _ = engineered_table(spark, path)
    numeric, _ = select_numeric(built)
    plain = [c for c in numeric if c in K.FEATURES]
    parts = settled(splitting.random_split(settled(built.select(*numeric, "DEP_DELAY"))))
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    _, metrics = models.train_and_evaluate(
        {
            "plain": models.forest("engineered", numeric=tuple(plain), categorical=()),
            "engineered": models.forest("engineered", numeric=tuple(numeric), categorical=()),
        },
        train, test,
    )
    base = metrics.filter("model = 'plain'").select("mae").scalar()
    return models.compare_baseline(metrics, base)


def select_numeric(df):
    from delaykit.operators.cleaning import select_features

    return select_features(df, target="DEP_DELAY")
