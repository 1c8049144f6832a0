"""Cleaning, metrics, summaries and rankings of delay-cause reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import numbers
from delaykit.operators import cleaning, enrichment, metrics, summaries
from delaykit.operators import history as past
from delaykit.operators.splitting import sample_keys, stratified_split
from delaykit.plans.catalog import ROW_DIGITS, query
from delaykit.plans.views import HUBS, digest_sql, each, number, strip, with_views
from delaykit.sources import testdata as data
from delaykit.sources.csv_files import union_sources

KEYS = ("year", "month", "carrier", "airport")


def report(spark, path, causes=None):
    causes = data.delay_cause(spark, path) if causes is None else causes
    return metrics.delay_metrics(cleaning.clean_delay_cause(causes))


def history_report(spark, path):
    return metrics.delay_history(data.delay_cause(spark, path))


def hist(spark, path, causes=None):
    causes = data.delay_cause(spark, path) if causes is None else causes
    return causes.transform(metrics.delay_rates_safe).transform(metrics.avg_delay_minutes_safe)


# ---- cleaning ---------------------------------------------------------------

_measures = [c for c in K.REPORT_NUMERIC if c not in ("year", "month")]


@query(
    "coerce_numeric",
    with_views(
        "dirty_dc",
        f"""SELECT carrier_name, airport, year, month, {number('arr_flights')} AS arr_flights,
        {number('weather_ct')} AS weather_ct FROM dirty_dc""",
    ),
    ["arr_flights", "weather_ct"],
)
def _(spark, path):
    df = cleaning.coerce_numeric(data.dirty_delay_cause(spark, path), ["arr_flights", "weather_ct"])
    return df.select("carrier_name", "airport", "year", "month", "arr_flights", "weather_ct")


@query(
    "normalize_codes",
    with_views(
        "dirty_flights",
        f"""SELECT upper({strip('OP_CARRIER')}) AS OP_CARRIER, {strip('FL_NUM')} AS FL_NUM,
        upper({strip('ORIGIN')}) AS ORIGIN, upper({strip('DEST')}) AS DEST FROM dirty_flights""",
    ),
)
def _(spark, path):
    raw = data.dirty_flights(spark, path)
    coded = cleaning.normalize_codes(raw, ["OP_CARRIER", "ORIGIN", "DEST"])
    return coded.select(
        "OP_CARRIER", F.regexp_replace("FL_NUM", r"^\s+|\s+$", "").alias("FL_NUM"), "ORIGIN", "DEST"
    )


@query(
    "clean_delay_cause",
    with_views(
        "dirty_dc",
        f"""SELECT year, month, upper({strip('carrier')}) AS carrier, airport,
        {number('arr_flights')} AS arr_flights, {number('weather_ct')} AS weather_ct, arr_del15
        FROM dirty_dc WHERE carrier IS NOT NULL AND {number('arr_flights')} > 0""",
    ),
    ["arr_flights", "weather_ct", "arr_del15"],
)
def _(spark, path):
    return cleaning.clean_delay_cause(data.dirty_delay_cause(spark, path)).select(
        *KEYS, "arr_flights", "weather_ct", "arr_del15"
    )


_profile_cols = [
    ("year", "int"), ("month", "int"), ("carrier", "string"), ("airport", "string"),
    ("arr_flights", "double"), ("weather_ct", "double"),
]


@query(
    "profile_table",
    with_views(
        "dirty_dc",
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
            f"count(x) AS n_filled, count(*) - count(x) AS n_null, count(DISTINCT x) AS n_distinct "
            f"FROM (SELECT {number(c) if t == 'double' else c} AS x FROM dirty_dc) v{i}"
            for i, (c, t) in enumerate(_profile_cols)
        ),
    ),
)
def _(spark, path):
    df = cleaning.coerce_numeric(data.dirty_delay_cause(spark, path), ["arr_flights", "weather_ct"])
    return cleaning.profile_table(df.select(*[c for c, _ in _profile_cols]))


# ---- metrics ----------------------------------------------------------------

_rates = [f"{c}_delay_rate" for c in K.CAUSES]
_strict_rates = ["total_delay_rate", "cancellation_rate", "diversion_rate", *_rates]
_avgs = ["avg_delay_minutes", *K.CAUSE_AVERAGES]


def _zero_flights(spark, path):
    """The report with months whose counts are zero or unknown."""
    df = data.delay_cause(spark, path)
    n = F.col("year") * 12 + F.col("month")
    return df.withColumns(
        {
            "arr_flights": F.when(n % 7 == 0, F.lit(0.0)).otherwise(F.col("arr_flights")),
            "nas_ct": F.when(n % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("nas_ct")),
        }
    )


_ZERO = """SELECT * REPLACE (
  CASE WHEN (year * 12 + month) % 7 = 0 THEN 0.0E0 ELSE arr_flights END AS arr_flights,
  CASE WHEN (year * 12 + month) % 11 = 0 THEN NULL ELSE nas_ct END AS nas_ct) FROM dc"""


def _safe(n: str, d: str) -> str:
    return f"{n} / (CASE WHEN {d} = 0 THEN 1.0E0 ELSE {d} END)"


@query(
    "delay_rates_strict",
    with_views("dcm", f"SELECT {', '.join(KEYS)}, {', '.join(_strict_rates)} FROM dcm"),
    _strict_rates,
)
def _(spark, path):
    df = cleaning.clean_delay_cause(data.delay_cause(spark, path))
    return metrics.delay_rates_strict(df).select(*KEYS, *_strict_rates)


@query(
    "delay_rates_safe",
    with_views(
        "dc",
        f"SELECT {', '.join(KEYS)}, {_safe('arr_del15', 'arr_flights')} AS total_delay_rate, "
        + ", ".join(f"{_safe(c + '_ct', 'arr_flights')} AS {c}_delay_rate" for c in K.CAUSES)
        + " FROM z",
        z=_ZERO,
    ),
    ["total_delay_rate", *_rates],
)
def _(spark, path):
    return metrics.delay_rates_safe(_zero_flights(spark, path)).select(*KEYS, "total_delay_rate", *_rates)


@query(
    "avg_delay_minutes_strict",
    with_views(
        "dc",
        f"SELECT {', '.join(KEYS)}, CASE WHEN arr_del15 > 0 THEN arr_delay / arr_del15 ELSE 0.0E0 END AS avg_delay_minutes, "
        + each("CASE WHEN {}_ct > 0 THEN {}_delay / {}_ct ELSE 0.0E0 END AS avg_{}_delay")
        + " FROM z",
        z=_ZERO,
    ),
    _avgs,
)
def _(spark, path):
    return metrics.avg_delay_minutes_strict(_zero_flights(spark, path)).select(*KEYS, *_avgs)


@query(
    "avg_delay_minutes_safe",
    with_views(
        "dc",
        f"SELECT {', '.join(KEYS)}, {_safe('arr_delay', 'arr_del15')} AS avg_delay_minutes, "
        + ", ".join(f"{_safe(c + '_delay', c + '_ct')} AS avg_{c}_delay" for c in K.CAUSES)
        + " FROM z",
        z=_ZERO,
    ),
    _avgs,
)
def _(spark, path):
    return metrics.avg_delay_minutes_safe(_zero_flights(spark, path)).select(*KEYS, *_avgs)


_total = "(" + each("{}_ct", sep=" + ") + ")"


@query(
    "delay_cause_pct",
    with_views(
        "dc",
        f"SELECT {', '.join(KEYS)}, "
        + each(f"{{}}_ct / (CASE WHEN {_total} > 0 THEN {_total} ELSE 1.0E0 END) * 100 AS {{}}_delay_pct")
        + " FROM z",
        z=_ZERO,
    ),
    K.CAUSE_SHARES,
)
def _(spark, path):
    return metrics.delay_cause_pct(_zero_flights(spark, path)).select(*KEYS, *K.CAUSE_SHARES)


@query("month_start_date", with_views("dc", "SELECT DISTINCT year, month, make_date(year, month, 1) AS date FROM dc"))
def _(spark, path):
    return metrics.with_month_start(data.delay_cause(spark, path)).select("year", "month", "date").distinct()


@query(
    "filter_hubs",
    with_views("dc", f"SELECT {', '.join(KEYS)}, arr_flights FROM dc WHERE airport IN {HUBS}"),
)
def _(spark, path):
    return cleaning.filter_hubs(data.delay_cause(spark, path), data.HUBS).select(*KEYS, "arr_flights")


# ---- summaries --------------------------------------------------------------


def _summary_sql(keys: str, sums, means, extra: str = "") -> str:
    return with_views(
        "dcm",
        f"SELECT {keys}, {each('sum({}) AS {}', list(sums))}, {each('avg({}) AS {}', list(means))}{extra} "
        f"FROM dcm GROUP BY {keys}",
    )


_ALL = list(K.SUMMED + K.AVERAGED)


@query("airport_summary", _summary_sql("airport, year, month", K.SUMMED, K.AVERAGED), _ALL)
def _(spark, path):
    return summaries.airport_summary(report(spark, path))


@query("carrier_summary", _summary_sql("carrier, year, month", K.SUMMED, K.AVERAGED), _ALL)
def _(spark, path):
    return summaries.carrier_summary(report(spark, path))


_TREND_SUMS = ("arr_flights", "arr_del15", "arr_delay")
_TREND_MEANS = ("total_delay_rate", "avg_delay_minutes") + K.CAUSE_SHARES[:3]


@query(
    "monthly_trends",
    _summary_sql("year, month", _TREND_SUMS, _TREND_MEANS, ", make_date(year, month, 1) AS date"),
    _TREND_SUMS + _TREND_MEANS,
)
def monthly_trends(spark, path):
    return summaries.monthly_trends(report(spark, path))


@query(
    "carrier_airport_month_lookup",
    with_views("lk", f"SELECT carrier, airport, year, month, arr_flights, {', '.join(K.HISTORY)} FROM lk"),
    ("arr_flights",) + K.HISTORY,
)
def _(spark, path):
    return summaries.carrier_airport_month_lookup(history_report(spark, path))


@query("airport_lookup", with_views("la", "SELECT * FROM la"), K.HISTORY_ORIGIN)
def _(spark, path):
    return summaries.airport_lookup(hist(spark, path))


@query("carrier_lookup", with_views("lc", "SELECT * FROM lc"), K.HISTORY_ORIGIN)
def _(spark, path):
    return summaries.carrier_lookup(hist(spark, path))


@query(
    "cause_totals_share",
    with_views(
        "dcm",
        "SELECT cause, delays, delays * 100.0E0 / sum(delays) OVER () AS share_pct FROM s",
        s=" UNION ALL ".join(f"SELECT '{c}' AS cause, sum({c}_ct) AS delays FROM dcm" for c in K.CAUSES),
    ),
    ["delays", "share_pct"],
)
def _(spark, path):
    return summaries.cause_totals_share(report(spark, path))


@query(
    "dataset_kpis",
    with_views(
        "dcm",
        """SELECT count(*) AS n_records, count(DISTINCT airport) AS n_airports, count(DISTINCT carrier) AS n_carriers,
        min(year) AS min_year, max(year) AS max_year, min(month) AS min_month, max(month) AS max_month,
        sum(arr_flights) AS total_flights, sum(arr_del15) AS total_delays,
        sum(arr_del15) * 100.0E0 / sum(arr_flights) AS delay_rate_pct,
        avg(avg_delay_minutes) AS mean_delay_minutes FROM dcm""",
    ),
    ["total_flights", "total_delays", "delay_rate_pct", "mean_delay_minutes"],
)
def _(spark, path):
    return summaries.dataset_kpis(report(spark, path))


@query(
    "kpis_by_year",
    with_views(
        "dcm",
        """SELECT year, count(*) AS n_records, count(DISTINCT airport) AS n_airports,
        count(DISTINCT carrier) AS n_carriers, min(month) AS min_month, max(month) AS max_month,
        sum(arr_flights) AS total_flights, sum(arr_del15) AS total_delays,
        sum(arr_del15) * 100.0E0 / sum(arr_flights) AS delay_rate_pct,
        avg(avg_delay_minutes) AS mean_delay_minutes FROM dcm GROUP BY year""",
    ),
    ["total_flights", "total_delays", "delay_rate_pct", "mean_delay_minutes"],
)
def _(spark, path):
    months = summaries.monthly_sketches(report(spark, path))
    return summaries.kpis_from_sketches(months, ["year"]).drop("min_year", "max_year")


_AIR_RANK = "SELECT airport, avg(avg_delay_minutes) AS mean_delay FROM dcm GROUP BY airport"


@query("airport_ranking", with_views("dcm", _AIR_RANK), ["mean_delay"])
def _(spark, path):
    return summaries.airport_ranking(report(spark, path))


_STATS = ["overall_mean", "span", "worst_mean", "best_mean", "highest", "lowest"]


def _stats_sql(table: str, key: str, value: str) -> str:
    return f"""SELECT avg({value}) AS overall_mean, max({value}) - min({value}) AS span, count(*) AS n_groups,
      avg(CASE WHEN w <= 5 THEN {value} END) AS worst_mean, avg(CASE WHEN b <= 5 THEN {value} END) AS best_mean,
      max({value}) AS highest, min({value}) AS lowest
    FROM (SELECT *, row_number() OVER (ORDER BY {value} DESC, {key}) AS w,
      row_number() OVER (ORDER BY {value}, {key} DESC) AS b FROM {table}) t"""


@query(
    "airport_ranking_statistics",
    with_views("dcm", _stats_sql("r", "airport", "mean_delay"), r=_AIR_RANK),
    _STATS,
)
def _(spark, path):
    return summaries.ranking_statistics(summaries.airport_ranking(report(spark, path)))


_CAR_RANK = """SELECT carrier_name, round(avg(avg_delay_minutes), 2) AS mean, count(avg_delay_minutes) AS count,
  round(stddev_samp(avg_delay_minutes), 2) AS std FROM dcm GROUP BY carrier_name"""


@query("carrier_ranking", with_views("dcm", _CAR_RANK))
def _(spark, path):
    return summaries.carrier_ranking(report(spark, path))


@query(
    "carrier_ranking_statistics",
    with_views(
        "dcm",
        _stats_sql("r", "carrier_name", "mean"),
        r="SELECT carrier_name, avg(avg_delay_minutes) AS mean FROM dcm GROUP BY carrier_name",
    ),
    _STATS,
)
def _(spark, path):
    ranked = summaries.carrier_ranking(report(spark, path), digits=12)
    return summaries.ranking_statistics(ranked, "carrier_name", "mean")


_PROFILE = ("avg_delay_minutes", "avg_weather_delay", "avg_late_aircraft_delay", "weather_delay_rate", "late_aircraft_delay_rate")


@query(
    "month_profile",
    with_views("dcm", f"SELECT month, {each('round(avg({}), 2) AS {}', _PROFILE)} FROM dcm GROUP BY month"),
)
def _(spark, path):
    return summaries.month_profile(report(spark, path))


def _rollup_cte(key: str) -> dict[str, str]:
    s = (
        f"SELECT {key}, year, month, sum(arr_flights) AS arr_flights, "
        f"{each('avg({}) AS {}', list(K.AVERAGED))} FROM dcm GROUP BY {key}, year, month"
    )
    r = (
        f"SELECT {key}, avg(total_delay_rate) AS total_delay_rate, avg(avg_delay_minutes) AS avg_delay_minutes, "
        f"sum(arr_flights) AS arr_flights, {each('avg({}) AS {}', K.CAUSE_SHARES[:3])} FROM s GROUP BY {key}"
    )
    return {"s": s, "r": r}


_ROLLED = ("total_delay_rate", "avg_delay_minutes", "arr_flights") + K.CAUSE_SHARES[:3]


def _rollup(spark, path, key):
    build = summaries.airport_summary if key == "airport" else summaries.carrier_summary
    return summaries.summary_rollup(build(report(spark, path)), key)


@query("carrier_rollup", with_views("dcm", "SELECT * FROM r", **_rollup_cte("carrier")), _ROLLED)
def _(spark, path):
    return _rollup(spark, path, "carrier")


@query("airport_rollup", with_views("dcm", "SELECT * FROM r", **_rollup_cte("airport")), _ROLLED)
def _(spark, path):
    return _rollup(spark, path, "airport")


for _name, _key, _by in (
    ("top_carriers_by_rate", "carrier", "total_delay_rate"),
    ("top_carriers_by_minutes", "carrier", "avg_delay_minutes"),
    ("top_airports_by_rate", "airport", "total_delay_rate"),
):

    @query(
        _name,
        with_views(
            "dcm", f"SELECT {_key}, {_by} FROM r ORDER BY {_by} DESC, {_key} LIMIT 15", **_rollup_cte(_key)
        ),
        [_by],
    )
    def _(spark, path, key=_key, by=_by):
        return summaries.top_groups(_rollup(spark, path, key), key, by)


for _key in ("carrier", "airport"):

    @query(
        f"top_causes_by_{_key}",
        with_views(
            "dcm",
            " UNION ALL ".join(f"SELECT {_key}, '{c}' AS cause, {c} AS pct FROM t" for c in K.CAUSE_SHARES[:3]),
            **_rollup_cte(_key),
            t=f"SELECT * FROM r ORDER BY carrier_delay_pct DESC, {_key} LIMIT 10",
        ),
        ["pct"],
    )
    def _(spark, path, key=_key):
        return summaries.top_causes(_rollup(spark, path, key), key)

    @query(
        f"volume_vs_rate_by_{_key}",
        with_views(
            "dcm", f"SELECT {_key}, arr_flights, total_delay_rate, avg_delay_minutes FROM r", **_rollup_cte(_key)
        ),
        ["arr_flights", "total_delay_rate", "avg_delay_minutes"],
    )
    def _(spark, path, key=_key):
        return summaries.volume_vs_rate(_rollup(spark, path, key), key)


@query(
    "volume_vs_rate_points",
    with_views("dcm", "SELECT carrier, arr_flights, total_delay_rate FROM dcm"),
    ["arr_flights", "total_delay_rate"],
)
def _(spark, path):
    return report(spark, path).select("carrier", "arr_flights", "total_delay_rate")


@query(
    "top_bottom_groups",
    with_views(
        "dcm",
        """SELECT 'top' AS side, airport, mean_delay FROM (SELECT * FROM r ORDER BY mean_delay DESC, airport LIMIT 5) a
        UNION ALL SELECT 'bottom', airport, mean_delay FROM (SELECT * FROM r ORDER BY mean_delay, airport DESC LIMIT 5) b""",
        r=_AIR_RANK,
    ),
    ["mean_delay"],
)
def _(spark, path):
    ranking = summaries.airport_ranking(report(spark, path))
    return summaries.top_bottom_groups(ranking, "airport", "mean_delay")


# ---- distinct, first, sample, split, union ----------------------------------


@query("distinct_combinations", with_views("dc", "SELECT DISTINCT carrier, airport, month FROM dc"))
def _(spark, path):
    return summaries.distinct_combinations(data.delay_cause(spark, path))


@query(
    "first_record_per_key",
    with_views(
        "dcm",
        """SELECT carrier, airport, year, month, arr_flights, arr_del15, avg_delay_minutes FROM (
        SELECT *, row_number() OVER (PARTITION BY carrier, airport ORDER BY year, month) AS rn FROM dcm) t WHERE rn = 1""",
    ),
    ["arr_flights", "arr_del15", "avg_delay_minutes"],
)
def _(spark, path):
    first = past.first_record_per_key(report(spark, path))
    return first.select("carrier", "airport", "year", "month", "arr_flights", "arr_del15", "avg_delay_minutes")


_COMBO = digest_sql(["carrier", "airport"])


@query(
    "sample_keys",
    with_views(
        "dc",
        f"""SELECT carrier, airport FROM (SELECT DISTINCT carrier, airport FROM dc) t
        ORDER BY {_COMBO}, carrier, airport LIMIT 60""",
    ),
)
def _(spark, path):
    return sample_keys(data.delay_cause(spark, path), n=60)


_SPLIT_COLS = ["year", "month", "carrier", "airport", "arr_flights", "arr_del15", "arr_delay"]
_SPLIT_KEY = digest_sql(_SPLIT_COLS, ("arr_flights", "arr_del15", "arr_delay"))


@query(
    "stratified_split",
    with_views(
        "dc",
        f"""SELECT {', '.join('d.' + c for c in _SPLIT_COLS)},
          CASE WHEN row_number() OVER (PARTITION BY d.airport ORDER BY {_SPLIT_KEY.replace('airport', 'd.airport')},
            year, month, carrier) <= q.quota THEN 'train' ELSE 'test' END AS split
        FROM dc d JOIN q ON d.airport = q.airport""",
        sz="SELECT airport, count(*) AS n, sum(count(*)) OVER () AS t FROM dc GROUP BY airport",
        fl="SELECT airport, n, t - ceil(t * 0.2E0) AS want, n * (t - ceil(t * 0.2E0)) / t AS exact FROM sz",
        q="""SELECT airport, floor(exact) + CASE WHEN row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, airport)
          <= want - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM fl""",
    ),
)
def _(spark, path):
    return stratified_split(data.delay_cause(spark, path).select(*_SPLIT_COLS), "airport")


@query(
    "union_sources",
    with_views(
        "dc",
        """SELECT carrier, airport, arr_flights, CAST(NULL AS DOUBLE) AS arr_delay FROM dc WHERE month <= 6
        UNION ALL SELECT carrier, NULL, NULL, arr_delay FROM dc WHERE month > 3""",
    ),
    ["arr_flights", "arr_delay"],
)
def _(spark, path):
    dc = data.delay_cause(spark, path)
    return union_sources(
        [
            dc.filter("month <= 6").select("carrier", "airport", "arr_flights"),
            dc.filter("month > 3").select("carrier", "arr_delay"),
        ]
    )


@query(
    "route_pairs",
    with_views(
        "dc",
        """SELECT a.airport AS origin, string_agg(b.airport, ',' ORDER BY b.airport) AS dest_options
        FROM (SELECT DISTINCT airport FROM dc) a JOIN (SELECT DISTINCT airport FROM dc) b ON a.airport <> b.airport
        GROUP BY a.airport""",
    ),
)
def _(spark, path):
    pairs = enrichment.route_pairs(data.delay_cause(spark, path))
    return pairs.withColumn("dest_options", F.array_join("dest_options", ","))


# ---- grid -------------------------------------------------------------------

_GRID_ORIGIN = ", ".join(f"a.{c}_origin" for c in K.HISTORY)
_GRID_DEST = ", ".join(f"c.{c}_origin AS {c}_dest" for c in K.HISTORY)


@query(
    "expected_delay_grid",
    with_views(
        "dch la lc",
        f"""SELECT CAST(h.v AS INT) AS dep_hour, CAST(d.v AS INT) AS dow, b.month,
          CASE WHEN d.v >= 5 THEN 1 ELSE 0 END AS is_weekend,
          {float(K.GRID_DISTANCE)}E0 AS DISTANCE, b.airport || '-XXX' AS route, b.airport AS ORIGIN, 'XXX' AS DEST, b.carrier AS OP_CARRIER,
          b.avg_delay_minutes AS route_avg_delay, a.avg_delay_minutes_origin AS origin_avg_delay,
          c.avg_delay_minutes_origin AS airline_avg_delay,
          {_GRID_ORIGIN}, {_GRID_DEST},
          greatest(0.0E0, b.avg_delay_minutes
            * (CASE WHEN h.v IN (7, 8, 9, 17, 18, 19) THEN 1.2E0 WHEN h.v IN (22, 23, 0, 1, 2, 3, 4, 5) THEN 0.8E0 ELSE 1.0E0 END)
            * (CASE WHEN d.v >= 5 THEN 1.1E0 ELSE 1.0E0 END)
            * (CASE WHEN b.month IN (6, 7, 8) THEN 1.15E0 WHEN b.month IN (12, 1, 2) THEN 1.1E0 ELSE 1.0E0 END)) AS ARR_DELAY
        FROM b JOIN la a ON b.airport = a.ORIGIN JOIN lc c ON b.carrier = c.OP_CARRIER,
          range(24) AS h(v), range(7) AS d(v)""",
        b="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY carrier, airport, month ORDER BY year) AS rn FROM dch) t
          WHERE rn = 1""",
    ),
    (*K.ENCODINGS, *K.HISTORY_ORIGIN, *K.HISTORY_DEST, "ARR_DELAY"),
    digits=ROW_DIGITS,
)
def expected_delay_grid(spark, path):
    h = hist(spark, path)
    base = past.first_record_per_key(h, ("carrier", "airport", "month"))
    return enrichment.expected_delay_grid(base, summaries.airport_lookup(h), summaries.carrier_lookup(h))


@query(
    "simple_composites",
    with_views(
        "dcm",
        """SELECT year, month, carrier, airport,
          avg_delay_minutes * carrier_delay_rate AS avg_delay_minutes_x_carrier_delay_rate,
          total_delay_rate * weather_delay_rate AS total_delay_rate_x_weather_delay_rate,
          nas_delay_rate * late_aircraft_delay_rate AS nas_delay_rate_x_late_aircraft_delay_rate,
          arr_flights * total_delay_rate AS volume_delay_interaction,
          month * avg_delay_minutes AS temporal_delay_pattern,
          (total_delay_rate + carrier_delay_rate + weather_delay_rate) / 3 AS delay_risk_score,
          total_delay_rate * total_delay_rate AS total_delay_rate_squared,
          carrier_delay_rate * carrier_delay_rate AS carrier_delay_rate_squared,
          avg_delay_minutes * avg_delay_minutes AS avg_delay_minutes_squared,
          weather_delay_rate * weather_delay_rate AS weather_delay_rate_squared
        FROM dcm""",
    ),
    [
        "avg_delay_minutes_x_carrier_delay_rate", "total_delay_rate_x_weather_delay_rate",
        "nas_delay_rate_x_late_aircraft_delay_rate", "volume_delay_interaction", "temporal_delay_pattern",
        "delay_risk_score", "total_delay_rate_squared", "carrier_delay_rate_squared",
        "avg_delay_minutes_squared", "weather_delay_rate_squared",
    ],
)
def _(spark, path):
    from delaykit.operators.engineered import simple_composites

    df = report(spark, path)
    built = simple_composites(df)
    return built.select(*KEYS, *[c for c in built.columns if c not in df.columns])
