"""Cleaning, joins, splits and distributions of flights, and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes, labels
from delaykit.operators import cleaning, enrichment, features, quantiles, splitting, summaries
from delaykit.operators import history as past
from delaykit.operators.lookups import settled
from delaykit.plans.catalog import ROW_DIGITS, query
from delaykit.plans.report_queries import hist, history_report
from delaykit.plans.views import HUBS, digest_sql, each, scenario, strip, timed, whole, with_views
from delaykit.sources import testdata as data

FLIGHT = ["OP_CARRIER", "FL_NUM", "ORIGIN", "DEST", "DEP_HOUR", "DEP_DELAY", "FL_DATE", "DISTANCE"]
_LIST = ", ".join(FLIGHT)


def clean(spark, path):
    return cleaning.clean_flights(data.flights(spark, path)).select(*FLIGHT)


def enriched(spark, path):
    return enrichment.enrich_origin_dest(clean(spark, path), history_report(spark, path))


def lookups(spark, path, causes=None):
    # The report is summed up from the facts once, for both lookups.
    h = settled(hist(spark, path, causes))
    return summaries.airport_lookup(h), summaries.carrier_lookup(h)


def route_table(spark, path):
    return (
        data.flights(spark, path)
        .groupBy("ORIGIN", "DEST")
        .agg(F.avg("DISTANCE").alias("DISTANCE"), F.avg("DEP_DELAY").alias("avg_delay"))
    )


# ---- cleaning and predicates ------------------------------------------------


@query("clean_flights", with_views("clean_flights", f"SELECT {_LIST} FROM clean_flights"), ["DEP_DELAY", "DISTANCE"])
def _(spark, path):
    return cleaning.clean_flights(data.dirty_flights(spark, path)).select(*FLIGHT)


@query(
    "parse_flight_date",
    with_views(
        "dirty_flights",
        "SELECT OP_CARRIER, TRY_CAST(FL_DATE AS DATE) AS FL_DATE FROM dirty_flights WHERE TRY_CAST(FL_DATE AS DATE) IS NOT NULL",
    ),
)
def _(spark, path):
    return cleaning.parse_flight_date(data.dirty_flights(spark, path)).select("OP_CARRIER", "FL_DATE")


@query(
    "hhmm_to_hour",
    with_views(
        "dirty_flights",
        f"""SELECT CRS_DEP_TIME, CAST(CASE WHEN {whole('CRS_DEP_TIME')} IS NOT NULL
          THEN least(23, greatest(0, floor({whole('CRS_DEP_TIME')} / 100.0E0))) END AS INT) AS DEP_HOUR FROM dirty_flights""",
    ),
)
def _(spark, path):
    from delaykit.functions.numbers import as_whole, hhmm_to_hour

    raw = data.dirty_flights(spark, path)
    return raw.select("CRS_DEP_TIME", hhmm_to_hour(as_whole(raw, "CRS_DEP_TIME")).alias("DEP_HOUR"))


@query(
    "filter_hub_routes",
    with_views(
        "clean_flights",
        f"""SELECT {_LIST} FROM clean_flights
        WHERE length(ORIGIN) = 3 AND length(DEST) = 3 AND (ORIGIN IN {HUBS} OR DEST IN {HUBS})""",
    ),
    ["DEP_DELAY", "DISTANCE"],
)
def _(spark, path):
    flights = cleaning.clean_flights(data.dirty_flights(spark, path))
    return cleaning.filter_hub_routes(flights, data.HUBS).select(*FLIGHT)


@query("temporal_features", with_views("cf", f"SELECT DEP_HOUR AS dep_hour, {timed('FL_DATE')}, FL_DATE FROM cf"))
def _(spark, path):
    return features.temporal_features(clean(spark, path)).select(
        "dep_hour", "dow", "month", "is_weekend", "FL_DATE"
    )


@query(
    "route_and_flight_key",
    with_views(
        "dirty_flights",
        f"""SELECT ORIGIN || '-' || DEST AS route,
        upper({strip('OP_CARRIER')}) || {strip('FL_NUM')} AS flight_key FROM dirty_flights""",
    ),
)
def _(spark, path):
    return features.route_and_flight_key(data.dirty_flights(spark, path)).select("route", "flight_key")


# Flight numbers as people type them.
_TYPED = """CASE (query_id + rank) % 6 WHEN 0 THEN ' ' || OP_CARRIER || ' - ' || FL_NUM || ' '
  WHEN 1 THEN lower(OP_CARRIER) || FL_NUM WHEN 2 THEN OP_CARRIER || '12345' WHEN 3 THEN carrier_name || FL_NUM
  WHEN 4 THEN OP_CARRIER || FL_NUM ELSE FL_NUM || OP_CARRIER END"""


def _typed_numbers(spark, path):
    f = data.flights(spark, path)
    kind = (F.col("query_id") + F.col("rank")) % 6
    c, n = F.col("OP_CARRIER"), F.col("FL_NUM")
    typed = (
        F.when(kind == 0, F.concat(F.lit(" "), c, F.lit(" - "), n, F.lit(" ")))
        .when(kind == 1, F.concat(F.lower(c), n))
        .when(kind == 2, F.concat(c, F.lit("12345")))
        .when(kind == 3, F.concat("carrier_name", n))
        .when(kind == 4, F.concat(c, n))
        .otherwise(F.concat(n, c))
    )
    return f.select(typed.alias("typed"))


def _parse_sql(pattern: str) -> str:
    ok = f"regexp_matches(typed, '{pattern}')"
    return (
        f"SELECT typed, CASE WHEN {ok} THEN upper(regexp_extract(typed, '{pattern}', 1)) END AS carrier, "
        f"CASE WHEN {ok} THEN regexp_extract(typed, '{pattern}', 2) END AS number FROM t"
    )


for _name, _pattern, _upper in (
    ("parse_flight_number", K.FLIGHT_NUMBER_ANY_CASE, False),
    ("parse_flight_number_upper", K.FLIGHT_NUMBER_UPPER, True),
):

    @query(_name, with_views("flights", _parse_sql(_pattern), t=f"SELECT {_TYPED} AS typed FROM flights"))
    def _(spark, path, upper=_upper):
        carrier, number_ = codes.flight_number_parts(F.col("typed"), upper)
        return _typed_numbers(spark, path).select("typed", carrier.alias("carrier"), number_.alias("number"))


@query(
    "validate_airport_code",
    with_views(
        "dirty_flights results",
        """SELECT code, regexp_matches(upper(regexp_replace(code, '^\\s+|\\s+$', '', 'g')), '^[A-Z]{3}$') AS valid FROM (
        SELECT DEST AS code FROM dirty_flights UNION ALL SELECT ' ' || lower(origin) AS code FROM results) t""",
    ),
)
def _(spark, path):
    given = data.dirty_flights(spark, path).select(F.col("DEST").alias("code")).unionByName(
        data.search_results(spark, path).select(F.concat(F.lit(" "), F.lower("origin")).alias("code"))
    )
    return given.select("code", codes.is_airport_code(F.col("code")).alias("valid"))


@query(
    "delay_category",
    with_views(
        "flights",
        """SELECT DEP_DELAY, CASE WHEN DEP_DELAY <= 0 THEN 'early' WHEN DEP_DELAY <= 15 THEN 'on_time'
        WHEN DEP_DELAY <= 30 THEN 'short_delay' WHEN DEP_DELAY <= 60 THEN 'medium_delay' ELSE 'long_delay' END AS delay_category
        FROM flights""",
    ),
    ["DEP_DELAY"],
)
def _(spark, path):
    return data.flights(spark, path, dest=False).select(
        "DEP_DELAY", labels.delay_category(F.col("DEP_DELAY")).alias("delay_category")
    )


@query(
    "category_counts",
    with_views(
        "flights",
        """SELECT CASE WHEN DEP_DELAY <= 0 THEN 'early' WHEN DEP_DELAY <= 15 THEN 'on_time'
        WHEN DEP_DELAY <= 30 THEN 'short_delay' WHEN DEP_DELAY <= 60 THEN 'medium_delay' ELSE 'long_delay' END AS delay_category,
        count(*) AS n FROM flights GROUP BY 1""",
    ),
)
def _(spark, path):
    return summaries.category_counts(data.flights(spark, path, dest=False))


_WEIGHT = "CASE WHEN DEP_DELAY > 60 THEN 4.0E0 WHEN DEP_DELAY > 30 THEN 3.0E0 WHEN DEP_DELAY > 15 THEN 2.0E0 ELSE 1.0E0 END"


@query(
    "sample_weights",
    with_views("flights", f"SELECT DEP_DELAY, {_WEIGHT} AS weight FROM flights"),
    ["DEP_DELAY", "weight"],
)
def _(spark, path):
    return data.flights(spark, path, dest=False).select(
        "DEP_DELAY", labels.sample_weight(F.col("DEP_DELAY")).alias("weight")
    )


@query(
    "sample_weight_report",
    with_views(
        "flights",
        f"SELECT min({_WEIGHT}) AS min_weight, max({_WEIGHT}) AS max_weight, avg({_WEIGHT}) AS mean_weight FROM flights",
    ),
    ["min_weight", "max_weight", "mean_weight"],
)
def _(spark, path):
    return summaries.sample_weight_report(data.flights(spark, path, dest=False))


# ---- joins ------------------------------------------------------------------

_ADDED = [f"{c}{s}" for s in ("_origin", "_dest") for c in K.HISTORY + ("arr_flights",)]


@query(
    "enrich_origin_dest",
    with_views("enr", f"SELECT {_LIST}, year, month, {', '.join(_ADDED)} FROM enr"),
    ["DEP_DELAY", "DISTANCE", *_ADDED],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return enriched(spark, path).select(*FLIGHT, "year", "month", *_ADDED)


_ENCODED = """
  avg(DEP_DELAY) OVER (PARTITION BY ORIGIN, DEST) AS route_avg_delay,
  avg(DEP_DELAY) OVER (PARTITION BY ORIGIN) AS origin_avg_delay,
  avg(DEP_DELAY) OVER (PARTITION BY OP_CARRIER) AS airline_avg_delay"""


@query(
    "target_encode_join",
    with_views("cf", f"SELECT {_LIST}, {_ENCODED} FROM cf"),
    ["DEP_DELAY", "DISTANCE", *K.ENCODINGS],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return enrichment.target_encode_join(clean(spark, path)).select(*FLIGHT, *K.ENCODINGS)


@query(
    "group_mean_delays",
    with_views(
        "cf",
        """SELECT 'route' AS group_type, ORIGIN || '-' || DEST AS group_key, avg(DEP_DELAY) AS avg_delay FROM cf GROUP BY 2
        UNION ALL SELECT 'origin', ORIGIN, avg(DEP_DELAY) FROM cf GROUP BY 2
        UNION ALL SELECT 'airline', OP_CARRIER, avg(DEP_DELAY) FROM cf GROUP BY 2""",
    ),
    ["avg_delay"],
)
def _(spark, path):
    return summaries.group_mean_delays(clean(spark, path))


_LED = ["carrier_avg_delay", "carrier_delay_rate", *K.HISTORY_ORIGIN, *K.HISTORY_DEST]


@query(
    "lookup_enrich_default",
    with_views("led", f"SELECT query_id, rank, carrier, origin, dest, flight_date, dep_hour, {', '.join(_LED)} FROM led"),
    _LED,
    digits=ROW_DIGITS,
)
def _(spark, path):
    return enrichment.lookup_enrich_default(data.requests(spark, path), *lookups(spark, path))


@query(
    "route_lookup_default",
    with_views(
        "req rt",
        """SELECT r.query_id, r.rank, r.origin, r.dest, coalesce(t.DISTANCE, 500.0E0) AS route_distance,
        coalesce(t.avg_delay, 10.0E0) AS route_avg_delay
        FROM req r LEFT JOIN rt t ON r.origin = t.ORIGIN AND r.dest = t.DEST""",
    ),
    ["route_distance", "route_avg_delay"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    out = enrichment.route_lookup_default(data.requests(spark, path), route_table(spark, path))
    return out.select("query_id", "rank", "origin", "dest", "route_distance", "route_avg_delay")


@query(
    "route_lookup_bare",
    with_views(
        "req rt",
        """SELECT r.query_id, r.rank, 500.0E0 AS route_distance,
        CASE WHEN t.ORIGIN IS NOT NULL THEN 0.0E0 ELSE 10.0E0 END AS route_avg_delay
        FROM req r LEFT JOIN rt t ON r.origin = t.ORIGIN AND r.dest = t.DEST""",
    ),
    ["route_distance", "route_avg_delay"],
)
def _(spark, path):
    bare = route_table(spark, path).select("ORIGIN", "DEST")
    out = enrichment.route_lookup_default(data.requests(spark, path), bare)
    return out.select("query_id", "rank", "route_distance", "route_avg_delay")


@query(
    "covered_carriers",
    with_views(
        "flights", f"SELECT OP_CARRIER, ORIGIN, DEST, FL_DATE FROM flights WHERE OP_CARRIER IN (SELECT carrier FROM cov)",
        cov="SELECT DISTINCT OP_CARRIER AS carrier FROM flights WHERE cause <> 0 AND OP_CARRIER < 'PR'",
    ),
)
def _(spark, path):
    f = data.flights(spark, path)
    coverage = f.filter((F.col("cause") != 0) & (F.col("OP_CARRIER") < "PR")).select("OP_CARRIER")
    return enrichment.covered_carriers(f, coverage).select("OP_CARRIER", "ORIGIN", "DEST", "FL_DATE")


@query(
    "uncovered_carriers",
    with_views(
        "flights",
        """SELECT DISTINCT OP_CARRIER FROM flights WHERE OP_CARRIER NOT IN (
        SELECT OP_CARRIER FROM flights WHERE cause <> 0 AND OP_CARRIER < 'PR')""",
    ),
)
def _(spark, path):
    f = data.flights(spark, path, dest=False)
    coverage = f.filter((F.col("cause") != 0) & (F.col("OP_CARRIER") < "PR")).select("OP_CARRIER")
    return enrichment.uncovered_carriers(f, coverage)


@query(
    "scenario_delay",
    with_views(
        "led rt",
        f"""SELECT query_id, rank, {scenario('avg_delay_minutes_origin', 'carrier_avg_delay',
        '(CASE WHEN isodow(flight_date) >= 6 THEN 1 ELSE 0 END)', 'dep_hour', 'coalesce(t.DISTANCE, 500.0E0)')} AS expected_delay
        FROM led l LEFT JOIN rt t ON l.origin = t.ORIGIN AND l.dest = t.DEST""",
    ),
    ["expected_delay"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    enriched_ = enrichment.lookup_enrich_default(data.requests(spark, path), *lookups(spark, path))
    routed = enrichment.route_lookup_default(enriched_, route_table(spark, path))
    expected = enrichment.scenario_delay(
        F.col("avg_delay_minutes_origin"), F.col("carrier_avg_delay"),
        codes.is_weekend(F.col("flight_date")), F.col("dep_hour"), F.col("route_distance"),
    )
    return routed.select("query_id", "rank", expected.alias("expected_delay"))


_NAMES = {"CL": "Click Air", "ER": "Error Airways", "ST": "Standard Air"}


@query(
    "carrier_display_name",
    with_views(
        "history",
        """SELECT flight_number, airline_code, CASE airline_code WHEN 'CL' THEN 'Click Air' WHEN 'ER' THEN 'Error Airways'
        WHEN 'VI' THEN 'View Lines' ELSE airline_code || ' Airlines' END AS airline FROM history""",
    ),
)
def _(spark, path):
    names = enrichment.carrier_names(spark, _NAMES)
    other = enrichment.carrier_names(spark, {"VI": "View Lines", "ER": "Never Used"})
    out = enrichment.carrier_display_name(data.history(spark, path), names, other)
    return out.select("flight_number", "airline_code", "airline")


for _kind, _key in (("airport", "ORIGIN"), ("carrier", "OP_CARRIER")):

    @query(
        f"flight_{_kind}_lookup",
        with_views("enr", f"SELECT {_key}, {each('avg({}) AS {}', list(K.HISTORY_ORIGIN))} FROM enr GROUP BY {_key}"),
        K.HISTORY_ORIGIN,
    )
    def _(spark, path, key=_key):
        return summaries.enriched_lookup(enriched(spark, path), key)


@query(
    "flight_lookup_mode",
    with_views(
        "cf",
        """SELECT flight_key, ORIGIN, DEST, dep_hour, n AS count FROM (
        SELECT *, row_number() OVER (PARTITION BY flight_key ORDER BY n DESC, ORIGIN, DEST, dep_hour) AS rn FROM (
          SELECT OP_CARRIER || FL_NUM AS flight_key, ORIGIN, DEST, DEP_HOUR AS dep_hour, count(*) AS n FROM cf GROUP BY 1, 2, 3, 4) c) t
        WHERE rn = 1""",
    ),
)
def _(spark, path):
    return summaries.flight_lookup_mode(clean(spark, path))


_HISTORY = K.HISTORY_ORIGIN + K.HISTORY_DEST


@query(
    "fill_missing_features",
    with_views(
        "enr",
        f"SELECT {_LIST}, {each('coalesce({}, 0.0E0) AS {}', list(_HISTORY))}, 0.0E0 AS extra FROM enr",
    ),
    ["DEP_DELAY", "DISTANCE", *_HISTORY],
)
def _(spark, path):
    filled = cleaning.fill_missing_features(enriched(spark, path), (*_HISTORY, "extra"))
    return filled.select(*FLIGHT, *_HISTORY, "extra")


# ---- splits and samples -----------------------------------------------------

_KEY = digest_sql(FLIGHT, ("DEP_DELAY", "DISTANCE"))


@query(
    "temporal_split",
    with_views(
        "cf",
        f"""SELECT {_LIST}, CASE WHEN row_number() OVER (ORDER BY FL_DATE, {_KEY}, {_LIST})
        <= floor((SELECT count(*) FROM cf) * (1 - 0.2E0)) THEN 'train' ELSE 'test' END AS split FROM cf""",
    ),
    ["DEP_DELAY", "DISTANCE"],
)
def _(spark, path):
    return splitting.temporal_split(clean(spark, path))


@query(
    "random_split",
    with_views(
        "cf",
        f"""SELECT {_LIST}, CASE WHEN row_number() OVER (ORDER BY {_KEY}, {_LIST})
        <= (SELECT count(*) - ceil(count(*) * 0.2E0) FROM cf) THEN 'train' ELSE 'test' END AS split FROM cf""",
    ),
    ["DEP_DELAY", "DISTANCE"],
)
def _(spark, path):
    return splitting.random_split(clean(spark, path))


_CAT = """CASE WHEN DEP_DELAY <= 0 THEN 'early' WHEN DEP_DELAY <= 15 THEN 'on_time' WHEN DEP_DELAY <= 30 THEN 'short_delay'
  WHEN DEP_DELAY <= 60 THEN 'medium_delay' ELSE 'long_delay' END"""
_CAT_KEY = digest_sql(FLIGHT + ["delay_category"], ("DEP_DELAY", "DISTANCE"))


@query(
    "stratified_sample",
    with_views(
        "cf",
        f"""SELECT {_LIST} FROM (SELECT t.*, q.quota,
            row_number() OVER (PARTITION BY t.delay_category ORDER BY {_CAT_KEY.replace('delay_category', 't.delay_category')}, {_LIST}) AS rn
          FROM tagged t JOIN q ON t.delay_category = q.delay_category) r WHERE rn <= quota""",
        tagged=f"SELECT {_LIST}, {_CAT} AS delay_category FROM cf",
        k="""SELECT delay_category, CAST(round_even(count(*) * least(1.0E0, 15000.0E0 / sum(count(*)) OVER ()), 0) AS BIGINT) AS k
          FROM tagged GROUP BY delay_category""",
        q="""SELECT delay_category, k - CASE WHEN row_number() OVER (ORDER BY k DESC, delay_category)
          <= greatest(0, sum(k) OVER () - 15000) THEN 1 ELSE 0 END AS quota FROM k""",
    ),
    ["DEP_DELAY", "DISTANCE"],
)
def _(spark, path):
    return splitting.stratified_sample(clean(spark, path))


# ---- distributions ----------------------------------------------------------

_DIST = ["mean", "std", "min", "max", "pct_delayed", "pct_highly_delayed", "p25", "p50", "p75"]


@query(
    "delay_distribution",
    with_views(
        "flights",
        """SELECT count(DEP_DELAY) AS n, avg(DEP_DELAY) AS mean, stddev_samp(DEP_DELAY) AS std, min(DEP_DELAY) AS min,
        max(DEP_DELAY) AS max, avg(CASE WHEN DEP_DELAY > 0 THEN 1.0E0 ELSE 0.0E0 END) * 100 AS pct_delayed,
        avg(CASE WHEN DEP_DELAY > 15 THEN 1.0E0 ELSE 0.0E0 END) * 100 AS pct_highly_delayed,
        quantile_cont(DEP_DELAY, 0.25) AS p25, quantile_cont(DEP_DELAY, 0.5) AS p50, quantile_cont(DEP_DELAY, 0.75) AS p75
        FROM flights""",
    ),
    _DIST,
)
def _(spark, path):
    return quantiles.delay_distribution(data.flights(spark, path, dest=False))


# ---- history ----------------------------------------------------------------

PAST = ["timestamp", "flight_number", "origin", "destination", "departure_hour", "predicted_delay", "history_key"]
_PAST_SQL = ", ".join(PAST)


def _past(spark, path):
    return data.history(spark, path).select(*PAST)


for _kind, _where in (
    ("recent", f"ORDER BY timestamp DESC, {_PAST_SQL} LIMIT 10"),
    ("week", f"WHERE timestamp >= TIMESTAMP '{data.NOW}' - INTERVAL 7 DAYS"),
    ("high", "WHERE predicted_delay > 20"),
    ("low", "WHERE predicted_delay < 10"),
):

    @query(
        f"history_filter_{_kind}",
        with_views("keyed", f"SELECT {_PAST_SQL} FROM keyed {_where}"),
        ["predicted_delay"],
    )
    def _(spark, path, kind=_kind):
        return past.history_filter(_past(spark, path), kind, data.NOW)


for _by in past.SORTS:

    @query(f"history_sort_{_by}", with_views("keyed", f"SELECT {_PAST_SQL} FROM keyed"), ["predicted_delay"])
    def _(spark, path, by=_by):
        return past.history_sort(_past(spark, path), by)


@query(
    "history_dedup",
    with_views(
        "keyed",
        f"""SELECT {_PAST_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY history_key
        ORDER BY timestamp, predicted_delay) AS rn FROM keyed) t WHERE rn = 1""",
    ),
    ["predicted_delay"],
)
def _(spark, path):
    return past.history_dedup(_past(spark, path))


@query(
    "history_stats",
    with_views(
        "history",
        """SELECT avg(predicted_delay) AS mean_delay, max(predicted_delay) AS max_delay, min(predicted_delay) AS min_delay,
        count(*) AS n_predictions FROM history""",
    ),
    ["mean_delay", "max_delay", "min_delay"],
)
def _(spark, path):
    return past.history_stats(_past(spark, path))


@query(
    "history_key",
    with_views(
        "history",
        """SELECT flight_number, concat_ws('_', flight_number, origin, destination, CAST(flight_date AS VARCHAR),
        CAST(departure_hour AS VARCHAR)) AS history_key FROM history""",
    ),
)
def _(spark, path):
    return past.with_history_key(data.history(spark, path)).select("flight_number", "history_key")


@query(
    "severity_band",
    with_views(
        "history",
        """SELECT predicted_delay, CASE WHEN predicted_delay < 10 THEN 'low' WHEN predicted_delay < 20 THEN 'mid'
        ELSE 'high' END AS severity FROM history""",
    ),
    ["predicted_delay"],
)
def _(spark, path):
    return _past(spark, path).select(
        "predicted_delay", labels.severity_band(F.col("predicted_delay")).alias("severity")
    )


@query(
    "confidence_badge",
    with_views(
        "history",
        """SELECT predicted_delay, CASE WHEN predicted_delay <= 20 THEN 'High' WHEN predicted_delay <= 35 THEN 'Medium'
        ELSE 'Low' END AS badge FROM history""",
    ),
    ["predicted_delay"],
)
def _(spark, path):
    return _past(spark, path).select(
        "predicted_delay", labels.confidence_badge(F.col("predicted_delay")).alias("badge")
    )
