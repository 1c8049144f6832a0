"""Joins that add history and lookups to flights and requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes
from delaykit.operators.lookups import lookup_join, record_join, rename_all, settled
from delaykit.operators.summaries import (
    carrier_airport_month_lookup,
    mean_from_counts,
    route_counts,
)

# Only these kinds of column are zero-filled when history is missing.
FILLED_MARKS = ("delay_rate", "avg_delay", "arr_flights")


def enrich_origin_dest(flights: DataFrame, history: DataFrame) -> DataFrame:
    """Monthly carrier history at both ends of the flight."""
    values = K.HISTORY + ("arr_flights",)
    filled = [c for c in values if any(mark in c for mark in FILLED_MARKS)]
    # Nulls are filled in the small table, and once more for flights without history.
    lookup = settled(carrier_airport_month_lookup(history).na.fill(0.0, subset=filled))
    nothing = F.struct(
        *[(F.lit(0.0) if c in filled else F.lit(None)).cast("double").alias(c) for c in values]
    )
    dated = flights.withColumns({"year": F.year("FL_DATE"), "month": F.month("FL_DATE")})
    columns = dated.columns
    for end, name in (("ORIGIN", "_o"), ("DEST", "_d")):
        side = lookup.withColumnsRenamed({"carrier": "OP_CARRIER", "airport": end})
        dated = record_join(
            dated, side.select("OP_CARRIER", end, "year", "month", *values),
            ["OP_CARRIER", end, "year", "month"], name,
        )
    known = dated.withColumns({n: F.coalesce(n, nothing) for n in ("_o", "_d")})
    return known.select(
        *columns,
        *[F.col(f"{n}.{c}").alias(f"{c}{s}") for n, s in (("_o", "_origin"), ("_d", "_dest")) for c in values],
    )


def encoding_table(flights: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """The three mean delays for every carrier and route that flies.

    Sums by carrier and route are all that is read from the flights; the means
    by route, origin and carrier are sums of those.
    """
    counts = settled(route_counts(flights if fit_on is None else fit_on))
    flown = counts if fit_on is None else route_counts(flights)
    table = flown.select("OP_CARRIER", "ORIGIN", "DEST")
    for name, keys in (
        ("route_avg_delay", ["ORIGIN", "DEST"]),
        ("origin_avg_delay", ["ORIGIN"]),
        ("airline_avg_delay", ["OP_CARRIER"]),
    ):
        table = table.join(mean_from_counts(counts, keys, name), keys, "left")
    return table


def target_encode_join(
    flights: DataFrame, fit_on: DataFrame | None = None, base: DataFrame | None = None
) -> DataFrame:
    """Group mean delays joined back to the flights.

    By default the means use every flight given, as training has always done;
    pass the training part as ``fit_on`` to keep the test part out of them.
    ``base`` is the same flights before other joins, if those need not be run to
    count them.
    """
    # Written first: by its size Spark then knows not to deal the flights out.
    table = settled(encoding_table(flights if base is None else base, fit_on))
    return lookup_join(flights, table, ["OP_CARRIER", "ORIGIN", "DEST"])


def lookup_enrich_default(
    requests: DataFrame, airport: DataFrame, carrier: DataFrame
) -> DataFrame:
    """Carrier, origin and destination statistics of each request, with defaults.

    Requests have carrier, origin and dest. An unknown key gets the mean delay
    of the lookup, a fixed delay rate and zero for the rest.
    """
    airport, carrier = settled(airport), settled(carrier)
    mean_delay = {
        "airport": airport.agg(F.avg("avg_delay_minutes_origin")).scalar(),
        "carrier": carrier.agg(F.avg("avg_delay_minutes_origin")).scalar(),
    }
    base = requests.withColumns({c: F.upper(c) for c in ("carrier", "origin", "dest")})

    mine = carrier.select(
        F.col("OP_CARRIER").alias("carrier"),
        F.col("avg_delay_minutes_origin").alias("carrier_avg_delay"),
        F.col("total_delay_rate_origin").alias("carrier_delay_rate"),
    )
    strange = F.struct(
        mean_delay["carrier"].alias("carrier_avg_delay"),
        F.lit(K.DEFAULT_CARRIER_RATE).alias("carrier_delay_rate"),
    )
    joined = record_join(base, mine, ["carrier"], "_c")
    for end, name in (("origin", "_o"), ("dest", "_d")):
        side = airport.select(
            F.col("ORIGIN").alias(end), *[F.col(f"{c}_origin").alias(c) for c in K.HISTORY]
        )
        joined = record_join(joined, side, [end], name)
    unknown = {c: F.lit(0.0) for c in K.HISTORY}
    unknown["total_delay_rate"] = F.lit(K.DEFAULT_AIRPORT_RATE)
    unknown["avg_delay_minutes"] = mean_delay["airport"]
    elsewhere = F.struct(*[v.alias(c) for c, v in unknown.items()])
    known = joined.withColumns(
        {
            "_c": F.coalesce("_c", strange),
            "_o": F.coalesce("_o", elsewhere),
            "_d": F.coalesce("_d", elsewhere),
        }
    )
    return known.select(
        *base.columns,
        "_c.carrier_avg_delay",
        "_c.carrier_delay_rate",
        *[F.col(f"{n}.{c}").alias(f"{c}{s}") for n, s in (("_o", "_origin"), ("_d", "_dest")) for c in K.HISTORY],
    )


def route_lookup_default(requests: DataFrame, routes: DataFrame | None) -> DataFrame:
    """Distance and mean delay of each request's route.

    An unknown route has both defaults; a known route whose table lacks a
    column has the default distance and no delay. ``routes`` holds ORIGIN and
    DEST once per route, DISTANCE and avg_delay if it has them.
    """
    fallback = {
        "route_distance": F.lit(K.DEFAULT_DISTANCE),
        "route_avg_delay": F.lit(K.DEFAULT_ROUTE_DELAY),
    }
    if routes is None:
        return requests.withColumns(fallback)
    has = set(routes.columns)
    side = routes.select(
        F.col("ORIGIN").alias("origin"),
        F.col("DEST").alias("dest"),
        (F.col("DISTANCE") if "DISTANCE" in has else F.lit(K.DEFAULT_DISTANCE)).alias("route_distance"),
        (F.col("avg_delay") if "avg_delay" in has else F.lit(0.0)).alias("route_avg_delay"),
    )
    joined = record_join(requests, side, ["origin", "dest"], "_r")
    strange = F.struct(*[v.alias(c) for c, v in fallback.items()])
    return joined.withColumn("_r", F.coalesce("_r", strange)).select(
        *requests.columns, "_r.route_distance", "_r.route_avg_delay"
    )


def covered_carriers(flights: DataFrame, coverage: DataFrame) -> DataFrame:
    """Flights whose carrier is in ``coverage`` (column OP_CARRIER)."""
    return lookup_join(flights, coverage.select("OP_CARRIER").distinct(), ["OP_CARRIER"], "left_semi")


def uncovered_carriers(flights: DataFrame, coverage: DataFrame) -> DataFrame:
    """Carriers that fly but are not covered."""
    flying = flights.na.drop(subset=["OP_CARRIER"]).select("OP_CARRIER").distinct()
    return lookup_join(flying, coverage.select("OP_CARRIER").distinct(), ["OP_CARRIER"], "left_anti")


def route_pairs(airports: DataFrame, key: str = "airport") -> DataFrame:
    """Destinations on offer for every origin: all other airports.

    One row per origin; the list of codes is read once as a scalar. A code has
    three characters, so there are at most 46,656 of them.
    """
    every = airports.na.drop(subset=[key]).select(key).distinct()
    codes_list = every.agg(F.sort_array(F.collect_set(key))).scalar()
    return every.select(
        F.col(key).alias("origin"),
        F.array_remove(codes_list, F.col(key)).alias("dest_options"),
    )


def carrier_display_name(
    df: DataFrame, names: DataFrame, other_names: DataFrame | None = None, code: str = "airline_code"
) -> DataFrame:
    """Name of a carrier code: first table, then the second, then a made name.

    Both tables have ``code`` and ``name``; a code listed twice in the second
    takes the alphabetically first name.
    """
    first = names.groupBy(F.col("code").alias(code)).agg(F.min("name").alias("_first"))
    out = lookup_join(df, first, [code])
    found = [F.col("_first")]
    if other_names is not None:
        second = other_names.groupBy(F.col("code").alias(code)).agg(F.min("name").alias("_second"))
        out = lookup_join(out, second, [code])
        found.append(F.col("_second"))
    name = F.coalesce(*found, F.concat(F.col(code), F.lit(" Airlines")))
    return out.withColumn("airline", name).drop("_first", "_second")


def carrier_names(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    rows = sorted((names or K.CARRIER_NAMES).items())
    return spark.createDataFrame(rows, "code string, name string")


def _hour_factor(hour: Column) -> Column:
    return (
        F.when(hour.isin(*K.GRID_RUSH_HOURS), K.GRID_FACTORS["rush"])
        .when(hour.isin(*K.GRID_NIGHT_HOURS), K.GRID_FACTORS["night"])
        .otherwise(1.0)
    )


def _season_factor(month: Column) -> Column:
    return (
        F.when(month.isin(*K.SUMMER), K.GRID_FACTORS["summer"])
        .when(month.isin(*K.WINTER), K.GRID_FACTORS["winter"])
        .otherwise(1.0)
    )


def expected_delay_grid(base: DataFrame, airport: DataFrame, carrier: DataFrame) -> DataFrame:
    """Training rows for every hour and weekday of each carrier, airport and month.

    ``base`` has one row per carrier, airport and month with avg_delay_minutes.
    Destination columns come from the carrier lookup. Hours and weekdays are
    exploded after the joins, so each lookup row is matched once.
    """
    origin = airport.withColumnRenamed("ORIGIN", "airport")
    other = rename_all(
        carrier.withColumnRenamed("OP_CARRIER", "carrier").withColumnsRenamed(
            {f"{c}_origin": c for c in K.HISTORY}
        ),
        ["carrier"],
        "_dest",
    )
    known = base.select("carrier", "airport", "month", "avg_delay_minutes")
    joined = lookup_join(lookup_join(known, origin, ["airport"], "inner"), other, ["carrier"], "inner")
    grid = joined.withColumn("dep_hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn(
        "dow", F.explode(F.sequence(F.lit(0), F.lit(6)))
    )
    weekend = F.col("dow").isin(*K.WEEKEND)
    expected = (
        F.col("avg_delay_minutes")
        * _hour_factor(F.col("dep_hour"))
        * F.when(weekend, K.GRID_FACTORS["weekend"]).otherwise(1.0)
        * _season_factor(F.col("month"))
    )
    return grid.select(
        "dep_hour", "dow", "month",
        weekend.cast("int").alias("is_weekend"),
        F.lit(K.GRID_DISTANCE).alias("DISTANCE"),
        codes.route(F.col("airport"), F.lit(K.GRID_DEST)).alias("route"),
        F.col("airport").alias("ORIGIN"),
        F.lit(K.GRID_DEST).alias("DEST"),
        F.col("carrier").alias("OP_CARRIER"),
        F.col("avg_delay_minutes").alias("route_avg_delay"),
        F.col("avg_delay_minutes_origin").alias("origin_avg_delay"),
        F.col("avg_delay_minutes_dest").alias("airline_avg_delay"),
        *K.HISTORY_ORIGIN,
        *K.HISTORY_DEST,
        F.greatest(F.lit(0.0), expected).alias("ARR_DELAY"),
    )


def scenario_delay(
    origin_avg: Column, airline_avg: Column, weekend: Column, hour: Column, distance: Column,
    rush_hours: Sequence[int] = K.RUSH_HOURS,
) -> Column:
    """Expected minutes of one flight from the two averages and its timing."""
    base = (origin_avg + airline_avg) / 2
    expected = (
        base
        * F.when(weekend == 1, K.SCENARIO_WEEKEND).otherwise(1.0)
        * F.when(hour.isin(*rush_hours), K.SCENARIO_RUSH).otherwise(1.0)
        * (1 + (distance / K.SCENARIO_MILES) * K.SCENARIO_SLOPE)
    )
    return F.greatest(F.lit(0.0), expected)
