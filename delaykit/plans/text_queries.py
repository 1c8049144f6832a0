"""Flights, times, routes and statuses out of search results and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators import enrichment, mentions
from delaykit.plans.catalog import query
from delaykit.plans.views import with_views
from delaykit.sources import testdata as data

_FM = rf"'{K.FLIGHT_MENTION}'"
_clock = "CASE WHEN departure_hour IS NOT NULL THEN printf('%02d:%02d', departure_hour, minute) END"

_LISTED = f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, title, snippet, link, position) AS nth FROM (
  SELECT query_id, rank, title, snippet, link, departure_hour, {_clock} AS departure_time,
    generate_subscripts(c, 1) - 1 AS position, unnest(c) AS carrier, unnest(n) AS number
  FROM (SELECT *, regexp_extract_all(text, {_FM}, 1) AS c, regexp_extract_all(text, {_FM}, 2) AS n
    FROM clocked WHERE rn <= 10) x) y"""


@query(
    "extract_flight_mentions",
    with_views(
        "clocked",
        """SELECT query_id, rank, CAST(position AS INT) AS position, carrier, number, carrier || number AS flight_number,
        title, link, departure_time, departure_hour FROM listed WHERE nth <= 10""",
        listed=_LISTED,
    ),
)
def flight_mentions(spark, path):
    return mentions.extract_flight_mentions(data.search_results(spark, path))


@query(
    "flights_by_carrier",
    with_views(
        "clocked",
        """SELECT query_id, carrier, count(*) AS n_flights,
        string_agg(carrier || number, ',' ORDER BY rank, position, carrier || number) AS flights
        FROM listed WHERE nth <= 10 GROUP BY query_id, carrier""",
        listed=_LISTED,
    ),
)
def _(spark, path):
    grouped = mentions.flights_by_carrier(flight_mentions(spark, path))
    return grouped.withColumn("flights", F.array_join("flights", ","))


@query(
    "covered_mentions",
    with_views(
        "clocked",
        """SELECT query_id, carrier, number FROM listed WHERE nth <= 10 AND carrier IN ('UA', 'AA', 'DL')""",
        listed=_LISTED,
    ),
)
def _(spark, path):
    found = flight_mentions(spark, path).withColumnRenamed("carrier", "OP_CARRIER")
    coverage = enrichment.carrier_names(spark).filter(F.col("code").isin("UA", "AA", "DL"))
    covered = enrichment.covered_carriers(found, coverage.select(F.col("code").alias("OP_CARRIER")))
    return covered.select("query_id", F.col("OP_CARRIER").alias("carrier"), "number")


@query(
    "extract_departure_time",
    with_views("clocked", f"SELECT query_id, rank, snippet, departure_hour, {_clock} AS departure_time FROM clocked"),
)
def _(spark, path):
    out = mentions.extract_departure_time(data.search_results(spark, path))
    return out.select("query_id", "rank", "snippet", "departure_hour", "departure_time")


_RP, _RS = rf"'{K.ROUTE_PAIR}'", rf"'{K.ROUTE_SPACED}'"


@query(
    "extract_route",
    with_views(
        "ranked",
        """SELECT query_id, origin, destination, title, link FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rn) AS nth FROM m WHERE origin IS NOT NULL) t WHERE nth = 1""",
        m=f"""SELECT query_id, rn, title, link,
          CASE WHEN regexp_extract(text, {_RP}, 1) <> '' THEN regexp_extract(text, {_RP}, 1)
            WHEN regexp_extract(text, {_RS}, 1) <> '' THEN regexp_extract(text, {_RS}, 1) END AS origin,
          CASE WHEN regexp_extract(text, {_RP}, 1) <> '' THEN regexp_extract(text, {_RP}, 2)
            WHEN regexp_extract(text, {_RS}, 1) <> '' THEN regexp_extract(text, {_RS}, 2) END AS destination
          FROM ranked WHERE rn <= 5""",
    ),
)
def _(spark, path):
    return mentions.extract_route(data.search_results(spark, path))


_STATUS = """SELECT query_id, rn, link, CASE WHEN contains(text, 'DELAYED') THEN 'DELAYED'
  WHEN contains(text, 'CANCELLED') OR contains(text, 'CANCELED') THEN 'CANCELLED'
  WHEN contains(text, 'ON TIME') THEN 'ON TIME' WHEN contains(text, 'ARRIVED') THEN 'ARRIVED'
  WHEN contains(text, 'LANDED') THEN 'LANDED' END AS status FROM ranked WHERE rn <= 3"""


@query(
    "extract_status",
    with_views(
        "ranked",
        """SELECT query_id, status, link AS status_link FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rn DESC) AS nth FROM m WHERE status IS NOT NULL) t WHERE nth = 1""",
        m=_STATUS,
    ),
)
def _(spark, path):
    return mentions.extract_status(data.search_results(spark, path))


for _keep, _order in (("first", "rn"), ("last", "rn DESC")):

    @query(
        "extract_times" if _keep == "first" else "extract_times_last",
        with_views(
            "ranked",
            f"""SELECT query_id, array_to_string(times, ',') AS times FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_order}) AS nth FROM m WHERE len(times) > 0) t WHERE nth = 1""",
            m=rf"SELECT query_id, rn, regexp_extract_all(text, '{K.CLOCK_ANY}', 1) AS times FROM ranked WHERE rn <= 3",
        ),
    )
    def _(spark, path, keep=_keep):
        found = mentions.extract_times(data.search_results(spark, path), keep)
        return found.withColumn("times", F.array_join("times", ","))


@query(
    "route_airlines",
    with_views(
        "ranked",
        """SELECT q.query_id, q.origin, q.dest, c.names IS NOT NULL AS from_results,
          coalesce(c.names, 'AA,DL,UA,WN,B6,AS,F9,NK') AS airlines, CAST(coalesce(c.n, 8) AS INT) AS airline_count
        FROM (SELECT query_id, min(origin) AS origin, min(dest) AS dest FROM ranked WHERE rn <= 10 GROUP BY query_id) q
        LEFT JOIN c ON q.query_id = c.query_id""",
        found=f"SELECT DISTINCT query_id, unnest(regexp_extract_all(text, {_FM}, 1)) AS carrier FROM ranked WHERE rn <= 10",
        c="SELECT query_id, string_agg(carrier, ',' ORDER BY carrier) AS names, count(*) AS n FROM found GROUP BY query_id",
    ),
)
def _(spark, path):
    listed = mentions.route_airlines(data.search_results(spark, path))
    return listed.withColumn("airlines", F.array_join("airlines", ","))


# ---- payloads ---------------------------------------------------------------

_TRIP = "coalesce(json_extract(payload, '$.best_flights[0]'), json_extract(payload, '$.other_flights[0]'))"


def _leg(path: str) -> str:
    return f"json_extract_string(trip, '$.flights[0].{path}')"


_FLAT = f"""SELECT query_id, rank, origin, destination, trip IS NULL AS no_trip,
  {_leg('departure_airport.time')} AS departure_time, {_leg('arrival_airport.time')} AS arrival_time,
  CAST({_leg('duration')} AS INT) AS duration_minutes, {_leg('airline')} AS airline,
  {_leg('flight_number')} AS flight_number, {_leg('airplane')} AS airplane, {_leg('travel_class')} AS travel_class,
  CASE WHEN trip IS NOT NULL THEN CAST(json_extract_string(trip, '$.price') AS INT) END AS price,
  CASE WHEN trip IS NOT NULL THEN CAST(json_extract_string(trip, '$.total_duration') AS INT) END AS total_duration
FROM (SELECT *, {_TRIP} AS trip FROM payloads) p
WHERE trip IS NULL OR json_array_length(json_extract(trip, '$.flights')) > 0"""

_FLAT_COLS = [
    "query_id", "rank", "origin", "destination", "source", "message", "departure_time", "arrival_time",
    "duration_minutes", "airline", "flight_number", "airplane", "travel_class", "price", "total_duration",
]


@query(
    "flatten_itineraries",
    with_views(
        "payloads",
        f"""SELECT * EXCLUDE (no_trip), CASE WHEN no_trip THEN 'google_flights_no_results' ELSE 'google_flights' END AS source,
        CASE WHEN no_trip THEN 'No flights found for this route on this date' END AS message FROM flat""",
        flat=_FLAT,
    ),
)
def _(spark, path):
    return mentions.flatten_itineraries(data.payloads(spark, path)).select(*_FLAT_COLS)


@query(
    "display_row",
    with_views(
        "payloads",
        """SELECT query_id, coalesce(flight_number, 'N/A') AS flight, coalesce(origin, '?') || ' → ' || coalesce(destination, '?') AS route,
          'N/A' AS date, CASE WHEN NOT no_trip THEN coalesce(departure_time, 'N/A') END AS departure,
          CASE WHEN NOT no_trip THEN coalesce(arrival_time, 'N/A') END AS arrival,
          CASE WHEN NOT no_trip THEN coalesce(CAST(duration_minutes AS VARCHAR), '0') || ' min' END AS duration,
          CASE WHEN NOT no_trip THEN coalesce(airline, 'N/A') END AS airline,
          CASE WHEN NOT no_trip THEN coalesce(airplane, 'N/A') END AS aircraft,
          CASE WHEN rank % 2 = 0 THEN CASE WHEN rank % 4 = 0 THEN 'ARRIVED' ELSE 'Unknown' END END AS status FROM flat""",
        flat=_FLAT,
    ),
)
def _(spark, path):
    flat = mentions.flatten_itineraries(data.payloads(spark, path))
    trip = F.struct("departure_time", "arrival_time", "duration_minutes", "airline", "airplane")
    told = F.struct(F.when(F.col("rank") % 4 == 0, "ARRIVED").alias("status"))
    records = flat.select(
        "query_id", "flight_number", "origin", "destination",
        F.lit(None).cast("date").alias("search_date"),
        F.when(F.col("source") == K.SOURCE_FOUND, trip).alias("itinerary"),
        F.when(F.col("rank") % 2 == 0, told).alias("status_info"),
    )
    return mentions.display_row(records)
