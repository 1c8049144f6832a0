"""Flights, times, routes and statuses read out of search results.

Results have query_id, rank, title, snippet and link; itineraries come as JSON
text. Patterns use Unicode word boundaries, so an accented letter is a letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.operators.selection import first_per_key, top_per_key

UNICODE = "(?U)"
RESULT_ORDER = ("rank", "title", "snippet", "link")

ITINERARY_SCHEMA = """
best_flights array<struct<
  flights array<struct<
    departure_airport struct<time string>, arrival_airport struct<time string>,
    duration int, airline string, flight_number string, airplane string,
    travel_class string, extensions array<string>>>,
  price int, total_duration int, layovers string, carbon_emissions string>>,
other_flights array<struct<
  flights array<struct<
    departure_airport struct<time string>, arrival_airport struct<time string>,
    duration int, airline string, flight_number string, airplane string,
    travel_class string, extensions array<string>>>,
  price int, total_duration int, layovers string, carbon_emissions string>>
""".replace("\n", " ").replace("struct<", "STRUCT<").replace("array<", "ARRAY<")


def result_text() -> Column:
    return F.upper(
        F.concat(
            F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("snippet", F.lit(""))
        )
    )


def first_results(results: DataFrame, n: int) -> DataFrame:
    """First n results of each query, with their text."""
    return top_per_key(results, ["query_id"], RESULT_ORDER, n).withColumn("_text", result_text())


def _groups(text: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.regexp_extract(text, UNICODE + pattern, g) for g in groups]


def _clock_hour(hour: Column, half: Column) -> Column:
    return (
        F.when((half == "PM") & (hour != 12), hour + 12)
        .when((half == "AM") & (hour == 12), F.lit(0))
        .otherwise(hour)
    )


def departure_clock(text: Column) -> tuple[Column, Column]:
    """(HH:mm, hour) of the first clock time: with AM/PM, then plain, then hour only."""
    h12, m12, half12 = _groups(text, K.CLOCK_12, 1, 2, 3)
    h24, m24 = _groups(text, K.CLOCK_24, 1, 2)
    h1, half1 = _groups(text, K.CLOCK_HOUR, 1, 2)
    as_int = lambda c: c.try_cast("int")
    hour = (
        F.when(h12 != "", _clock_hour(as_int(h12), half12))
        .when(h24 != "", as_int(h24))
        .when(h1 != "", _clock_hour(as_int(h1), half1))
    )
    minute = (
        F.when(h12 != "", as_int(m12)).when(h24 != "", as_int(m24)).when(h1 != "", F.lit(0))
    )
    return F.when(hour.isNotNull(), F.format_string("%02d:%02d", hour, minute)), hour


def extract_departure_time(results: DataFrame) -> DataFrame:
    text = result_text()
    clock, hour = departure_clock(text)
    return results.withColumn("departure_time", clock).withColumn("departure_hour", hour)


def extract_flight_mentions(results: DataFrame) -> DataFrame:
    """Flight numbers named in the first results of each query, in order."""
    taken = first_results(results, K.RESULTS_TAKEN)
    clock, hour = departure_clock(F.col("_text"))
    pattern = F.lit(UNICODE + K.FLIGHT_MENTION)
    found = taken.select(
        "query_id", *RESULT_ORDER,
        clock.alias("departure_time"),
        hour.alias("departure_hour"),
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("_text", pattern, F.lit(1)).alias("carrier"),
                F.regexp_extract_all("_text", pattern, F.lit(2)).alias("number"),
            )
        ).alias("position", "found"),
    )
    listed = found.select(
        "query_id", "rank", "position",
        F.col("found.carrier").alias("carrier"),
        F.col("found.number").alias("number"),
        F.concat("found.carrier", "found.number").alias("flight_number"),
        "title", "snippet", "link", "departure_time", "departure_hour",
    )
    return top_per_key(
        listed, ["query_id"], [*RESULT_ORDER, "position"], K.FLIGHTS_GIVEN
    ).drop("snippet")


def flights_by_carrier(mentions: DataFrame) -> DataFrame:
    """Flights of a query listed per carrier; a query has ten at most."""
    entry = F.struct("rank", "position", "flight_number")
    return mentions.groupBy("query_id", "carrier").agg(
        F.count(F.lit(1)).alias("n_flights"),
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["flight_number"]).alias("flights"),
    )


def extract_route(results: DataFrame) -> DataFrame:
    """First airport pair in the first results of each query.

    The separator is optional, so a six-letter word reads as a pair too.
    """
    taken = first_results(results, K.ROUTE_RESULTS)
    o1, d1 = _groups(F.col("_text"), K.ROUTE_PAIR, 1, 2)
    o2, d2 = _groups(F.col("_text"), K.ROUTE_SPACED, 1, 2)
    paired = taken.withColumns(
        {
            "origin": F.when(o1 != "", o1).when(o2 != "", o2),
            "destination": F.when(o1 != "", d1).when(o2 != "", d2),
        }
    ).filter(F.col("origin").isNotNull())
    return first_per_key(
        paired.select("query_id", *RESULT_ORDER, "origin", "destination"), ["query_id"], RESULT_ORDER
    ).select("query_id", "origin", "destination", "title", "link")


def status_of(text: Column) -> Column:
    """First status, by precedence, whose words the text contains."""
    label = None
    for name, words in K.STATUS_WORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label


def extract_status(results: DataFrame) -> DataFrame:
    """Status of each query: a later result overrules an earlier one."""
    taken = first_results(results, K.STATUS_RESULTS).withColumn("status", status_of(F.col("_text")))
    told = taken.filter(F.col("status").isNotNull()).select("query_id", *RESULT_ORDER, "status")
    return first_per_key(told, ["query_id"], [F.desc(c) for c in RESULT_ORDER]).select(
        "query_id", "status", F.col("link").alias("status_link")
    )


def extract_times(results: DataFrame, keep: str = "first") -> DataFrame:
    """Clock times of the first (or last) result of each query that has any."""
    pattern = F.lit(UNICODE + K.CLOCK_ANY)
    taken = first_results(results, K.STATUS_RESULTS).withColumn(
        "times", F.regexp_extract_all("_text", pattern, F.lit(1))
    )
    told = taken.filter(F.size("times") > 0).select("query_id", *RESULT_ORDER, "times")
    order = [F.asc(c) if keep == "first" else F.desc(c) for c in RESULT_ORDER]
    return first_per_key(told, ["query_id"], order).select("query_id", "times")


def route_airlines(results: DataFrame) -> DataFrame:
    """Carriers named for each query's route, or the common ones if none are.

    Needs origin and dest besides the result columns; at most ten results of a
    query are gathered.
    """
    taken = first_results(results, K.RESULTS_TAKEN).withColumn(
        "_carriers", F.regexp_extract_all("_text", F.lit(UNICODE + K.FLIGHT_MENTION), F.lit(1))
    )
    gathered = taken.groupBy("query_id").agg(
        F.upper(F.min("origin")).alias("origin"),
        F.upper(F.min("dest")).alias("dest"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("_carriers")))).alias("_found"),
    )
    common = F.array(*[F.lit(c) for c in K.COMMON_CARRIERS])
    listed = F.when(F.size("_found") > 0, F.col("_found")).otherwise(common)
    return gathered.select(
        "query_id", "origin", "dest",
        (F.size("_found") > 0).alias("from_results"),
        listed.alias("airlines"),
        F.size(listed).alias("airline_count"),
    )


def flatten_itineraries(payloads: DataFrame, json: str = "payload") -> DataFrame:
    """First itinerary of each payload: best ones first, then the others.

    A payload without itineraries gives a marker row; an itinerary without
    legs gives none.
    """
    # A list of one, unfolded: a plain column would be parsed again for the filter, several times a row.
    parsed = payloads.select("*", F.explode(F.array(F.from_json(json, ITINERARY_SCHEMA))).alias("_p"))
    best, other = F.col("_p.best_flights"), F.col("_p.other_flights")
    options = F.when(F.coalesce(F.size(best), F.lit(0)) > 0, best).otherwise(other)
    none = F.coalesce(F.size(options), F.lit(0)) <= 0
    picked = parsed.withColumn("_none", none).withColumn("_f", F.try_element_at(options, F.lit(1)))
    leg = F.try_element_at(F.col("_f.flights"), F.lit(1))
    rows = picked.withColumn("_leg", leg).filter(F.col("_none") | F.col("_leg").isNotNull())
    keep = [c for c in payloads.columns if c != json]
    fields = {
        "departure_time": F.col("_leg.departure_airport.time"),
        "arrival_time": F.col("_leg.arrival_airport.time"),
        "duration_minutes": F.col("_leg.duration"),
        "airline": F.col("_leg.airline"),
        "flight_number": F.col("_leg.flight_number"),
        "airplane": F.col("_leg.airplane"),
        "travel_class": F.col("_leg.travel_class"),
        "extensions": F.col("_leg.extensions"),
        "price": F.col("_f.price"),
        "total_duration": F.col("_f.total_duration"),
        "layovers": F.col("_f.layovers"),
        "carbon_emissions": F.col("_f.carbon_emissions"),
    }
    return rows.select(
        *keep,
        F.when(F.col("_none"), K.SOURCE_NONE).otherwise(K.SOURCE_FOUND).alias("source"),
        F.when(F.col("_none"), K.NO_FLIGHTS).alias("message"),
        *[c.alias(n) for n, c in fields.items()],
    )


def display_row(records: DataFrame) -> DataFrame:
    """Flat display columns of a record.

    ``itinerary`` (departure_time, arrival_time, duration_minutes, airline,
    airplane) and ``status_info`` (status) are structs and may be null.
    """
    def shown(col: str, default: str = "N/A") -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit(default))

    has = F.col("itinerary").isNotNull()
    minutes = F.concat(shown("itinerary.duration_minutes", "0"), F.lit(" min"))
    return records.select(
        "query_id",
        shown("flight_number").alias("flight"),
        F.concat(shown("origin", "?"), F.lit(" → "), shown("destination", "?")).alias("route"),
        shown("search_date").alias("date"),
        F.when(has, shown("itinerary.departure_time")).alias("departure"),
        F.when(has, shown("itinerary.arrival_time")).alias("arrival"),
        F.when(has, minutes).alias("duration"),
        F.when(has, shown("itinerary.airline")).alias("airline"),
        F.when(has, shown("itinerary.airplane")).alias("aircraft"),
        F.when(F.col("status_info").isNotNull(), shown("status_info.status", "Unknown")).alias("status"),
    )
