"""Column names, fixed values and defaults shared by the operators."""

from __future__ import annotations

# --------------------------------------------------------------------------
# Column families
# --------------------------------------------------------------------------

CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")

CAUSE_COUNTS = tuple(f"{c}_ct" for c in CAUSES)
CAUSE_MINUTES = tuple(f"{c}_delay" for c in CAUSES)
CAUSE_RATES = tuple(f"{c}_delay_rate" for c in CAUSES)
CAUSE_AVERAGES = tuple(f"avg_{c}_delay" for c in CAUSES)
CAUSE_SHARES = tuple(f"{c}_delay_pct" for c in CAUSES)

VOLUMES = ("arr_flights", "arr_del15", "arr_cancelled", "arr_diverted", "arr_delay")
SUMMED = VOLUMES + CAUSE_COUNTS + CAUSE_MINUTES
AVERAGED = (
    "total_delay_rate",
    "cancellation_rate",
    "diversion_rate",
    "avg_delay_minutes",
) + CAUSE_SHARES

# The twelve history statistics carried by every lookup table.
HISTORY = ("total_delay_rate",) + CAUSE_RATES + ("avg_delay_minutes",) + CAUSE_AVERAGES
HISTORY_ORIGIN = tuple(f"{c}_origin" for c in HISTORY)
HISTORY_DEST = tuple(f"{c}_dest" for c in HISTORY)

FLIGHT_COLUMNS = (
    "OP_CARRIER", "FL_NUM", "ORIGIN", "DEST",
    "CRS_DEP_TIME", "DEP_DELAY", "FL_DATE", "DISTANCE",
)
REPORT_COLUMNS = (
    "year", "month", "carrier", "carrier_name", "airport", "airport_name",
) + VOLUMES[:2] + CAUSE_COUNTS + VOLUMES[2:] + CAUSE_MINUTES
REPORT_REQUIRED = tuple(
    c for c in REPORT_COLUMNS if c not in ("carrier_name", "airport_name")
)
REPORT_NUMERIC = ("year", "month") + SUMMED

ENCODINGS = ("route_avg_delay", "origin_avg_delay", "airline_avg_delay")
TIME_FEATURES = ("dep_hour", "dow", "month", "is_weekend")
NUMERIC_FEATURES = TIME_FEATURES + ("DISTANCE",) + ENCODINGS
CATEGORICAL_FEATURES = ("route", "ORIGIN", "DEST", "OP_CARRIER")
FEATURES = (
    TIME_FEATURES + ("DISTANCE",) + CATEGORICAL_FEATURES
    + ENCODINGS + HISTORY_ORIGIN + HISTORY_DEST
)

# --------------------------------------------------------------------------
# These must equal the published ones for results to agree.
# --------------------------------------------------------------------------

MAJOR_HUBS = ("ATL", "DEN", "IAD", "LAX")

CARRIER_NAMES = {
    "9E": "Endeavor Air", "AA": "American Airlines", "AS": "Alaska Airlines",
    "B6": "JetBlue Airways", "C5": "CommutAir", "DL": "Delta Air Lines",
    "F9": "Frontier Airlines", "G4": "Allegiant Air", "G7": "GoJet Airlines",
    "HA": "Hawaiian Airlines", "MQ": "Envoy Air", "NK": "Spirit Airlines",
    "OH": "PSA Airlines", "OO": "SkyWest Airlines", "QX": "Horizon Air",
    "UA": "United Airlines", "WN": "Southwest Airlines", "YV": "Mesa Airlines",
    "YX": "Republic Airways", "ZW": "Air Wisconsin",
}
COMMON_CARRIERS = ("AA", "DL", "UA", "WN", "B6", "AS", "F9", "NK")

DELAY_RANGE = (-30.0, 300.0)
DELAY_EDGES = (0.0, 15.0, 30.0, 60.0)
DELAY_LABELS = ("early", "on_time", "short_delay", "medium_delay", "long_delay")
DELAY_WEIGHTS = (1.0, 2.0, 3.0, 4.0)      # up to 15, 30, 60 and above

BADGE_LIMITS = (20.0, 35.0)
SEVERITY_LIMITS = (10.0, 20.0)

RUSH_HOURS = (6, 7, 8, 16, 17, 18, 19)        # scenario and temporal risk
GRID_RUSH_HOURS = (7, 8, 9, 17, 18, 19)       # expected-delay grid
GRID_NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
WEEKEND = (5, 6)                              # Monday is 0
GRID_FACTORS = {
    "rush": 1.2, "night": 0.8, "weekend": 1.1, "summer": 1.15, "winter": 1.1,
}
SUMMER = (6, 7, 8)
WINTER = (12, 1, 2)
SCENARIO_WEEKEND, SCENARIO_RUSH = 1.2, 1.3
SCENARIO_MILES, SCENARIO_SLOPE = 2000.0, 0.1
GRID_DISTANCE, GRID_DEST = 1000.0, "XXX"

DEFAULT_DISTANCE = 500.0
DEFAULT_ROUTE_DELAY = 10.0
DEFAULT_CARRIER_RATE = 0.20
DEFAULT_AIRPORT_RATE = 0.18
DEFAULT_MAE = 12.5
GATED_MAE = 5.0

# Values a request starts from before the lookups override them.
REQUEST_DEFAULTS = {
    "arr_flights": 1000.0, "arr_del15": 200.0,
    "arr_cancelled": 10.0, "arr_diverted": 2.0,
    "total_delay_rate": 0.2, "carrier_delay_rate": 0.1,
    "weather_delay_rate": 0.05, "nas_delay_rate": 0.08,
    "security_delay_rate": 0.01, "late_aircraft_delay_rate": 0.06,
    "avg_carrier_delay": 50.0, "avg_weather_delay": 30.0,
    "avg_nas_delay": 40.0, "avg_security_delay": 10.0,
    "avg_late_aircraft_delay": 45.0,
}

EPSILON = 1e-8
BASELINE_MAE = 15.0
ENTROPY_WORDS = ("carrier", "weather", "nas", "security", "late_aircraft")

# Text patterns
FLIGHT_NUMBER_ANY_CASE = r"^\s*([A-Za-z]{2,3})\s*-?\s*(\d{1,4})\s*$"
FLIGHT_NUMBER_UPPER = r"^\s*([A-Z]{2,3})\s*-?\s*(\d{1,4})\s*$"
AIRPORT_CODE = r"^[A-Z]{3}$"
FLIGHT_MENTION = r"\b([A-Z]{2,3})\s*(\d{1,4})\b"
CLOCK_12 = r"(\d{1,2}):(\d{2})\s*(AM|PM)"
CLOCK_24 = r"(\d{1,2}):(\d{2})"
CLOCK_HOUR = r"(\d{1,2})\s*(AM|PM)"
CLOCK_ANY = r"(\d{1,2}:\d{2}\s*(?:AM|PM)?)"
ROUTE_PAIR = r"\b([A-Z]{3})\s*(?:TO|FROM|->|→|–|—|-)?\s*([A-Z]{3})\b"
ROUTE_SPACED = r"\b([A-Z]{3})\s+([A-Z]{3})\b"

# Labels and messages of search results and gated predictions
RESULTS_TAKEN, ROUTE_RESULTS, STATUS_RESULTS, FLIGHTS_GIVEN = 10, 5, 3, 10
STATUS_WORDS = (
    ("DELAYED", ("DELAYED",)),
    ("CANCELLED", ("CANCELLED", "CANCELED")),
    ("ON TIME", ("ON TIME",)),
    ("ARRIVED", ("ARRIVED",)),
    ("LANDED", ("LANDED",)),
)
SOURCE_FOUND, SOURCE_NONE = "google_flights", "google_flights_no_results"
NO_FLIGHTS = "No flights found for this route on this date"
AVAILABLE_PREFIX = "Prediction based on available data: "
FAILED_MESSAGE = "Prediction failed: an input of the model is missing"
UNKNOWN_MESSAGE = (
    "No historical data found for carrier %s, origin %s, or destination %s. "
    "Cannot generate prediction."
)

# Name marks of engineered features
NEW_FEATURE_MARKS = (
    "_X_", "_DIV_", "_squared", "log_", "composite_", "temporal_",
    "route_congestion", "delay_type_diversity", "_group",
)
FAMILY_MARKS = {
    "interaction": ("_X_", "_DIV_"),
    "polynomial": ("_squared", "log_"),
    "composite": ("composite_", "temporal_", "route_congestion", "delay_type_diversity"),
    "aggregation": ("_group",),
}

# Inputs of the airport-month model
AIRPORT_MODEL_NUMERIC = (
    "year", "month", "arr_flights", "arr_del15", "arr_cancelled", "arr_diverted",
    "total_delay_rate",
) + CAUSE_RATES + CAUSE_AVERAGES
AIRPORT_MODEL_CATEGORICAL = ("airport", "carrier")
