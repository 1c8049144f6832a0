"""SQL views of the benchmark tables, written apart from the operators.

``with_views("dcm", "SELECT ...")`` puts the view and all it needs in front.
"""

from __future__ import annotations

from delaykit import constants as K

CAUSES = K.CAUSES
HUBS = "('A03', 'A07', 'A11', 'A15')"


def each(template: str, items=CAUSES, sep: str = ", ") -> str:
    return sep.join(template.replace("{}", i) for i in items)


NUM = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
INT = r"'^\s*[+-]?\d+\s*$'"


def number(col: str) -> str:
    return f"(CASE WHEN regexp_matches({col}, {NUM}) THEN TRY_CAST(trim({col}) AS DOUBLE) END)"


def whole(col: str) -> str:
    return f"(CASE WHEN regexp_matches({col}, {INT}) THEN TRY_CAST(trim({col}) AS BIGINT) END)"


def strip(col: str) -> str:
    return rf"regexp_replace({col}, '^\s+|\s+$', '', 'g')"


FLIGHTS = """
SELECT substr(p.p_type, 1, 2) AS OP_CARRIER,
  CAST(l.l_suppkey % 40 AS VARCHAR) AS FL_NUM,
  'A' || lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS ORIGIN,
  'A' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS DEST,
  CAST(((l.l_partkey * 7 + l.l_linenumber) % 24) * 100 + l.l_orderkey % 60 AS INT) AS CRS_DEP_TIME,
  l.l_quantity * 8 - 60 + l.l_discount * 100 AS DEP_DELAY,
  CAST(l.l_shipdate AS DATE) AS FL_DATE,
  CAST(200 + (l.l_partkey * 37) % 1800 AS DOUBLE) AS DISTANCE,
  p.p_type AS carrier_name,
  CAST(l.l_partkey % 5 AS INT) AS cause,
  l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_tax AS tax,
  l.l_orderkey AS query_id, l.l_linenumber AS rank
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""

CF = """
SELECT OP_CARRIER, FL_NUM, ORIGIN, DEST, CAST(CRS_DEP_TIME // 100 AS INT) AS DEP_HOUR,
  DEP_DELAY, FL_DATE, DISTANCE
FROM flights WHERE DEP_DELAY BETWEEN -30 AND 300
"""


def _sum_if(test: str, value: str = "1.0E0") -> str:
    return f"sum(CASE WHEN {test} THEN {value} ELSE 0.0E0 END)"


_counts = ", ".join(
    f"{_sum_if(f'DEP_DELAY > 15 AND cause = {i}')} AS {c}_ct" for i, c in enumerate(CAUSES)
)
_minutes = ", ".join(
    f"{_sum_if(f'DEP_DELAY > 15 AND cause = {i}', 'DEP_DELAY')} AS {c}_delay"
    for i, c in enumerate(CAUSES)
)
DC = f"""
SELECT CAST(year(FL_DATE) AS INT) AS year, CAST(month(FL_DATE) AS INT) AS month,
  OP_CARRIER AS carrier, carrier_name, ORIGIN AS airport, 'Airport ' || ORIGIN AS airport_name,
  CAST(count(*) AS DOUBLE) AS arr_flights,
  {_sum_if('DEP_DELAY > 15')} AS arr_del15,
  {_counts},
  {_sum_if("rf = 'R' AND ls = 'O' AND tax >= 0.06")} AS arr_cancelled,
  {_sum_if('tax >= 0.08')} AS arr_diverted,
  {_sum_if('DEP_DELAY > 15', 'DEP_DELAY')} AS arr_delay,
  {_minutes}
FROM flights GROUP BY 1, 2, 3, 4, 5, 6
"""

_pct_total = each("{}_ct", sep=" + ")
DCM = f"""
SELECT *, arr_del15 / arr_flights AS total_delay_rate,
  arr_cancelled / arr_flights AS cancellation_rate,
  arr_diverted / arr_flights AS diversion_rate,
  {each('{}_ct / arr_flights AS {}_delay_rate')},
  CASE WHEN arr_del15 > 0 THEN arr_delay / arr_del15 ELSE 0.0E0 END AS avg_delay_minutes,
  {each('CASE WHEN {}_ct > 0 THEN {}_delay / {}_ct ELSE 0.0E0 END AS avg_{}_delay')},
  {each(f'{{}}_ct / (CASE WHEN {_pct_total} > 0 THEN {_pct_total} ELSE 1.0E0 END) * 100 AS {{}}_delay_pct')}
FROM dc WHERE arr_flights > 0
"""

_one = "(CASE WHEN {} = 0 THEN 1.0E0 ELSE {} END)"
DCH = f"""
SELECT *, make_date(year, month, 1) AS date,
  arr_del15 / {_one.replace('{}', 'arr_flights')} AS total_delay_rate,
  {each('{}_ct / ' + _one.replace('{}', 'arr_flights') + ' AS {}_delay_rate')},
  arr_delay / {_one.replace('{}', 'arr_del15')} AS avg_delay_minutes,
  {each('{}_delay / (CASE WHEN {}_ct = 0 THEN 1.0E0 ELSE {}_ct END) AS avg_{}_delay')}
FROM dc
"""

HIST = list(K.HISTORY)
LK = f"""
SELECT carrier, airport, year, month, sum(arr_flights) AS arr_flights,
  {each('avg({}) AS {}', HIST)}
FROM dch GROUP BY carrier, airport, year, month
"""
LA = f"SELECT airport AS ORIGIN, {each('avg({}) AS {}_origin', HIST)} FROM dch GROUP BY airport"
LC = f"SELECT carrier AS OP_CARRIER, {each('avg({}) AS {}_origin', HIST)} FROM dch GROUP BY carrier"


def _side(alias: str, suffix: str) -> str:
    out = []
    for c in HIST + ["arr_flights"]:
        source, name = f"{alias}.{c}", f"{c}{suffix}"
        if any(m in name for m in ("delay_rate", "avg_delay", "arr_flights")):
            source = f"coalesce({source}, 0.0E0)"
        out.append(f"{source} AS {name}")
    return ", ".join(out)


ENR = f"""
SELECT f.*, CAST(year(f.FL_DATE) AS INT) AS year, CAST(month(f.FL_DATE) AS INT) AS month,
  {_side('o', '_origin')}, {_side('d', '_dest')}
FROM cf f
LEFT JOIN lk o ON f.OP_CARRIER = o.carrier AND f.ORIGIN = o.airport
  AND year(f.FL_DATE) = o.year AND month(f.FL_DATE) = o.month
LEFT JOIN lk d ON f.OP_CARRIER = d.carrier AND f.DEST = d.airport
  AND year(f.FL_DATE) = d.year AND month(f.FL_DATE) = d.month
"""

TIMED = """
CAST(isodow({d}) - 1 AS INT) AS dow, CAST(month({d}) AS INT) AS month,
CASE WHEN isodow({d}) >= 6 THEN 1 ELSE 0 END AS is_weekend
"""


def timed(date: str) -> str:
    return TIMED.replace("{d}", date)


FEAT = f"""
SELECT DEP_HOUR AS dep_hour, {timed('FL_DATE')}, DISTANCE,
  ORIGIN || '-' || DEST AS route, ORIGIN, DEST, OP_CARRIER,
  avg(DEP_DELAY) OVER (PARTITION BY ORIGIN, DEST) AS route_avg_delay,
  avg(DEP_DELAY) OVER (PARTITION BY ORIGIN) AS origin_avg_delay,
  avg(DEP_DELAY) OVER (PARTITION BY OP_CARRIER) AS airline_avg_delay,
  {each('coalesce({}, 0.0E0) AS {}', list(K.HISTORY_ORIGIN + K.HISTORY_DEST))},
  DEP_DELAY, FL_DATE, FL_NUM
FROM enr
"""

REQ = """
SELECT query_id, rank,
  CASE WHEN (query_id + rank) % 3 = 0 THEN 'ZZ' ELSE OP_CARRIER END AS carrier,
  CASE WHEN (query_id + rank) % 4 = 0 THEN 'Z01' ELSE ORIGIN END AS origin,
  CASE WHEN (query_id + rank) % 5 = 0 THEN 'Z02' ELSE DEST END AS dest,
  FL_DATE AS flight_date, CAST(CRS_DEP_TIME // 100 AS INT) AS dep_hour
FROM flights
"""

_c_mean = "(SELECT avg(avg_delay_minutes_origin) FROM lc)"
_a_mean = "(SELECT avg(avg_delay_minutes_origin) FROM la)"


def _end(alias: str, suffix: str) -> str:
    out = []
    for c in HIST:
        default = {"total_delay_rate": "0.18E0", "avg_delay_minutes": _a_mean}.get(c, "0.0E0")
        out.append(
            f"CASE WHEN {alias}.ORIGIN IS NOT NULL THEN {alias}.{c}_origin ELSE {default} END AS {c}{suffix}"
        )
    return ", ".join(out)


LED = f"""
SELECT r.query_id, r.rank, r.carrier, r.origin, r.dest, r.flight_date, r.dep_hour,
  CASE WHEN c.OP_CARRIER IS NOT NULL THEN c.avg_delay_minutes_origin ELSE {_c_mean} END AS carrier_avg_delay,
  CASE WHEN c.OP_CARRIER IS NOT NULL THEN c.total_delay_rate_origin ELSE 0.2E0 END AS carrier_delay_rate,
  {_end('a', '_origin')}, {_end('b', '_dest')}
FROM req r LEFT JOIN lc c ON r.carrier = c.OP_CARRIER
LEFT JOIN la a ON r.origin = a.ORIGIN LEFT JOIN la b ON r.dest = b.ORIGIN
"""

RT = """
SELECT ORIGIN, DEST, avg(DISTANCE) AS DISTANCE, avg(DEP_DELAY) AS avg_delay
FROM flights GROUP BY ORIGIN, DEST
"""
SERV = f"""
SELECT l.query_id, l.rank, l.dep_hour, {timed('l.flight_date')},
  coalesce(t.DISTANCE, 500.0E0) AS DISTANCE, l.origin || '-' || l.dest AS route,
  l.origin AS ORIGIN, l.dest AS DEST, l.carrier AS OP_CARRIER,
  coalesce(t.avg_delay, 10.0E0) AS route_avg_delay,
  l.avg_delay_minutes_origin AS origin_avg_delay, l.carrier_avg_delay AS airline_avg_delay,
  {each('l.{}', list(K.HISTORY_ORIGIN + K.HISTORY_DEST))},
  l.carrier_avg_delay, l.carrier_delay_rate, l.flight_date
FROM led l LEFT JOIN rt t ON l.origin = t.ORIGIN AND l.dest = t.DEST
"""

_rush = "(6, 7, 8, 16, 17, 18, 19)"


def scenario(o: str, a: str, weekend: str, hour: str, miles: str) -> str:
    return (
        f"greatest(0.0E0, (({o} + {a}) / 2) * (CASE WHEN {weekend} = 1 THEN 1.2E0 ELSE 1.0E0 END)"
        f" * (CASE WHEN {hour} IN {_rush} THEN 1.3E0 ELSE 1.0E0 END) * (1 + ({miles} / 2000.0E0) * 0.1E0))"
    )


_defaults = {c: f"{v!r}E0" for c, v in K.REQUEST_DEFAULTS.items()}


def _avail(col: str) -> str:
    if col in ("carrier_delay_rate", "avg_carrier_delay"):
        return f"CASE WHEN c.OP_CARRIER IS NOT NULL THEN c.{col}_origin ELSE {_defaults[col]} END AS {col}"
    if col in ("total_delay_rate", "weather_delay_rate", "nas_delay_rate", "security_delay_rate",
               "late_aircraft_delay_rate"):
        return f"CASE WHEN a.ORIGIN IS NOT NULL THEN a.{col}_origin ELSE {_defaults[col]} END AS {col}"
    return f"{_defaults[col]} AS {col}"


AVAIL = f"""
SELECT r.query_id, r.rank, r.carrier, r.origin, r.dest, r.flight_date, r.dep_hour,
  c.OP_CARRIER IS NOT NULL AS has_carrier, a.ORIGIN IS NOT NULL AS has_origin, b.ORIGIN IS NOT NULL AS has_dest,
  r.origin AS airport, CAST(year(r.flight_date) AS INT) AS year, CAST(month(r.flight_date) AS INT) AS month,
  CASE WHEN isodow(r.flight_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  {', '.join(_avail(c) for c in K.REQUEST_DEFAULTS)},
  c.weather_delay_rate_origin AS carrier_weather_delay_rate,
  c.nas_delay_rate_origin AS carrier_nas_delay_rate,
  a.avg_delay_minutes_origin AS avg_delay_minutes,
  b.total_delay_rate_origin AS dest_delay_rate, b.avg_delay_minutes_origin AS dest_avg_delay,
  b.weather_delay_rate_origin AS dest_weather_delay_rate, b.nas_delay_rate_origin AS dest_nas_delay_rate
FROM req r LEFT JOIN lc c ON r.carrier = c.OP_CARRIER
LEFT JOIN la a ON r.origin = a.ORIGIN LEFT JOIN la b ON r.dest = b.ORIGIN
"""

HISTORY = """
SELECT ts AS timestamp, upper(substr(event_type, 1, 2)) || CAST(user_id AS VARCHAR) AS flight_number,
  upper(substr(event_type, 1, 2)) AS airline_code,
  'A' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS origin,
  'A' || lpad(CAST((user_id + 7) % 25 AS VARCHAR), 2, '0') AS destination,
  CAST(ts AS DATE) AS flight_date, CAST(hour(ts) AS INT) AS departure_hour,
  value AS predicted_delay, 12.5E0 AS confidence_mae
FROM events
"""
HIST_KEYED = """
SELECT *, flight_number || '_' || origin || '_' || destination || '_'
  || strftime(flight_date, '%Y-%m-%d') || '_' || CAST(departure_hour AS VARCHAR) AS history_key
FROM history
"""

_q = "(query_id + rank)"
DIRTY_FLIGHTS = f"""
SELECT query_id, rank,
  CASE WHEN {_q} % 5 = 0 THEN ' ' || lower(OP_CARRIER) || chr(9) ELSE OP_CARRIER END AS OP_CARRIER,
  ' ' || FL_NUM AS FL_NUM,
  CASE WHEN {_q} % 3 = 0 THEN lower(ORIGIN) ELSE ORIGIN END AS ORIGIN,
  CASE WHEN {_q} % 7 = 0 THEN DEST || 'X' ELSE DEST || ' ' END AS DEST,
  CASE WHEN query_id % 17 = 0 THEN 'n/a' WHEN query_id % 19 = 0 THEN CAST(CRS_DEP_TIME AS VARCHAR) || '.0'
    WHEN query_id % 23 = 0 THEN '2500' WHEN query_id % 29 = 0 THEN '-5' ELSE CAST(CRS_DEP_TIME AS VARCHAR) END AS CRS_DEP_TIME,
  CASE WHEN {_q} % 11 = 0 THEN '1d' WHEN {_q} % 13 = 0 THEN '' WHEN {_q} % 31 = 0 THEN 'NaN'
    ELSE CAST(DEP_DELAY AS VARCHAR) END AS DEP_DELAY,
  CASE WHEN query_id % 37 = 0 THEN 'not a date' ELSE CAST(FL_DATE AS VARCHAR) END AS FL_DATE,
  DISTANCE
FROM flights
"""
CLEAN_FLIGHTS = f"""
SELECT * FROM (
  SELECT upper({strip('OP_CARRIER')}) AS OP_CARRIER, {strip('FL_NUM')} AS FL_NUM,
    upper({strip('ORIGIN')}) AS ORIGIN, upper({strip('DEST')}) AS DEST, CRS_DEP_TIME,
    {number('DEP_DELAY')} AS DEP_DELAY, TRY_CAST(FL_DATE AS DATE) AS FL_DATE, DISTANCE,
    CAST(CASE WHEN {whole('CRS_DEP_TIME')} IS NOT NULL
      THEN least(23, greatest(0, floor({whole('CRS_DEP_TIME')} / 100.0E0))) END AS INT) AS DEP_HOUR
  FROM dirty_flights) t
WHERE DEP_HOUR IS NOT NULL AND DEP_DELAY BETWEEN -30 AND 300
"""
_n = "(year * 12 + month)"
DIRTY_DC = f"""
SELECT * REPLACE (
  CASE WHEN {_n} % 13 = 0 THEN NULL WHEN {_n} % 5 = 0 THEN '  ' || lower(carrier) ELSE carrier END AS carrier,
  CASE WHEN {_n} % 17 = 0 THEN 'n/a' WHEN {_n} % 19 = 0 THEN '0'
    ELSE CAST(CAST(arr_flights AS INT) AS VARCHAR) END AS arr_flights,
  CASE WHEN CAST(arr_flights AS INT) % 4 = 0 THEN 'bad' ELSE CAST(CAST(weather_ct AS INT) AS VARCHAR) END AS weather_ct)
FROM dc
"""

_o = "('Q' || chr(CAST(65 + CAST(substr(ORIGIN, 2, 2) AS INT) // 5 AS INT)) || chr(CAST(65 + CAST(substr(ORIGIN, 2, 2) AS INT) % 5 AS INT)))"
_d = _o.replace("ORIGIN", "DEST")
_name = "(OP_CARRIER || ' ' || FL_NUM)"
_h = "(CRS_DEP_TIME // 100)"
_m = "lpad(CAST(CRS_DEP_TIME % 100 AS VARCHAR), 2, '0')"
_h12 = f"CAST({_h} % 12 + 1 AS VARCHAR)"
_hs = f"CAST({_h} AS VARCHAR)"
RESULTS = f"""
SELECT query_id, rank, 'Result ' || CAST(rank AS VARCHAR) AS title,
  CASE (rank + CRS_DEP_TIME) % 8
    WHEN 0 THEN {_name} || ' departs ' || {_h12} || ':' || {_m} || ' AM from ' || {_o} || ' to ' || {_d}
    WHEN 1 THEN OP_CARRIER || FL_NUM || ' at ' || {_h12} || ' PM, ' || {_o} || ' → ' || {_d} || ' on time'
    WHEN 2 THEN {_o} || {_d} || ' delayed until ' || {_hs} || ':' || {_m}
    WHEN 3 THEN {_name} || ' and UA 77 landed 12:' || {_m} || ' PM, 12:05 AM'
    WHEN 4 THEN 'no schedule for this day'
    WHEN 5 THEN {_o} || ' - ' || {_d} || ' canceled; ' || {_name} || ' arrived 12 AM'
    WHEN 6 THEN lower({_o}) || '  ' || lower({_d}) || ' via aa1224'
    ELSE 'it is ' || {_hs} || ':' || {_m} || ' now' END AS snippet,
  '/r/' || OP_CARRIER || '/' || FL_NUM AS link, {_o} AS origin, {_d} AS dest
FROM flights
"""
RANKED = """
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, title, snippet, link) AS rn,
  upper(coalesce(title, '') || ' ' || coalesce(snippet, '')) AS text
FROM results
"""
# The scorer clock: hour and minute of the first time in the text.
_p12, _p24, _p1 = rf"'{K.CLOCK_12}'", rf"'{K.CLOCK_24}'", rf"'{K.CLOCK_HOUR}'"


def _x(pattern: str, group: int) -> str:
    return f"regexp_extract(text, {pattern}, {group})"


def _to24(hour: str, half: str) -> str:
    return (
        f"CASE WHEN {half} = 'PM' AND CAST({hour} AS INT) <> 12 THEN CAST({hour} AS INT) + 12 "
        f"WHEN {half} = 'AM' AND CAST({hour} AS INT) = 12 THEN 0 ELSE CAST({hour} AS INT) END"
    )


CLOCKED = f"""
SELECT *, CASE WHEN {_x(_p12, 1)} <> '' THEN {_to24(_x(_p12, 1), _x(_p12, 3))}
    WHEN {_x(_p24, 1)} <> '' THEN CAST({_x(_p24, 1)} AS INT)
    WHEN {_x(_p1, 1)} <> '' THEN {_to24(_x(_p1, 1), _x(_p1, 2))} END AS departure_hour,
  CASE WHEN {_x(_p12, 1)} <> '' THEN CAST({_x(_p12, 2)} AS INT)
    WHEN {_x(_p24, 1)} <> '' THEN CAST({_x(_p24, 2)} AS INT)
    WHEN {_x(_p1, 1)} <> '' THEN 0 END AS minute
FROM ranked
"""
_leg = (
    "'{\"departure_airport\":{\"time\":\"' || CAST(FL_DATE AS VARCHAR) || '\"},\"arrival_airport\":{\"time\":\"later\"},\"duration\":' "
    "|| CRS_DEP_TIME || ',\"airline\":\"' || OP_CARRIER || '\",\"flight_number\":\"' || OP_CARRIER || ' ' || FL_NUM "
    "|| '\",\"airplane\":\"B7\",\"travel_class\":\"Economy\",\"extensions\":[\"x\"]}'"
)
_trip = (
    "'{\"flights\":[' || " + _leg + " || '],\"price\":' || (cause * 50 + 100) || ',\"total_duration\":' || (CRS_DEP_TIME + 5) || '}'"
)
PAYLOADS = f"""
SELECT query_id, rank, ORIGIN AS origin, DEST AS destination,
  CASE (query_id + rank) % 5
    WHEN 0 THEN '{{"best_flights":[' || {_trip} || '],"other_flights":[]}}'
    WHEN 1 THEN '{{"best_flights":[],"other_flights":[' || {_trip} || ']}}'
    WHEN 2 THEN '{{"best_flights":[]}}'
    WHEN 3 THEN '{{"best_flights":[{{"flights":[],"price":1}}]}}'
    ELSE '{{"other_flights":[' || {_trip} || ']}}' END AS payload
FROM flights
"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "flights": (FLIGHTS, ()),
    "cf": (CF, ("flights",)),
    "dc": (DC, ("flights",)),
    "dcm": (DCM, ("dc",)),
    "dch": (DCH, ("dc",)),
    "lk": (LK, ("dch",)),
    "la": (LA, ("dch",)),
    "lc": (LC, ("dch",)),
    "enr": (ENR, ("cf", "lk")),
    "feat": (FEAT, ("enr",)),
    "req": (REQ, ("flights",)),
    "led": (LED, ("req", "la", "lc")),
    "rt": (RT, ("flights",)),
    "serv": (SERV, ("led", "rt")),
    "avail": (AVAIL, ("req", "la", "lc")),
    "history": (HISTORY, ()),
    "keyed": (HIST_KEYED, ("history",)),
    "dirty_flights": (DIRTY_FLIGHTS, ("flights",)),
    "clean_flights": (CLEAN_FLIGHTS, ("dirty_flights",)),
    "dirty_dc": (DIRTY_DC, ("dc",)),
    "results": (RESULTS, ("flights",)),
    "ranked": (RANKED, ("results",)),
    "clocked": (CLOCKED, ("ranked",)),
    "payloads": (PAYLOADS, ("flights",)),
}


def with_views(names: str, body: str, **extra: str) -> str:
    """``body`` behind the named views, their inputs and any extra ones."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for n in names.split():
        need(n)
    parts = [f"{n} AS ({VIEWS[n][0].strip()})" for n in order]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body.strip()}"


def digest_sql(cols: list[str], doubles: tuple[str, ...] = ()) -> str:
    parts = []
    for c in cols:
        value = f"CAST(round({c} * 1000000) AS BIGINT)" if c in doubles else c
        parts.append(f"coalesce(CAST({value} AS VARCHAR), '')")
    return f"md5(concat_ws('|', {', '.join(parts)}))"
