"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

The SQL is written independently of the Spark code: it restates each
operator's semantics as plain SQL over the pre-registered driver views.
Shared "dirty" views and the star bindings are CTEs composed below.
"""

from __future__ import annotations


# ------------------------------------------------------------------ helpers

def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def title(x: str) -> str:
    return rf"array_to_string(list_transform(regexp_extract_all({x}, '([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)'), lambda r: upper(r[1]) || lower(r[2:])), '')"


def r4(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 4)"


def clean_city(raw: str, state: str, code: str) -> str:
    def norm(v):
        return f"lower(replace({strip(v)}, '.', ''))"
    suffix = norm(f"regexp_extract({raw}, '^(.*),([^,]*)$', 2)")
    base = strip(f"regexp_extract({raw}, '^(.*),([^,]*)$', 1)")
    return (f"CASE WHEN {raw} IS NULL THEN NULL "
            f"WHEN {raw} LIKE '%,%' AND {suffix} <> '' AND ({suffix} = {norm(f'coalesce(CAST({state} AS VARCHAR), {chr(39)}{chr(39)})')} "
            f"OR {suffix} = {norm(f'coalesce(CAST({code} AS VARCHAR), {chr(39)}{chr(39)})')}) THEN {base} ELSE {raw} END")


LOAD_TS = "'2024-02-01 00:00:00'"

# ------------------------------------------------------------------ views

EVENTS_DIRTY = """events_dirty AS (
  SELECT event_id, ts,
         user_id + CASE WHEN event_id % 31 = 0 THEN 100000 ELSE 0 END AS user_id,
         CASE WHEN event_id % 5 = 0 THEN '  ' || upper(event_type)
              WHEN event_id % 7 = 0 THEN event_type || ' '
              ELSE event_type END AS event_type,
         CASE WHEN event_id % 53 = 0 THEN 'not-a-date' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS event_date,
         CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS event_hour,
         CASE WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 97 = 0 THEN value * 100
              WHEN event_id % 101 = 0 THEN -value
              ELSE value END AS value,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(event_id % 5 AS INTEGER) END AS status
  FROM events)"""

OBS = """obs AS (
  SELECT CAST(row_number() OVER (ORDER BY station, obs_date, obs_hour) AS BIGINT) AS obs_id, *
  FROM (SELECT event_type AS station, CAST(ts AS DATE) AS obs_date,
               CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS obs_hour,
               avg(value) AS spd, max(value) AS gust, min(value) AS low, count(*) AS n
        FROM events GROUP BY 1, 2, 3) g)"""

OBS_DIRTY = OBS + """,
obs_dirty AS (
  SELECT obs_id, station, obs_date, obs_hour, n,
         CASE WHEN obs_id % 13 = 0 THEN NULL ELSE spd END AS spd,
         CASE WHEN obs_id % 13 = 0 OR obs_id % 11 = 0 THEN NULL
              WHEN obs_id % 19 = 0 THEN spd / 2 ELSE gust END AS gust,
         CASE WHEN obs_id % 13 = 0 THEN NULL
              WHEN obs_id % 23 = 0 THEN gust + 1 ELSE low END AS low
  FROM obs)"""

NATION_DIRTY = """nation_dirty AS (
  SELECT n_nationkey, n_regionkey,
         CASE WHEN n_nationkey % 4 = 0 THEN ' ' || lower(n_name) || ', R.' || CAST(n_regionkey AS VARCHAR)
              ELSE n_name END AS n_name
  FROM nation)"""

STATIONS = NATION_DIRTY + """,
stations AS (
  SELECT n.n_nationkey AS airport, n.n_name AS display_airport_name, n.n_name AS display_airport_city_name_full,
         r.r_name AS airport_state_name, 'R' || CAST(n.n_regionkey AS VARCHAR) AS airport_state_code,
         CAST(n.n_nationkey AS DOUBLE) AS latitude, CAST(n.n_regionkey AS DOUBLE) AS longitude
  FROM nation_dirty n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LINEITEM_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

STAR_FLIGHTS = f"""star_flights AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         CAST(l.l_shipdate AS DATE) AS fl_date,
         CAST(l.l_orderkey % 24 AS INTEGER) AS dep_hour,
         c.c_nationkey AS origin, s.s_nationkey AS dest,
         l.l_suppkey AS mkt_unique_carrier, l.l_suppkey AS op_unique_carrier, l.l_partkey AS tail_num,
         CASE WHEN (l.l_orderkey + l.l_linenumber) % 10 = 0 THEN NULL
              WHEN l.l_returnflag = 'N' THEN 'Not Cancelled' ELSE l.l_returnflag END AS cancellation_reason,
         l.l_linestatus AS weather_description,
         l.l_quantity AS dep_delay, l.l_discount * 100 AS taxi_out, l.l_tax * 100 AS air_time,
         l.l_extendedprice AS distance
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""


def holiday_dates_sql(years_cte: str) -> str:
    """Federal holiday dates (observed) for the years in ``years_cte`` (column y) +-1."""
    def obs(d):
        return (f"(CASE isodow({d}) WHEN 6 THEN {d} - INTERVAL 1 DAY WHEN 7 THEN {d} + INTERVAL 1 DAY "
                f"ELSE {d} END)")

    def nth(m, dow, n):  # dow: ISO 1=Mon..7=Sun
        first = f"make_date(y, {m}, 1)"
        return f"({first} + INTERVAL (((({dow} - isodow({first})) + 7) % 7) + 7 * ({n} - 1)) DAY)"

    last_mon_may = "(make_date(y, 5, 31) - INTERVAL ((isodow(make_date(y, 5, 31)) - 1 + 7) % 7) DAY)"
    rules = [
        (obs("make_date(y, 1, 1)"), "TRUE"), (nth(1, 1, 3), "y >= 1986"), (nth(2, 1, 3), "TRUE"),
        (last_mon_may, "TRUE"), (obs("make_date(y, 6, 19)"), "y >= 2021"), (obs("make_date(y, 7, 4)"), "TRUE"),
        (nth(9, 1, 1), "TRUE"), (nth(10, 1, 2), "TRUE"), (obs("make_date(y, 11, 11)"), "TRUE"),
        (nth(11, 4, 4), "TRUE"), (obs("make_date(y, 12, 25)"), "TRUE"),
    ]
    yrs = f"(SELECT DISTINCT y + k AS y FROM {years_cte}, (VALUES (-1), (0), (1)) kk(k))"
    parts = [f"SELECT CAST({d} AS DATE) AS hd FROM {yrs} WHERE {cond}" for d, cond in rules]
    return " UNION ".join(parts)


def star_dims(with_fact_ids: bool = True) -> str:
    """CTEs: star_flights, dim_fl_dates, dim_dep_hours, dim_stations, dim_carriers,
    dim_aircraft, dim_junk (ids dense in natural-key order, nulls last)."""
    city = clean_city(title(strip("display_airport_city_name_full")), "airport_state_name", "airport_state_code")
    return f"""{STAR_FLIGHTS},
{STATIONS},
fd AS (SELECT DISTINCT fl_date AS FL_DATE FROM star_flights WHERE fl_date IS NOT NULL),
fd_years AS (SELECT DISTINCT CAST(year(FL_DATE) AS INTEGER) AS y FROM fd),
hol AS ({holiday_dates_sql('fd_years')}),
dim_fl_dates AS (
  SELECT CAST(row_number() OVER (ORDER BY FL_DATE) AS BIGINT) AS FL_DATE_ID, FL_DATE,
         strftime(FL_DATE, '%A') AS DAY_OF_WEEK,
         FL_DATE IN (SELECT hd FROM hol) AS IS_HOLIDAY,
         CAST(month(FL_DATE) AS SMALLINT) AS MONTH, CAST(quarter(FL_DATE) AS SMALLINT) AS QUARTER,
         CAST(year(FL_DATE) AS SMALLINT) AS YEAR, {LOAD_TS} AS LOAD_TIMESTAMP
  FROM fd),
dim_dep_hours AS (
  SELECT CAST(row_number() OVER (ORDER BY DEP_HOUR) AS BIGINT) AS DEP_HOUR_ID, DEP_HOUR,
         CASE WHEN DEP_HOUR >= 0 AND DEP_HOUR < 4 THEN 'Night' WHEN DEP_HOUR >= 4 AND DEP_HOUR < 8 THEN 'Early Morning'
              WHEN DEP_HOUR >= 8 AND DEP_HOUR < 12 THEN 'Morning' WHEN DEP_HOUR >= 12 AND DEP_HOUR < 16 THEN 'Afternoon'
              WHEN DEP_HOUR >= 16 AND DEP_HOUR < 20 THEN 'Evening' ELSE 'Late Evening' END AS TIME_BAND,
         {LOAD_TS} AS LOAD_TIMESTAMP
  FROM (SELECT DISTINCT dep_hour AS DEP_HOUR FROM star_flights WHERE dep_hour IS NOT NULL) h),
st1 AS (
  SELECT airport AS AIRPORT_CODE, {title(strip('display_airport_name'))} AS AIRPORT_NAME, {city} AS CITY,
         airport_state_name AS STATE, latitude AS LATITUDE, longitude AS LONGITUDE
  FROM stations),
st2 AS (SELECT *, row_number() OVER (PARTITION BY AIRPORT_CODE ORDER BY AIRPORT_NAME, CITY, STATE, LATITUDE, LONGITUDE) AS rn FROM st1),
dim_stations AS (
  SELECT CAST(row_number() OVER (ORDER BY AIRPORT_CODE) AS BIGINT) AS STATION_ID, AIRPORT_CODE, AIRPORT_NAME, CITY,
         STATE, LATITUDE, LONGITUDE, {LOAD_TS} AS LOAD_TIMESTAMP
  FROM st2 WHERE rn = 1),
ca1 AS (SELECT s_suppkey AS CODE, s_name AS DESCRIPTION,
               row_number() OVER (PARTITION BY s_suppkey ORDER BY s_name) AS rn FROM supplier),
dim_carriers AS (
  SELECT CAST(row_number() OVER (ORDER BY CODE) AS BIGINT) AS CARRIER_ID, CODE, DESCRIPTION, {LOAD_TS} AS LOAD_TIMESTAMP
  FROM ca1 WHERE rn = 1),
ac1 AS (SELECT p_partkey AS TAIL_NUM, p_brand AS MANUFACTURER, CAST(1950 + p_size AS INTEGER) AS yom,
               row_number() OVER (PARTITION BY p_partkey ORDER BY p_brand, p_size) AS rn FROM part),
dim_aircraft AS (
  SELECT CAST(row_number() OVER (ORDER BY TAIL_NUM) AS BIGINT) AS AIRCRAFT_ID, TAIL_NUM, MANUFACTURER,
         CAST((SELECT max(year(fl_date)) FROM star_flights) - yom AS INTEGER) AS AIRCRAFT_AGE,
         {LOAD_TS} AS LOAD_TIMESTAMP
  FROM ac1 WHERE rn = 1),
dim_junk AS (
  SELECT CAST(row_number() OVER (ORDER BY CANCELLATION_REASON ASC NULLS LAST, WEATHER_DESCRIPTION ASC NULLS LAST) AS BIGINT) AS JUNK_ID,
         CANCELLATION_REASON, WEATHER_DESCRIPTION, {LOAD_TS} AS LOAD_TIMESTAMP
  FROM (SELECT DISTINCT cancellation_reason AS CANCELLATION_REASON, weather_description AS WEATHER_DESCRIPTION
        FROM star_flights) j)"""


def star_fact() -> str:
    """CTEs of star_dims plus the fact (FLIGHT_ID dense in line-item order)."""
    return star_dims() + f""",
fact AS (
  SELECT CAST(row_number() OVER (ORDER BY {', '.join('f.' + c.strip() for c in LINEITEM_ORDER.split(','))}) AS BIGINT) AS FLIGHT_ID,
         d.FL_DATE_ID, h.DEP_HOUR_ID, so.STATION_ID AS ORIGIN_STATION_ID, sd.STATION_ID AS DEST_STATION_ID,
         cm.CARRIER_ID AS MKT_CARRIER_ID, co.CARRIER_ID AS OP_CARRIER_ID, a.AIRCRAFT_ID,
         coalesce(j.JUNK_ID, (SELECT min(JUNK_ID) FROM dim_junk WHERE CANCELLATION_REASON IS NULL AND WEATHER_DESCRIPTION IS NULL)) AS JUNK_ID,
         f.dep_delay AS DEP_DELAY, f.taxi_out AS TAXI_OUT, f.air_time AS AIR_TIME, f.distance AS DISTANCE,
         f.cancellation_reason AS CANCELLATION_REASON,
         {LOAD_TS} AS LOAD_TIMESTAMP
  FROM star_flights f
  LEFT JOIN dim_fl_dates d ON f.fl_date = d.FL_DATE
  LEFT JOIN dim_dep_hours h ON f.dep_hour = h.DEP_HOUR
  LEFT JOIN dim_stations so ON f.origin = so.AIRPORT_CODE
  LEFT JOIN dim_stations sd ON f.dest = sd.AIRPORT_CODE
  LEFT JOIN dim_carriers cm ON f.mkt_unique_carrier = cm.CODE
  LEFT JOIN dim_carriers co ON f.op_unique_carrier = co.CODE
  LEFT JOIN dim_aircraft a ON f.tail_num = a.TAIL_NUM
  LEFT JOIN dim_junk j ON f.cancellation_reason IS NOT DISTINCT FROM j.CANCELLATION_REASON
                      AND f.weather_description IS NOT DISTINCT FROM j.WEATHER_DESCRIPTION)"""


SQL: dict[str, str] = {}


def _q(key: str, sql: str) -> None:
    SQL[key] = sql.strip()


# ------------------------------------------------------------------ K / C5 / C9 / D34 / F1

_q("K1_build_fl_dates", f"""WITH {star_dims()}
SELECT FL_DATE_ID, CAST(FL_DATE AS VARCHAR) AS FL_DATE, DAY_OF_WEEK, IS_HOLIDAY, MONTH, QUARTER, YEAR, LOAD_TIMESTAMP
FROM dim_fl_dates""")
_q("K2_build_dep_hours", f"WITH {star_dims()} SELECT * FROM dim_dep_hours")
_q("K3_build_stations", f"WITH {star_dims()} SELECT * FROM dim_stations")
_q("K4_build_carriers", f"WITH {star_dims()} SELECT CARRIER_ID, DESCRIPTION, LOAD_TIMESTAMP FROM dim_carriers")
_q("K5_build_aircraft", f"WITH {star_dims()} SELECT * FROM dim_aircraft")
_q("K6_build_junk", f"WITH {star_dims()} SELECT * FROM dim_junk")
_q("K7_build_fact", f"""WITH {star_fact()}
SELECT FLIGHT_ID, FL_DATE_ID, DEP_HOUR_ID, ORIGIN_STATION_ID, DEST_STATION_ID, MKT_CARRIER_ID, OP_CARRIER_ID,
       AIRCRAFT_ID, JUNK_ID, {r4('DEP_DELAY')} AS DEP_DELAY, {r4('TAXI_OUT')} AS TAXI_OUT, {r4('AIR_TIME')} AS AIR_TIME,
       {r4('DISTANCE')} AS DISTANCE, LOAD_TIMESTAMP FROM fact""")
_q("K8_holiday_flags", f"""WITH {star_dims()}
SELECT CAST(FL_DATE AS VARCHAR) AS FL_DATE, DAY_OF_WEEK FROM dim_fl_dates WHERE IS_HOLIDAY""")
_q("C5_surrogate_key_lookup", f"""WITH {star_fact()}
SELECT FLIGHT_ID, FL_DATE_ID, DEP_HOUR_ID, ORIGIN_STATION_ID, DEST_STATION_ID, MKT_CARRIER_ID, OP_CARRIER_ID, AIRCRAFT_ID FROM fact""")
_q("C6_junk_lookup", f"WITH {star_fact()} SELECT FLIGHT_ID, JUNK_ID FROM fact")
_q("C9_star_join", f"""WITH {star_fact()}
SELECT f.FLIGHT_ID, s.STATE AS ORIGIN_STATE, d.MONTH, {r4('f.DEP_DELAY')} AS DEP_DELAY, {r4('f.DISTANCE')} AS DISTANCE
FROM fact f LEFT JOIN dim_stations s ON f.ORIGIN_STATION_ID = s.STATION_ID
LEFT JOIN dim_fl_dates d ON f.FL_DATE_ID = d.FL_DATE_ID""")
_D34 = f"""{star_fact()},
d34 AS (
  SELECT s.STATE AS ORIGIN_STATE, d.MONTH, avg(f.DEP_DELAY) AS avg_dep_delay, avg(f.DISTANCE) AS avg_distance,
         count(f.FLIGHT_ID) AS n_flights
  FROM fact f LEFT JOIN dim_stations s ON f.ORIGIN_STATION_ID = s.STATION_ID
  LEFT JOIN dim_fl_dates d ON f.FL_DATE_ID = d.FL_DATE_ID
  WHERE s.STATE IS NOT NULL AND d.MONTH IS NOT NULL
  GROUP BY 1, 2)"""
_q("D34_delay_by_state_month", f"""WITH {_D34}
SELECT ORIGIN_STATE, MONTH, {r4('avg_dep_delay')} AS avg_dep_delay, {r4('avg_distance')} AS avg_distance, n_flights
FROM d34 ORDER BY ORIGIN_STATE, MONTH""")
_q("F1_top_states", f"""WITH {_D34}
SELECT ORIGIN_STATE, {r4('avg(avg_dep_delay)')} AS avg_dep_delay, CAST(sum(n_flights) AS BIGINT) AS n_flights
FROM d34 GROUP BY ORIGIN_STATE ORDER BY avg(avg_dep_delay) DESC, ORIGIN_STATE LIMIT 10""")


# ------------------------------------------------------------------ data quality

def _score(issues: str, total: str) -> str:
    return f"round(CASE WHEN ({total}) > 0 THEN 1.0 - CAST(({issues}) AS DOUBLE) / ({total}) ELSE 0.0 END, 4)"


def _status(s: str) -> str:
    return f"CASE WHEN {s} >= 0.95 THEN 'PASS' WHEN {s} >= 0.80 THEN 'WARN' ELSE 'FAIL' END"


def _parses(x: str) -> str:
    return (f"(try_strptime(CAST({x} AS VARCHAR), '%Y-%m-%d') IS NOT NULL "
            f"OR try_strptime(CAST({x} AS VARCHAR), '%Y-%m-%d %H:%M:%S') IS NOT NULL)")


EV_REQ = ["event_id", "ts", "user_id", "event_type", "event_date", "event_hour", "value", "status"]
EV_VALID = [("event_type", "regexp_matches(event_type, '^[A-Za-z]+$')"), ("event_date", _parses("event_date")),
            ("event_hour", "event_hour BETWEEN 0 AND 23"), ("value", "value BETWEEN 0 AND 100"),
            ("status", "status IN (0, 1, 2, 3, 4)")]
EV_CONS = [("cancelled_no_value", "NOT coalesce(coalesce(status, 0) > 0 AND value > 0, FALSE)"),
           ("value_present_unless_cancelled", "value IS NOT NULL OR coalesce(coalesce(status, 0) > 0, FALSE)"),
           ("fk_user_id", "user_id IS NULL OR user_id IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)")]
EV_KEYS = ["user_id", "event_date", "event_hour", "event_type"]
OB_REQ = ["obs_id", "station", "obs_date", "obs_hour", "spd", "gust", "low"]
OB_VALID = [("obs_hour", "obs_hour BETWEEN 0 AND 23"), ("spd", "spd BETWEEN 0 AND 100"),
            ("gust", "gust BETWEEN 0 AND 100"), ("low", "low BETWEEN 0 AND 100")]
OB_CONS = [("low_le_gust", "coalesce(low <= gust, FALSE) OR low IS NULL OR gust IS NULL"),
           ("gust_ge_spd", "coalesce(gust >= spd, FALSE) OR gust IS NULL OR spd IS NULL")]
OB_KEYS = ["station", "obs_date", "obs_hour"]


def _inv(col, pred):
    return f"({col} IS NOT NULL AND NOT coalesce({pred}, FALSE))"


def scorecard_sql(table, src, req, valid, cons, keys, time_col=None, accuracy=None, dims=None):
    """Scorecard rows (Table, Dimension, Score, Issues, Status, Details) as a SELECT."""
    aggs = ["count(*) AS n"]
    aggs += [f"count(*) FILTER (WHERE {c} IS NULL) AS miss_{i}" for i, c in enumerate(req)]
    aggs += [f"count(*) FILTER (WHERE {_inv(c, p)}) AS inv_{i}" for i, (c, p) in enumerate(valid)]
    if valid:
        aggs.append("count(*) FILTER (WHERE " + " OR ".join(_inv(c, p) for c, p in valid) + ") AS inv_any")
    if cons:
        aggs.append("count(*) FILTER (WHERE NOT (" + " AND ".join(f"coalesce({p}, FALSE)" for _, p in cons) + ")) AS incons")
    if time_col:
        t = f"coalesce(try_strptime(CAST({time_col} AS VARCHAR), '%Y-%m-%d %H:%M:%S'), try_strptime(CAST({time_col} AS VARCHAR), '%Y-%m-%d'))"
        stale = f"coalesce(floor(epoch(TIMESTAMP '2024-02-01 00:00:00' - {t}) / 86400) > 1825, FALSE)"
        fut = f"coalesce({t} > TIMESTAMP '2024-02-01 00:00:00', FALSE)"
        aggs += [f"count(*) FILTER (WHERE {stale}) AS stale", f"count(*) FILTER (WHERE {fut}) AS fut",
                 f"count(*) FILTER (WHERE {stale} OR {fut}) AS late"]
    if accuracy:
        c, r, tol = accuracy
        aggs.append(f"count(*) FILTER (WHERE coalesce(abs({c} - {r}) > {tol}, FALSE)) AS acc")
    keylist = ", ".join(keys)
    rows = []
    miss_sum = " + ".join(f"miss_{i}" for i in range(len(req)))
    miss_det = ("'Missing per column: {' || concat_ws(', ', " +
                ", ".join(f"CASE WHEN miss_{i} > 0 THEN '''{c}'': ' || CAST(miss_{i} AS VARCHAR) END" for i, c in enumerate(req))
                + ") || '}'")
    rows.append(("Completeness", miss_sum, f"n * {len(req)}", miss_det))
    keys_py = "[" + ", ".join(f"''{k}''" for k in keys) + "]"
    rows.append(("Uniqueness", "dups", "n", f"'Duplicate rows on {keys_py}: ' || CAST(dups AS VARCHAR)"))
    if valid:
        det = "concat_ws(' | ', " + ", ".join(f"'{c}: ' || CAST(inv_{i} AS VARCHAR) || ' invalid'" for i, (c, _) in enumerate(valid)) + ")"
        rows.append(("Validity", "inv_any", "n", det))
    if cons:
        rows.append(("Consistency", "incons", "n", "CAST(incons AS VARCHAR) || ' rows violate rules'"))
    if time_col:
        rows.append(("Timeliness", "late", "n", "'Future dates: ' || CAST(fut AS VARCHAR) || ' | Stale (>1825d): ' || CAST(stale AS VARCHAR)"))
    if accuracy:
        c, r, tol = accuracy
        rows.append(("Accuracy", "acc", "n", f"'{c} vs {r} (tol={tol}): ' || CAST(acc AS VARCHAR) || ' inaccurate'"))
    if dims:
        rows = [r for r in rows if r[0] in dims]
    sel = " UNION ALL ".join(
        f"SELECT '{table}' AS \"Table\", '{d}' AS Dimension, {_score(i, t)} AS Score, CAST({i} AS BIGINT) AS Issues, "
        f"{_status(_score(i, t))} AS Status, {det} AS Details FROM c" for d, i, t, det in rows)
    return (f"(WITH c AS (SELECT * FROM (SELECT {', '.join(aggs)} FROM {src}) a, "
            f"(SELECT coalesce(sum(k) FILTER (WHERE k > 1), 0) AS dups FROM (SELECT count(*) AS k FROM {src} GROUP BY {keylist}) g) u) "
            f"{sel})")


EV_SRC = "(SELECT *, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS ts_hour FROM events_dirty)"


def ev_card(dims=None):
    return scorecard_sql("events_dirty", EV_SRC, EV_REQ, EV_VALID, EV_CONS, EV_KEYS, "event_date",
                         ("event_hour", "ts_hour", 0), dims)


def ob_card():
    return scorecard_sql("obs_dirty", "obs_dirty", OB_REQ, OB_VALID, OB_CONS, OB_KEYS, "obs_date")


for _k, _d in [("D1_completeness", "Completeness"), ("D2_uniqueness", "Uniqueness"), ("D3_validity", "Validity"),
               ("D4_consistency", "Consistency"), ("D5_timeliness", "Timeliness"), ("D6_accuracy", "Accuracy")]:
    _q(_k, f"WITH {EVENTS_DIRTY} SELECT Dimension, Score, Issues FROM {ev_card([_d])} x")
_q("D7_scorecard", f"WITH {EVENTS_DIRTY} SELECT * FROM {ev_card()} x")
_CARDS = f"WITH {EVENTS_DIRTY}, {OBS_DIRTY}, cards AS (SELECT * FROM {ev_card()} a UNION ALL SELECT * FROM {ob_card()} b)"
_q("D9_run_dqa", f"{_CARDS} SELECT * FROM cards")
_q("G1_union_reports", f"{_CARDS} SELECT \"Table\", Dimension, Score, Issues, Status FROM cards")
_q("D8_overall_score", f"{_CARDS} SELECT \"Table\", round(coalesce(avg(Score), 0.0), 4) AS overall_score FROM cards GROUP BY 1")
_q("D39_scorecard_pivot", f"""{_CARDS}
SELECT "Table", """ + ", ".join(
    f"least(greatest(max(Score) FILTER (WHERE Dimension = '{d}'), 0.0), 1.0) AS {d}"
    for d in ["Completeness", "Uniqueness", "Validity", "Consistency", "Timeliness"]) + " FROM cards GROUP BY 1")
_q("D10_validity_rules", f"WITH {EVENTS_DIRTY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_inv(c, p)}) AS n_invalid FROM events_dirty" for c, p in EV_VALID))
_q("D11_consistency_rules", f"WITH {EVENTS_DIRTY} " + " UNION ALL ".join(
    f"SELECT '{k}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, FALSE)) AS n_violations FROM events_dirty" for k, p in EV_CONS))
_q("C12_fk_membership", f"""WITH {EVENTS_DIRTY}
SELECT count(*) FILTER (WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)) AS n_broken,
       count(*) FILTER (WHERE user_id IS NULL OR user_id IN (SELECT c_custkey FROM customer)) AS n_ok
FROM events_dirty""")


# ------------------------------------------------------------------ cleaning chain on events_dirty

def _pdate(x):
    return (f"strftime(coalesce(try_strptime(CAST({x} AS VARCHAR), '%Y-%m-%d'), "
            f"try_strptime(CAST({x} AS VARCHAR), '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d')")


_CUST = "(SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IS NOT NULL)"
EV_CHAIN = EVENTS_DIRTY + f""",
s1 AS (SELECT *, {strip('event_type')} AS n1 FROM events_dirty),
a1 AS (SELECT 'standardize_strings' AS step, 'event_type' AS column_name, CAST(event_id AS VARCHAR) AS row_id,
              event_type AS before, n1 AS after, 'spacing and case unified' AS reason
       FROM s1 WHERE event_type IS NOT NULL AND n1 <> event_type),
t1 AS (SELECT * EXCLUDE (n1) REPLACE (n1 AS event_type) FROM s1),
s2 AS (SELECT *, {_pdate('event_date')} AS n2 FROM t1),
a2 AS (SELECT 'parse_dates', 'event_date', CAST(event_id AS VARCHAR), event_date, n2, 'date as yyyy-MM-dd'
       FROM s2 WHERE event_date IS NOT NULL AND n2 IS DISTINCT FROM event_date),
t2 AS (SELECT * EXCLUDE (n2) REPLACE (n2 AS event_date) FROM s2),
s3 AS (SELECT *, CASE WHEN coalesce(value < 0 OR value > 100, FALSE) THEN NULL ELSE value END AS n3 FROM t2),
a3 AS (SELECT 'fix_validity_range:value', 'value', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR), CAST(n3 AS VARCHAR),
              'outside [0, 100], emptied' FROM s3 WHERE value IS DISTINCT FROM n3),
t3 AS (SELECT * EXCLUDE (n3) REPLACE (n3 AS value) FROM s3),
s4 AS (SELECT *, CASE WHEN status IS NULL OR status IN (0, 1, 2, 3) THEN status END AS n4 FROM t3),
a4 AS (SELECT 'fix_invalid_to_null:status', 'status', CAST(event_id AS VARCHAR), CAST(status AS VARCHAR), CAST(n4 AS VARCHAR),
              'not an allowed value, emptied' FROM s4 WHERE status IS NOT NULL AND n4 IS NULL),
t4 AS (SELECT * EXCLUDE (n4) REPLACE (n4 AS status) FROM s4),
s5 AS (SELECT *, CASE WHEN user_id IN {_CUST} THEN user_id END AS n5 FROM t4),
a5 AS (SELECT 'fix_fk_to_null:user_id', 'user_id', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(n5 AS VARCHAR),
              'no such parent key, emptied' FROM s5 WHERE user_id IS NOT NULL AND n5 IS NULL),
t5 AS (SELECT * EXCLUDE (n5) REPLACE (n5 AS user_id) FROM s5),
s6 AS (SELECT *, CASE WHEN coalesce(coalesce(status, 0) > 0 AND value > 0, FALSE) THEN NULL ELSE value END AS n6 FROM t5),
a6 AS (SELECT 'fix_cancelled_air_time', 'value', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR), CAST(n6 AS VARCHAR),
              'not flown, emptied' FROM s6 WHERE value IS DISTINCT FROM n6),
t6 AS (SELECT * EXCLUDE (n6) REPLACE (n6 AS value) FROM s6),
b7s AS (SELECT list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS arr,
                count(value) AS n, CAST(0.99 AS DOUBLE) * (count(value) - 1) AS pos FROM t6),
b7 AS (SELECT arr[1] AS lo,
              CASE WHEN floor(pos) = ceil(pos) OR arr[CAST(floor(pos) AS BIGINT) + 1] = arr[CAST(ceil(pos) AS BIGINT) + 1]
                   THEN arr[CAST(floor(pos) AS BIGINT) + 1]
                   ELSE (ceil(pos) - pos) * arr[CAST(floor(pos) AS BIGINT) + 1]
                        + (pos - floor(pos)) * arr[CAST(ceil(pos) AS BIGINT) + 1] END AS hi FROM b7s),
s7 AS (SELECT t6.*, CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, lo), hi) END AS n7 FROM t6, b7),
a7 AS (SELECT 'winsorize_numeric', 'value', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR), CAST(n7 AS VARCHAR),
              'clipped to quantiles [0.0, 0.99]' FROM s7 WHERE value IS NOT NULL AND n7 <> value),
t7 AS (SELECT * EXCLUDE (n7) REPLACE (n7 AS value) FROM s7),
gm AS (SELECT median(value) AS gmed FROM t7),
grp AS (SELECT event_type AS g, median(value) AS gmv FROM t7 GROUP BY 1),
s8 AS (SELECT t7.*, coalesce(grp.gmv, gm.gmed) AS fill FROM t7 CROSS JOIN gm LEFT JOIN grp ON t7.event_type IS NOT DISTINCT FROM grp.g),
a8 AS (SELECT 'impute_numeric_nulls_by_group_median:value', 'value', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR),
              CAST(fill AS VARCHAR), 'median within event_type' FROM s8 WHERE value IS NULL AND fill IS NOT NULL),
ev_clean AS (SELECT * EXCLUDE (fill) REPLACE (CASE WHEN value IS NULL THEN fill ELSE value END AS value) FROM s8),
audit AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a3 UNION ALL SELECT * FROM a4
          UNION ALL SELECT * FROM a5 UNION ALL SELECT * FROM a6 UNION ALL SELECT * FROM a7 UNION ALL SELECT * FROM a8)"""

_q("D26_audit_log", f"WITH {EV_CHAIN} SELECT * FROM audit")
_q("D27_audit_summary", f"""WITH {EV_CHAIN}
SELECT step, count(*) AS changes, array_to_string(list_sort(list_distinct(list(column_name))), ', ') AS cols_affected
FROM audit GROUP BY step ORDER BY changes DESC""")
SQL["F2_report_sort"] = SQL["D27_audit_summary"]
_CLEAN_CARD = scorecard_sql("events_dirty", "(SELECT *, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS ts_hour FROM ev_clean)",
                            EV_REQ, EV_VALID, EV_CONS, EV_KEYS, "event_date", ("event_hour", "ts_hour", 0))
_q("C8_scorecard_compare", f"""WITH {EV_CHAIN}, bef AS (SELECT * FROM {ev_card()} x), aft AS (SELECT * FROM {_CLEAN_CARD} y)
SELECT b.Dimension, b.Score AS Score_before, b.Issues AS Issues_before, b.Status AS Status_before,
       a.Score AS Score_after, a.Issues AS Issues_after, a.Status AS Status_after,
       round(a.Score - b.Score, 4) AS Delta,
       CASE WHEN round(a.Score - b.Score, 4) > 0 THEN 'YES' WHEN round(a.Score - b.Score, 4) = 0 THEN '=' ELSE 'NO' END AS Improved
FROM bef b JOIN aft a ON b.Dimension = a.Dimension""")
_EVC = ["event_id", "ts", "user_id", "event_type", "event_date", "event_hour", "value", "status"]
_q("D15_table_counts", f"""WITH {EV_CHAIN},
b AS (SELECT count(*) AS rows_before, CAST({' + '.join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _EVC)} AS BIGINT) AS nulls_before FROM events_dirty),
a AS (SELECT count(*) AS rows_after, CAST({' + '.join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _EVC)} AS BIGINT) AS nulls_after FROM ev_clean)
SELECT 'events_dirty' AS table_name, rows_before, rows_after, rows_before - rows_after AS rows_removed, nulls_before, nulls_after FROM b, a""")

_q("B1_standardize_strings", f"""WITH {NATION_DIRTY}
SELECT n_nationkey, {title(strip('n_name'))} AS n_name_title, upper({strip('n_name')}) AS n_name_upper FROM nation_dirty""")
_q("B2_parse_dates", f"WITH {EVENTS_DIRTY} SELECT event_id, {_pdate('event_date')} AS event_date FROM events_dirty")
_q("B3_winsorize", f"""WITH {EVENTS_DIRTY}, b AS (SELECT quantile_cont(value, 0.0) AS lo, quantile_cont(value, 0.99) AS hi FROM events_dirty)
SELECT event_id, round(CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, lo), hi) END, 4) AS value FROM events_dirty, b""")
_q("B4_invalid_pattern", f"""WITH {EVENTS_DIRTY}
SELECT event_id, CASE WHEN event_type IS NULL OR regexp_matches(event_type, '^[a-z]{{4,8}}$') THEN event_type END AS event_type FROM events_dirty""")
_q("B5_invalid_to_null", f"WITH {EVENTS_DIRTY} SELECT event_id, CASE WHEN status IS NULL OR status IN (0, 1, 2, 3) THEN status END AS status FROM events_dirty")
_q("B6_pattern_to_null", "SELECT p_partkey, CASE WHEN p_brand IS NULL OR regexp_matches(p_brand, '^Brand#[0-9]$') THEN p_brand END AS p_brand FROM part")
_q("B7_validity_range", f"""WITH {EVENTS_DIRTY}
SELECT event_id, round(CASE WHEN coalesce(value < 0 OR value > 100, FALSE) THEN NULL ELSE value END, 4) AS value FROM events_dirty""")
_q("B8_cancelled_air_time", f"""WITH {EVENTS_DIRTY}
SELECT event_id, round(CASE WHEN coalesce(coalesce(status, 0) > 0 AND value > 0, FALSE) THEN NULL ELSE value END, 4) AS value FROM events_dirty""")
_q("B19_cancelled_filter", f"WITH {EVENTS_DIRTY} SELECT event_id, status FROM events_dirty WHERE status IS DISTINCT FROM 0")
_q("C1_fk_to_null", f"WITH {EVENTS_DIRTY} SELECT event_id, CASE WHEN user_id IN {_CUST} THEN user_id END AS user_id FROM events_dirty")
_q("E4_group_median_impute", f"""WITH {EVENTS_DIRTY}, gm AS (SELECT median(value) AS gmed FROM events_dirty),
grp AS (SELECT event_type AS g, median(value) AS gmv FROM events_dirty GROUP BY 1)
SELECT event_id, event_type, round(CASE WHEN value IS NULL THEN coalesce(grp.gmv, gm.gmed) ELSE value END, 4) AS value
FROM events_dirty CROSS JOIN gm LEFT JOIN grp ON event_type IS NOT DISTINCT FROM grp.g""")


# ------------------------------------------------------------------ weather role

def interp_sql(src: str, cols, limit=2, gap=3, digits=4) -> str:
    """E3 restated with window frames over (station, time)."""
    sel = []
    for c in cols:
        pt = f"CASE WHEN {c} IS NOT NULL THEN struct_pack(rr := rn, ss := s, vv := CAST({c} AS DOUBLE)) END"
        sel.append(f"last_value({pt} IGNORE NULLS) OVER (PARTITION BY station ORDER BY s, obs_id "
                   f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p_{c}")
        sel.append(f"first_value({pt} IGNORE NULLS) OVER (PARTITION BY station ORDER BY s, obs_id "
                   f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x_{c}")
        sel.append(f"count({c}) OVER (PARTITION BY station) AS k_{c}")
    outs = []
    for c in cols:
        p, x = f"p_{c}", f"x_{c}"
        interp = (f"CASE WHEN {p} IS NOT NULL AND {x} IS NOT NULL THEN "
                  f"(CASE WHEN {x}.ss = {p}.ss THEN {p}.vv ELSE {p}.vv + ({x}.vv - {p}.vv) * (s - {p}.ss) / ({x}.ss - {p}.ss) END) "
                  f"WHEN {p} IS NOT NULL THEN {p}.vv ELSE {x}.vv END")
        allowed = (f"(coalesce(rn - {p}.rr <= {limit}, FALSE) OR coalesce({x}.rr - rn <= {limit}, FALSE)) AND "
                   f"(k_{c} < 2 OR least(coalesce((s - {p}.ss) / 3600.0, 1e308), coalesce(({x}.ss - s) / 3600.0, 1e308)) <= {gap})")
        value = f"CASE WHEN {c} IS NOT NULL THEN CAST({c} AS DOUBLE) WHEN nt >= 2 AND {allowed} THEN {interp} END"
        outs.append(f"{value} AS {c}" if digits is None else f"round({value}, {digits}) AS {c}")
    return (f"(SELECT obs_id, {', '.join(outs)} FROM (SELECT *, {', '.join(sel)} FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY station ORDER BY s, obs_id) AS rn, "
            f"count(*) OVER (PARTITION BY station) AS nt FROM "
            f"(SELECT *, epoch(CAST(obs_date AS TIMESTAMP)) + obs_hour * 3600 AS s FROM {src}) b) r) w)")


_W = ["spd", "gust", "low"]
_ALLNULL = "spd IS NULL AND gust IS NULL AND low IS NULL"
_LK = """lk AS (SELECT station AS w_a, obs_date AS w_d, obs_hour AS w_h, obs_id AS new_id FROM
          (SELECT *, row_number() OVER (PARTITION BY station, obs_date, obs_hour ORDER BY obs_id) AS rk FROM obs
           WHERE station IS NOT NULL AND obs_date IS NOT NULL AND obs_hour IS NOT NULL) q WHERE rk = 1)"""
_LINKED = f"""{EVENTS_DIRTY}, {OBS_DIRTY}, {_LK},
linked AS (SELECT e.*, lk.new_id AS weather_observation_id FROM events_dirty e LEFT JOIN lk
           ON e.event_type = lk.w_a AND CAST(try_strptime(e.event_date, '%Y-%m-%d') AS DATE) = lk.w_d AND e.event_hour = lk.w_h)"""
_C3 = f"""{_LINKED},
nullw AS (SELECT obs_id FROM obs_dirty WHERE {_ALLNULL}),
aff AS (SELECT * FROM linked WHERE weather_observation_id IN (SELECT obs_id FROM nullw WHERE obs_id IS NOT NULL)),
cnt AS (SELECT (SELECT count(*) FROM nullw) AS n_null_weather_rows, (SELECT count(*) FROM aff) AS n_affected_flights,
               (SELECT count(*) FILTER (WHERE status IN (1, 2)) FROM aff) AS n_dangerous_cancellations),
dec AS (SELECT *, CASE WHEN n_affected_flights > 0 THEN round(n_dangerous_cancellations / n_affected_flights, 4) ELSE 0.0 END AS dangerous_pct,
               (n_null_weather_rows = n_affected_flights AND n_null_weather_rows > 0) AS perfect_cooccurrence FROM cnt),
dec2 AS (SELECT *, perfect_cooccurrence AND (n_dangerous_cancellations = 0 OR coalesce(dangerous_pct <= 0.1, FALSE)) AS safe_to_drop,
                CASE WHEN NOT perfect_cooccurrence THEN 'null observations and flights do not match one to one'
                     WHEN NOT coalesce(dangerous_pct <= 0.1, FALSE) AND n_dangerous_cancellations > 0 THEN
                       CAST(n_dangerous_cancellations AS VARCHAR) || ' flights (' || printf('%.1f%%', dangerous_pct * 100) || ') have a cancellation code that forbids dropping; limit 10.0%'
                     ELSE 'ok' END AS reason FROM dec)"""

_q("B9_dew_point_swap", f"""WITH {OBS_DIRTY}
SELECT obs_id, round(CASE WHEN coalesce(low > gust, FALSE) THEN low ELSE gust END, 4) AS gust,
       round(CASE WHEN coalesce(low > gust, FALSE) THEN gust ELSE low END, 4) AS low FROM obs_dirty""")
_q("B10_wind_gust_floor", f"""WITH {OBS_DIRTY}
SELECT obs_id, round(CASE WHEN spd IS NOT NULL AND gust IS NOT NULL AND gust < spd THEN spd ELSE gust END, 4) AS gust FROM obs_dirty""")
_q("B11_cloud_cover_fix", f"""WITH {OBS_DIRTY}, c AS (SELECT *, CAST(obs_hour % 5 AS DOUBLE) AS cc, CAST(n % 2 AS DOUBLE) AS lf, gust * 1000 AS ly FROM obs_dirty)
SELECT obs_id, round(CASE WHEN cc IS NOT NULL AND cc = 0 AND (coalesce(lf, 0.0) = 1.0 OR coalesce(ly <= 10000, FALSE)) THEN 1.0 ELSE cc END, 4) AS cloud_cover FROM c""")
_q("B12_snap_to_domain", f"""WITH {OBS_DIRTY}
SELECT obs_id, round(CASE WHEN spd IS NULL THEN NULL ELSE least(4.0, greatest(0.0, ceil(spd / 10 - 0.5))) END, 4) AS spd_level FROM obs_dirty""")
_q("C2_weather_fk_rebuild", f"WITH {_LINKED} SELECT event_id, weather_observation_id FROM linked")
_q("C2_weather_fk_report", f"""WITH {_LINKED}
SELECT count(*) FILTER (WHERE weather_observation_id IS NOT NULL) AS recovered, CAST(0 AS BIGINT) AS nullified,
       count(*) FILTER (WHERE weather_observation_id IS NOT NULL) AS linked FROM linked""")
_q("A9_weather_link", f"""WITH {OBS}, {_LK}
SELECT e.event_id, lk.new_id AS weather_observation_id FROM events e LEFT JOIN lk
  ON e.event_type = lk.w_a AND CAST(e.ts AS DATE) = lk.w_d AND EXTRACT(HOUR FROM e.ts) = lk.w_h""")
_q("C3_null_cooccurrence", f"""WITH {_C3}
SELECT n_null_weather_rows, n_affected_flights, perfect_cooccurrence, n_dangerous_cancellations, round(dangerous_pct, 4) AS dangerous_pct,
       CAST(0.1 AS DOUBLE) AS max_dangerous_pct_threshold, safe_to_drop, reason,
       CASE WHEN safe_to_drop THEN 'drop the empty observations and their flights'
            ELSE 'interpolate: ' || reason END AS recommendation FROM dec2""")
_q("C4_drop_linked_children", f"""WITH {_LINKED}
SELECT event_id, weather_observation_id FROM linked
WHERE weather_observation_id IS NULL OR weather_observation_id NOT IN (SELECT obs_id FROM obs_dirty WHERE {_ALLNULL} AND obs_id IS NOT NULL)""")
_q("E3_interpolate_temporal", f"WITH {OBS_DIRTY} SELECT * FROM {interp_sql('obs_dirty', _W)} z")
_q("B13_handle_weather_nulls", f"""WITH {_C3}
SELECT * FROM {interp_sql('obs_dirty', _W)} z WHERE NOT (SELECT safe_to_drop FROM dec2)
UNION ALL SELECT obs_id, round(spd, 4), round(gust, 4), round(low, 4) FROM obs_dirty WHERE (SELECT safe_to_drop FROM dec2) AND NOT ({_ALLNULL})""")
_q("E5_temporal_gaps", f"""WITH {OBS},
t AS (SELECT DISTINCT station, CAST(obs_date AS TIMESTAMP) + obs_hour * INTERVAL 1 HOUR AS e FROM obs),
l AS (SELECT station, e, lag(e) OVER (PARTITION BY station ORDER BY e) AS b FROM t)
SELECT station, CAST(b AS VARCHAR) AS gap_start, CAST(e AS VARCHAR) AS gap_end,
       round(epoch(e - b) / 3600.0, 4) AS gap_length_hours, CAST(floor(epoch(e - b) / 3600.0) AS BIGINT) AS gap_length_intervals
FROM l WHERE b IS NOT NULL AND epoch(e - b) / 3600.0 > 1.5""")
_q("E1_deduplicate", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 4) AS l_quantity FROM
(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rk FROM lineitem) q WHERE rk = 1""")
_q("E2_duplicate_flag", """SELECT is_dup, count(*) AS n_rows FROM
(SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_dup FROM lineitem) q GROUP BY 1""")
_q("E6_dense_ids", f"""SELECT CAST(row_number() OVER (ORDER BY {LINEITEM_ORDER}) AS BIGINT) AS row_id, l_orderkey, l_linenumber, l_partkey
FROM lineitem""")
_q("C7_chained_measures", f"""WITH {_LINKED},
aw AS (SELECT * FROM (VALUES (0, 'None'), (1, 'Rain'), (2, 'Snow')) t(status, weather_description))
SELECT l.event_id, round(o.spd, 4) AS spd, round(o.gust, 4) AS gust, round(o.low, 4) AS low, aw.weather_description AS _weather_desc
FROM linked l LEFT JOIN obs_dirty o ON l.weather_observation_id = o.obs_id
LEFT JOIN aw ON CAST(o.n % 3 AS INTEGER) = aw.status""")


# ------------------------------------------------------------------ profiling, missingness, outliers

_EVT = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
        ("event_date", "string"), ("event_hour", "int"), ("value", "double"), ("status", "int")]
_bands = "CASE WHEN p <= 0 THEN 'complete' WHEN p <= 1 THEN 'negligible (<1%)' WHEN p <= 5 THEN 'low (1-5%)' WHEN p <= 15 THEN 'moderate (5-15%)' WHEN p <= 100 THEN 'high (>15%)' END"
_q("D12_missingness_summary", f"WITH {EVENTS_DIRTY}, m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n, '{t}' AS dtype FROM events_dirty"
    for c, t in _EVT) + f"""), m2 AS (SELECT *, CASE WHEN n > 0 THEN round(missing_count / n * 100, 2) ELSE 0.0 END AS p FROM m)
SELECT column_name, missing_count, p AS missing_pct, n - missing_count AS present_count, dtype, {_bands} AS status
FROM m2 WHERE missing_count > 0""")


def _tostr(c, t):
    if t == "timestamp_ntz":
        return f"CAST({c} AS VARCHAR)"
    if t == "double":
        return f"CAST({c} AS VARCHAR)"
    return f"CAST({c} AS VARCHAR)"


_q("D13_column_profile", f"WITH {EVENTS_DIRTY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(DISTINCT {c}) AS n_unique, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"substr(min({_tostr(c, t)}), 1, 30) AS sample, 'N/A' AS description FROM events_dirty" for c, t in _EVT))

_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_fd = []
for _a in _PART:
    for _b in _PART:
        if _a != _b:
            _fd.append(f"""SELECT '{_a}' AS determinant, '{_b}' AS dependent FROM
  (SELECT count(*) AS g, max(k) AS mx FROM (SELECT count(DISTINCT {_b}) AS k FROM part WHERE {_a} IS NOT NULL GROUP BY {_a}) x) y
  WHERE g >= 2 AND mx = 1""")
_q("D16_discover_fd", " UNION ALL ".join(_fd))
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_q("D17_fd_compound_key", "SELECT count(*) AS n_groups, count(*) FILTER (WHERE bad) AS n_violations FROM (SELECT " + " OR ".join(
    f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) > 1" for c in _LI_REST) +
    " AS bad FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber) g")


def _map(name, t, a, b):
    return (f"SELECT '{name}' AS mapping, count(*) AS n_keys, count(*) FILTER (WHERE k > 1) AS n_multi FROM "
            f"(SELECT count(DISTINCT {b}) + max(CASE WHEN {b} IS NULL THEN 1 ELSE 0 END) AS k FROM {t} WHERE {a} IS NOT NULL GROUP BY {a}) g")


_q("D18_mapping_cardinality", " UNION ALL ".join([_map("nation->segment", "customer", "c_nationkey", "c_mktsegment"),
                                                   _map("customer->priority", "orders", "o_custkey", "o_orderpriority"),
                                                   _map("customer->nation", "customer", "c_custkey", "c_nationkey")]))
_q("D19_cancelled_consistency", f"""WITH {EVENTS_DIRTY}, c AS (SELECT * FROM events_dirty WHERE status IS DISTINCT FROM 0)
SELECT count(*) AS n_cancelled, count(*) FILTER (WHERE value IS NULL) AS n_value_null, count(*) FILTER (WHERE value = 0) AS n_value_zero,
       round(count(*) FILTER (WHERE value IS NULL) / count(*) * 100, 2) AS pct_value_null,
       count(*) FILTER (WHERE coalesce(date_trunc('hour', ts) <> CAST(try_strptime(event_date, '%Y-%m-%d') AS DATE) + event_hour * INTERVAL 1 HOUR, FALSE)) AS n_time_mismatch,
       count(*) FILTER (WHERE coalesce(value > 0, FALSE)) AS n_value_positive FROM c""")


def _pcorr(x, y, src):
    r = f"corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))"
    return f"CASE WHEN NOT isnan({r}) THEN {r} END"


_q("D20_comissing_matrix", f"WITH {EVENTS_DIRTY} " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({_pcorr(f'({a} IS NULL)::INT', f'({b} IS NULL)::INT', 'events_dirty')}, 4) AS corr FROM events_dirty"
    for a in ["value", "status"] for b in ["value", "status"]))
_q("D21_missing_correlation", f"WITH {EVENTS_DIRTY}, med AS (SELECT " + ", ".join(
    f"median(CAST({f} AS DOUBLE)) AS m_{f}" for f in ["user_id", "event_hour", "status"]) + " FROM events_dirty) " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round({_pcorr('(value IS NULL)::INT', f'coalesce(CAST({f} AS DOUBLE), m_{f})', '')}, 4) AS correlation_with_missingness FROM events_dirty, med"
    for f in ["user_id", "event_hour", "status"]))
_q("D22_chi2_statistic", f"""WITH {EVENTS_DIRTY},
cells AS (SELECT coalesce(event_type, 'MISSING') AS g, count(*) FILTER (WHERE value IS NOT NULL) AS o0, count(*) FILTER (WHERE value IS NULL) AS o1 FROM events_dirty GROUP BY 1),
tot AS (SELECT sum(o0) AS c0, sum(o1) AS c1, count(*) AS k FROM cells),
t2 AS (SELECT *, c0 + c1 AS nn, (k - 1) * (CAST(c0 > 0 AS INT) + CAST(c1 > 0 AS INT) - 1) AS dof FROM tot),
terms AS (SELECT cells.*, t2.*, (o0 + o1) * c0 / nn AS e0, (o0 + o1) * c1 / nn AS e1 FROM cells, t2),
adj AS (SELECT *, CASE WHEN dof = 1 THEN greatest(abs(o0 - e0) - least(0.5, abs(o0 - e0)), 0) ELSE abs(o0 - e0) END AS a0,
                  CASE WHEN dof = 1 THEN greatest(abs(o1 - e1) - least(0.5, abs(o1 - e1)), 0) ELSE abs(o1 - e1) END AS a1 FROM terms)
SELECT round(coalesce(sum(CASE WHEN c0 > 0 AND e0 > 0 THEN a0 * a0 / e0 ELSE 0 END + CASE WHEN c1 > 0 AND e1 > 0 THEN a1 * a1 / e1 ELSE 0 END), 0.0), 4) AS chi2,
       CAST(first(dof) AS BIGINT) AS dof FROM adj""")
_q("D25_category_variants", f"""WITH {EVENTS_DIRTY}
SELECT event_type AS variant, count(*) AS n_rows, lower(trim(event_type)) AS canonical FROM events_dirty WHERE event_type IS NOT NULL GROUP BY 1""")
_IQR = f"""q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events_dirty),
iq AS (SELECT e.*, coalesce(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1), FALSE) AS IQR_value,
              q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM events_dirty e, q),
md AS (SELECT median(value) AS med FROM events_dirty),
mad AS (SELECT median(abs(coalesce(value, med) - med)) AS mad FROM events_dirty, md),
mz AS (SELECT iq.*, CASE WHEN mad <> 0 THEN coalesce(abs(0.6745 * (coalesce(value, med) - med) / mad) > 3.5, FALSE) END AS ModZ_value, mad
       FROM iq, md, mad),
votes AS (SELECT *, CAST(IQR_value AS INT) + CAST(coalesce(ModZ_value, FALSE) AS INT) AS votes FROM mz)"""
_q("D28_iqr", f"WITH {EVENTS_DIRTY}, {_IQR} SELECT event_id, IQR_value FROM votes")
_q("D29_modified_zscore", f"WITH {EVENTS_DIRTY}, {_IQR} SELECT event_id, ModZ_value FROM votes")
_q("D31_consensus_votes", f"WITH {EVENTS_DIRTY}, {_IQR} SELECT votes, count(*) AS n_rows FROM votes GROUP BY 1")
_q("C10_flagged_rows", f"WITH {EVENTS_DIRTY}, {_IQR} SELECT event_id, round(value, 4) AS value, IQR_value, ModZ_value, votes FROM votes WHERE votes >= 2")


def _osum(table, src, col, k):
    return f"""SELECT '{table}' AS table_name, 'IQR (k={k})' AS method, '{col}' AS column_name,
       round(q1 - {k} * (q3 - q1), 4) AS lower_fence, round(q3 + {k} * (q3 - q1), 4) AS upper_fence,
       (SELECT count(*) FILTER (WHERE coalesce({col} < q1 - {k} * (q3 - q1) OR {col} > q3 + {k} * (q3 - q1), FALSE)) FROM {src}) AS n_flagged,
       round((SELECT count(*) FILTER (WHERE coalesce({col} < q1 - {k} * (q3 - q1) OR {col} > q3 + {k} * (q3 - q1), FALSE)) FROM {src}) / (SELECT count(*) FROM {src}) * 100, 2) AS pct_flagged
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src}) q
UNION ALL
SELECT '{table}', 'Modified Z-score (t=3.5)', '{col}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), n_flagged, round(n_flagged / n * 100, 2) FROM
(SELECT count(*) FILTER (WHERE coalesce(abs(0.6745 * (coalesce({col}, med) - med) / mad) > 3.5, FALSE)) AS n_flagged, count(*) AS n, max(mad) AS mad
 FROM {src}, (SELECT median({col}) AS med FROM {src}) m,
      (SELECT median(abs(coalesce({col}, med) - med)) AS mad FROM {src}, (SELECT median({col}) AS med FROM {src}) m2) d) z WHERE mad <> 0"""


_q("D32_outlier_summary", f"WITH {EVENTS_DIRTY}, {OBS_DIRTY} {_osum('events_dirty', 'events_dirty', 'value', 1.5)} UNION ALL {_osum('obs_dirty', 'obs_dirty', 'gust', 2.5)}")


# ------------------------------------------------------------------ sources, contracts, KPIs, misc

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations"]
_q("A1_load_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS n_columns" for t in _TABLES))
_q("A2_normalize_columns", "SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY, "
   "round(c_acctbal, 4) AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT FROM customer")
_q("A7_warehouse_metadata", f"WITH {star_fact()} " + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, CAST({k} AS BIGINT) AS n_columns, '{pk}' AS pk"
    for n, t, k, pk in [("DIM_FL_DATES", "dim_fl_dates", 8, "FL_DATE_ID"), ("DIM_DEP_HOURS", "dim_dep_hours", 4, "DEP_HOUR_ID"),
                        ("DIM_STATIONS", "dim_stations", 8, "STATION_ID"), ("DIM_CARRIERS", "dim_carriers", 3, "CARRIER_ID"),
                        ("DIM_AIRCRAFTS", "dim_aircraft", 5, "AIRCRAFT_ID"), ("DIM_JUNK", "dim_junk", 4, "JUNK_ID"),
                        ("FLIGHTS", "fact", 14, "FLIGHT_ID")]))
_q("A8_reconcile_entity", """SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS aircraft_id, p_partkey, p_brand, p_size, p_type
FROM (SELECT DISTINCT p.p_partkey, p.p_brand, p.p_size, p.p_type FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) x""")
_q("B14_clean_city", f"WITH {STATIONS} SELECT airport, {clean_city(title(strip('display_airport_city_name_full')), 'airport_state_name', 'airport_state_code')} AS city FROM stations")
_q("B15_time_band", """SELECT hour, n_rows, CASE WHEN hour >= 0 AND hour < 4 THEN 'Night' WHEN hour >= 4 AND hour < 8 THEN 'Early Morning'
  WHEN hour >= 8 AND hour < 12 THEN 'Morning' WHEN hour >= 12 AND hour < 16 THEN 'Afternoon' WHEN hour >= 16 AND hour < 20 THEN 'Evening'
  ELSE 'Late Evening' END AS time_band FROM (SELECT CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour, count(*) AS n_rows FROM events GROUP BY 1) h""")


def bucket_sql(x, edges, labels, zero=None, strict=False, closed="<="):
    parts = ([f"WHEN {x} = 0 THEN '{zero}'"] if zero else []) + [f"WHEN {x} {closed} {e} THEN '{l}'" for e, l in zip(edges, labels)]
    expr = f"CASE {' '.join(parts)} ELSE '{labels[-1]}' END"
    return f"CASE WHEN {x} IS NOT NULL THEN {expr} END" if strict else expr


VIS = ([2, 4, 6, 8, 10], ["0-2 mi", "2-4 mi", "4-6 mi", "6-8 mi", "8-10 mi", ">10 mi"])
GUST = ([10, 20, 30], ["≤10 kt", "10-20 kt", "20-30 kt", ">30 kt"])
TEMP = ([-10, 0, 10, 20, 30], ["≤ -10 °C", "-10 to 0 °C", "0 to 10 °C", "10 to 20 °C", "20 to 30 °C", "> 30 °C"])
AGE = ([6, 16, 31], ["0-5 yr", "6-15 yr", "16-30 yr", "31+ yr"])
_q("B16_buckets", f"""WITH {OBS_DIRTY}
SELECT obs_id, {bucket_sql('(spd / 5)', *VIS, zero='0 mi')} AS visibility_bucket, {bucket_sql('gust', *GUST)} AS gust_bucket,
       {bucket_sql('(low - 20)', *TEMP)} AS temperature_bucket, {bucket_sql('n', *AGE, closed='<')} AS age_bucket,
       {bucket_sql('gust', *GUST, strict=True)} AS gust_bucket_strict FROM obs_dirty""")
_q("B17_is_departed", f"""WITH {STAR_FLIGHTS}
SELECT coalesce(cancellation_reason = 'Not Cancelled', FALSE) AS is_departed, count(*) AS n_flights FROM star_flights GROUP BY 1""")
_q("B18_aircraft_age", f"WITH {star_dims()} SELECT TAIL_NUM, AIRCRAFT_AGE, {bucket_sql('AIRCRAFT_AGE', *AGE, closed='<')} AS AGE_BUCKET FROM dim_aircraft")
_q("B20_sample_fixed_n", "SELECT event_id, event_type, round(value, 4) AS value FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || '42'), event_id LIMIT 500")
_q("B21_projection", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem")
_FKS = ["FL_DATE_ID", "DEP_HOUR_ID", "ORIGIN_STATION_ID", "DEST_STATION_ID", "MKT_CARRIER_ID", "OP_CARRIER_ID", "AIRCRAFT_ID", "JUNK_ID"]
_q("D33_fk_completeness", f"WITH {star_fact()} " + " UNION ALL ".join(
    f"SELECT '{c}' AS fk_column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS n_rows, "
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM fact" for c in _FKS))
_FR = f"""{star_fact()}, fr AS (SELECT f.*, d.YEAR, d.QUARTER, d.MONTH, d.DAY_OF_WEEK FROM fact f LEFT JOIN dim_fl_dates d ON f.FL_DATE_ID = d.FL_DATE_ID)"""
_DEP = "coalesce(CANCELLATION_REASON = 'Not Cancelled', FALSE)"
_q("D35_kpi_glossary", f"""WITH {_FR}
SELECT YEAR, count(*) AS number_of_flights, round(avg(DEP_DELAY), 4) AS avg_delay,
       round(avg(CASE WHEN DEP_DELAY IS NOT NULL THEN CAST(DEP_DELAY > 15 AS DOUBLE) END), 4) AS delay_rate_gt15,
       round(avg(CASE WHEN DEP_DELAY IS NOT NULL THEN CAST(DEP_DELAY >= 15 AS DOUBLE) END), 4) AS delay_rate_ge15,
       round(avg(CAST(NOT {_DEP} AS DOUBLE)), 4) AS cancellation_rate, round(avg(TAXI_OUT), 4) AS avg_taxi_out,
       round(avg(AIR_TIME), 4) AS avg_air_time, round(avg(DISTANCE), 4) AS avg_distance FROM fr GROUP BY YEAR""")
_q("D36_dashboard_rates", f"""WITH {_FR}
SELECT MONTH, count(FLIGHT_ID) AS n_flights, round(count(*) FILTER (WHERE DEP_DELAY >= 15) / count(FLIGHT_ID), 4) AS dep_delay_rate,
       round(count(*) FILTER (WHERE NOT {_DEP}) / count(FLIGHT_ID), 4) AS cancellation_rate,
       round(avg(CASE WHEN {_DEP} THEN DEP_DELAY END), 4) AS avg_dep_delay_departed,
       round(avg(CASE WHEN {_DEP} THEN TAXI_OUT END), 4) AS avg_taxi_out_departed,
       round(avg(CASE WHEN {_DEP} THEN AIR_TIME END), 4) AS avg_air_time_departed FROM fr GROUP BY MONTH""")
_q("D37_high_volume_groups", f"""WITH {_FR}
SELECT DAY_OF_WEEK, DEP_HOUR_ID, count(*) AS n_flights, round(avg(DEP_DELAY), 4) AS avg_dep_delay FROM fr
GROUP BY DAY_OF_WEEK, DEP_HOUR_ID HAVING count(*) >= 350""")
_q("D38_rollup", f"""WITH {_FR}
SELECT YEAR, QUARTER, MONTH, CAST(GROUPING(YEAR, QUARTER, MONTH) AS INTEGER) AS grouping_level, round(sum(DEP_DELAY), 4) AS sum_dep_delay,
       round(avg(DISTANCE), 4) AS avg_distance, count(FLIGHT_ID) AS n_flights FROM fr GROUP BY ROLLUP (YEAR, QUARTER, MONTH)""")
_q("F3_nulls_last_ids", f"WITH {star_dims()} SELECT JUNK_ID, CANCELLATION_REASON, WEATHER_DESCRIPTION FROM dim_junk ORDER BY JUNK_ID")
_q("F4_head", "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 5")
_q("G2_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
_q("H2_validate_contract", """SELECT * FROM (VALUES
 ('customer', 'column_count', 'PASS', 'as agreed'),
 ('customer', 'missing_columns', 'FAIL', 'c_mktsegment'),
 ('customer', 'extra_columns', 'FAIL', 'c_extra'),
 ('customer', 'column_order', 'WARN', 'c_name < c_custkey < c_nationkey < c_acctbal'),
 ('customer', 'dtype_changes', 'WARN', 'c_acctbal double -> string'),
 ('orders', 'registration', 'SKIP', 'no contract')) t(table_name, "check", status, message)
UNION ALL
SELECT 'customer', 'pk_uniqueness', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN d = 0 THEN 'as agreed' ELSE CAST(d AS VARCHAR) || ' surplus rows' END
FROM (SELECT count(*) - count(DISTINCT c_custkey) AS d FROM customer) x""")


def _h3(t, pk, ncols, dup_src):
    rows = [(c, "PASS", "as agreed") for c in ("column_count", "missing_columns", "extra_columns", "column_order", "dtype_changes")]
    const = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS \"check\", '{s}' AS status, '{m}' AS message" for c, s, m in rows)
    pkq = (f"SELECT '{t}', 'pk_uniqueness', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN d = 0 THEN 'as agreed' "
           f"ELSE CAST(d AS VARCHAR) || ' surplus rows' END FROM (SELECT count(*) - count(DISTINCT {pk}) AS d FROM {dup_src}) x")
    return const + " UNION ALL " + pkq


_q("H3_validate_all", "SELECT *, CAST(1 AS INTEGER) AS failures FROM (" + " UNION ALL ".join([
    _h3("region", "r_regionkey", 2, "region"), _h3("nation", "n_nationkey", 3, "nation"),
    _h3("supplier", "s_suppkey", 4, "(SELECT * FROM supplier UNION ALL SELECT * FROM supplier)")]) + ") z")
_KEYS = [("FL_DATE_ID", "dim_fl_dates", "FL_DATE_ID"), ("DEP_HOUR_ID", "dim_dep_hours", "DEP_HOUR_ID"), ("ORIGIN_STATION_ID", "dim_stations", "STATION_ID"),
         ("DEST_STATION_ID", "dim_stations", "STATION_ID"), ("MKT_CARRIER_ID", "dim_carriers", "CARRIER_ID"), ("OP_CARRIER_ID", "dim_carriers", "CARRIER_ID"),
         ("AIRCRAFT_ID", "dim_aircraft", "AIRCRAFT_ID"), ("JUNK_ID", "dim_junk", "JUNK_ID")]
_q("H4_declared_constraints", f"""WITH {star_fact()}
SELECT 'PRIMARY KEY' AS constraint_type, 'FLIGHT_ID' AS column_name, coalesce(sum(k) FILTER (WHERE k > 1), 0) AS violations
FROM (SELECT count(*) AS k FROM fact GROUP BY FLIGHT_ID) g
""" + "".join(f"""UNION ALL SELECT 'NOT NULL', '{k}', count(*) FILTER (WHERE {k} IS NULL) FROM fact
UNION ALL SELECT 'REFERENCES', '{k}', count(*) FROM fact WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {i} FROM {t})
""" for k, t, i in _KEYS))
_q("K9_load_timestamp", f"WITH {star_fact()} " + " UNION ".join(f"SELECT LOAD_TIMESTAMP FROM {t}" for t in (
    "dim_fl_dates", "dim_dep_hours", "dim_stations", "dim_carriers", "dim_aircraft", "dim_junk", "fact")))
_STEPS = [("fl_dates", "dim_fl_dates", "star_flights"), ("dep_hours", "dim_dep_hours", "star_flights"), ("stations", "dim_stations", "stations"),
          ("carriers", "dim_carriers", "supplier"), ("aircraft", "dim_aircraft", "part"), ("junk", "dim_junk", "star_flights"), ("fact", "fact", "star_flights")]
_q("K10_run_log", f"WITH {star_fact()} " + " UNION ALL ".join(
    f"SELECT 'build_{n}' AS step, 'success' AS status, (SELECT count(*) FROM {src}) AS input_rows, (SELECT count(*) FROM {t}) AS output_rows" for n, t, src in _STEPS))


# ------------------------------------------------------------------ environment measures and hierarchies

_ENV_FLIGHTS = STAR_FLIGHTS.replace("star_flights AS (", "plain_flights AS (", 1) + f""",
{OBS},
star_flights AS (SELECT f.* REPLACE (r.r_name AS weather_description), o.spd AS wind_spd, o.gust AS wind_gust, o.low / 10 AS visibility,
    o.spd - 20 AS temperature, CAST(o.n % 5 AS DOUBLE) AS cloud_cover
  FROM plain_flights f LEFT JOIN obs o ON (f.l_orderkey * 7 + f.l_linenumber) % 5000 + 1 = o.obs_id LEFT JOIN region r ON o.n % 4 = r.r_regionkey)"""
ENV_DIMS = star_dims().replace(STAR_FLIGHTS, _ENV_FLIGHTS, 1)
ENV_FACT = star_fact().replace(STAR_FLIGHTS, _ENV_FLIGHTS, 1).replace("f.dep_delay AS DEP_DELAY", """f.weather_description AS WEATHER_DESCRIPTION,
         f.wind_spd AS WIND_SPD, f.wind_gust AS WIND_GUST, f.visibility AS VISIBILITY, f.temperature AS TEMPERATURE, f.cloud_cover AS CLOUD_COVER,
         f.dep_delay AS DEP_DELAY""", 1)
_q("K6_build_junk_environment", f"WITH {ENV_DIMS} SELECT * FROM dim_junk")
_q("K7_build_fact_environment", f"WITH {ENV_FACT} SELECT FLIGHT_ID, " + ", ".join(k for k, _, _ in _KEYS) + ", " + ", ".join(
    f"{r4(m)} AS {m}" for m in ("WIND_SPD", "WIND_GUST", "VISIBILITY", "TEMPERATURE", "CLOUD_COVER", "DEP_DELAY", "TAXI_OUT", "AIR_TIME", "DISTANCE")) +
   ", LOAD_TIMESTAMP FROM fact")
_q("D35_kpi_glossary_environment", f"""WITH {ENV_FACT}
SELECT WEATHER_DESCRIPTION, count(*) AS number_of_flights, round(avg(DEP_DELAY), 4) AS avg_delay,
       round(avg(CASE WHEN DEP_DELAY IS NOT NULL THEN CAST(DEP_DELAY > 15 AS DOUBLE) END), 4) AS delay_rate_gt15,
       round(avg(CASE WHEN DEP_DELAY IS NOT NULL THEN CAST(DEP_DELAY >= 15 AS DOUBLE) END), 4) AS delay_rate_ge15,
       round(avg(CAST(NOT {_DEP} AS DOUBLE)), 4) AS cancellation_rate, round(avg(TAXI_OUT), 4) AS avg_taxi_out,
       round(avg(AIR_TIME), 4) AS avg_air_time, round(avg(DISTANCE), 4) AS avg_distance, round(avg(WIND_SPD), 4) AS avg_wind_spd,
       round(avg(VISIBILITY), 4) AS avg_visibility, round(avg(CASE WHEN VISIBILITY IS NOT NULL THEN CAST(VISIBILITY > 0 AND VISIBILITY <= 3 AS DOUBLE) END), 4) AS low_visibility_rate,
       round(min(TEMPERATURE), 4) AS min_temperature, round(avg(CLOUD_COVER), 4) AS avg_cloud_cover FROM fact GROUP BY 1""")
_q("D36_dashboard_rates_environment", f"""WITH {ENV_FACT}, fr AS (SELECT f.*, d.YEAR FROM fact f LEFT JOIN dim_fl_dates d ON f.FL_DATE_ID = d.FL_DATE_ID)
SELECT YEAR, count(FLIGHT_ID) AS n_flights, round(count(*) FILTER (WHERE DEP_DELAY >= 15) / count(FLIGHT_ID), 4) AS dep_delay_rate,
       round(count(*) FILTER (WHERE NOT {_DEP}) / count(FLIGHT_ID), 4) AS cancellation_rate,
       round(avg(CASE WHEN {_DEP} THEN DEP_DELAY END), 4) AS avg_dep_delay_departed,
       round(avg(CASE WHEN {_DEP} THEN TAXI_OUT END), 4) AS avg_taxi_out_departed,
       round(avg(CASE WHEN {_DEP} THEN AIR_TIME END), 4) AS avg_air_time_departed,
       round(count(*) FILTER (WHERE VISIBILITY > 0 AND VISIBILITY <= 3) / count(FLIGHT_ID), 4) AS low_visibility_rate FROM fr GROUP BY YEAR""")
_PLACES = f"""{star_fact()}, pl AS (SELECT f.*, s.AIRPORT_CODE, s.CITY, s.STATE, h.DEP_HOUR, h.TIME_BAND FROM fact f
  LEFT JOIN dim_stations s ON f.ORIGIN_STATION_ID = s.STATION_ID LEFT JOIN dim_dep_hours h ON f.DEP_HOUR_ID = h.DEP_HOUR_ID)"""
_q("D38_rollup_places", f"""WITH {_PLACES} SELECT STATE, CITY, AIRPORT_CODE, CAST(GROUPING(STATE, CITY, AIRPORT_CODE) AS INTEGER) AS grouping_level,
       round(sum(DEP_DELAY), 4) AS sum_dep_delay, round(avg(DISTANCE), 4) AS avg_distance FROM pl GROUP BY ROLLUP (STATE, CITY, AIRPORT_CODE)""")
_q("D38_rollup_hours", f"""WITH {_PLACES} SELECT TIME_BAND, DEP_HOUR, CAST(GROUPING(TIME_BAND, DEP_HOUR) AS INTEGER) AS grouping_level,
       round(sum(DEP_DELAY), 4) AS sum_dep_delay, round(avg(DISTANCE), 4) AS avg_distance FROM pl GROUP BY ROLLUP (TIME_BAND, DEP_HOUR)""")
_q("D38_cube", f"""WITH {_PLACES} SELECT STATE, TIME_BAND, CAST(GROUPING(STATE, TIME_BAND) AS INTEGER) AS grouping_level,
       round(sum(DEP_DELAY), 4) AS sum_dep_delay, count(*) AS n_flights FROM pl GROUP BY CUBE (STATE, TIME_BAND)""")
_q("D37_groups_by_state_band", f"""WITH {_PLACES} SELECT STATE, TIME_BAND, count(*) AS n_flights, round(avg(DEP_DELAY), 4) AS avg_dep_delay
FROM pl GROUP BY STATE, TIME_BAND""")


# ------------------------------------------------------------------ fuzzy duplicates

_q("C11_fuzzy_duplicates", """WITH fp AS (
  SELECT p_partkey, p_brand, CASE WHEN p_partkey % 9 = 0 THEN substr(p_name, 1, 1) || substr(p_name, 3) ELSE p_name END AS p_name, p_type
  FROM part)
SELECT a.p_partkey AS p_partkey_1, b.p_partkey AS p_partkey_2, a.p_name AS p_name_1, b.p_name AS p_name_2,
       a.p_type AS p_type_1, b.p_type AS p_type_2,
       round(coalesce(jaro_winkler_similarity(a.p_name, b.p_name), 0) + coalesce(jaro_winkler_similarity(a.p_type, b.p_type), 0), 4) AS Score
FROM fp a JOIN fp b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey
WHERE coalesce(jaro_winkler_similarity(a.p_name, b.p_name), 0) + coalesce(jaro_winkler_similarity(a.p_type, b.p_type), 0) > 1.75""")


# ------------------------------------------------------------------ rounding parity

def _decimal_rounding(sql: str) -> str:
    """Rewrite every ``round(x, n)`` to round the shortest decimal text of ``x``.

    Spark rounds a double half-up on its shortest decimal representation;
    DuckDB's double ``round`` scales in binary and can land the other way on
    a tie.  ``CAST(CAST(x AS VARCHAR) AS DECIMAL)`` then ``round`` gives
    Spark's result for the same double.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma is None:
            out.append(sql[i:k])
            i = k
            continue
        arg, digits = sql[j + 6:comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(CAST(({_decimal_rounding(arg)}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)")
        i = k


SQL["A5_warehouse_sink"] = SQL["K1_build_fl_dates"]
SQL["A6_report_sink"] = SQL["D27_audit_summary"]
SQL["A6_report_sink_all"] = " UNION ALL ".join(f"SELECT '{n}' AS report, (SELECT count(*) FROM ({SQL[k]}) q) AS n_rows" for n, k in (
    ("scorecards", "D9_run_dqa"), ("audit_summary", "D27_audit_summary"), ("outlier_summary", "D32_outlier_summary"), ("missingness", "D12_missingness_summary")))
SQL["A5_warehouse_sink_all"] = f"WITH {star_fact()} " + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST({c} AS BIGINT) AS n_columns FROM {t}" for n, t, c in (
        ("DIM_FL_DATES", "dim_fl_dates", 8), ("DIM_DEP_HOURS", "dim_dep_hours", 4), ("DIM_STATIONS", "dim_stations", 8), ("DIM_CARRIERS", "dim_carriers", 3),
        ("DIM_JUNK", "dim_junk", 4), ("DIM_AIRCRAFTS", "dim_aircraft", 5), ("FLIGHTS", "fact", 14)))
_WIDE = """wide AS (SELECT l.*, p.p_partkey, s.s_suppkey, n.n_nationkey, CAST(l_shipdate AS DATE) AS obs_date, CAST(l_orderkey % 24 AS INTEGER) AS obs_hour
  FROM lineitem l JOIN part p ON l_partkey = p_partkey JOIN supplier s ON l_suppkey = s_suppkey JOIN orders o ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey)"""
SQL["A8_reconcile_all"] = f"WITH {_WIDE} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in ks)}) AS natural_key, "
    f"CAST(row_number() OVER (ORDER BY {', '.join(ks)}) AS BIGINT) AS id FROM (SELECT DISTINCT {', '.join(ks)} FROM wide) x" for t, ks in (
        ("aircraft", ["p_partkey"]), ("carriers", ["s_suppkey"]), ("stations", ["n_nationkey"]), ("cancellation", ["l_returnflag"]),
        ("active_weather", ["l_linestatus"]), ("weather", ["n_nationkey", "obs_date", "obs_hour"]))) + """
UNION ALL SELECT 'flights', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), CAST(NULL AS BIGINT) FROM wide"""
SQL = {k: _decimal_rounding(v) for k, v in SQL.items()}
