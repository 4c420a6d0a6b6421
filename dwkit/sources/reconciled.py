"""The seven reconciled tables, bound to the driver tables with injected dirt.

Each view is one SELECT that Spark and DuckDB read alike (key arithmetic decides which value a row
carries; every view reads its whole source).  ``tables`` builds the frames, ``view_sql`` gives the same
views as common table expressions.

With ``one_to_one`` every empty observation has exactly one flight that points at it and few of these are cancelled for
reasons that forbid dropping; otherwise flights point at observations in no such relation.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.windows import with_dense_id


def _station_code(k: str) -> str:
    return f"concat(chr(CAST(65 + floor(({k}) / 26) AS INT)), chr(CAST(65 + ({k}) % 26 AS INT)), 'X')"


def _carrier_code(k: str) -> str:
    return (f"concat(chr(CAST(65 + floor(({k}) / 26) % 26 AS INT)), chr(CAST(65 + ({k}) % 26 AS INT)), "
            f"CASE WHEN ({k}) >= 676 THEN CAST({k} AS STRING) ELSE '' END)")


def _tail_number(k: str) -> str:
    return f"concat('N', CASE WHEN ({k}) < 10000 THEN lpad(CAST({k} AS STRING), 4, '0') ELSE CAST({k} AS STRING) END)"


def _untidy(value: str, when: str) -> str:
    return f"CASE WHEN {when} THEN concat(' ', lower({value})) ELSE {value} END"


# Column names and order of the reconciled layer are fixed values.
_STATION = _station_code("n_nationkey")
_STATIONS = f"""
SELECT {_untidy(_STATION, 'n_nationkey % 4 = 0')} AS airport,
       CAST(CASE WHEN n_nationkey % 9 = 0 THEN 1000 ELSE 1000 + n_nationkey END AS INT) AS airport_id,
       concat(lower(n_name), ' field') AS display_airport_name, concat(' ', n_name) AS display_airport_city_name_full,
       upper(r_name) AS airport_state_name,
       CASE WHEN n_nationkey % 4 = 0 THEN 'ab' ELSE concat(chr(CAST(65 + n_regionkey AS INT)), 'Z') END AS airport_state_code,
       CAST(n_nationkey * 8 - 90 AS DOUBLE) AS latitude, CAST(n_nationkey * 10 - 100 AS DOUBLE) AS longitude,
       CAST(n_nationkey * 300 - 1600 AS INT) AS elevation,
       CASE WHEN n_nationkey % 9 = 0 THEN 'KAAX' ELSE concat('K', {_STATION}) END AS icao, {_STATION} AS iata,
       CASE WHEN n_nationkey % 6 <> 0 THEN {_STATION} END AS faa, concat({_STATION}, 'Z') AS mesonet_station
FROM {{nation}} LEFT JOIN {{region}} ON n_regionkey = r_regionkey"""

_CARRIERS = f"""
SELECT CASE WHEN s_suppkey % 5 = 0 THEN concat(lower({_carrier_code('s_suppkey')}), ' ') ELSE {_carrier_code('s_suppkey')} END AS code,
       CASE WHEN s_suppkey % 17 <> 0 THEN upper(s_name) END AS description
FROM {{supplier}}"""

_AIRCRAFTS = f"""
SELECT CASE WHEN p_partkey % 29 = 0 THEN concat('X', CAST(p_partkey AS STRING)) ELSE {_untidy(_tail_number('p_partkey'), 'p_partkey % 6 = 0')} END AS tail_num,
       CAST(1945 + p_size AS INT) AS year_of_manufacture,
       CASE p_partkey % 7 WHEN 0 THEN 'airbus' WHEN 1 THEN 'BOEING' WHEN 2 THEN ' Bombardier' WHEN 3 THEN 'Embraer'
                          WHEN 4 THEN 'unknown' WHEN 5 THEN 'Acme' END AS manufacturer,
       CASE WHEN p_partkey % 11 = 0 THEN 'too long' ELSE concat('b7', CAST(p_partkey % 90 AS STRING)) END AS icao_type,
       CASE p_partkey % 4 WHEN 0 THEN 'Long Range' WHEN 1 THEN 'Medium Range' WHEN 2 THEN 'Short Range' END AS "range",
       CASE p_partkey % 3 WHEN 0 THEN 'Narrow-body' WHEN 1 THEN 'Wide-body' END AS width
FROM {{part}}"""

_CANCELLATION = "SELECT CAST(r_regionkey AS INT) AS status, lower(r_name) AS cancellation_reason FROM {region}"
_ACTIVE_WEATHER = "SELECT CAST(r_regionkey AS INT) AS status, r_name AS weather_description FROM {region} WHERE r_regionkey < 3"

_WEATHER_CELLS = """
SELECT user_id % 5 AS st, CAST(ts AS DATE) AS day, CAST(EXTRACT(HOUR FROM ts) AS INT) AS obs_hour, max(value) AS v, min(value) AS u
FROM {events} GROUP BY user_id % 5, CAST(ts AS DATE), CAST(EXTRACT(HOUR FROM ts) AS INT)"""

_GONE = "o % 13 = 0"
_WEATHER_ROWS = f"""
SELECT o AS obs_id, {_untidy(_station_code('st'), 'o % 6 = 0')} AS origin_airport,
       CASE WHEN o % 10 = 1 THEN replace(CAST(day AS STRING), '-', '/') ELSE CAST(day AS STRING) END AS obs_date, obs_hour,
       CASE WHEN {_GONE} THEN NULL ELSE CAST(o % 400 AS DOUBLE) END AS wind_dir,
       CASE WHEN {_GONE} THEN NULL ELSE u END AS wind_spd,
       CASE WHEN {_GONE} OR o % 11 = 0 THEN NULL WHEN o % 19 = 0 THEN u / 2 ELSE v END AS wind_gust,
       CASE WHEN {_GONE} OR o % 7 = 0 THEN NULL WHEN o % 29 = 0 THEN CAST(25 AS DOUBLE) ELSE CAST(o % 21 AS DOUBLE) END AS visibility,
       CASE WHEN {_GONE} THEN NULL ELSE CAST(o % 50 - 10 AS DOUBLE) END AS temperature,
       CASE WHEN {_GONE} OR o % 17 = 0 THEN NULL WHEN o % 23 = 0 THEN CAST(o % 50 - 5 AS DOUBLE) ELSE CAST(o % 50 - 15 AS DOUBLE) END AS dew_point,
       CASE WHEN {_GONE} THEN NULL WHEN o % 31 = 0 THEN CAST(130 AS DOUBLE) ELSE CAST(o % 101 AS DOUBLE) END AS rel_humidity,
       CASE WHEN {_GONE} THEN NULL WHEN o % 37 = 0 THEN CAST(12 AS DOUBLE) ELSE CAST(29 AS DOUBLE) + CAST(o % 10 AS DOUBLE) / 10 END AS altimeter,
       CASE WHEN {_GONE} OR o % 3 = 0 THEN NULL ELSE CAST(o % 250 * 100 AS DOUBLE) END AS lowest_cloud_layer,
       CASE WHEN {_GONE} THEN NULL ELSE CAST(o % 4 AS DOUBLE) END AS n_cloud_layer,
       CASE WHEN {_GONE} THEN NULL ELSE CAST(o % 2 AS DOUBLE) END AS low_level_cloud,
       CASE WHEN {_GONE} THEN NULL WHEN o % 3 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS mid_level_cloud,
       CASE WHEN {_GONE} THEN NULL WHEN o % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS high_level_cloud,
       CASE WHEN {_GONE} THEN NULL ELSE CAST(o % 5 AS DOUBLE) END AS cloud_cover,
       CASE WHEN {_GONE} THEN NULL WHEN o % 41 = 0 THEN CAST(9 AS DOUBLE) ELSE CAST(o % 3 AS DOUBLE) END AS active_weather_status
FROM {{cells}}"""
#: Some observations occur twice, the second time under a later id.
_WEATHER = """
SELECT * FROM {rows}
UNION ALL
SELECT obs_id + 1000000000 AS obs_id, {columns} FROM {rows} WHERE obs_id % 37 = 5 AND obs_id % 13 <> 0"""

_FLIGHTS = f"""
SELECT event_id + 1 AS flight_id,
       CASE WHEN event_id % 53 = 0 THEN 'not-a-date' WHEN event_id % 10 = 1 THEN replace(CAST(CAST(ts AS DATE) AS STRING), '-', '/')
            ELSE CAST(CAST(ts AS DATE) AS STRING) END AS fl_date,
       CAST(EXTRACT(HOUR FROM ts) AS INT) AS dep_hour,
       {_carrier_code('user_id % 120')} AS mkt_unique_carrier, CAST(user_id AS INT) AS mkt_carrier_fl_num,
       {_untidy(_carrier_code('user_id % 90'), 'event_id % 5 = 0')} AS op_unique_carrier, CAST(event_id % 1000 AS INT) AS op_carrier_fl_num,
       CASE WHEN event_id % 31 = 0 THEN 'N9ZZZ' ELSE {_untidy(_tail_number('event_id % 150'), 'event_id % 6 = 0')} END AS tail_num,
       {_untidy(_station_code('user_id % 5'), 'event_id % 5 = 0')} AS origin, {_station_code('event_id % 27')} AS dest,
       date_trunc('hour', ts) AS dep_time, date_trunc('day', ts) AS crs_dep_time,
       value AS taxi_out, CASE WHEN event_id % 43 <> 0 THEN CAST(event_id % 200 - 20 AS INT) END AS dep_delay,
       CASE WHEN event_id % 17 <> 0 THEN value * 2 END AS air_time, value * 10 AS distance,
       CAST(CASE WHEN event_id % 260 = 0 THEN 1 WHEN event_id % 13 = 0 THEN 3 WHEN event_id % 41 = 0 THEN 7 WHEN event_id % 47 = 0 THEN NULL
                 ELSE event_id % 5 END AS INT) AS cancelled,
       {{link}} AS weather_observation_id
FROM {{events}}"""
_LINK = {True: "CASE WHEN event_id % 13 = 0 THEN event_id ELSE event_id - event_id % 13 + 1 END", False: "event_id % 1000 + 1"}

WEATHER_COLUMNS = ["obs_id", "origin_airport", "obs_date", "obs_hour", "wind_dir", "wind_spd", "wind_gust", "visibility", "temperature", "dew_point",
                   "rel_humidity", "altimeter", "lowest_cloud_layer", "n_cloud_layer", "low_level_cloud", "mid_level_cloud", "high_level_cloud",
                   "cloud_cover", "active_weather_status"]
_SIMPLE = {"Stations": _STATIONS, "Carriers": _CARRIERS, "Aircrafts": _AIRCRAFTS, "Cancellation": _CANCELLATION, "Active_Weather": _ACTIVE_WEATHER}
_SOURCES = ["nation", "region", "supplier", "part", "events"]


def tables(spark: SparkSession, sf_dir: str, one_to_one: bool = True) -> dict[str, DataFrame]:
    """The seven frames, lazily."""
    src = {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in _SOURCES}

    def run(text: str, **frames) -> DataFrame:
        used = {k: v for k, v in (src | frames).items() if "{" + k + "}" in text}
        return spark.sql(text.replace('"range"', "`range`"), **used)

    out = {name: run(text) for name, text in _SIMPLE.items()}
    cells = with_dense_id(run(_WEATHER_CELLS), ["st", "day", "obs_hour"], "o")
    rows = run(_WEATHER_ROWS, cells=cells)
    out["Weather_Observations"] = run(_WEATHER.replace("{columns}", ", ".join(WEATHER_COLUMNS[1:])), rows=rows)
    out["Flights"] = run(_FLIGHTS.replace("{link}", _LINK[one_to_one]))
    return out


def view_sql(one_to_one: bool = True) -> str:
    """The same views as common table expressions ``rec_<table>`` over the driver tables."""
    names = {t: t for t in _SOURCES}
    parts = [f"rec_{name.lower()} AS ({text.format(**names)})" for name, text in _SIMPLE.items()]
    parts.append(f"rec_cells AS (SELECT CAST(row_number() OVER (ORDER BY st, day, obs_hour) AS BIGINT) AS o, * FROM ({_WEATHER_CELLS.format(**names)}) c)")
    parts.append(f"rec_weather_rows AS ({_WEATHER_ROWS.format(cells='rec_cells')})")
    parts.append(f"rec_weather_observations AS ({_WEATHER.format(rows='rec_weather_rows', columns=', '.join(WEATHER_COLUMNS[1:]))})")
    parts.append(f"rec_flights AS ({_FLIGHTS.format(link=_LINK[one_to_one], **names)})")
    return ",\n".join(parts)
