"""DuckDB SQL of the seven-table queries: the cleaning run and the rule registry (see ``oracle_sql``)."""

from __future__ import annotations

from dwkit.sources.reconciled import WEATHER_COLUMNS, view_sql
from oracle_sql import AGE, ENV_DIMS, ENV_FACT, EVENTS_DIRTY, GUST, TEMP, VIS, bucket_sql, interp_sql, star_dims, star_fact, strip, title

COLUMNS = {
    "Active_Weather": ["status", "weather_description"], "Cancellation": ["status", "cancellation_reason"], "Carriers": ["code", "description"],
    "Stations": ["airport", "airport_id", "display_airport_name", "display_airport_city_name_full", "airport_state_name", "airport_state_code",
                 "latitude", "longitude", "elevation", "icao", "iata", "faa", "mesonet_station"],
    "Aircrafts": ["tail_num", "year_of_manufacture", "manufacturer", "icao_type", '"range"', "width"],
    "Weather_Observations": WEATHER_COLUMNS,
    "Flights": ["flight_id", "fl_date", "dep_hour", "mkt_unique_carrier", "mkt_carrier_fl_num", "op_unique_carrier", "op_carrier_fl_num", "tail_num",
                "origin", "dest", "dep_time", "crs_dep_time", "taxi_out", "dep_delay", "air_time", "distance", "cancelled", "weather_observation_id"],
}
ORDER = list(COLUMNS)
MEASURES = WEATHER_COLUMNS[4:18]
_EMPTY = " AND ".join(f"{c} IS NULL" for c in MEASURES)
DATE = "try_strptime({}, ['%Y-%m-%d', '%Y/%m/%d', '%m/%d/%Y'])"


def _day(x: str) -> str:
    return f"strftime({DATE.format(x)}, '%Y-%m-%d')"


def _with(src: str, columns: list[str], **new: str) -> str:
    """SELECT of all columns with some replaced."""
    return "SELECT " + ", ".join(f"{new[c]} AS {c}" if c in new else c for c in columns) + f" FROM {src}"


def _upper(*cols: str) -> dict:
    return {c: f"upper({strip(c)})" for c in cols}


def _title(*cols: str) -> dict:
    return {c: title(strip(c)) for c in cols}


def _in_parent(col: str, parent: str, key: str) -> str:
    return f"CASE WHEN {col} IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL) THEN {col} END"


def run_ctes(one_to_one: bool = True) -> str:
    """Every step of the run as a common table expression; cl_<table> are the clean tables."""
    c = COLUMNS
    w, f, st, ac = c["Weather_Observations"], c["Flights"], c["Stations"], c["Aircrafts"]
    domains = {"low_level_cloud": [0, 1], "mid_level_cloud": [0, 1], "high_level_cloud": [0, 1], "cloud_cover": [0, 1, 2, 3, 4]}
    snap = {k: f"CASE WHEN {k} IS NOT NULL THEN (SELECT arg_min(v, abs(v - {k}) * 10 + v * 0.0001) FROM (VALUES {', '.join(f'({v}.0)' for v in vs)}) t(v)) END" for k, vs in domains.items()}
    ctes = [view_sql(one_to_one)]

    def add(name: str, text: str):
        ctes.append(f"{name} AS ({text})")

    add("cl_active_weather", "SELECT * FROM rec_active_weather")
    add("cl_cancellation", _with("rec_cancellation", c["Cancellation"], **_title("cancellation_reason")))
    add("cl_carriers", _with("rec_carriers", c["Carriers"], **_upper("code"), **_title("description")))
    add("st1", _with("rec_stations", st, **_upper("airport", "airport_state_code", "icao", "iata", "faa", "mesonet_station"),
                     **_title("display_airport_name", "display_airport_city_name_full", "airport_state_name")))
    add("cl_stations", _with("st1", st, elevation="CASE WHEN elevation < -1500 THEN NULL ELSE elevation END"))
    add("ac1", _with("rec_aircrafts", ac, **_upper("tail_num", "icao_type"), **_title("manufacturer")))
    add("cl_aircrafts", _with("ac1", ac, tail_num="CASE WHEN regexp_matches(tail_num, '^N[A-Z0-9]{2,5}$') THEN tail_num END",
                              manufacturer="CASE WHEN manufacturer IN ('Airbus', 'Boeing', 'Bombardier', 'Embraer', 'Unknown') THEN manufacturer END",
                              icao_type="CASE WHEN regexp_matches(icao_type, '^[A-Z0-9]{2,4}$') THEN icao_type END"))
    add("w1", _with("rec_weather_observations", w, **_upper("origin_airport"), obs_date=_day("obs_date")))
    add("empty_obs", f"SELECT obs_id FROM w1 WHERE {_EMPTY}")
    add("linked", "SELECT * FROM rec_flights WHERE weather_observation_id IN (SELECT obs_id FROM empty_obs)")
    add("decision", """SELECT n = a AND n > 0 AND (d = 0 OR round(d / a, 4) <= 0.1) AS safe FROM (SELECT (SELECT count(*) FROM empty_obs) AS n,
        (SELECT count(*) FROM linked) AS a, (SELECT count(*) FROM linked WHERE cancelled IN (1, 2)) AS d) q""")
    # empty rows go, or measures are interpolated by time within the airport and codes snapped to their domain
    add("w_time", "SELECT *, origin_airport AS station FROM w1")
    add("w_filled", "SELECT k.obs_id, " + ", ".join(f"i.{m}" for m in MEASURES) + f" FROM w1 k JOIN {interp_sql('w_time', MEASURES, digits=None)} i ON k.obs_id = i.obs_id")
    add("w_int", "SELECT w1.obs_id, " + ", ".join(f"f.{x}" if x in MEASURES else f"w1.{x}" for x in w[1:]) + " FROM w1 JOIN w_filled f ON w1.obs_id = f.obs_id")
    add("w2", f"SELECT * FROM w1 WHERE (SELECT safe FROM decision) AND NOT ({_EMPTY}) UNION ALL "
              + _with("w_int", w, **snap) + " WHERE NOT (SELECT safe FROM decision)")
    add("w3", f"SELECT {', '.join(w)} FROM (SELECT *, row_number() OVER (PARTITION BY origin_airport, obs_date, obs_hour ORDER BY obs_id) AS rk FROM w2) q WHERE rk = 1")
    add("w4", _with("w3", w, obs_id="CAST(row_number() OVER (ORDER BY obs_id) AS BIGINT)"))

    def span(x, lo, hi):
        return f"CASE WHEN {x} < {lo} OR {x} > {hi} THEN NULL ELSE {x} END"

    add("w5", _with("w4", w, rel_humidity=span("rel_humidity", 0, 100), altimeter=span("altimeter", 25, 35), visibility=span("visibility", 0, 20)))
    add("w6", _with("w5", w, visibility="coalesce(visibility, median(visibility) OVER (PARTITION BY origin_airport), (SELECT median(visibility) FROM w5))"))
    add("w7", _with("w6", w, dew_point="CASE WHEN dew_point > temperature THEN temperature ELSE dew_point END",
                    temperature="CASE WHEN dew_point > temperature THEN dew_point ELSE temperature END",
                    wind_gust="CASE WHEN wind_gust < wind_spd THEN wind_spd ELSE wind_gust END",
                    cloud_cover="""CASE WHEN cloud_cover = 0 AND (coalesce(low_level_cloud, 0) = 1 OR coalesce(mid_level_cloud, 0) = 1
                      OR coalesce(high_level_cloud, 0) = 1 OR coalesce(lowest_cloud_layer <= 10000, FALSE)) THEN 1 ELSE cloud_cover END"""))
    add("cl_weather_observations", _with("w7", w, origin_airport=_in_parent("origin_airport", "cl_stations", "airport"),
                                         active_weather_status=_in_parent("active_weather_status", "cl_active_weather", "status")))
    add("f0", "SELECT * FROM rec_flights WHERE NOT (SELECT safe FROM decision) OR weather_observation_id IS NULL OR weather_observation_id NOT IN (SELECT obs_id FROM empty_obs)")
    add("f1", _with("f0", f, **_upper("origin", "dest", "op_unique_carrier", "mkt_unique_carrier", "tail_num"), fl_date=_day("fl_date")))
    add("f2", _with("f1", f, air_time="CASE WHEN coalesce(cancelled, 0) > 0 AND air_time > 0 THEN NULL ELSE air_time END"))
    add("f3", _with("f2", f, origin=_in_parent("origin", "cl_stations", "airport"), dest=_in_parent("dest", "cl_stations", "airport"),
                    tail_num=_in_parent("tail_num", "cl_aircrafts", "tail_num"), mkt_unique_carrier=_in_parent("mkt_unique_carrier", "cl_carriers", "code"),
                    op_unique_carrier=_in_parent("op_unique_carrier", "cl_carriers", "code"), cancelled=_in_parent("cancelled", "cl_cancellation", "status")))
    add("lk", """SELECT origin_airport AS la, obs_date AS ld, obs_hour AS lh, min(obs_id) AS new_id FROM cl_weather_observations
        WHERE origin_airport IS NOT NULL AND obs_date IS NOT NULL AND obs_hour IS NOT NULL GROUP BY 1, 2, 3""")
    add("f4", "SELECT " + ", ".join("new_id AS weather_observation_id" if x == "weather_observation_id" else x for x in f)
        + " FROM f3 LEFT JOIN lk ON origin = la AND fl_date = ld AND dep_hour = lh")

    def clip(x):
        return (f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, (SELECT min({x}) FROM f4)), (SELECT quantile_cont({x}, 0.99) FROM f4)) END")

    add("cl_flights", _with("f4", f, taxi_out=clip("taxi_out"), air_time=clip("air_time")))
    return "WITH " + ",\n".join(ctes)


def clean_table_sql(table: str, one_to_one: bool = True) -> str:
    def out(c):
        if c in ("dep_time", "crs_dep_time"):
            return f"CAST({c} AS VARCHAR) AS {c}"
        if c in MEASURES + ["taxi_out", "air_time", "distance", "latitude", "longitude", "active_weather_status"]:
            return f"round(CAST({c} AS DOUBLE), 4) AS {c}"
        return c
    return run_ctes(one_to_one) + " SELECT " + ", ".join(map(out, COLUMNS[table])) + f" FROM cl_{table.lower()}"


def counts_sql(one_to_one: bool = True) -> str:
    parts = []
    for t, cols in COLUMNS.items():
        def nulls(src):
            return f"(SELECT coalesce(CAST(sum({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in cols)}) AS BIGINT), 0) FROM {src}_{t.lower()})"
        parts.append(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM rec_{t.lower()}) AS rows_before, (SELECT count(*) FROM cl_{t.lower()}) AS rows_after, "
                     f"(SELECT count(*) FROM rec_{t.lower()}) - (SELECT count(*) FROM cl_{t.lower()}) AS rows_removed, "
                     f"{nulls('rec')} AS nulls_before, {nulls('cl')} AS nulls_after, CAST({len(cols)} AS BIGINT) AS n_columns")
    return run_ctes(one_to_one) + " " + " UNION ALL ".join(parts)


def audit_sql(one_to_one: bool = True) -> str:
    """Changed cells by table, step and column; batch steps count one entry."""
    def moved(t, step, cols, a, b, key):
        return [f"SELECT '{t}' AS table_name, '{step}' AS step, '{c}' AS column_name, count(*) AS n FROM {a} a JOIN {b} b ON a.{key} = b.{key} "
                f"WHERE CAST(a.{c} AS VARCHAR) IS DISTINCT FROM CAST(b.{c} AS VARCHAR)" for c in cols]

    def text(t, cols, new):
        return [f"SELECT '{t}' AS table_name, 'standardize_strings' AS step, '{c}' AS column_name, count(*) AS n FROM rec_{t.lower()} "
                f"WHERE {c} IS DISTINCT FROM {new(c)[c]}" for c in cols]

    def emptied(t, step, col, src, bad):
        return [f"SELECT '{t}' AS table_name, '{step}' AS step, '{col}' AS column_name, count(*) AS n FROM {src} WHERE {col} IS NOT NULL AND {bad}"]

    def fk(t, col, src, parent, key):
        return emptied(t, f"fix_fk_to_null:{col}", col, src, f"{col} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)")

    def batch(t, step, col, a, b):
        return [f"SELECT '{t}' AS table_name, '{step}' AS step, '{col}' AS column_name, CASE WHEN (SELECT count(*) FROM {a}) <> (SELECT count(*) FROM {b}) THEN 1 ELSE 0 END AS n"]

    key3 = str(["origin_airport", "obs_date", "obs_hour"]).replace("'", "''")
    measures = str(MEASURES).replace("'", "''")
    parts = text("Cancellation", ["cancellation_reason"], _title) + text("Carriers", ["code"], _upper) + text("Carriers", ["description"], _title)
    parts += text("Stations", ["airport", "airport_state_code", "icao", "iata", "faa", "mesonet_station"], _upper)
    parts += text("Stations", ["display_airport_name", "display_airport_city_name_full", "airport_state_name"], _title)
    parts += emptied("Stations", "fix_validity_range:elevation", "elevation", "st1", "elevation < -1500")
    parts += text("Aircrafts", ["tail_num", "icao_type"], _upper) + text("Aircrafts", ["manufacturer"], _title)
    parts += emptied("Aircrafts", "flag_invalid_tail_num", "tail_num", "ac1", "NOT regexp_matches(tail_num, '^N[A-Z0-9]{2,5}$')")
    parts += emptied("Aircrafts", "fix_invalid_to_null:manufacturer", "manufacturer", "ac1", "manufacturer NOT IN ('Airbus', 'Boeing', 'Bombardier', 'Embraer', 'Unknown')")
    parts += emptied("Aircrafts", "fix_invalid_pattern", "icao_type", "ac1", "NOT regexp_matches(icao_type, '^[A-Z0-9]{2,4}$')")
    t = "Weather_Observations"
    parts += text(t, ["origin_airport"], _upper) + moved(t, "parse_dates", ["obs_date"], "rec_weather_observations", "w1", "obs_id")
    parts += [f"SELECT '{t}', 'handle_weather_nulls_drop', '{measures}', CAST((SELECT safe FROM decision) AS INTEGER)",
              f"SELECT '{t}', 'handle_weather_nulls_drop', 'weather_observation_id', CAST((SELECT safe FROM decision) AS INTEGER)"]
    parts += [f"SELECT '{t}', 'interpolate_temporal', '{m}', count(*) FROM w1 JOIN w_int i ON w1.obs_id = i.obs_id "
              f"WHERE NOT (SELECT safe FROM decision) AND w1.{m} IS NULL AND i.{m} IS NOT NULL" for m in MEASURES]
    parts += [f"SELECT '{t}', 'round_discrete_cols', '{m}', count(*) FROM w_int i JOIN w2 ON i.obs_id = w2.obs_id "
              f"WHERE NOT (SELECT safe FROM decision) AND i.{m} <> w2.{m}" for m in MEASURES[10:]]
    parts += batch(t, "deduplicate", key3, "w2", "w3")
    parts += emptied(t, "fix_validity_range:rel_humidity", "rel_humidity", "w4", "rel_humidity NOT BETWEEN 0 AND 100")
    parts += emptied(t, "fix_validity_range:altimeter", "altimeter", "w4", "altimeter NOT BETWEEN 25 AND 35")
    parts += emptied(t, "fix_validity_range:visibility", "visibility", "w4", "visibility NOT BETWEEN 0 AND 20")
    parts += moved(t, "impute_numeric_nulls_by_group_median:visibility", ["visibility"], "w5", "w6", "obs_id")
    parts += [f"SELECT '{t}', 'fix_dew_point_swap', 'dew_point', count(*) FROM w6 WHERE dew_point > temperature"]
    parts += moved(t, "fix_wind_gust_floor", ["wind_gust"], "w6", "w7", "obs_id")
    parts += [f"SELECT '{t}', 'fix_cloud_cover_consistency', 'cloud_cover', count(*) FROM w6 JOIN w7 ON w6.obs_id = w7.obs_id WHERE w6.cloud_cover <> w7.cloud_cover"]
    parts += fk(t, "origin_airport", "w7", "cl_stations", "airport") + fk(t, "active_weather_status", "w7", "cl_active_weather", "status")
    t = "Flights"
    parts += [f"SELECT '{t}', 'standardize_strings', '{c}', count(*) FROM f0 WHERE {c} IS DISTINCT FROM {_upper(c)[c]}"
              for c in ["origin", "dest", "op_unique_carrier", "mkt_unique_carrier", "tail_num"]]
    parts += moved(t, "parse_dates", ["fl_date"], "f0", "f1", "flight_id")
    parts += emptied(t, "fix_cancelled_air_time", "air_time", "f1", "coalesce(cancelled, 0) > 0 AND air_time > 0")
    for col, parent, key in [("origin", "cl_stations", "airport"), ("dest", "cl_stations", "airport"), ("tail_num", "cl_aircrafts", "tail_num"),
                             ("mkt_unique_carrier", "cl_carriers", "code"), ("op_unique_carrier", "cl_carriers", "code"), ("cancelled", "cl_cancellation", "status")]:
        parts += fk(t, col, "f2", parent, key)
    parts += [f"SELECT '{t}', 'fix_weather_observation_fk', 'weather_observation_id', 1"]
    parts += [f"SELECT '{t}', 'winsorize_numeric', '{c}', count(*) FROM f4 JOIN cl_flights b ON f4.flight_id = b.flight_id WHERE f4.{c} <> b.{c}" for c in ["taxi_out", "air_time"]]
    return (run_ctes(one_to_one) + " SELECT table_name, step, column_name, '2024-02-01 00:00:00' AS timestamp, CAST(n AS BIGINT) AS n_entries FROM ("
            + " UNION ALL ".join(parts) + ") q WHERE n > 0")


def dropped_sql(one_to_one: bool = True) -> str:
    return run_ctes(one_to_one) + """ SELECT 'Weather_Observations' AS table_name, 'handle_weather_nulls_drop' AS step, CAST(obs_id AS VARCHAR) AS row_id
FROM empty_obs WHERE (SELECT safe FROM decision)
UNION ALL SELECT 'Weather_Observations', 'deduplicate', CAST(obs_id AS VARCHAR) FROM w2 WHERE obs_id NOT IN (SELECT obs_id FROM w3)
UNION ALL SELECT 'Flights', 'handle_weather_nulls_drop', CAST(flight_id AS VARCHAR) FROM linked WHERE (SELECT safe FROM decision)"""


# ------------------------------------------------------------------ rule registry

def _between(lo, hi):
    return lambda c: f"{c} BETWEEN {lo} AND {hi}"


def _match(p):
    return lambda c: f"regexp_matches({c}, '{p}')"


def _in(*values):
    return lambda c: f"{c} IN ({', '.join(map(repr, values))})"


def _date(c):
    return f"{DATE.format(c)} IS NOT NULL"


def _true(c):
    return "TRUE"


_FLOWN = "coalesce(cancelled, 0) <= 0"
#: table -> key columns, required columns, date column, validity by column, predicates, foreign keys, unique columns
REGISTRY = {
    "Active_Weather": (["status"], ["status", "weather_description"], None, {"status": _in(0, 1, 2)}, {}, {}, []),
    "Cancellation": (["status"], ["status", "cancellation_reason"], None, {"status": _in(0, 1, 2, 3, 4)}, {}, {}, []),
    "Carriers": (["code"], ["code", "description"], None, {"code": _match("^[A-Z0-9]{2}$")}, {}, {}, []),
    "Stations": (["airport"], ["airport", "airport_id", "display_airport_name", "latitude", "longitude"], None,
                 {"latitude": _between(-90, 90), "longitude": _between(-180, 180), "airport": _match("^[A-Z]{3}$"), "airport_state_code": _match("^[A-Z]{2}$"),
                  "elevation": lambda c: f"{c} > -1500", "icao": _match("^[A-Z]{4}$"), "iata": _match("^[A-Z]{3}$"), "faa": _match("^[A-Z]{3}$"),
                  "mesonet_station": _match("^[A-Z0-9]{3,5}$")}, {}, {}, ["airport_id", "icao", "iata", "mesonet_station"]),
    "Aircrafts": (["tail_num"], ["tail_num", "manufacturer", "year_of_manufacture"], None,
                  {"year_of_manufacture": _between(1950, 2024), "tail_num": _match("^N[A-Z0-9]{4,5}$"),
                   "manufacturer": _in("Airbus", "Boeing", "Bombardier", "Embraer", "Unknown"), "icao_type": _match("^[A-Z0-9]{2,4}$"),
                   '"range"': _in("Long Range", "Medium Range", "Short Range"), "width": _in("Narrow-body", "Wide-body")},
                  {"wide_body_not_short_range": """NOT coalesce(width = 'Wide-body', FALSE) OR coalesce("range" <> 'Short Range', TRUE)"""}, {}, []),
    "Weather_Observations": (
        ["origin_airport", "obs_date", "obs_hour"], ["obs_id", "origin_airport", "obs_date", "obs_hour"], "obs_date",
        {"obs_date": _date, "obs_hour": _between(0, 23), "wind_dir": _between(0, 360), "wind_spd": _between(0, 250), "wind_gust": _between(0, 300),
         "visibility": _between(0, 20), "temperature": _between(-80, 60), "dew_point": _between(-80, 35), "rel_humidity": _between(0, 100),
         "altimeter": _between(25, 35), "lowest_cloud_layer": lambda c: f"{c} >= 0", "n_cloud_layer": lambda c: f"{c} >= 0", "low_level_cloud": _in(0, 1),
         "mid_level_cloud": _in(0, 1), "high_level_cloud": _in(0, 1), "cloud_cover": _in(0, 1, 2, 3, 4)},
        {"dew_point_le_temperature": "coalesce(dew_point <= temperature, TRUE)", "gust_ge_sustained": "coalesce(wind_gust >= wind_spd, TRUE)",
         "clear_sky_no_layer_flags": """NOT coalesce(cloud_cover = 0, FALSE) OR (coalesce(low_level_cloud, 0) = 0 AND coalesce(mid_level_cloud, 0) = 0
            AND coalesce(high_level_cloud, 0) = 0)""",
         "clear_sky_high_layer": "NOT coalesce(cloud_cover = 0, FALSE) OR coalesce(lowest_cloud_layer > 10000, TRUE)"},
        {"origin_airport": ("Stations", "airport"), "active_weather_status": ("Active_Weather", "status")}, []),
    "Flights": (
        ["fl_date", "dep_hour", "origin", "dest", "op_unique_carrier", "op_carrier_fl_num"],
        ["flight_id", "fl_date", "dep_hour", "origin", "dest", "op_unique_carrier", "mkt_unique_carrier", "tail_num"], "fl_date",
        {"fl_date": _date, "dep_time": _true, "crs_dep_time": _true, "dep_hour": _between(0, 23), "distance": _between(0, 5100), "taxi_out": _between(0, 300),
         "air_time": _between(0, 900), "dep_delay": lambda c: f"{c} >= -120"},
        {"cancelled_no_air_time": f"({_FLOWN}) OR NOT coalesce(air_time > 0, FALSE)", "dep_delay_present_unless_cancelled": f"NOT ({_FLOWN}) OR dep_delay IS NOT NULL",
         "air_time_positive_unless_cancelled": f"NOT ({_FLOWN}) OR coalesce(air_time > 0, TRUE)"},
        {"origin": ("Stations", "airport"), "dest": ("Stations", "airport"), "tail_num": ("Aircrafts", "tail_num"), "mkt_unique_carrier": ("Carriers", "code"),
         "op_unique_carrier": ("Carriers", "code"), "weather_observation_id": ("Weather_Observations", "obs_id"), "cancelled": ("Cancellation", "status")}, []),
}


def _bad_value(col, rule):
    return f"({col} IS NOT NULL AND NOT coalesce({rule(col)}, FALSE))"


def _bad_rows(t: str, prefix: str, src: str) -> dict[str, str]:
    """rule -> condition of a violating row."""
    _, _, _, _, predicates, fks, unique = REGISTRY[t]
    bad = {name: f"NOT ({p})" for name, p in predicates.items()}
    bad |= {f"fk_{c}": f"({c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {prefix}_{p.lower()} WHERE {k} IS NOT NULL))" for c, (p, k) in fks.items()}
    bad |= {f"unique_{c}": f"({c} IN (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))" for c in unique}
    return bad


def registry_sql(one_to_one: bool = True) -> str:
    parts = []
    for t, (_, _, _, validity, _, _, _) in REGISTRY.items():
        src = f"rec_{t.lower()}"
        parts += [f"SELECT '{t}' AS table_name, 'validity' AS kind, '{c.strip(chr(34))}' AS rule, count(*) FILTER (WHERE {_bad_value(c, rule)}) AS n_violations, count(*) AS n_rows FROM {src}"
                  for c, rule in validity.items()]
        parts += [f"SELECT '{t}' AS table_name, 'consistency' AS kind, '{name}' AS rule, count(*) FILTER (WHERE {cond}) AS n_violations, count(*) AS n_rows FROM {src}"
                  for name, cond in _bad_rows(t, "rec", src).items()]
    return f"WITH {view_sql(one_to_one)} " + " UNION ALL ".join(parts)


def _scores(t: str, prefix: str, src: str) -> str:
    """(dimension, issues, total) of one table."""
    keys, required, day, validity, _, _, _ = REGISTRY[t]
    out = [f"SELECT 'Completeness' AS dim, coalesce(sum({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in required)}), 0) AS issues, count(*) * {len(required)} AS total FROM {src}",
           f"SELECT 'Uniqueness', coalesce((SELECT sum(k) FROM (SELECT count(*) AS k FROM {src} GROUP BY {', '.join(keys)}) g WHERE k > 1), 0), count(*) FROM {src}",
           f"SELECT 'Validity', count(*) FILTER (WHERE {' OR '.join(_bad_value(c, r) for c, r in validity.items())}), count(*) FROM {src}"]
    if bad := _bad_rows(t, prefix, src):
        out.append(f"SELECT 'Consistency', count(*) FILTER (WHERE {' OR '.join(bad.values())}), count(*) FROM {src}")
    if day:
        age = f"date_diff('day', CAST({DATE.format(day)} AS DATE), DATE '2024-02-01')"
        out.append(f"SELECT 'Timeliness', count(*) FILTER (WHERE coalesce({age} > 1825 OR {age} < 0, FALSE)), count(*) FROM {src}")
    return " UNION ALL ".join(out)


def comparison_sql(one_to_one: bool = True) -> str:
    def graded(q):
        return f"(SELECT dim, CAST(issues AS BIGINT) AS issues, CASE WHEN total > 0 THEN round(1.0 - CAST(issues AS DOUBLE) / total, 4) ELSE 0.0 END AS score FROM ({q}) z)"

    def status(x):
        return f"CASE WHEN {x} >= 0.95 THEN 'PASS' WHEN {x} >= 0.8 THEN 'WARN' ELSE 'FAIL' END"

    parts = []
    for t in REGISTRY:
        before = "f0" if t == "Flights" else f"rec_{t.lower()}"
        parts.append(f"""SELECT '{t}' AS table_name, a.dim AS "Dimension", a.score AS "Score_before", a.issues AS "Issues_before", {status('a.score')} AS "Status_before",
b.score AS "Score_after", b.issues AS "Issues_after", {status('b.score')} AS "Status_after", round(b.score - a.score, 4) AS "Delta",
CASE WHEN round(b.score - a.score, 4) > 0 THEN 'YES' WHEN round(b.score - a.score, 4) = 0 THEN '=' ELSE 'NO' END AS "Improved"
FROM {graded(_scores(t, 'rec', before))} a JOIN {graded(_scores(t, 'cl', f'cl_{t.lower()}'))} b ON a.dim = b.dim""")
    return run_ctes(one_to_one) + " " + " UNION ALL ".join(parts)


def validation_sql(one_to_one: bool = True) -> str:
    """Clean tables have the raw columns in the raw order; codes and clipped measures keep their types."""
    retyped = {}
    parts = []
    keys = {t: (k if len(k) == 1 else {"Flights": ["flight_id"], "Weather_Observations": ["obs_id"]}[t]) for t, (k, *_) in REGISTRY.items()}
    for t in REGISTRY:
        for check in ["column_count", "missing_columns", "extra_columns", "column_order"]:
            parts.append(f"SELECT '{t}' AS table_name, '{check}' AS \"check\", 'PASS' AS status, 'as agreed' AS message")
        parts.append(f"SELECT '{t}', 'dtype_changes', '{'WARN' if t in retyped else 'PASS'}', '{retyped.get(t, 'as agreed')}'")
        k = keys[t][0]
        parts.append(f"SELECT '{t}', 'pk_uniqueness', CASE WHEN s = 0 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN s = 0 THEN 'as agreed' ELSE s || ' surplus rows' END "
                     f"FROM (SELECT CAST(sum(n - 1) AS BIGINT) AS s FROM (SELECT count(*) AS n FROM cl_{t.lower()} GROUP BY {k}) g) h")
    return run_ctes(one_to_one) + " " + " UNION ALL ".join(parts)


# ------------------------------------------------------------------ declared layers, dictionary, stored contracts, load gate

def layers_sql() -> str:
    """Only a date that can't be read makes a row of these tables unfit."""
    unfit = {"Flights": f"fl_date IS NOT NULL AND {DATE.format('fl_date')} IS NULL"}
    parts = []
    for layer, names in (("original", {"CompleteData": "Flights", "ActiveWeather": "Active_Weather", "Cancellation": "Cancellation", "Carriers": "Carriers", "Stations": "Stations"}),
                         ("reconciled", {t: t for t in COLUMNS})):
        for name, t in names.items():
            bad = unfit.get(t, "FALSE")
            parts.append(f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) FILTER (WHERE NOT ({bad})) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_rejected FROM rec_{t.lower()}")
    dims = {"DIM_FL_DATES": "dim_fl_dates", "DIM_DEP_HOURS": "dim_dep_hours", "DIM_STATIONS": "dim_stations", "DIM_CARRIERS": "dim_carriers",
            "DIM_AIRCRAFTS": "dim_aircraft", "DIM_JUNK": "dim_junk", "FLIGHTS": "star_flights"}
    parts += [f"SELECT 'dw' AS layer, '{n}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, CAST(0 AS BIGINT) AS n_rejected" for n, t in dims.items()]
    return f"WITH {view_sql()}, {ENV_DIMS} " + " UNION ALL ".join(parts)


def rejects_sql() -> str:
    return f"""WITH {view_sql()}
SELECT * FROM (SELECT 'Flights' AS table_name, 'fl_date: not date' AS reason, count(*) AS n_rows FROM rec_flights WHERE fl_date IS NOT NULL AND {DATE.format('fl_date')} IS NULL
UNION ALL SELECT 'Aircrafts', 'icao_type: longer than 20', count(*) FROM rec_aircrafts WHERE icao_type = 'too long'
UNION ALL SELECT 'Weather_Observations', 'visibility: not double', count(*) FROM rec_weather_observations WHERE visibility = 25) q WHERE n_rows > 0"""


def typed_flights_sql() -> str:
    cols = [{"fl_date": f"strftime({DATE.format('fl_date')}, '%Y-%m-%d') AS fl_date", "dep_time": "CAST(dep_time AS VARCHAR) AS dep_time",
             "crs_dep_time": "CAST(crs_dep_time AS VARCHAR) AS crs_dep_time", "taxi_out": "round(taxi_out, 4) AS taxi_out", "air_time": "round(air_time, 4) AS air_time",
             "distance": "round(distance, 4) AS distance", "dep_hour": "CAST(dep_hour AS SMALLINT) AS dep_hour"}.get(c, c) for c in COLUMNS["Flights"]]
    return f"WITH {view_sql()} SELECT {', '.join(cols)} FROM rec_flights WHERE fl_date IS NULL OR {DATE.format('fl_date')} IS NOT NULL"


def dictionary_sql() -> str:
    from dwkit.sources.layers import GLOSSARY

    kinds = {**{c: "int" for c in ["airport_id", "elevation", "year_of_manufacture", "status", "obs_hour", "dep_hour", "mkt_carrier_fl_num", "op_carrier_fl_num", "dep_delay", "cancelled"]},
             **{c: "bigint" for c in ["obs_id", "flight_id", "weather_observation_id"]}, **{c: "timestamp" for c in ["dep_time", "crs_dep_time"]},
             **{c: "double" for c in MEASURES + ["active_weather_status", "latitude", "longitude", "taxi_out", "air_time", "distance"]}}
    parts = []
    for t, cols in COLUMNS.items():
        for c in cols:
            name = c.strip('"')
            text = f"CAST({c} AS VARCHAR)"
            note = GLOSSARY.get(name.upper(), "N/A").replace("'", "''")
            parts.append(f"SELECT '{t}' AS table_name, '{name}' AS column_name, '{kinds.get(name, 'string')}' AS dtype, count(DISTINCT {c}) AS n_unique, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, substr(min({text}), 1, 30) AS sample, '{note}' AS description FROM rec_{t.lower()}")
    return f"WITH {view_sql()} " + " UNION ALL ".join(parts)


TYPE_NAMES = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END"
#: First column of each driver table.
FIRST = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
         "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
         "labels": "doc_id", "conversations": "conv_id"}


def contract_sql() -> str:
    """The driver tables have no nulls; names, types and positions come from the catalogue."""
    counts = " UNION ALL ".join(f"SELECT '{t}' AS t, (SELECT count(*) FROM {t}) AS n_rows, (SELECT count(DISTINCT {k}) FROM {t}) AS n_keys, '{k}' AS k" for t, k in FIRST.items())
    return f"""WITH counts AS ({counts})
SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name, {TYPE_NAMES} AS data_type, FALSE AS has_nulls, column_name = k AS is_key, n_rows, n_keys
FROM information_schema.columns JOIN counts ON table_name = t"""


DRIFT = """SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, 'rows' AS change, CAST((SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS VARCHAR) AS stored,
       CAST((SELECT count(*) FROM orders) AS VARCHAR) AS found
UNION ALL SELECT 'orders', 'o_orderkey', 'keys', CAST((SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey % 2 = 0) AS VARCHAR), CAST((SELECT count(DISTINCT o_orderkey) FROM orders) AS VARCHAR)
UNION ALL SELECT 'orders', 'o_custkey', 'nulls', 'false', 'true' WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey % 7 = 0)
UNION ALL SELECT 'customer', 'c_custkey', 'type', 'int', 'bigint'
UNION ALL SELECT 'customer', 'c_name', 'column new', NULL, 'string'
UNION ALL SELECT 'customer', column_name, 'position', CAST(ordinal_position - 1 AS VARCHAR), CAST(ordinal_position AS VARCHAR)
  FROM information_schema.columns c WHERE table_name = 'customer' AND ordinal_position > (SELECT ordinal_position FROM information_schema.columns WHERE table_name = 'customer' AND column_name = 'c_name')
UNION ALL SELECT 'nation', column_name, 'column new', NULL, """ + TYPE_NAMES + """ FROM information_schema.columns WHERE table_name = 'nation'"""

_GATED = """gated AS (SELECT * REPLACE (CASE WHEN FLIGHT_ID % 17 <> 0 THEN ORIGIN_STATION_ID END AS ORIGIN_STATION_ID,
  CASE WHEN FLIGHT_ID % 19 <> 0 THEN AIRCRAFT_ID END AS AIRCRAFT_ID) FROM fact)"""
_KEYS = ["FL_DATE_ID", "DEP_HOUR_ID", "ORIGIN_STATION_ID", "DEST_STATION_ID", "MKT_CARRIER_ID", "OP_CARRIER_ID", "AIRCRAFT_ID", "JUNK_ID"]
_WHOLE = " AND ".join(f"{k} IS NOT NULL" for k in _KEYS)
_FAILING = "concat_ws(',', " + ", ".join(f"CASE WHEN {k} IS NULL THEN '{k}' END" for k in _KEYS) + ")"


def gate_sql(select: str) -> str:
    return f"WITH {star_fact()}, {_GATED} {select}"


_PARTS = """fp AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 9 = 0 THEN substr(p_name, 1, 1) || substr(p_name, 3) ELSE p_name END AS p_name, p_type FROM part),
prof AS (SELECT p_brand, p_name, p_type, min(p_partkey) AS k, count(*) AS n FROM fp GROUP BY 1, 2, 3),
jw AS (SELECT a.k AS a, b.k AS b, a.n AS n_a, b.n AS n_b, jaro_winkler_similarity(a.p_name, b.p_name) + jaro_winkler_similarity(a.p_type, b.p_type) AS score
  FROM prof a JOIN prof b ON a.p_brand = b.p_brand AND (a.k < b.k OR (a.k = b.k AND a.n > 1))),
pairs AS (SELECT * FROM jw WHERE score > 1.75)"""


def groupings_sql() -> str:
    cols = {"MONTH": "d.MONTH", "DAY_OF_WEEK": "d.DAY_OF_WEEK", "DEP_HOUR": "h.DEP_HOUR", "TIME_BAND": "h.TIME_BAND", "AIRPORT_CODE": "s.AIRPORT_CODE", "STATE": "s.STATE",
            "AIRLINE": "c.DESCRIPTION", "CANCELLATION_REASON": "f.CANCELLATION_REASON", "WEATHER_DESCRIPTION": "f.WEATHER_DESCRIPTION",
            "VISIBILITY_BUCKET": bucket_sql("f.VISIBILITY", *VIS, zero="0 mi"), "GUST_BUCKET": bucket_sql("f.WIND_GUST", *GUST), "TEMPERATURE_BUCKET": bucket_sql("f.TEMPERATURE", *TEMP),
            "MANUFACTURER": "a.MANUFACTURER", "AGE_BUCKET": bucket_sql("a.AIRCRAFT_AGE", *AGE, closed="<")}
    dep = "coalesce(reason = 'Not Cancelled', FALSE)"
    each = ", ".join(f"struct_pack(g := '{k}', v := CAST({v} AS VARCHAR))" for k, v in cols.items())
    return f"""WITH {ENV_FACT}, long AS (SELECT DEP_DELAY, TAXI_OUT, AIR_TIME, VISIBILITY, reason, x.g, x.v FROM (
  SELECT f.DEP_DELAY, f.TAXI_OUT, f.AIR_TIME, f.VISIBILITY, f.CANCELLATION_REASON AS reason, unnest([{each}]) AS x FROM fact f
  LEFT JOIN dim_fl_dates d ON f.FL_DATE_ID = d.FL_DATE_ID LEFT JOIN dim_dep_hours h ON f.DEP_HOUR_ID = h.DEP_HOUR_ID LEFT JOIN dim_stations s ON f.ORIGIN_STATION_ID = s.STATION_ID
  LEFT JOIN dim_carriers c ON f.MKT_CARRIER_ID = c.CARRIER_ID LEFT JOIN dim_aircraft a ON f.AIRCRAFT_ID = a.AIRCRAFT_ID) t)
SELECT g AS grouping, v AS value, count(*) AS n_flights, round(count(*) FILTER (WHERE DEP_DELAY >= 15) / count(*), 4) AS dep_delay_rate,
  round(count(*) FILTER (WHERE NOT {dep}) / count(*), 4) AS cancellation_rate, round(avg(CASE WHEN {dep} THEN DEP_DELAY END), 4) AS avg_dep_delay_departed,
  round(avg(CASE WHEN {dep} THEN TAXI_OUT END), 4) AS avg_taxi_out_departed, round(avg(CASE WHEN {dep} THEN AIR_TIME END), 4) AS avg_air_time_departed,
  round(count(*) FILTER (WHERE VISIBILITY > 0 AND VISIBILITY <= 3) / count(*), 4) AS low_visibility_rate FROM long GROUP BY 1, 2 HAVING count(*) >= 5"""


def dimension_constraints_sql() -> str:
    required = {"DIM_FL_DATES": ("dim_fl_dates", ["FL_DATE_ID", "FL_DATE"]), "DIM_DEP_HOURS": ("dim_dep_hours", ["DEP_HOUR_ID"]),
                "DIM_STATIONS": ("dim_stations", ["STATION_ID", "AIRPORT_CODE"]), "DIM_CARRIERS": ("dim_carriers", ["CARRIER_ID", "DESCRIPTION"]),
                "DIM_JUNK": ("dim_junk", ["JUNK_ID"]), "DIM_AIRCRAFTS": ("dim_aircraft", ["AIRCRAFT_ID", "TAIL_NUM"])}
    parts = []
    for t, (src, cols) in required.items():
        parts.append(f"SELECT '{t}' AS table_name, 'PRIMARY KEY' AS constraint_type, '{cols[0]}' AS column_name, coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {src} GROUP BY {cols[0]}) g WHERE n > 1), 0) AS violations")
        parts += [f"SELECT '{t}', 'NOT NULL', '{c}', (SELECT count(*) FROM {src} WHERE {c} IS NULL)" for c in cols]
    return f"WITH {star_dims()} SELECT table_name, constraint_type, column_name, CAST(violations AS BIGINT) AS violations FROM (" + " UNION ALL ".join(parts) + ") q"


SQL = {f"RUN_clean_{t.lower()}": clean_table_sql(t) for t in COLUMNS if t not in ("Active_Weather", "Cancellation")}
SQL |= {f"RUN_clean_{t.lower()}_interpolated": clean_table_sql(t, False) for t in ("Weather_Observations", "Flights")}
SQL |= {"RUN_counts": counts_sql(), "RUN_audit": audit_sql(), "RUN_audit_interpolated": audit_sql(False), "RUN_dropped_rows": dropped_sql(),
        "RUN_comparison": comparison_sql(),
        "RUN_validation": validation_sql(), "D10_D11_rule_registry": registry_sql(),
        "A1_typed_layers": layers_sql(), "A1_typed_rejects": rejects_sql(), "A1_typed_flights": typed_flights_sql(),
        "A1_typed_aircrafts": f"WITH {view_sql()} SELECT {', '.join(COLUMNS['Aircrafts'])} FROM rec_aircrafts WHERE icao_type <> 'too long'",
        "D13_data_dictionary": dictionary_sql(), "B2_parse_date_forms": "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events",
        "H1_contract_columns": contract_sql(), "H1_contract_drift": DRIFT,
        "D33_gate_loaded": gate_sql(f"SELECT FLIGHT_ID, {', '.join(_KEYS)}, round(DEP_DELAY, 4) AS DEP_DELAY FROM gated WHERE {_WHOLE}"),
        "D33_gate_quarantined": gate_sql(f"SELECT FLIGHT_ID, {_FAILING} AS FAILING_KEYS FROM gated WHERE NOT ({_WHOLE})"),
        "D33_gate_counters": gate_sql("SELECT 'rows' AS counter, count(*) AS n FROM gated UNION ALL SELECT 'loaded', count(*) FROM gated WHERE " + _WHOLE
                                      + "".join(f" UNION ALL SELECT '{k}', count(*) FILTER (WHERE {k} IS NULL) FROM gated" for k in _KEYS)),
        "D33_unknown_member": gate_sql("""SELECT STATE, count(*) AS n_flights FROM fact LEFT JOIN dim_stations
            ON CASE WHEN FLIGHT_ID % 17 <> 0 THEN ORIGIN_STATION_ID END = STATION_ID GROUP BY STATE"""),
        "C11_profile_pairs": f"WITH {_PARTS} SELECT least(a, b) AS p_partkey_1, greatest(a, b) AS p_partkey_2, n_a AS n_1, n_b AS n_2, round(score, 4) AS \"Score\" FROM pairs",
        "C11_membership": f"""WITH {_PARTS} SELECT fp.p_partkey, prof.k AS profile FROM fp JOIN prof USING (p_brand, p_name, p_type)
            WHERE prof.k IN (SELECT a FROM pairs UNION SELECT b FROM pairs)""",
        "D25_apply_mapping": f"""WITH {EVENTS_DIRTY} SELECT CASE WHEN lower(trim(event_type)) <> 'error' THEN lower(trim(event_type)) ELSE event_type END AS event_type, count(*) AS n_rows
            FROM events_dirty GROUP BY 1""",
        "D37_dashboard_groupings": groupings_sql(), "H4_dimension_constraints": dimension_constraints_sql()}
