"""Warehouse build: dimensions, surrogate-key lookups and the fact.

Each dimension is one lazy plan; ids are dense 1..n in the natural-key order
(``with_dense_id``).  Dimensions whose size is fixed by a domain (dates, hours,
flag pairs) are broadcast explicitly; the others are broadcast only when the
optimizer's size estimate is under the threshold, otherwise the join is left
to AQE (which still converts it at run time when the real size is small).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.exprs import clean_city, standardize_string, time_band
from ..session import materialize
from .holidays import is_holiday_flag
from .windows import deduplicate, with_dense_id

def small_side(df: DataFrame, bounded: bool = False) -> DataFrame:
    """Broadcast hint for a side whose size is bounded by its value domain; any other side is left to the
    session's broadcast threshold and adaptive execution."""
    return F.broadcast(df) if bounded else df


def _ts(load_ts) -> Column:
    return F.lit(load_ts).cast("timestamp_ntz") if load_ts is not None else F.localtimestamp().cast("timestamp_ntz")


# ------------------------------------------------------------------ dimensions

def build_fl_dates(flights: DataFrame, date_col: str = "fl_date", load_ts=None) -> DataFrame:
    """K1: distinct valid dates with day name, holiday flag, month, quarter, year."""
    d = (flights.select(F.col(date_col).cast("date").alias("FL_DATE"))
                .where(F.col("FL_DATE").isNotNull()).distinct())
    d = is_holiday_flag(d, "FL_DATE", "IS_HOLIDAY")
    d = d.select("FL_DATE", F.date_format("FL_DATE", "EEEE").alias("DAY_OF_WEEK"), "IS_HOLIDAY",
                 F.month("FL_DATE").cast("short").alias("MONTH"),
                 F.quarter("FL_DATE").cast("short").alias("QUARTER"),
                 F.year("FL_DATE").cast("short").alias("YEAR"),
                 _ts(load_ts).alias("LOAD_TIMESTAMP"))
    return with_dense_id(d, ["FL_DATE"], "FL_DATE_ID", bounded=True)


def build_dep_hours(flights: DataFrame, hour_col: str = "dep_hour", load_ts=None) -> DataFrame:
    """K2: distinct hours with their time band."""
    h = (flights.select(F.col(hour_col).cast("int").alias("DEP_HOUR"))
                .where(F.col("DEP_HOUR").isNotNull()).distinct())
    h = h.select("DEP_HOUR", time_band("DEP_HOUR").alias("TIME_BAND"), _ts(load_ts).alias("LOAD_TIMESTAMP"))
    return with_dense_id(h, ["DEP_HOUR"], "DEP_HOUR_ID", bounded=True)


def build_stations(stations: DataFrame, load_ts=None, clean_names: bool = True) -> DataFrame:
    """K3: stations with the state suffix cut from the city; first row per airport."""
    city = F.col("display_airport_city_name_full")
    name = F.col("display_airport_name")
    if clean_names:
        city = standardize_string(city, title=True)
        name = standardize_string(name, title=True)
    has_code = "airport_state_code" in stations.columns
    city = clean_city(city, F.col("airport_state_name"), F.col("airport_state_code") if has_code else None)
    s = stations.select(F.col("airport").alias("AIRPORT_CODE"), name.alias("AIRPORT_NAME"), city.alias("CITY"),
                        F.col("airport_state_name").alias("STATE"), F.col("latitude").alias("LATITUDE"),
                        F.col("longitude").alias("LONGITUDE"))
    s = deduplicate(s, ["AIRPORT_CODE"])
    s = s.withColumn("LOAD_TIMESTAMP", _ts(load_ts))
    return with_dense_id(s, ["AIRPORT_CODE"], "STATION_ID")


def build_carriers(carriers: DataFrame, load_ts=None) -> DataFrame:
    """K4: first row per code; CODE is kept for lookups and dropped at the sink."""
    c = deduplicate(carriers.select(F.col("code").alias("CODE"), F.col("description").alias("DESCRIPTION")), ["CODE"])
    c = c.withColumn("LOAD_TIMESTAMP", _ts(load_ts))
    return with_dense_id(c, ["CODE"], "CARRIER_ID")


def reference_year(flights: DataFrame, date_col: str = "fl_date") -> DataFrame:
    """B18 helper: one-row frame with the latest flight year."""
    return flights.agg(F.max(F.year(F.col(date_col))).alias("_dw_ref_year"))


def build_aircraft(aircraft: DataFrame, flights: DataFrame, date_col: str = "fl_date", load_ts=None) -> DataFrame:
    """K5: first row per tail number, manufacturer and age."""
    ref = reference_year(flights, date_col)  # one row: broadcast is bounded
    a = aircraft.select(F.col("tail_num").alias("TAIL_NUM"), F.col("manufacturer").alias("MANUFACTURER"),
                        F.col("year_of_manufacture"))
    a = deduplicate(a, ["TAIL_NUM"])
    a = (a.crossJoin(F.broadcast(ref))
          .select("TAIL_NUM", "MANUFACTURER",
                  (F.col("_dw_ref_year") - F.col("year_of_manufacture")).cast("int").alias("AIRCRAFT_AGE"),
                  _ts(load_ts).alias("LOAD_TIMESTAMP")))
    return with_dense_id(a, ["TAIL_NUM"], "AIRCRAFT_ID")


def build_junk(flights: DataFrame, reason_col: str = "cancellation_reason",
               weather_col: str = "weather_description", load_ts=None) -> DataFrame:
    """K6: distinct (reason, weather) pairs seen in flights, nulls last."""
    j = flights.select(F.col(reason_col).alias("CANCELLATION_REASON"),
                       F.col(weather_col).alias("WEATHER_DESCRIPTION")).distinct()
    j = j.withColumn("LOAD_TIMESTAMP", _ts(load_ts))
    return with_dense_id(j, ["CANCELLATION_REASON", "WEATHER_DESCRIPTION"], "JUNK_ID", bounded=True)


# ------------------------------------------------------------------ lookups

def lookup_key(fact: DataFrame, dim: DataFrame, fact_col, dim_key: str, dim_id: str, out_col: str,
               bounded: bool = False) -> DataFrame:
    """Natural key -> surrogate id (left join, unmatched -> null).

    The lookup side has the same shape for every role of a dimension
    (origin / dest, marketing / operating carrier), so its broadcast exchange
    is built once and reused by each role.
    """
    lk = dim.select(F.col(dim_key).alias("_dw_lk_key"), F.col(dim_id).alias("_dw_lk_id"))
    fc = F.col(fact_col) if isinstance(fact_col, str) else fact_col
    return (fact.join(small_side(lk, bounded=bounded), fc == F.col("_dw_lk_key"), "left")
                .withColumnRenamed("_dw_lk_id", out_col).drop("_dw_lk_key"))


def lookup_junk(fact: DataFrame, junk: DataFrame, reason_col: str = "cancellation_reason",
                weather_col: str = "weather_description", out_col: str = "JUNK_ID") -> DataFrame:
    """Null-safe pair lookup; an unseen pair gets the id of (null, null).

    The size of the pair table is left to Spark's own broadcast decision; the
    fallback id is a one-row frame.
    """
    lk = junk.select(F.col("CANCELLATION_REASON").alias("_dw_r"), F.col("WEATHER_DESCRIPTION").alias("_dw_w"),
                     F.col("JUNK_ID").alias("_dw_jid"))
    fallback = (junk.where(F.col("CANCELLATION_REASON").isNull() & F.col("WEATHER_DESCRIPTION").isNull())
                    .agg(F.min("JUNK_ID").alias("_dw_jfb")))
    cond = F.col(reason_col).eqNullSafe(F.col("_dw_r")) & F.col(weather_col).eqNullSafe(F.col("_dw_w"))
    out = (fact.join(lk, cond, "left")
               .crossJoin(F.broadcast(fallback))
               .withColumn(out_col, F.coalesce(F.col("_dw_jid"), F.col("_dw_jfb")))
               .drop("_dw_r", "_dw_w", "_dw_jid", "_dw_jfb"))
    return out


def chained_measures(flights: DataFrame, weather: DataFrame, fk_col: str, obs_id: str,
                     measures: Sequence[str], status_col: str | None = None,
                     status_lookup: DataFrame | None = None, status_key: str = "status",
                     status_text: str = "weather_description") -> DataFrame:
    """Flight -> observation (shuffle join on the id) -> status text (broadcast)."""
    w = weather.select(F.col(obs_id).alias("_dw_oid"), *[F.col(m) for m in measures],
                       *([F.col(status_col).alias("_dw_status")] if status_col else []))
    out = flights.join(w, F.col(fk_col) == F.col("_dw_oid"), "left").drop("_dw_oid")
    if status_col and status_lookup is not None:
        lk = status_lookup.select(F.col(status_key).alias("_dw_sk"), F.col(status_text).alias("_weather_desc"))
        out = out.join(small_side(lk), F.col("_dw_status") == F.col("_dw_sk"), "left").drop("_dw_sk", "_dw_status")
    return out


# ------------------------------------------------------------------ fact

# The fact's keys and measures.
FK_COLS = ["FL_DATE_ID", "DEP_HOUR_ID", "ORIGIN_STATION_ID", "DEST_STATION_ID", "MKT_CARRIER_ID",
           "OP_CARRIER_ID", "AIRCRAFT_ID", "JUNK_ID"]
ENV_MEASURES = ["wind_spd", "wind_gust", "visibility", "temperature", "cloud_cover"]
PERF_MEASURES = ["dep_delay", "taxi_out", "air_time", "distance"]


def fact_fk_lookups(flights: DataFrame, dims: dict[str, DataFrame], fks: Sequence[str] = FK_COLS) -> DataFrame:
    """C5 + C6: the surrogate keys of a flight (all of them by default), one plan.

    A left join cannot be dropped by the optimizer even when its column is
    unused (it does not know the dimension key is unique), so callers that
    read only some keys pass ``fks``.  The aircraft, whose number grows with the fleet,
    come last, when a row has ids in place of texts: if they are not broadcast, that is
    what the join shuffles.
    """
    lookups = {
        "FL_DATE_ID": lambda f: lookup_key(f, dims["fl_dates"], F.col("fl_date").cast("date"), "FL_DATE",
                                           "FL_DATE_ID", "FL_DATE_ID", bounded=True),
        "DEP_HOUR_ID": lambda f: lookup_key(f, dims["dep_hours"], F.col("dep_hour").cast("int"), "DEP_HOUR",
                                            "DEP_HOUR_ID", "DEP_HOUR_ID", bounded=True),
        "ORIGIN_STATION_ID": lambda f: lookup_key(f, dims["stations"], "origin", "AIRPORT_CODE", "STATION_ID",
                                                  "ORIGIN_STATION_ID"),
        "DEST_STATION_ID": lambda f: lookup_key(f, dims["stations"], "dest", "AIRPORT_CODE", "STATION_ID",
                                                "DEST_STATION_ID"),
        "MKT_CARRIER_ID": lambda f: lookup_key(f, dims["carriers"], "mkt_unique_carrier", "CODE", "CARRIER_ID",
                                               "MKT_CARRIER_ID"),
        "OP_CARRIER_ID": lambda f: lookup_key(f, dims["carriers"], "op_unique_carrier", "CODE", "CARRIER_ID",
                                              "OP_CARRIER_ID"),
        "AIRCRAFT_ID": lambda f: lookup_key(f, dims["aircraft"], "tail_num", "TAIL_NUM", "AIRCRAFT_ID", "AIRCRAFT_ID"),
        "JUNK_ID": lambda f: lookup_junk(f, dims["junk"]),
    }
    f = flights
    for k in sorted(FK_COLS, key=lambda k: k == "AIRCRAFT_ID"):
        if k in fks:
            f = lookups[k](f)
    return f


def build_fact(flights: DataFrame, dims: dict[str, DataFrame], order_cols: Sequence[str], load_ts=None,
               measures: Sequence[str] | None = None, with_ids: bool = True, seq_col: str | None = None,
               fks: Sequence[str] = FK_COLS) -> DataFrame:
    """K7: 8 foreign keys + measures + dense FLIGHT_ID + load timestamp.

    ``with_ids=False`` returns the lazy fact without FLIGHT_ID: queries that
    never read the id (KPIs count rows) then skip the global sort the id
    needs, and Catalyst prunes the lookups they do not use.  ``seq_col`` names
    a dense sequence the flights already carry (assigned at the source, where
    the order is defined); it becomes FLIGHT_ID without another sort.
    ``fks`` limits the lookups to the keys a query reads (the written fact
    always has all eight).
    """
    keys = [k for k in FK_COLS if k in fks]
    f = fact_fk_lookups(flights, dims, keys)
    ms = [m for m in (measures or ENV_MEASURES + PERF_MEASURES) if m in flights.columns]
    f = f.select(*([seq_col] if seq_col else []), *order_cols, *keys, *[F.col(m).alias(m.upper()) for m in ms])
    if not with_ids:
        return f.select(*keys, *[m.upper() for m in ms], _ts(load_ts).alias("LOAD_TIMESTAMP"))
    if seq_col is not None:
        f = f.withColumn("FLIGHT_ID", F.col(seq_col).cast("long")) if seq_col != "FLIGHT_ID" else f
    else:
        f = with_dense_id(f, list(order_cols), "FLIGHT_ID")
    return f.select("FLIGHT_ID", *keys, *[m.upper() for m in ms], _ts(load_ts).alias("LOAD_TIMESTAMP"))


def flight_key_summary(flights: DataFrame, groups: Sequence[Sequence[str]]) -> dict[tuple[str, ...], DataFrame]:
    """One pass over the flights for every small dimension: the distinct values of each group of columns, by its columns.

    A group's size is bounded by the calendar or the flag domains, not by the number of flights.  Their combinations are many
    (in a task half as many as its flights), so the groups are counted side by side.  They are written so that the
    dimensions built from them do not re-read the flights."""
    kinds = {"fl_date": "date", "dep_hour": "int"}
    groups = list(dict.fromkeys(map(tuple, groups)))
    columns = sorted({c for g in groups for c in g})
    narrow = flights.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in columns])
    found = narrow.groupingSets([[F.col(c) for c in g] for g in groups], *columns).agg(F.grouping_id().alias("_dw_group"), F.count(F.lit(1)).alias("count"))
    keys = materialize(found, "flight-keys")
    absent = {g: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in g) for g in groups}  # grouping_id: a bit per column left out
    return {g: keys.where(F.col("_dw_group") == absent[g]).select(*g, "count") for g in groups}


# The dimension of each foreign key, and the flight columns that a dimension is read from.
DIM_OF_KEY = {"FL_DATE_ID": "fl_dates", "DEP_HOUR_ID": "dep_hours", "ORIGIN_STATION_ID": "stations", "DEST_STATION_ID": "stations",
              "MKT_CARRIER_ID": "carriers", "OP_CARRIER_ID": "carriers", "AIRCRAFT_ID": "aircraft", "JUNK_ID": "junk"}
FLIGHT_COLUMNS = {"fl_dates": ["fl_date"], "dep_hours": ["dep_hour"], "aircraft": ["fl_date"],
                  "junk": ["cancellation_reason", "weather_description"]}


def build_warehouse(flights: DataFrame, stations: DataFrame, carriers: DataFrame, aircraft: DataFrame,
                    order_cols: Sequence[str], load_ts=None, fact_ids: bool = True,
                    seq_col: str | None = None, key_source: DataFrame | None = None,
                    fks: Sequence[str] = FK_COLS, also: Sequence[str] = ()) -> dict[str, DataFrame]:
    """K1-K7: the small dimensions come from one summary pass, the fact from one more.

    Only the dimensions that ``fks`` look up (and those named in ``also``) are built, and the summary
    pass reads only their columns.  ``key_source`` may be a narrower frame with the flights'
    rows and their date, hour and junk columns (no lookups needed for those), so the
    summary pass skips the joins that only the fact needs.
    """
    wanted = {DIM_OF_KEY[k] for k in fks} | set(also)
    columns = {d: tuple(FLIGHT_COLUMNS[d]) for d in sorted(wanted & set(FLIGHT_COLUMNS))}
    alone = {  # the other dimensions read the summary of the flights' keys
        "stations": lambda: build_stations(stations, load_ts=load_ts),
        "carriers": lambda: build_carriers(carriers, load_ts=load_ts),
    }
    after = {
        "fl_dates": lambda keys: build_fl_dates(keys, load_ts=load_ts),
        "dep_hours": lambda keys: build_dep_hours(keys, load_ts=load_ts),
        "aircraft": lambda keys: build_aircraft(aircraft, keys, load_ts=load_ts),
        "junk": lambda keys: build_junk(keys, load_ts=load_ts),
    }
    # dimensions are written while they get their ids: independent ones side by side
    with ThreadPoolExecutor(max_workers=len(alone) + 1) as pool:
        summary = pool.submit(flight_key_summary, key_source if key_source is not None else flights, list(columns.values())) if columns else None
        made = {name: pool.submit(make) for name, make in alone.items() if name in wanted}
        keys = summary.result() if summary else None
        dims = {name: make(keys[columns[name]]) for name, make in after.items() if name in wanted} | {name: f.result() for name, f in made.items()}
    fact = build_fact(flights, dims, order_cols, load_ts=load_ts, with_ids=fact_ids, seq_col=seq_col, fks=fks)
    return {**dims, "fact": fact}


def fk_completeness(fact: DataFrame, fk_cols: Sequence[str] = FK_COLS, on_fail: str = "report") -> DataFrame:
    """Null count per foreign key in one aggregate.

    ``on_fail="raise"`` raises ValueError when any key is null (the reference
    gate); ``"report"`` only returns the counts.
    """
    agg = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fk_cols], F.count(F.lit(1)).alias("_n"))
    long = agg.select(F.col("_n").alias("n_rows"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("fk_column"), F.col(c).alias("null_count")) for c in fk_cols])).alias("s"))
    out = long.select("s.fk_column", "s.null_count", "n_rows",
                      F.when(F.col("s.null_count") == 0, "OK").otherwise("FAIL").alias("status"))
    if on_fail == "raise":
        gaps = {r["fk_column"]: r["null_count"] for r in out.collect() if r["null_count"]}
        if gaps:
            raise ValueError(f"foreign keys without a dimension row: {gaps}")
    return out


def quarantine(fact: DataFrame, fk_cols: Sequence[str] = FK_COLS) -> tuple[DataFrame, DataFrame]:
    """D33 option: (rows whose keys all have a dimension row, the others)."""
    whole = F.lit(True)
    for c in fk_cols:
        whole = whole & F.col(c).isNotNull()
    return fact.where(whole), fact.where(~whole)


def with_unknown_member(fact: DataFrame, fk_cols: Sequence[str] = FK_COLS, member: int = -1) -> DataFrame:
    """D33 option: null keys point at the unknown member's id."""
    return fact.withColumns({c: F.coalesce(F.col(c), F.lit(member).cast("long")) for c in fk_cols})


@dataclass(frozen=True)
class Gate:
    """Both outputs of ``load_gate`` and its counters (rows, loaded, and null rows of each key)."""
    loaded: DataFrame
    quarantined: DataFrame
    counters: dict[str, int]


def load_gate(fact: DataFrame, path: str, fk_cols: Sequence[str] = FK_COLS) -> Gate:
    """One pass writes every row of the fact once, loadable rows and quarantined rows (with the names of
    their failing keys) side by side; the counters are observed while the rows are written."""
    failing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in fk_cols]))
    judged = fact.withColumn("FAILING_KEYS", failing).withColumn("loadable", (F.size("FAILING_KEYS") == 0).cast("int"))
    seen = Observation()
    judged = judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("loadable"), F.lit(0)).alias("loaded"),
                            *[F.count_if(F.col(c).isNull()).alias(c) for c in fk_cols])
    judged.write.mode("overwrite").partitionBy("loadable").parquet(path)
    back = fact.sparkSession.read.schema(judged.schema).parquet(path)
    return Gate(back.where("loadable = 1").drop("loadable", "FAILING_KEYS"), back.where("loadable = 0").drop("loadable"), dict(seen.get))


def with_unknown_row(dim: DataFrame, id_col: str, member: int = -1) -> DataFrame:
    """D33 option: the dimension with its unknown member, all attributes null, which ``with_unknown_member`` points at."""
    blank = dim.sparkSession.range(1).select(*[(F.lit(member) if c == id_col else F.lit(None)).cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    return dim.unionByName(blank)
