"""Bindings of the warehouse roles to the driver tables.

The driver tables are clean (no nulls, no broken keys), so the operators are
exercised on "dirty" views that inject nulls, casing, blanks, broken keys,
bad dates and outliers by key arithmetic.  Every view reads its whole source
table; the arithmetic only decides *which* value a row carries.

Roles
-----
flights (hour grain)   events_dirty
weather observations   obs / obs_dirty (events grouped by type, date, hour)
stations               nation join region (state = region)
carriers               supplier
aircraft               part (brand = manufacturer, 1950 + size = year)
flights (star grain)   lineitem join orders join customer join supplier
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import with_dense_id, with_dense_id_by_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights-like fact at hour grain with injected dirt."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid,
        F.col("ts"),
        (F.col("user_id") + F.when(eid % 31 == 0, F.lit(100000)).otherwise(F.lit(0))).alias("user_id"),
        F.when(eid % 5 == 0, F.concat(F.lit("  "), F.upper("event_type")))
         .when(eid % 7 == 0, F.concat(F.col("event_type"), F.lit(" ")))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.when(eid % 53 == 0, F.lit("not-a-date"))
         .otherwise(F.col("ts").cast("date").cast("string")).alias("event_date"),
        F.hour("ts").cast("int").alias("event_hour"),
        F.when(eid % 17 == 0, F.lit(None).cast("double"))
         .when(eid % 97 == 0, F.col("value") * 100)
         .when(eid % 101 == 0, -F.col("value"))
         .otherwise(F.col("value")).alias("value"),
        F.when(eid % 43 == 0, F.lit(None).cast("int")).otherwise((eid % 5).cast("int")).alias("status"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly observation per station: events aggregated to (type, date, hour)."""
    e = table(spark, sf_dir, "events")
    g = (e.groupBy(F.col("event_type").alias("station"), F.col("ts").cast("date").alias("obs_date"),
                   F.hour("ts").cast("int").alias("obs_hour"))
          .agg(F.avg("value").alias("spd"), F.max("value").alias("gust"), F.min("value").alias("low"),
               F.count(F.lit(1)).alias("n")))
    return with_dense_id(g, ["station", "obs_date", "obs_hour"], "obs_id")


def obs_dirty(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    o = base if base is not None else obs(spark, sf_dir)
    oid = F.col("obs_id")
    gone = oid % 13 == 0
    return o.select(
        "obs_id", "station", "obs_date", "obs_hour", "n",
        F.when(gone, F.lit(None).cast("double")).otherwise(F.col("spd")).alias("spd"),
        F.when(gone | (oid % 11 == 0), F.lit(None).cast("double"))
         .when(oid % 19 == 0, F.col("spd") / 2).otherwise(F.col("gust")).alias("gust"),
        F.when(gone, F.lit(None).cast("double"))
         .when(oid % 23 == 0, F.col("gust") + 1).otherwise(F.col("low")).alias("low"),
    )


def nation_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        "n_nationkey", "n_regionkey",
        F.when(k % 4 == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(", R."),
                                    F.col("n_regionkey").cast("string")))
         .otherwise(F.col("n_name")).alias("n_name"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-like table: nation (dirty names) with its region as the state."""
    n = nation_dirty(spark, sf_dir)
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("n_nationkey").alias("airport"),
                     F.col("n_name").alias("display_airport_name"),
                     F.col("n_name").alias("display_airport_city_name_full"),
                     F.col("r_name").alias("airport_state_name"),
                     F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("airport_state_code"),
                     F.col("n_nationkey").cast("double").alias("latitude"),
                     F.col("n_regionkey").cast("double").alias("longitude")))


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("description"))


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("tail_num"), F.col("p_brand").alias("manufacturer"),
                    (F.lit(1950) + F.col("p_size")).cast("int").alias("year_of_manufacture"))


# Columns of lineitem in a fixed order: together they are unique, so they give
# every "row order" step (dense flight ids) a total order.
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _line_item_keys() -> list:
    """Flight attributes that come from the line item alone (date, hour, junk pair)."""
    flag = F.col("l_returnflag")
    return [
        F.col("l_shipdate").cast("date").alias("fl_date"),
        (F.col("l_orderkey") % 24).cast("int").alias("dep_hour"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0, F.lit(None).cast("string"))
         .when(flag == "N", F.lit("Not Cancelled")).otherwise(flag).alias("cancellation_reason"),
        F.col("l_linestatus").alias("weather_description"),
    ]


def star_flight_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights' date, hour and junk pair without the widening joins: line items
    that have an order (a semi-join), i.e. the flights' row set.  Enough for the
    date, hour, junk and aircraft-age dimensions."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left_semi").select(*_line_item_keys())


def star_flights(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """Flights at star grain: one line item = one flight.

    ``with_seq=True`` adds ``flight_seq``: dense 1..n over the flights in
    ``LINEITEM_ORDER``, assigned on the line items that have an order (the flights' row
    set) in the shuffle by order key that their join with the orders needs anyway.
    Orders find their customer's nation before the line items do, so line items are
    shuffled once.

    origin = customer nation, dest = supplier nation, carrier = supplier,
    aircraft = part, date = ship date, hour from the order key, cancellation
    reason from the return flag ('N' = "Not Cancelled", every 10th null),
    weather description from the line status.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if with_seq:
        li = with_dense_id_by_key(li, o.select("o_orderkey"), LINEITEM_ORDER, "flight_seq")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = o.join(c, F.col("o_custkey") == c.c_custkey, "left").select("o_orderkey", "c_nationkey")
    j = (li.join(placed, li.l_orderkey == placed.o_orderkey, "inner")
           .join(s, li.l_suppkey == s.s_suppkey, "left"))
    return j.select(
        *(["flight_seq"] if with_seq else []),
        *LINEITEM_ORDER,
        *_line_item_keys(),
        F.col("c_nationkey").alias("origin"),
        F.col("s_nationkey").alias("dest"),
        F.col("l_suppkey").alias("mkt_unique_carrier"),
        F.col("l_suppkey").alias("op_unique_carrier"),
        F.col("l_partkey").alias("tail_num"),
        F.col("l_quantity").alias("dep_delay"),
        (F.col("l_discount") * 100).alias("taxi_out"),
        (F.col("l_tax") * 100).alias("air_time"),
        F.col("l_extendedprice").alias("distance"),
    )


# Observation of a flight in the environment binding: a fixed hash of its key over this many ids.
OBSERVATION_SPAN = 5000


def _environment_measures(spark: SparkSession, sf_dir: str, flights: DataFrame, measures: list[str]) -> DataFrame:
    """Flights (with ``l_orderkey`` and ``l_linenumber``) with the measures and the weather text of their observation."""
    from ..operators.star import chained_measures

    o = obs(spark, sf_dir).select(
        "obs_id", F.col("spd").alias("wind_spd"), F.col("gust").alias("wind_gust"), (F.col("low") / 10).alias("visibility"),
        (F.col("spd") - 20).alias("temperature"), (F.col("n") % 5).cast("double").alias("cloud_cover"), (F.col("n") % 4).alias("status"))
    status = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("status"), F.col("r_name").alias("weather_description"))
    flights = flights.drop("weather_description")
    flights = flights.withColumn("weather_observation_id", (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % OBSERVATION_SPAN + 1)
    linked = chained_measures(flights, o, "weather_observation_id", "obs_id", measures, "status", status)
    return linked.withColumnRenamed("_weather_desc", "weather_description")


def environment_flights(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """``star_flights`` linked to an observation by key arithmetic; the five environment measures
    and the weather text come through the chain flight -> observation -> status (C7)."""
    return _environment_measures(spark, sf_dir, star_flights(spark, sf_dir, with_seq),
                                 ["wind_spd", "wind_gust", "visibility", "temperature", "cloud_cover"])


def environment_flight_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date, hour and junk pair of ``environment_flights``: as ``star_flight_keys``, with the weather text of the observation."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    keys = li.join(o, li.l_orderkey == o.o_orderkey, "left_semi").select("l_orderkey", "l_linenumber", *_line_item_keys())
    return _environment_measures(spark, sf_dir, keys, [])
