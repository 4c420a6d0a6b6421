"""KPI and roll-up queries over the star.

Measures are a catalogue of ``Column`` builders with their additivity, so a
roll-up can refuse a SUM over a non-additive measure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_departed
from .star import small_side


def star_analytic(fact: DataFrame, stations: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact left-joined with the origin station (state) and the date (month).

    Both dimensions are small relative to the fact: the join is a broadcast
    hash join when the estimate allows, else AQE decides at run time.
    """
    st = stations.select(F.col("STATION_ID").alias("ORIGIN_STATION_ID"), F.col("STATE").alias("ORIGIN_STATE"))
    dt = dates.select("FL_DATE_ID", "MONTH")
    return (fact.join(small_side(st), "ORIGIN_STATION_ID", "left")
                .join(small_side(dt, bounded=True), "FL_DATE_ID", "left"))


def delay_by_state_month(analytic: DataFrame) -> DataFrame:
    """Average delay and distance and flight count per origin state and month.

    Rows with a null state or month are dropped (pandas ``groupby`` default).
    Flights are counted as rows (FLIGHT_ID is never null), so the fact may
    be passed without its ids.
    Partial aggregation runs before the shuffle, so the shuffle carries one
    row per (state, month) per task, whatever the skew of a state.
    """
    return (analytic.where(F.col("ORIGIN_STATE").isNotNull() & F.col("MONTH").isNotNull())
                    .groupBy("ORIGIN_STATE", "MONTH")
                    .agg(F.avg("DEP_DELAY").alias("avg_dep_delay"), F.avg("DISTANCE").alias("avg_distance"),
                         F.count(F.lit(1)).alias("n_flights"))
                    .orderBy("ORIGIN_STATE", "MONTH"))


def top_states(by_month: DataFrame, n: int = 10, weighted: bool = False) -> DataFrame:
    """states by mean of monthly mean delay (or flight-weighted), top n."""
    if weighted:
        avg = (F.sum(F.col("avg_dep_delay") * F.col("n_flights")) / F.sum("n_flights")).alias("avg_dep_delay")
    else:
        avg = F.avg("avg_dep_delay").alias("avg_dep_delay")
    return (by_month.groupBy("ORIGIN_STATE").agg(avg, F.sum("n_flights").alias("n_flights"))
                    .orderBy(F.col("avg_dep_delay").desc(), F.col("ORIGIN_STATE")).limit(n))


# ------------------------------------------------------------------ measures

@dataclass(frozen=True)
class Measure:
    name: str
    expr: Column
    additivity: str = "additive"          # additive | semi-additive | non-additive
    valid_aggs: tuple = field(default=("SUM", "AVG", "MIN", "MAX"))


def measure_catalogue(low_vis_hi: float = 3.0) -> list[Measure]:
    """The 12 glossary KPIs over the fact (column names upper case).

    delay_rate is kept twice: ``> 15`` (glossary) and ``>= 15`` (dashboards).
    """
    dep = F.col("DEP_DELAY")
    vis = F.col("VISIBILITY")
    departed = is_departed(F.col("CANCELLATION_REASON"))
    return [
        Measure("number_of_flights", F.count(F.lit(1)), "additive", ("SUM",)),
        Measure("avg_delay", F.avg(dep), "additive", ("SUM", "AVG", "MIN", "MAX", "RATIO")),
        Measure("delay_rate_gt15", F.avg(F.when(dep.isNotNull(), (dep > 15).cast("double"))), "non-additive", ("RATIO",)),
        Measure("delay_rate_ge15", F.avg(F.when(dep.isNotNull(), (dep >= 15).cast("double"))), "non-additive", ("RATIO",)),
        Measure("cancellation_rate", F.avg((~departed).cast("double")), "non-additive", ("RATIO",)),
        Measure("avg_taxi_out", F.avg("TAXI_OUT"), "semi-additive", ("AVG", "MIN", "MAX")),
        Measure("avg_air_time", F.avg("AIR_TIME"), "semi-additive", ("AVG", "MIN", "MAX")),
        Measure("avg_distance", F.avg("DISTANCE"), "semi-additive", ("AVG", "MIN", "MAX")),
        Measure("avg_wind_spd", F.avg("WIND_SPD"), "non-additive", ("AVG", "MAX")),
        Measure("avg_visibility", F.avg(vis), "non-additive", ("RATIO", "AVG")),
        Measure("low_visibility_rate", F.avg(F.when(vis.isNotNull(), ((vis > 0) & (vis <= low_vis_hi)).cast("double"))),
                "non-additive", ("RATIO",)),
        Measure("min_temperature", F.min("TEMPERATURE"), "non-additive", ("AVG", "MIN", "MAX")),
        Measure("avg_cloud_cover", F.avg("CLOUD_COVER"), "non-additive", ("AVG", "MAX")),
    ]


def kpis(df: DataFrame, group_cols: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Evaluate catalogue measures whose inputs exist, grouped or global."""
    cols = set(df.columns)
    needed = {"avg_wind_spd": "WIND_SPD", "avg_visibility": "VISIBILITY", "low_visibility_rate": "VISIBILITY",
              "min_temperature": "TEMPERATURE", "avg_cloud_cover": "CLOUD_COVER", "avg_taxi_out": "TAXI_OUT",
              "avg_air_time": "AIR_TIME", "avg_distance": "DISTANCE", "cancellation_rate": "CANCELLATION_REASON"}
    ms = [m for m in measure_catalogue() if (names is None or m.name in names)
          and needed.get(m.name, "DEP_DELAY") in cols]
    aggs = [m.expr.alias(m.name) for m in ms]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def dashboard_rates(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """COUNTD(IF ...)/COUNTD rates and departed-only averages.

    FLIGHT_ID is unique, so a distinct count of ids equals a conditional row
    count: ``count_if`` keeps the aggregate a plain partial/final sum instead
    of a distinct (re-shuffled) aggregate.
    """
    dep = F.col("DEP_DELAY")
    departed = is_departed(F.col("CANCELLATION_REASON"))
    n = F.count(F.lit(1))  # FLIGHT_ID is unique and never null
    aggs = [
        n.alias("n_flights"),
        (F.count_if(dep >= 15) / n).alias("dep_delay_rate"),
        (F.count_if(~departed) / n).alias("cancellation_rate"),
        F.avg(F.when(departed, dep)).alias("avg_dep_delay_departed"),
        F.avg(F.when(departed, F.col("TAXI_OUT"))).alias("avg_taxi_out_departed"),
        F.avg(F.when(departed, F.col("AIR_TIME"))).alias("avg_air_time_departed"),
    ]
    if "VISIBILITY" in df.columns:
        vis = F.col("VISIBILITY")
        aggs.append((F.count_if((vis > 0) & (vis <= 3)) / n).alias("low_visibility_rate"))
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def high_volume_groups(df: DataFrame, group_cols: Sequence[str], min_flights: int) -> DataFrame:
    """Flights and average delay per group, keeping groups with >= n flights."""
    return (df.groupBy(*group_cols)
              .agg(F.count(F.lit(1)).alias("n_flights"), F.avg("DEP_DELAY").alias("avg_dep_delay"))
              .where(F.col("n_flights") >= min_flights))


#: Groupings of the dashboards on when and where, and on why.
DASHBOARD_GROUPINGS = ["MONTH", "DAY_OF_WEEK", "DEP_HOUR", "TIME_BAND", "AIRPORT_CODE", "STATE", "AIRLINE", "CANCELLATION_REASON", "WEATHER_DESCRIPTION",
                       "VISIBILITY_BUCKET", "GUST_BUCKET", "TEMPERATURE_BUCKET", "MANUFACTURER", "AGE_BUCKET"]


def dashboard_groupings(df: DataFrame, dims: Sequence[str], min_flights: int = 1) -> DataFrame:
    """The rates of D36 by every one of ``dims``, (grouping, value, rates...), keeping values with enough flights.

    All groupings share one pass: a flight becomes one (grouping, value) row for each, and tasks send one row a value.
    """
    narrow = ["DEP_DELAY", "TAXI_OUT", "AIR_TIME", "CANCELLATION_REASON"] + (["VISIBILITY"] if "VISIBILITY" in df.columns else [])
    each = F.array(*[F.struct(F.lit(d).alias("grouping"), F.col(d).cast("string").alias("value")) for d in dims if d in df.columns])
    long = df.select(*narrow, F.explode(each).alias("_g")).select(*narrow, "_g.grouping", "_g.value")
    return dashboard_rates(long, ["grouping", "value"]).where(F.col("n_flights") >= min_flights)


def rollup(df: DataFrame, levels: Sequence[str], measures: dict[str, tuple[str, str]],
           catalogue: dict[str, str] | None = None) -> DataFrame:
    """Aggregate along a hierarchy (``ROLLUP``) with the grouping level.

    ``measures`` maps output name -> (column, aggregate).  A SUM over a
    measure marked non-additive or semi-additive in ``catalogue`` raises.
    """
    catalogue = catalogue or {}
    aggs = []
    for out, (col, how) in measures.items():
        kind = catalogue.get(col.lower(), "additive")
        if how.upper() == "SUM" and kind != "additive":
            raise ValueError(f"SUM is not valid for {kind} measure {col}")
        fn = {"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "COUNT": F.count}[how.upper()]
        aggs.append(fn(col).alias(out))
    return df.rollup(*levels).agg(F.grouping_id().alias("grouping_level"), *aggs)


# Additivity of the measures (fixed values from the model).
MEASURE_ADDITIVITY = {
    "dep_delay": "additive", "taxi_out": "semi-additive", "air_time": "semi-additive", "distance": "semi-additive",
    "wind_spd": "non-additive", "wind_gust": "non-additive", "cloud_cover": "non-additive",
    "temperature": "non-additive", "visibility": "non-additive",
}
