"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator ID.

The callables bind the library operators to the driver tables
(``sources.bindings``).  Results go through ``portable`` so that doubles are
rounded to 4 places and dates/timestamps are text, the form the DuckDB
oracle produces too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import kpi, star
from ..sources import bindings as B

LOAD_TS = "2024-02-01 00:00:00"
DIGITS = 4  # places of a double in a result
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, T.DoubleType) and f.metadata.get("digits", DIGITS + 1) <= DIGITS:
            pass  # its operator has rounded it, where there were fewer rows
        elif isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), DIGITS)
        elif isinstance(dt, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("timestamp_ntz").cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(key: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return deco


# ------------------------------------------------------------------ star (K, C5, C6, C9, D34, F1)

def _star(spark: SparkSession, sf_dir: str, fact_ids: bool = True, fks=star.FK_COLS) -> dict[str, DataFrame]:
    flights = B.star_flights(spark, sf_dir, with_seq=fact_ids)
    return star.build_warehouse(flights, B.stations(spark, sf_dir), B.carriers(spark, sf_dir),
                                B.aircraft(spark, sf_dir), B.LINEITEM_ORDER, load_ts=LOAD_TS, fact_ids=fact_ids,
                                seq_col="flight_seq" if fact_ids else None,
                                key_source=B.star_flight_keys(spark, sf_dir), fks=fks)


@query("K1_build_fl_dates")
def k1(spark, d):
    return star.build_fl_dates(B.star_flights(spark, d), load_ts=LOAD_TS)


@query("K2_build_dep_hours")
def k2(spark, d):
    return star.build_dep_hours(B.star_flights(spark, d), load_ts=LOAD_TS)


@query("K3_build_stations")
def k3(spark, d):
    return star.build_stations(B.stations(spark, d), load_ts=LOAD_TS)


@query("K4_build_carriers")
def k4(spark, d):
    # CODE is kept for lookups but not written (DIM_CARRIERS has no natural key).
    return star.build_carriers(B.carriers(spark, d), load_ts=LOAD_TS).drop("CODE")


@query("K5_build_aircraft")
def k5(spark, d):
    return star.build_aircraft(B.aircraft(spark, d), B.star_flights(spark, d), load_ts=LOAD_TS)


@query("K6_build_junk")
def k6(spark, d):
    return star.build_junk(B.star_flights(spark, d), load_ts=LOAD_TS)


@query("K7_build_fact")
def k7(spark, d):
    return _star(spark, d)["fact"]


@query("K8_holiday_flags")
def k8(spark, d):
    dates = star.build_fl_dates(B.star_flights(spark, d), load_ts=LOAD_TS)
    return dates.where("IS_HOLIDAY").select("FL_DATE", "DAY_OF_WEEK")


@query("C5_surrogate_key_lookup")
def c5(spark, d):
    return _star(spark, d, fks=star.FK_COLS[:-1])["fact"].select("FLIGHT_ID", *star.FK_COLS[:-1])


@query("C6_junk_lookup")
def c6(spark, d):
    return _star(spark, d, fks=["JUNK_ID"])["fact"].select("FLIGHT_ID", "JUNK_ID")


def _analytic(spark, d, fact_ids: bool = True):
    # only the two keys that the analysis reads are looked up, and only their dimensions built
    w = _star(spark, d, fact_ids, fks=["FL_DATE_ID", "ORIGIN_STATION_ID"])
    return kpi.star_analytic(w["fact"], w["stations"], w["fl_dates"])


@query("C9_star_join")
def c9(spark, d):
    return _analytic(spark, d).select("FLIGHT_ID", "ORIGIN_STATE", "MONTH", "DEP_DELAY", "DISTANCE")


@query("D34_delay_by_state_month")
def d34(spark, d):
    return kpi.delay_by_state_month(_analytic(spark, d, fact_ids=False))


@query("F1_top_states")
def f1(spark, d):
    return kpi.top_states(kpi.delay_by_state_month(_analytic(spark, d, fact_ids=False)), 10)


# ------------------------------------------------------------------ data quality

from ..functions import rules as R  # noqa: E402
from ..operators import dqa  # noqa: E402


def _events_scored(spark, d):
    ev = B.events_dirty(spark, d).withColumn("ts_hour", F.hour("ts").cast("int"))
    return ev, R.events_rules(), {"customer": B.table(spark, d, "customer")}


def _dim_query(dim):
    def run(spark, d):
        ev, rules, refs = _events_scored(spark, d)
        return dqa.run_dqa(ev, "events_dirty", rules, refs, dims=[dim]).select("Dimension", "Score", "Issues")
    return run


for _k, _dim in [("D1_completeness", "Completeness"), ("D2_uniqueness", "Uniqueness"), ("D3_validity", "Validity"),
                 ("D4_consistency", "Consistency"), ("D5_timeliness", "Timeliness"), ("D6_accuracy", "Accuracy")]:
    query(_k)(_dim_query(_dim))


@query("D7_scorecard")
def d7(spark, d):
    ev, rules, refs = _events_scored(spark, d)
    return dqa.run_dqa(ev, "events_dirty", rules, refs)


def _scorecards(spark, d):
    ev, rules, refs = _events_scored(spark, d)
    a = dqa.run_dqa(ev, "events_dirty", rules, refs)
    b = dqa.run_dqa(B.obs_dirty(spark, d), "obs_dirty", R.obs_rules())
    return a.unionByName(b)


@query("D8_overall_score")
def d8(spark, d):
    return dqa.overall_score(_scorecards(spark, d))


@query("D9_run_dqa")
def d9(spark, d):
    return _scorecards(spark, d)


@query("G1_union_reports")
def g1(spark, d):
    return _scorecards(spark, d).select("Table", "Dimension", "Score", "Issues", "Status")


@query("D39_scorecard_pivot")
def d39(spark, d):
    return dqa.scorecard_pivot(_scorecards(spark, d))


@query("D10_validity_rules")
def d10(spark, d):
    ev = B.events_dirty(spark, d)
    inv = R.validity_invalid(ev, R.events_rules().validity)
    row = ev.agg(*[F.count_if(v).alias(c) for c, v in inv.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_invalid"))
                                          for c in inv])).alias("s")).select("s.*")


@query("D11_consistency_rules")
def d11(spark, d):
    ev, rules, refs = _events_scored(spark, d)
    work, cons = R.compile_consistency(ev, rules.consistency, refs)
    row = work.agg(*[F.count_if(~v).alias(k) for k, v in cons.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n_violations"))
                                          for k in cons])).alias("s")).select("s.*")


@query("C12_fk_membership")
def c12(spark, d):
    ev = B.events_dirty(spark, d)
    hit = R.fk_hit(ev, "user_id", B.table(spark, d, "customer"), "c_custkey", "_hit")
    return hit.agg(F.count_if(F.col("user_id").isNotNull() & ~F.col("_hit")).alias("n_broken"),
                   F.count_if(F.col("user_id").isNull() | F.col("_hit")).alias("n_ok"))


# ------------------------------------------------------------------ cleaning (B, C1, C8, D15, D26, D27, E4)

from ..functions import exprs as X  # noqa: E402
from .cleaning import CleaningPlan, table_counts  # noqa: E402


def events_plan(spark, d) -> CleaningPlan:
    """The flights-role cleaning run on ``events_dirty``."""
    p = CleaningPlan(B.events_dirty(spark, d), "events_dirty", pk="event_id")
    p.standardize_strings(["event_type"])
    p.parse_dates("event_date")
    p.fix_validity_range("value", 0, 100)
    p.fix_invalid_to_null("status", [0, 1, 2, 3])
    p.fix_fk_to_null("user_id", B.table(spark, d, "customer"), "c_custkey")
    p.fix_cancelled_air_time("status", "value")
    p.winsorize_numeric(["value"], 0.0, 0.99)
    p.impute_numeric_nulls_by_group_median("value", "event_type")
    return p


@query("D26_audit_log")
def d26(spark, d):
    return events_plan(spark, d).audit_log().withColumnRenamed("column", "column_name")


@query("D27_audit_summary")
def d27(spark, d):
    return events_plan(spark, d).audit_summary().orderBy(F.col("changes").desc())


@query("F2_report_sort")
def f2(spark, d):
    return events_plan(spark, d).audit_summary().orderBy(F.col("changes").desc(), F.col("step"))


@query("C8_scorecard_compare")
def c8(spark, d):
    ev, rules, refs = _events_scored(spark, d)
    before = dqa.run_dqa(ev, "events_dirty", rules, refs)
    clean = events_plan(spark, d).clean_df.withColumn("ts_hour", F.hour("ts").cast("int"))
    after = dqa.run_dqa(clean, "events_dirty", rules, refs)
    return dqa.compare_scorecards(before, after)


@query("D15_table_counts")
def d15(spark, d):
    return table_counts(B.events_dirty(spark, d), events_plan(spark, d).clean_df, "events_dirty")


@query("B1_standardize_strings")
def b1(spark, d):
    n = B.nation_dirty(spark, d)
    return n.select("n_nationkey", X.standardize_string("n_name", title=True).alias("n_name_title"),
                    X.standardize_string("n_name", upper=True).alias("n_name_upper"))


@query("B2_parse_dates")
def b2(spark, d):
    return B.events_dirty(spark, d).select("event_id", X.parse_and_format_date("event_date").alias("event_date"))


@query("B3_winsorize")
def b3(spark, d):
    p = CleaningPlan(B.events_dirty(spark, d), "events_dirty", pk="event_id", audit=False)
    return p.winsorize_numeric(["value"], 0.0, 0.99).clean_df.select("event_id", "value")


@query("B4_invalid_pattern")
def b4(spark, d):
    return B.events_dirty(spark, d).select("event_id", X.null_unless_match("event_type", r"^[a-z]{4,8}$").alias("event_type"))


@query("B5_invalid_to_null")
def b5(spark, d):
    return B.events_dirty(spark, d).select("event_id", X.null_unless_in("status", [0, 1, 2, 3]).alias("status"))


@query("B6_pattern_to_null")
def b6(spark, d):
    return B.table(spark, d, "part").select("p_partkey", X.null_unless_match("p_brand", r"^Brand#[0-9]$").alias("p_brand"))


@query("B7_validity_range")
def b7(spark, d):
    return B.events_dirty(spark, d).select("event_id", X.null_outside_range("value", 0, 100).alias("value"))


@query("B8_cancelled_air_time")
def b8(spark, d):
    return B.events_dirty(spark, d).select("event_id", X.cancelled_air_time("status", "value").alias("value"))


@query("B19_cancelled_filter")
def b19(spark, d):
    return B.events_dirty(spark, d).where(X.not_cancelled_filter(F.col("status"))).select("event_id", "status")


@query("C1_fk_to_null")
def c1(spark, d):
    p = CleaningPlan(B.events_dirty(spark, d), "events_dirty", pk="event_id", audit=False)
    return p.fix_fk_to_null("user_id", B.table(spark, d, "customer"), "c_custkey").clean_df.select("event_id", "user_id")


@query("E4_group_median_impute")
def e4(spark, d):
    p = CleaningPlan(B.events_dirty(spark, d), "events_dirty", pk="event_id", audit=False)
    return p.impute_numeric_nulls_by_group_median("value", "event_type").clean_df.select("event_id", "event_type", "value")


# ------------------------------------------------------------------ weather role

from ..operators import clean as CL  # noqa: E402
from ..operators import windows as W  # noqa: E402


@query("B9_dew_point_swap")
def b9(spark, d):
    o = B.obs_dirty(spark, d)
    t, dw = X.dew_point_swap("gust", "low")
    return o.select("obs_id", t.alias("gust"), dw.alias("low"))


@query("B10_wind_gust_floor")
def b10(spark, d):
    return B.obs_dirty(spark, d).select("obs_id", X.wind_gust_floor("spd", "gust").alias("gust"))


def _cloud(o):
    return o.withColumns({"cloud_cover": (F.col("obs_hour") % 5).cast("double"),
                          "low_level_cloud": (F.col("n") % 2).cast("double"),
                          "lowest_cloud_layer": F.col("gust") * 1000})


@query("B11_cloud_cover_fix")
def b11(spark, d):
    o = _cloud(B.obs_dirty(spark, d))
    return o.select("obs_id", X.cloud_cover_fix("cloud_cover", ["low_level_cloud"], "lowest_cloud_layer").alias("cloud_cover"))


@query("B12_snap_to_domain")
def b12(spark, d):
    o = B.obs_dirty(spark, d)
    return o.select("obs_id", X.snap_to_domain(F.col("spd") / 10, [0, 1, 2, 3, 4]).alias("spd_level"))


def _linked_flights(spark, d):
    """events_dirty with weather_observation_id rebuilt from obs."""
    ev = B.events_dirty(spark, d).withColumn("weather_observation_id", F.lit(None).cast("long"))
    return CL.fix_weather_observation_fk(ev, B.obs(spark, d), "event_type", "event_date", "event_hour",
                                         "weather_observation_id", "station", "obs_date", "obs_hour", "obs_id")


@query("C2_weather_fk_rebuild")
def c2(spark, d):
    return _linked_flights(spark, d).select("event_id", "weather_observation_id")


@query("C2_weather_fk_report")
def c2r(spark, d):
    return CL.fk_rebuild_report(_linked_flights(spark, d), "weather_observation_id")


@query("A9_weather_link")
def a9(spark, d):
    """UPDATE ... FROM: set the obs id where the natural key matches and the id is null."""
    ev = B.table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("date").cast("string").alias("event_date"),
                                            F.hour("ts").alias("event_hour"),
                                            F.lit(None).cast("long").alias("weather_observation_id"))
    lk = CL.weather_lookup(B.obs(spark, d), "station", "obs_date", "obs_hour", "obs_id")
    j = ev.join(lk, (F.col("event_type") == F.col("_w_a")) & (F.to_date("event_date") == F.col("_w_d"))
                & (F.col("event_hour") == F.col("_w_h")), "left")
    return j.select("event_id", F.coalesce("weather_observation_id", "_new_obs_id").alias("weather_observation_id"))


_WCOLS = ["spd", "gust", "low"]


@query("C3_null_cooccurrence")
def c3(spark, d):
    return CL.null_cooccurrence(B.obs_dirty(spark, d), _linked_flights(spark, d), _WCOLS, "obs_id",
                                "weather_observation_id", "status")


@query("C4_drop_linked_children")
def c4(spark, d):
    o = B.obs_dirty(spark, d)
    dropped = o.where(CL.all_null(_WCOLS)).select("obs_id")
    return CL.drop_linked_children(_linked_flights(spark, d), dropped, "weather_observation_id", "obs_id") \
        .select("event_id", "weather_observation_id")


@query("B13_handle_weather_nulls")
def b13(spark, d):
    p = CleaningPlan(B.obs_dirty(spark, d), "obs_dirty", pk="obs_id", audit=False)
    p.handle_weather_nulls(_WCOLS, _linked_flights(spark, d), "obs_id", "weather_observation_id", "status",
                           group_col="station", date_col="obs_date", hour_col="obs_hour")
    return p.clean_df.select("obs_id", *_WCOLS)


@query("E3_interpolate_temporal")
def e3(spark, d):
    o = B.obs_dirty(spark, d)
    return W.interpolate_temporal(o, _WCOLS, ["station"], "obs_date", "obs_hour", limit=2, max_gap_hours=3,
                                  row_id="obs_id").select("obs_id", *_WCOLS)


@query("E5_temporal_gaps")
def e5(spark, d):
    return W.detect_temporal_gaps(B.obs(spark, d), "obs_date", "obs_hour", "station")


def _lineitem_dups(spark, d):
    return B.table(spark, d, "lineitem")


@query("E1_deduplicate")
def e1(spark, d):
    li = _lineitem_dups(spark, d)
    rest = [c for c in B.LINEITEM_ORDER if c not in ("l_orderkey", "l_linenumber")]
    return W.deduplicate(li, ["l_orderkey", "l_linenumber"], rest).select("l_orderkey", "l_linenumber", "l_partkey",
                                                                            "l_suppkey", "l_quantity")


@query("E2_duplicate_flag")
def e2(spark, d):
    li = _lineitem_dups(spark, d)
    flagged = W.with_duplicate_flag(li, ["l_orderkey", "l_linenumber"], "is_dup")
    return flagged.groupBy("is_dup").agg(F.count(F.lit(1)).alias("n_rows"))


@query("E6_dense_ids")
def e6(spark, d):
    li = _lineitem_dups(spark, d).select(*B.LINEITEM_ORDER)
    return W.with_dense_id(li, B.LINEITEM_ORDER, "row_id").select("row_id", "l_orderkey", "l_linenumber", "l_partkey")


@query("C7_chained_measures")
def c7(spark, d):
    fl = _linked_flights(spark, d).select("event_id", "weather_observation_id")
    o = B.obs_dirty(spark, d).withColumn("active_weather_status", (F.col("n") % 3).cast("int"))
    aw = spark.createDataFrame([(0, "None"), (1, "Rain"), (2, "Snow")], "status int, weather_description string")
    out = star.chained_measures(fl, o, "weather_observation_id", "obs_id", ["spd", "gust", "low"],
                                "active_weather_status", aw)
    return out.select("event_id", "spd", "gust", "low", "_weather_desc")


# ------------------------------------------------------------------ profiling, missingness, outliers

from ..operators import missing as M  # noqa: E402
from ..operators import outliers as O  # noqa: E402
from ..operators import profile as P  # noqa: E402


@query("D12_missingness_summary")
def d12(spark, d):
    return P.missingness_summary(B.events_dirty(spark, d))


@query("D13_column_profile")
def d13(spark, d):
    return P.column_profile(B.events_dirty(spark, d))


@query("D16_discover_fd")
def d16(spark, d):
    return P.discover_fd(B.table(spark, d, "part"))


@query("D17_fd_compound_key")
def d17(spark, d):
    return P.fd_violations(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("D18_mapping_cardinality")
def d18(spark, d):
    c = B.table(spark, d, "customer")
    o = B.table(spark, d, "orders")
    return (P.mapping_cardinality(c, "c_nationkey", "c_mktsegment", "nation->segment")
            .unionByName(P.mapping_cardinality(o, "o_custkey", "o_orderpriority", "customer->priority"))
            .unionByName(P.mapping_cardinality(c, "c_custkey", "c_nationkey", "customer->nation")))


@query("D19_cancelled_consistency")
def d19(spark, d):
    ev = B.events_dirty(spark, d)
    canc = ev.where(X.not_cancelled_filter(F.col("status")))
    slot = (X.parse_date("event_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("event_hour")))
    return canc.agg(F.count(F.lit(1)).alias("n_cancelled"),
                    F.count_if(F.col("value").isNull()).alias("n_value_null"),
                    F.count_if(F.col("value") == 0).alias("n_value_zero"),
                    F.round(F.count_if(F.col("value").isNull()) / F.count(F.lit(1)) * 100, 2).alias("pct_value_null"),
                    F.count_if(F.coalesce(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz") != slot, F.lit(False)))
                     .alias("n_time_mismatch"),
                    F.count_if(F.coalesce(F.col("value") > 0, F.lit(False))).alias("n_value_positive"))


@query("D20_comissing_matrix")
def d20(spark, d):
    ev = B.events_dirty(spark, d)
    return M.comissing_matrix(ev, M.columns_with_missing(ev))


@query("D21_missing_correlation")
def d21(spark, d):
    return M.missing_correlation(B.events_dirty(spark, d), "value", ["user_id", "event_hour", "status"])


@query("D22_chi2_statistic")
def d22(spark, d):
    return M.chi2_statistic(B.events_dirty(spark, d), "value", "event_type")


@query("D22_mcar_test")
def d22t(spark, d):
    r = M.mcar_chi2_test(B.events_dirty(spark, d), "value", "event_type")
    return spark.createDataFrame([r], "chi2 double, p_value double, dof long, significance string, verdict string")


@query("D23_mar_logistic")
def d23(spark, d):
    r = M.mar_logistic_test(B.events_dirty(spark, d), "value", ["user_id", "event_hour", "status"])
    return spark.createDataFrame([(r.get("pseudo_r2"), r.get("verdict", r.get("error")))],
                                 "pseudo_r2 double, verdict string")


@query("D24_classify_all")
def d24(spark, d):
    return M.classify_all(B.events_dirty(spark, d), ["event_type"], ["event_hour", "user_id"])


@query("D24_classify_weather")
def d24_weather(spark, d):
    """The mechanism of five measures of the reconciled weather table, with rules of their own for one, all in the same rounds."""
    from ..sources import reconciled

    w = reconciled.tables(spark, d)["Weather_Observations"].select(
        "obs_id", "origin_airport", "obs_hour", "visibility", "wind_gust", "dew_point", "lowest_cloud_layer", "altimeter")
    return M.classify_all(w, ["origin_airport"], ["obs_hour", "obs_id"], {"visibility": {"group_cols": ["obs_hour"], "predictors": ["altimeter"]}})


@query("D25_category_variants")
def d25(spark, d):
    return P.category_variants(B.events_dirty(spark, d), "event_type")


def _events_outliers(spark, d):
    return O.run_outliers(B.events_dirty(spark, d), "events_dirty", {"value": 1.5}, ["value"])


@query("D28_iqr")
def d28(spark, d):
    det = O.OutlierDetector(B.events_dirty(spark, d), "events_dirty").detect_iqr("value", 1.5)
    return det.df.select("event_id", "IQR_value")


@query("D29_modified_zscore")
def d29(spark, d):
    det = O.OutlierDetector(B.events_dirty(spark, d), "events_dirty").detect_modified_zscore("value")
    return det.df.select("event_id", "ModZ_value")


@query("D31_consensus_votes")
def d31(spark, d):
    return _events_outliers(spark, d).votes().groupBy("votes").agg(F.count(F.lit(1)).alias("n_rows"))


@query("C10_flagged_rows")
def c10(spark, d):
    return _events_outliers(spark, d).flagged_rows(2).select("event_id", "value", "IQR_value", "ModZ_value", "votes")


@query("D32_outlier_summary")
def d32(spark, d):
    a = _events_outliers(spark, d).summary()
    b = O.run_outliers(B.obs_dirty(spark, d), "obs_dirty", {"gust": 2.5}, ["gust"]).summary()
    return a.unionByName(b)


def _three_methods(spark, d):
    return O.run_outliers(B.obs_dirty(spark, d), "obs_dirty", {"gust": 2.5}, ["gust"], forest=["spd", "gust", "low"], key="obs_id")


@query("D31_consensus_three_methods")
def d31_three(spark, d):
    """Votes over IQR, modified z-score and isolation forest."""
    return _three_methods(spark, d).votes().groupBy("votes").agg(F.count(F.lit(1)).alias("n_rows"))


@query("D32_summary_three_methods")
def d32_three(spark, d):
    return _three_methods(spark, d).summary()


# ------------------------------------------------------------------ sources, contracts, KPIs, misc

from ..sources import io as IO  # noqa: E402
from ..sources.reconcile import reconcile_entity  # noqa: E402
from . import contract as H  # noqa: E402


def _driver_tables(spark, d):
    return {t: B.table(spark, d, t) for t in IO.DRIVER_TABLES}


@query("A1_load_tables")
def a1(spark, d):
    return IO.table_inventory(IO.load_tables(spark, d))


@query("A2_normalize_columns")
def a2(spark, d):
    return IO.normalize_columns(B.table(spark, d, "customer"), "upper")


@query("A7_warehouse_metadata")
def a7(spark, d):
    w = _star(spark, d)
    tables = {"DIM_FL_DATES": w["fl_dates"], "DIM_DEP_HOURS": w["dep_hours"], "DIM_STATIONS": w["stations"],
              "DIM_CARRIERS": w["carriers"].drop("CODE"), "DIM_AIRCRAFTS": w["aircraft"], "DIM_JUNK": w["junk"],
              "FLIGHTS": w["fact"]}
    H.check_table_set(list(tables))
    return IO.table_inventory(tables, with_pk=True)


@query("A8_reconcile_all")
def a8_all(spark, d):
    """The wide source split into its seven tables: (table, natural key, dense id) of every row."""
    from ..sources.reconcile import reconcile

    li, p, s, n = (B.table(spark, d, t) for t in ("lineitem", "part", "supplier", "nation"))
    o = B.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = B.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("origin"))
    # orders meet their customers first, and the texts come last: line items are shuffled with few columns
    wide = (li.join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(n, F.col("origin") == F.col("n_nationkey")))
    wide = wide.select(*li.columns, *p.columns, *s.columns, *o.columns, *c.columns, *n.columns,
                       F.col("l_shipdate").cast("date").alias("obs_date"), (F.col("l_orderkey") % 24).cast("int").alias("obs_hour"))
    entities = {"aircraft": (["p_partkey"], ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]), "carriers": (["s_suppkey"], ["s_name"]),
                "stations": (["n_nationkey"], ["n_name"]), "cancellation": (["l_returnflag"], []), "active_weather": (["l_linestatus"], []),
                "weather": (["n_nationkey", "obs_date", "obs_hour"], [])}
    tables = reconcile(wide, entities, "flights")
    keys = {k: key for k, (key, _) in entities.items()} | {"flights": ["l_orderkey", "l_linenumber"]}
    out = None
    for name, t in tables.items():
        part = t.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys[name]]).alias("natural_key"),
                        *([F.col(f"{name}_id").alias("id")] if name != "flights" else [F.lit(None).cast("long").alias("id")]))
        out = part if out is None else out.unionByName(part)
    return out


@query("A8_reconcile_entity")
def a8(spark, d):
    li = B.table(spark, d, "lineitem")
    p = B.table(spark, d, "part")
    wide = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return reconcile_entity(wide, ["p_partkey"], ["p_brand", "p_size", "p_type"], "aircraft_id")


@query("B14_clean_city")
def b14(spark, d):
    s = B.stations(spark, d)
    city = X.standardize_string("display_airport_city_name_full", title=True)
    return s.select("airport", X.clean_city(city, F.col("airport_state_name"), F.col("airport_state_code")).alias("city"))


@query("B15_time_band")
def b15(spark, d):
    e = B.table(spark, d, "events").select(F.hour("ts").alias("hour"))
    return e.groupBy("hour").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("time_band", X.time_band("hour"))


@query("B16_buckets")
def b16(spark, d):
    o = B.obs_dirty(spark, d)
    return o.select("obs_id", X.visibility_bucket(F.col("spd") / 5).alias("visibility_bucket"),
                    X.gust_bucket("gust").alias("gust_bucket"),
                    X.temperature_bucket(F.col("low") - 20).alias("temperature_bucket"),
                    X.age_bucket(F.col("n")).alias("age_bucket"),
                    X.gust_bucket("gust", strict_null=True).alias("gust_bucket_strict"))


@query("B17_is_departed")
def b17(spark, d):
    f = B.star_flights(spark, d)
    return (f.withColumn("is_departed", X.is_departed(F.col("cancellation_reason")))
             .groupBy("is_departed").agg(F.count(F.lit(1)).alias("n_flights")))


@query("B18_aircraft_age")
def b18(spark, d):
    a = star.build_aircraft(B.aircraft(spark, d), B.star_flights(spark, d), load_ts=LOAD_TS)
    return a.select("TAIL_NUM", "AIRCRAFT_AGE", X.age_bucket("AIRCRAFT_AGE").alias("AGE_BUCKET"))


@query("B20_sample_fixed_n")
def b20(spark, d):
    """Exact-n sample: rank by a seeded hash of the key (the sample is the feature)."""
    e = B.table(spark, d, "events")
    return (e.orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("42"))), "event_id").limit(500)
             .select("event_id", "event_type", "value"))


@query("B21_projection")
def b21(spark, d):
    return B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("D33_fk_completeness")
def d33(spark, d):
    return star.fk_completeness(_star(spark, d)["fact"])


def _fact_reason(spark, d):
    w = _star(spark, d, fact_ids=False, fks=["FL_DATE_ID", "DEP_HOUR_ID", "JUNK_ID"])
    j = w["junk"].select("JUNK_ID", "CANCELLATION_REASON")
    dt = w["fl_dates"].select("FL_DATE_ID", "YEAR", "QUARTER", "MONTH", "DAY_OF_WEEK")
    return (w["fact"].join(F.broadcast(j), "JUNK_ID", "left").join(F.broadcast(dt), "FL_DATE_ID", "left"))


@query("D35_kpi_glossary")
def d35(spark, d):
    return kpi.kpis(_fact_reason(spark, d), ["YEAR"])


@query("D36_dashboard_rates")
def d36(spark, d):
    return kpi.dashboard_rates(_fact_reason(spark, d), ["MONTH"])


@query("D37_high_volume_groups")
def d37(spark, d):
    return kpi.high_volume_groups(_fact_reason(spark, d), ["DAY_OF_WEEK", "DEP_HOUR_ID"], 350)


@query("D38_rollup")
def d38(spark, d):
    return kpi.rollup(_fact_reason(spark, d), ["YEAR", "QUARTER", "MONTH"],
                      {"sum_dep_delay": ("DEP_DELAY", "SUM"), "avg_distance": ("DISTANCE", "AVG"),
                       "n_flights": ("DEP_HOUR_ID", "COUNT")}, kpi.MEASURE_ADDITIVITY)


@query("F3_nulls_last_ids")
def f3(spark, d):
    j = star.build_junk(B.star_flights(spark, d), load_ts=LOAD_TS)
    return j.select("JUNK_ID", "CANCELLATION_REASON", "WEATHER_DESCRIPTION").orderBy("JUNK_ID")


@query("F4_head")
def f4(spark, d):
    return B.table(spark, d, "customer").orderBy("c_custkey").limit(5)


@query("G2_distinct")
def g2(spark, d):
    return B.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("H1_register_contract")
def h1(spark, d):
    c = H.SchemaContract()
    rows = []
    for t, df in _driver_tables(spark, d).items():
        c.register(t, df, pk=df.columns[0])
        s = c._layouts[t]
        rows.append((t, len(s.columns), s.n_rows, s.key, s.to_json()))
    return spark.createDataFrame(rows, "table_name string, n_columns long, n_rows long, pk string, contract string")


def _contract_case(spark, d):
    c = H.SchemaContract()
    cust = B.table(spark, d, "customer")
    c.register("customer", cust, pk="c_custkey", count_rows=False)
    changed = (cust.drop("c_mktsegment").withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
                   .withColumn("c_extra", F.lit(1)).select("c_name", "c_custkey", "c_nationkey", "c_acctbal", "c_extra"))
    return c, cust, changed


@query("H2_validate_contract")
def h2(spark, d):
    c, _, changed = _contract_case(spark, d)
    return c.validate(spark, "customer", changed, strict=True).unionByName(
        c.validate(spark, "orders", B.table(spark, d, "orders")))


@query("H3_validate_all")
def h3(spark, d):
    c = H.SchemaContract()
    tables = {t: B.table(spark, d, t) for t in ["region", "nation", "supplier"]}
    for t, df in tables.items():
        c.register(t, df, pk=df.columns[0], count_rows=False)
    tables["supplier"] = tables["supplier"].unionByName(tables["supplier"])  # every key twice
    details, failures = c.validate_all(spark, tables)
    return details.withColumn("failures", F.lit(failures))


@query("H4_declared_constraints")
def h4(spark, d):
    """The keys of the fact are written once; every check reads its column of them."""
    from ..session import materialize

    w = _star(spark, d)
    f = materialize(w["fact"].select("FLIGHT_ID", *star.FK_COLS), "constraint-keys")
    ids = {"fl_dates": "FL_DATE_ID", "dep_hours": "DEP_HOUR_ID", "stations": "STATION_ID", "carriers": "CARRIER_ID",
           "aircraft": "AIRCRAFT_ID", "junk": "JUNK_ID"}
    parents = {k: (w[star.DIM_OF_KEY[k]], ids[star.DIM_OF_KEY[k]]) for k in star.FK_COLS}
    return H.declared_constraints(f, "FLIGHT_ID", star.FK_COLS, parents)


@query("K9_load_timestamp")
def k9(spark, d):
    w = _star(spark, d)
    parts = [w[k].select("LOAD_TIMESTAMP") for k in ["fl_dates", "dep_hours", "stations", "carriers", "aircraft", "junk", "fact"]]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.distinct()


@query("K10_run_log")
def k10(spark, d):
    """All seven build steps, each written; rows in are the rows of the step's own source."""
    from ..session import scratch_path
    from .runlog import RunLog
    log = RunLog()
    w = _star(spark, d)
    flights = B.star_flight_keys(spark, d).count()
    sources = {"fl_dates": flights, "dep_hours": flights, "stations": B.stations(spark, d).count(), "carriers": B.carriers(spark, d).count(),
               "aircraft": B.aircraft(spark, d).count(), "junk": flights, "fact": flights}
    base = _sink_dir(spark, "runlog")
    for name, rows in sources.items():
        log.run_step(f"build_{name}", lambda n=name: w[n], name, input_rows=rows,
                     sink=lambda df, n=name: IO.write_table(df, f"{base}/{n}"))
    return log.summary(spark).select("step", "status", "input_rows", "output_rows")


# ------------------------------------------------------------------ environment measures (C7 into K6, K7, D35, D36, D38)

def _environment(spark, d, fact_ids: bool = False, fks=star.FK_COLS) -> dict[str, DataFrame]:
    flights = B.environment_flights(spark, d, with_seq=fact_ids)
    return star.build_warehouse(flights, B.stations(spark, d), B.carriers(spark, d), B.aircraft(spark, d), B.LINEITEM_ORDER,
                                load_ts=LOAD_TS, fact_ids=fact_ids, seq_col="flight_seq" if fact_ids else None,
                                key_source=B.environment_flight_keys(spark, d), fks=fks)


@query("K6_build_junk_environment")
def k6_environment(spark, d):
    return star.build_junk(B.environment_flights(spark, d), load_ts=LOAD_TS)


@query("K7_build_fact_environment")
def k7_environment(spark, d):
    """Eight keys and nine measures."""
    return _environment(spark, d, fact_ids=True)["fact"]


def _environment_analytic(spark, d) -> DataFrame:
    w = _environment(spark, d, fks=["FL_DATE_ID", "JUNK_ID"])
    dates = w["fl_dates"].select("FL_DATE_ID", "YEAR", "QUARTER", "MONTH")
    junk = w["junk"].select("JUNK_ID", "CANCELLATION_REASON", "WEATHER_DESCRIPTION")
    return w["fact"].join(F.broadcast(dates), "FL_DATE_ID", "left").join(junk, "JUNK_ID", "left")


@query("D35_kpi_glossary_environment")
def d35_environment(spark, d):
    """All twelve measures of the glossary by weather text."""
    return kpi.kpis(_environment_analytic(spark, d), ["WEATHER_DESCRIPTION"])


@query("D36_dashboard_rates_environment")
def d36_environment(spark, d):
    """With the low-visibility rate."""
    return kpi.dashboard_rates(_environment_analytic(spark, d), ["YEAR"])


def _places(spark, d) -> DataFrame:
    w = _star(spark, d, fact_ids=False, fks=["DEP_HOUR_ID", "ORIGIN_STATION_ID"])
    stations = w["stations"].select(F.col("STATION_ID").alias("ORIGIN_STATION_ID"), "AIRPORT_CODE", "CITY", "STATE")
    return w["fact"].join(stations, "ORIGIN_STATION_ID", "left").join(F.broadcast(w["dep_hours"].select("DEP_HOUR_ID", "DEP_HOUR", "TIME_BAND")), "DEP_HOUR_ID", "left")


@query("D38_rollup_places")
def d38_places(spark, d):
    """Hierarchy airport -> city -> state."""
    return kpi.rollup(_places(spark, d), ["STATE", "CITY", "AIRPORT_CODE"], {"sum_dep_delay": ("DEP_DELAY", "SUM"), "avg_distance": ("DISTANCE", "AVG")}, kpi.MEASURE_ADDITIVITY)


@query("D38_rollup_hours")
def d38_hours(spark, d):
    """Hierarchy hour -> time band."""
    return kpi.rollup(_places(spark, d), ["TIME_BAND", "DEP_HOUR"], {"sum_dep_delay": ("DEP_DELAY", "SUM"), "avg_distance": ("DISTANCE", "AVG")}, kpi.MEASURE_ADDITIVITY)


@query("D38_cube")
def d38_cube(spark, d):
    """All combinations of state and time band."""
    return _places(spark, d).cube("STATE", "TIME_BAND").agg(F.grouping_id().alias("grouping_level"), F.sum("DEP_DELAY").alias("sum_dep_delay"), F.count(F.lit(1)).alias("n_flights"))


@query("D37_groups_by_state_band")
def d37_state_band(spark, d):
    return kpi.high_volume_groups(_places(spark, d), ["STATE", "TIME_BAND"], 1)


# ------------------------------------------------------------------ fuzzy duplicates (C11), isolation forest

from ..operators.fuzzy import near_duplicates  # noqa: E402
from ..operators.iforest import isolation_forest  # noqa: E402


def fuzzy_parts(spark, d):
    """part with a one-letter typo (second letter removed) in every ninth name."""
    p = B.table(spark, d, "part")
    name = F.when(F.col("p_partkey") % 9 == 0, F.concat(F.substring("p_name", 1, 1), F.expr("substring(p_name, 3)"))) \
        .otherwise(F.col("p_name"))
    return p.select("p_partkey", "p_brand", name.alias("p_name"), "p_type")


@query("C11_fuzzy_duplicates")
def c11(spark, d):
    return near_duplicates(fuzzy_parts(spark, d), "p_partkey", "p_brand", ["p_name", "p_type"], digits=DIGITS)


def _short_pairs(spark, d):
    from ..operators.fuzzy import near_duplicate_profiles

    return near_duplicate_profiles(fuzzy_parts(spark, d), "p_partkey", "p_brand", ["p_name", "p_type"])


@query("C11_profile_pairs")
def c11_profiles(spark, d):
    return _short_pairs(spark, d)[0]


@query("C11_membership")
def c11_members(spark, d):
    return _short_pairs(spark, d)[1]


@query("D30_forest_scores")
def d30_scores(spark, d):
    return isolation_forest(B.obs_dirty(spark, d), "obs_id", ["spd", "gust", "low"], contamination=0.02).select("obs_id", "anomaly_score", "IsoForest_Outlier")


@query("D30_isolation_forest")
def d30(spark, d):
    o = B.obs_dirty(spark, d)
    f = isolation_forest(o, "obs_id", ["spd", "gust", "low"], contamination=0.02)
    return f.groupBy("IsoForest_Outlier").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ sinks (A5, A6): write, then read back

def _sink_dir(spark, name):
    import uuid

    from ..session import scratch_path
    return scratch_path(spark, f"sinks/{name}-{uuid.uuid4().hex}")


@query("A5_warehouse_sink")
def a5(spark, d):
    """Write the date dimension as a layer table (partitioned by YEAR) and read it back."""
    dates = star.build_fl_dates(B.star_flights(spark, d), load_ts=LOAD_TS)
    paths = IO.write_layer({"DIM_FL_DATES": dates}, _sink_dir(spark, "dw"), partition_by={"DIM_FL_DATES": ["YEAR"]})
    back = spark.read.parquet(paths["DIM_FL_DATES"])
    return back.select(*dates.columns).withColumn("YEAR", F.col("YEAR").cast("short"))


@query("A6_report_sink")
def a6(spark, d):
    """Write the audit summary report as CSV (header, overwrite) and read it back with its schema."""
    rep = events_plan(spark, d).audit_summary()
    path = _sink_dir(spark, "reports") + "/audit_summary.csv"
    IO.write_table(rep, path, fmt="csv")
    return IO.read_table(spark, path, fmt="csv", schema="step string, changes long, cols_affected string", na_values=())


@query("A5_warehouse_sink_all")
def a5_all(spark, d):
    """All seven warehouse tables written and read back: rows and columns of each."""
    w = _star(spark, d)
    names = {"DIM_FL_DATES": "fl_dates", "DIM_DEP_HOURS": "dep_hours", "DIM_STATIONS": "stations", "DIM_CARRIERS": "carriers",
             "DIM_JUNK": "junk", "DIM_AIRCRAFTS": "aircraft", "FLIGHTS": "fact"}
    tables = {n: (w[k].drop("CODE") if k == "carriers" else w[k]) for n, k in names.items()}
    paths = IO.write_layer(tables, _sink_dir(spark, "warehouse"))
    return IO.table_inventory({n: spark.read.parquet(p) for n, p in paths.items()})


@query("A6_report_sink_all")
def a6_all(spark, d):
    """The scorecard, audit, outlier and missingness reports written as CSV and read back: rows of each."""
    reports = {"scorecards": _scorecards(spark, d), "audit_summary": events_plan(spark, d).audit_summary(),
               "outlier_summary": QUERIES["D32_outlier_summary"](spark, d), "missingness": QUERIES["D12_missingness_summary"](spark, d)}
    base = _sink_dir(spark, "reports")
    out = None
    for name, df in reports.items():
        path = f"{base}/{name}.csv"
        IO.write_table(df, path, fmt="csv")
        part = spark.read.option("header", True).csv(path).agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ the cleaning run and the rule registry of the seven tables

from ..sources import reconciled as REC  # noqa: E402
from .cleaning_run import CleaningRun  # noqa: E402


def cleaning_run(spark, d, one_to_one: bool = True) -> CleaningRun:
    return CleaningRun(REC.tables(spark, d, one_to_one))


def _clean_query(table: str, one_to_one: bool):
    return lambda spark, d: cleaning_run(spark, d, one_to_one).clean(table)


for _t in ["Carriers", "Stations", "Aircrafts", "Weather_Observations", "Flights"]:
    query(f"RUN_clean_{_t.lower()}")(_clean_query(_t, True))
for _t in ["Weather_Observations", "Flights"]:  # the observations may not go here: their measures are interpolated
    query(f"RUN_clean_{_t.lower()}_interpolated")(_clean_query(_t, False))


@query("RUN_counts")
def run_counts(spark, d):
    return cleaning_run(spark, d).counts()


def _entries(run: CleaningRun) -> DataFrame:
    log = run.audit_log(LOAD_TS)
    return log.groupBy("table_name", "step", F.col("column").alias("column_name"), "timestamp").agg(F.count(F.lit(1)).alias("n_entries"))


@query("RUN_audit")
def run_audit(spark, d):
    return _entries(cleaning_run(spark, d))


@query("RUN_audit_interpolated")
def run_audit_interpolated(spark, d):
    return _entries(cleaning_run(spark, d, False))


@query("RUN_dropped_rows")
def run_dropped_rows(spark, d):
    return cleaning_run(spark, d).dropped_rows()


@query("RUN_comparison")
def run_comparison(spark, d):
    return cleaning_run(spark, d).comparison()


@query("RUN_validation")
def run_validation(spark, d):
    return cleaning_run(spark, d).validation()


@query("D10_D11_rule_registry")
def rule_registry(spark, d):
    """Every rule of the seven tables on the raw layer."""
    tables, out = REC.tables(spark, d), None
    for name, rules in R.domain_rules().items():
        part = dqa.rule_report(tables[name], name, rules, tables)
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ declared layers, dictionary, stored contracts, load gate

from ..sources import layers as LAY  # noqa: E402


def _written(spark, name: str, tables: dict[str, DataFrame]) -> dict[str, LAY.Loaded]:
    """The layer's tables written as CSV under the shared folder and read against their declared schemas."""
    folder = _sink_dir(spark, f"layer-{name}")
    for t, schema in LAY.LAYERS[name].items():
        LAY.write_typed(tables[t], f"{folder}/{t}.csv", schema)
    return LAY.load_layer(spark, name, folder)


def _original(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The wide source table and its look-ups, put together from the reconciled tables."""
    weather = tables["Weather_Observations"].select(F.col("obs_id").alias("_obs"), *[
        F.col(c).alias("active_weather") if c == "active_weather_status" else F.col(c) for c in REC.WEATHER_COLUMNS[4:]])
    planes = tables["Aircrafts"].withColumnRenamed("tail_num", "_tail")
    places = tables["Stations"].select(F.col("airport").alias("_airport"), "latitude", "longitude", "elevation", "mesonet_station")
    wide = (tables["Flights"].join(planes, F.col("tail_num") == F.col("_tail"), "left")
            .join(weather, F.col("weather_observation_id") == F.col("_obs"), "left").join(places, F.col("origin") == F.col("_airport"), "left"))
    return {"CompleteData": wide, "ActiveWeather": tables["Active_Weather"], **{t: tables[t] for t in ("Cancellation", "Carriers", "Stations")}}


def layer_counts(layer: str, loaded: dict[str, LAY.Loaded]) -> DataFrame:
    """Rows and rejected rows of every table of a layer; each file is read once."""
    out = None
    for name, t in loaded.items():
        part = t.counts.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows", "n_rejected")
        out = part if out is None else out.unionByName(part)
    return out


@query("A1_typed_layers")
def a1_layers(spark, d):
    """Rows and rejected rows of every table of the original, reconciled and warehouse layers."""
    tables, w = REC.tables(spark, d), _environment(spark, d, fact_ids=True)
    dw = {"DIM_FL_DATES": w["fl_dates"], "DIM_DEP_HOURS": w["dep_hours"], "DIM_STATIONS": w["stations"], "DIM_CARRIERS": w["carriers"],
          "DIM_AIRCRAFTS": w["aircraft"], "DIM_JUNK": w["junk"], "FLIGHTS": w["fact"]}
    out = None
    for layer, given in (("original", _original(tables)), ("reconciled", tables), ("dw", dw)):
        part = layer_counts(layer, _written(spark, layer, given))
        out = part if out is None else out.unionByName(part)
    return out


def _reconciled_layer(spark, d) -> dict[str, LAY.Loaded]:
    """The reconciled tables through CSV, with two further faults: overlong aircraft types and text in a number."""
    tables = REC.tables(spark, d)
    tables["Aircrafts"] = tables["Aircrafts"].withColumn("icao_type", F.when(F.col("icao_type") == "too long", F.lit("x" * 21)).otherwise(F.col("icao_type")))
    tables["Weather_Observations"] = tables["Weather_Observations"].withColumn("visibility", F.when(F.col("visibility") == 25, F.lit("high")).otherwise(F.col("visibility").cast("string")))
    return _written(spark, "reconciled", tables)


@query("A1_typed_rejects")
def a1_rejects(spark, d):
    loaded, out = _reconciled_layer(spark, d), None
    for t in loaded.values():
        out = t.rejected if out is None else out.unionByName(t.rejected)
    return out.select("table_name", F.explode("reasons").alias("reason")).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("A1_typed_aircrafts")
def a1_aircrafts(spark, d):
    return _reconciled_layer(spark, d)["Aircrafts"].rows


@query("A1_typed_flights")
def a1_flights(spark, d):
    return _reconciled_layer(spark, d)["Flights"].rows


@query("D13_data_dictionary")
def d13_dictionary(spark, d):
    return P.data_dictionary({t: LAY.described(df) for t, df in REC.tables(spark, d).items()})


@query("B2_parse_date_forms")
def b2_forms(spark, d):
    """The event date written in many forms reads as the same date in all of them."""
    day, forms = F.col("ts").cast("date"), ["yyyy-MM-dd", "yyyyMMdd", "yyyy-M-d", "d MMM yyyy", "MM/dd/yyyy", "MMM d, yyyy", "yyyy/M/d", "d MMMM yyyy"]
    text = F.element_at(F.array(*[F.date_format(day, f) for f in forms]), (F.col("event_id") % len(forms) + 1).cast("int"))
    return B.table(spark, d, "events").select("event_id", X.parse_date(text).alias("event_date"))


@query("H1_contract_columns")
def h1_columns(spark, d):
    return H.contract_columns(_driver_tables(spark, d))


@query("H1_contract_drift")
def h1_drift(spark, d):
    """A contract stored from half of the orders and a narrower customer table, compared with the tables as they are."""
    store = H.ContractStore(spark, _sink_dir(spark, "contracts"))
    orders, customer, nation = (B.table(spark, d, t) for t in ("orders", "customer", "nation"))
    store.save({"orders": orders, "customer": customer})
    store.save({"orders": orders.where("o_orderkey % 2 = 0"), "customer": customer.drop("c_name").withColumn("c_custkey", F.col("c_custkey").cast("int"))})
    return store.drift({"orders": orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))), "customer": customer, "nation": nation})


def _gated(spark, d):
    """The fact with two kinds of broken keys, through the load gate, which reads it once."""
    fact = _star(spark, d)["fact"]
    broken = fact.withColumns({"ORIGIN_STATION_ID": F.when(F.col("FLIGHT_ID") % 17 != 0, F.col("ORIGIN_STATION_ID")),
                               "AIRCRAFT_ID": F.when(F.col("FLIGHT_ID") % 19 != 0, F.col("AIRCRAFT_ID"))})
    return broken, star.load_gate(broken, _sink_dir(spark, "gate"))


@query("D33_gate_loaded")
def d33_loaded(spark, d):
    return _gated(spark, d)[1].loaded.select("FLIGHT_ID", *star.FK_COLS, "DEP_DELAY")


@query("D33_gate_quarantined")
def d33_quarantined(spark, d):
    return _gated(spark, d)[1].quarantined.select("FLIGHT_ID", F.array_join("FAILING_KEYS", ",").alias("FAILING_KEYS"))


@query("D33_gate_counters")
def d33_counters(spark, d):
    counters = _gated(spark, d)[1].counters
    return spark.createDataFrame(sorted(counters.items()), "counter string, n long")


@query("D33_unknown_member")
def d33_unknown(spark, d):
    """Flights by origin state when broken origins point at the unknown member."""
    w = _star(spark, d, fact_ids=True, fks=["ORIGIN_STATION_ID"])
    fact = w["fact"].withColumn("ORIGIN_STATION_ID", F.when(F.col("FLIGHT_ID") % 17 != 0, F.col("ORIGIN_STATION_ID")))
    fact = star.with_unknown_member(fact, ["ORIGIN_STATION_ID"])
    dim = star.with_unknown_row(w["stations"], "STATION_ID").select(F.col("STATION_ID").alias("ORIGIN_STATION_ID"), "STATE")
    return fact.join(dim, "ORIGIN_STATION_ID").groupBy("STATE").agg(F.count(F.lit(1)).alias("n_flights"))


# ------------------------------------------------------------------ mapped categories, dashboards, constraints of the dimensions

@query("D25_apply_mapping")
def d25_mapping(spark, d):
    """The spellings of the event type joined to their canonical form, and what is left unmapped."""
    ev = B.events_dirty(spark, d)
    mapping = P.category_variants(ev, "event_type").where(F.col("canonical") != "error").select("variant", "canonical")
    return P.apply_mapping(ev, "event_type", mapping).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("D37_dashboard_groupings")
def d37_groupings(spark, d):
    """Every grouping of the two dashboards in one pass: when and where, and why."""
    w = _environment(spark, d, fks=star.FK_COLS)
    f = w["fact"].join(F.broadcast(w["fl_dates"].select("FL_DATE_ID", "MONTH", "DAY_OF_WEEK")), "FL_DATE_ID", "left")
    f = f.join(F.broadcast(w["dep_hours"].select("DEP_HOUR_ID", "DEP_HOUR", "TIME_BAND")), "DEP_HOUR_ID", "left")
    f = f.join(w["stations"].select(F.col("STATION_ID").alias("ORIGIN_STATION_ID"), "AIRPORT_CODE", "STATE"), "ORIGIN_STATION_ID", "left")
    f = f.join(w["carriers"].select(F.col("CARRIER_ID").alias("MKT_CARRIER_ID"), F.col("DESCRIPTION").alias("AIRLINE")), "MKT_CARRIER_ID", "left")
    f = f.join(w["aircraft"].select("AIRCRAFT_ID", "MANUFACTURER", "AIRCRAFT_AGE"), "AIRCRAFT_ID", "left")
    f = f.join(w["junk"].select("JUNK_ID", "CANCELLATION_REASON", "WEATHER_DESCRIPTION"), "JUNK_ID", "left")
    f = f.withColumns({"VISIBILITY_BUCKET": X.visibility_bucket("VISIBILITY"), "GUST_BUCKET": X.gust_bucket("WIND_GUST"),
                       "TEMPERATURE_BUCKET": X.temperature_bucket("TEMPERATURE"), "AGE_BUCKET": X.age_bucket("AIRCRAFT_AGE")})
    return kpi.dashboard_groupings(f, kpi.DASHBOARD_GROUPINGS, min_flights=5)


@query("H4_dimension_constraints")
def h4_dimensions(spark, d):
    """PRIMARY KEY and NOT NULL of the six dimensions, as their schemas declare them."""
    w, out = _star(spark, d), None
    names = {"DIM_FL_DATES": "fl_dates", "DIM_DEP_HOURS": "dep_hours", "DIM_STATIONS": "stations", "DIM_CARRIERS": "carriers", "DIM_JUNK": "junk", "DIM_AIRCRAFTS": "aircraft"}
    for table, name in names.items():
        required = [f.name.upper() for f in LAY.LAYERS["dw"][table].fields if not f.nullable]
        part = H.declared_constraints(w[name], required[0], required).select(F.lit(table).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out
