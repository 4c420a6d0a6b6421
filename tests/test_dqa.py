"""Quality scoring (D1-D9), rules (D10-D11, C12) and the one-aggregate plan."""

from pyspark.sql import functions as F

from dwkit.functions import rules as R
from dwkit.operators import dqa


def card(df, rules, refs=None, **kw):
    return {r.Dimension: r for r in dqa.run_dqa(df, "t", rules, refs, **kw).collect()}


def test_empty_table_scores_zero(spark):
    df = spark.createDataFrame([], "k int, v double")
    c = card(df, R.TableRules(pk="k", validity={"v": R.between(0, 1)}))
    assert c["Completeness"].Score == 0.0 and c["Uniqueness"].Score == 0.0 and c["Validity"].Score == 0.0


def test_counts_nulls_duplicates_validity(spark):
    df = spark.createDataFrame([(1, 0.5), (1, None), (None, 2.0), (None, 0.1), (3, 0.2)], "k int, v double")
    rules = R.TableRules(pk="k", req_cols=["k", "v"], validity={"v": R.between(0, 1), "absent": R.between(0, 1)})
    c = card(df, rules)
    assert c["Completeness"].Issues == 3 and c["Completeness"].Score == round(1 - 3 / 10, 4)
    assert c["Uniqueness"].Issues == 4  # both copies of 1 and both nulls
    assert c["Validity"].Issues == 1 and c["Validity"].Details == "v: 1 invalid"
    assert c["Completeness"].Details == "Missing per column: {'k': 2, 'v': 1}"
    assert c["Validity"].Status == "WARN"


def test_consistency_fk_and_timeliness(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 5), (2, "2010-01-01", 99), (3, "2030-01-01", None), (4, "junk", 5)],
                               "k int, d string, fk int")
    parent = spark.createDataFrame([(5,), (6,)], "id int")
    rules = R.TableRules(pk="k", time_col="d", consistency=[R.fk_rule("fk", "P", "id")])
    c = card(df, rules, {"P": parent})
    assert c["Consistency"].Issues == 1
    assert c["Timeliness"].Issues == 2 and c["Timeliness"].Details == "Future dates: 1 | Stale (>1825d): 1"
    # parent absent -> rule is a no-op
    assert card(df, rules)["Consistency"].Issues == 0


def test_rule_on_absent_column_is_skipped_but_required_column_fails(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert "Validity" in card(df, R.TableRules(validity={"nope": R.between(0, 1)}))
    try:
        card(df, R.TableRules(req_cols=["nope"]))
    except KeyError:
        pass
    else:
        raise AssertionError("missing required column must fail")


def test_single_aggregate_plan(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    rules = R.TableRules(pk="k", validity={"v": R.between(0, 5)},
                         consistency=[R.ConsistencyRule("pos", lambda: F.col("v") >= 0, needs=("v",))], time_col=None)
    plan = dqa.run_dqa(df, "t", rules)._jdf.queryExecution().executedPlan().toString()
    # one fused counter aggregate (partial + final) plus the uniqueness count (two levels)
    assert plan.count("HashAggregate") <= 6
    assert "CartesianProduct" not in plan


def test_overall_and_compare(spark):
    a = spark.createDataFrame([("t", "Completeness", 0.9, 1, "WARN"), ("t", "Validity", 0.8, 2, "WARN")],
                              "Table string, Dimension string, Score double, Issues long, Status string")
    b = spark.createDataFrame([("t", "Completeness", 1.0, 0, "PASS"), ("t", "Validity", 0.8, 2, "WARN")],
                              "Table string, Dimension string, Score double, Issues long, Status string")
    assert dqa.overall_score(a).first().overall_score == 0.85
    cmp = {r.Dimension: r.Improved for r in dqa.compare_scorecards(a, b).collect()}
    assert cmp == {"Completeness": "YES", "Validity": "="}


def test_registry_compiles_on_reference_shapes(spark):
    reg = R.domain_rules()
    assert set(reg) == {"Flights", "Weather_Observations", "Stations", "Aircrafts", "Carriers", "Active_Weather",
                        "Cancellation"}
    w = spark.createDataFrame([(1, "ATL", "2022-01-01", 1, 10.0, 5.0, 12.0, 0.0, 1.0, 5000.0)],
                              "obs_id int, origin_airport string, obs_date string, obs_hour int, temperature double, "
                              "wind_spd double, dew_point double, cloud_cover double, low_level_cloud double, "
                              "lowest_cloud_layer double")
    c = card(w, reg["Weather_Observations"], dims=["Validity", "Consistency"])
    assert c["Consistency"].Issues == 1  # dew > temperature and clear sky with flags / low layer
    assert c["Validity"].Issues == 0
