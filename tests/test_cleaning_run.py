"""The cleaning run over several tables: order, both branches, dropped rows, shared keys."""

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from dwkit.functions.rules import TableRules, domain_rules
from dwkit.operators import dqa
from dwkit.plans.cleaning import CleaningPlan
from dwkit.plans.cleaning_run import SPECS, CleaningRun, TableSpec
from dwkit.sources import reconciled


def test_views_equal_in_spark_and_duckdb(spark):
    con = duckdb.connect()
    for t in ("nation", "region", "supplier", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, df in reconciled.tables(spark, SF_SMALL, one_to_one=False).items():
        cols = [c for c in df.columns if c not in ("dep_time", "crs_dep_time")]
        want = con.execute(f"WITH {reconciled.view_sql(False)} SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in cols)} FROM rec_{name.lower()}").fetchall()
        got = [tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in cols]).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)), name


def test_parents_come_first(spark):
    order = CleaningRun({t: spark.range(0) for t in SPECS}).order()
    assert set(order) == set(SPECS)
    for name, spec in SPECS.items():
        assert all(order.index(p) < order.index(name) for p in spec.parents())
    loop = {"a": TableSpec("k", fks=[("x", "b", "k")]), "b": TableSpec("k", fks=[("x", "a", "k")])}
    with pytest.raises(ValueError):
        CleaningRun({"a": spark.range(0), "b": spark.range(0)}, loop).order()


@pytest.mark.parametrize("one_to_one", [True, False])
def test_empty_observations_go_only_when_safe(spark, one_to_one):
    tables = reconciled.tables(spark, SF_SMALL, one_to_one)
    run = CleaningRun(tables)
    empty = tables["Weather_Observations"].where("temperature IS NULL AND wind_spd IS NULL AND altimeter IS NULL").count()
    gone = {(r.table_name, r.step): r["count"] for r in run.dropped_rows().groupBy("table_name", "step").count().collect()}
    assert gone.get(("Weather_Observations", "handle_weather_nulls_drop"), 0) == gone.get(("Flights", "handle_weather_nulls_drop"), 0) == (empty if one_to_one else 0)
    counts = {r.table_name: r for r in run.counts().collect()}
    assert counts["Flights"].rows_removed == (empty if one_to_one else 0)
    assert counts["Weather_Observations"].rows_removed == (empty if one_to_one else 0) + gone[("Weather_Observations", "deduplicate")]
    w = run.clean("Weather_Observations")
    assert w.agg(F.max("obs_id")).first()[0] == w.count() == w.select("origin_airport", "obs_date", "obs_hour").distinct().count()
    assert tables["Flights"].count() == counts["Flights"].rows_before  # the input itself is not changed
    assert not [r for r in run.validation().collect() if r.status == "FAIL" and r.table_name != "Aircrafts"]
    assert len(run._keys) == len(set(run._keys))


def test_absent_parents_are_skipped(spark):
    tables = reconciled.tables(spark, SF_SMALL)
    run = CleaningRun({"Flights": tables["Flights"]})
    f = run.clean("Flights")
    assert f.count() == tables["Flights"].count() and f.where("origin IS NULL").count() == 0
    assert {r.Dimension for r in run.scorecards("after").collect()} >= {"Completeness", "Consistency"}


def test_dropped_rows_keep_their_audit_entries(spark):
    df = spark.createDataFrame([(1, " a"), (2, "a"), (3, "b ")], "id long, k string")
    p = CleaningPlan(df, "t", pk="id").standardize_strings(["k"]).deduplicate(["k"], ["k", "id"])
    log = p.audit_log("2024-02-01 00:00:00")
    assert {(r.step, r.row_id) for r in log.collect()} == {("standardize_strings", "1"), ("standardize_strings", "3"), ("deduplicate", None)}
    assert [r.row_id for r in p.dropped_rows().collect()] == ["2"] and "timestamp" in log.columns
    p = CleaningPlan(df, "t", pk="id").standardize_strings(["k"]).deduplicate(["k"], ["id"])
    p.reset_serial_id("id")
    assert {r.row_id for r in p.audit_log().where("step = 'standardize_strings'").collect()} == {"1", "3"}  # ids of the source


def test_rule_report_counts_hot_and_broken_keys(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id") % 7).alias("fk"), (F.col("id") % 3999).alias("u"))
    parent = spark.createDataFrame([(0,), (1,), (2,), (None,)], "k int")
    from dwkit.functions.rules import between, fk_rule, unique_rule

    rules = TableRules(validity={"u": between(0, 100)}, consistency=[fk_rule("fk", "P", "k"), unique_rule("u"), fk_rule("absent", "P", "k")])
    got = {(r.kind, r.rule): r.n_violations for r in dqa.rule_report(df, "t", rules, {"P": parent}).collect()}
    assert got == {("validity", "u"): df.where("u > 100").count(), ("consistency", "fk_fk"): df.where("fk > 2").count(),
                   ("consistency", "unique_u"): 2, ("consistency", "fk_absent"): 0}
    assert sum(len(r.consistency) + len(r.validity) for r in domain_rules().values()) == 63
