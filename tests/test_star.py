"""Warehouse build (K1-K8, C5-C7, D33-D38) on sf0.001 and hand rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dwkit.operators import holidays, kpi, star
from dwkit.sources import bindings as B


def test_holiday_observed_dates(spark):
    days = ["2021-12-31", "2022-01-01", "2022-06-19", "2022-06-20", "2022-12-25", "2022-12-26", "2023-01-02",
            "2022-01-17", "2022-05-30", "2022-11-24", "2022-10-10", "2022-07-04"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    got = {str(r.d): r.h for r in holidays.is_holiday_flag(df, "d", "h").collect()}
    assert got == {"2021-12-31": True, "2022-01-01": False, "2022-06-19": False, "2022-06-20": True,
                   "2022-12-25": False, "2022-12-26": True, "2023-01-02": True, "2022-01-17": True,
                   "2022-05-30": True, "2022-11-24": True, "2022-10-10": True, "2022-07-04": True}


def test_junk_lookup_null_safe(spark):
    junk = star.build_junk(spark.createDataFrame([("a", None), (None, None), (None, "b")], "cancellation_reason string, weather_description string"))
    assert [tuple(r) for r in junk.select("JUNK_ID", "CANCELLATION_REASON", "WEATHER_DESCRIPTION").orderBy("JUNK_ID").collect()] == \
        [(1, "a", None), (2, None, "b"), (3, None, None)]
    fact = spark.createDataFrame([("a", None), (None, None), ("z", "z")], "cancellation_reason string, weather_description string")
    assert [r.JUNK_ID for r in star.lookup_junk(fact, junk).collect()] == [1, 3, 3]


def test_key_summary_counts_groups_not_their_combinations(spark):
    rows = [(f"2024-01-{d + 1:02d}", h, r, w) for d in range(20) for h in (0, 7, None) for r in ("a", None) for w in ("x", None)] + [(None, 7, "a", "y")]
    df = spark.createDataFrame(rows, "fl_date string, dep_hour int, cancellation_reason string, weather_description string")
    groups = [["fl_date"], ["dep_hour"], ["fl_date"], ["cancellation_reason", "weather_description"]]
    got = star.flight_key_summary(df, groups)
    dates, hours, junk = (got[tuple(g)].collect() for g in (groups[0], groups[1], groups[3]))
    assert len(dates) == 21 and {(r.fl_date, r["count"]) for r in dates} == {(dt.date(2024, 1, d + 1), 12) for d in range(20)} | {(None, 1)}
    assert sorted(map(tuple, hours), key=str) == sorted([(0, 80), (7, 81), (None, 80)], key=str)
    assert sorted(map(tuple, junk), key=str) == sorted([("a", "x", 60), ("a", None, 60), (None, "x", 60), (None, None, 60), ("a", "y", 1)], key=str)
    assert got[("dep_hour",)].inputFiles() and sum(r["count"] for r in dates) == len(rows)  # 29 rows written, not 241 combinations
    only = star.flight_key_summary(df.limit(0), [["dep_hour"]])
    assert list(only) == [("dep_hour",)] and only[("dep_hour",)].count() == 0


def test_environment_keys_are_those_of_its_flights(spark, tmp_path):
    n = spark.range
    tables = {
        "customer": n(20).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey")),
        "supplier": n(9).select(F.col("id").alias("s_suppkey"), (F.col("id") % 5).cast("int").alias("s_nationkey")),
        "region": n(3).select(F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), F.col("id")).alias("r_name")),
        "orders": n(80).select((F.col("id") % 60).alias("o_orderkey"), F.when(F.col("id") % 7 > 0, F.col("id") % 25).alias("o_custkey")),
        "events": n(900).select(F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, CAST(id * id * 7 % 20000 AS INT), 0)").alias("ts"), F.concat(F.lit("t"), F.col("id") % 4).alias("event_type"),
                                (F.col("id") / 3).alias("value")),
        "lineitem": n(600).select(
            F.when(F.col("id") % 50 > 0, F.col("id") % 90).alias("l_orderkey"), F.lit(1).cast("long").alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"), (F.col("id") % 5).cast("int").alias("l_linenumber"),
            *[F.lit(1.5).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], F.when(F.col("id") % 3 > 0, F.lit("N")).otherwise(F.lit("A")).alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"), F.when(F.col("id") % 8 > 0, F.expr("timestamp_ntz '2024-03-01' + make_dt_interval(CAST(id % 17 AS INT))")).alias("l_shipdate"))}
    for t, df in tables.items():
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    cols = ["fl_date", "dep_hour", "cancellation_reason", "weather_description"]
    want = B.environment_flights(spark, str(tmp_path), with_seq=True).groupBy(*cols).count().collect()
    keys = B.environment_flight_keys(spark, str(tmp_path))
    got = {tuple(r)[:4] for r in keys.groupBy(*cols).count().collect()}
    assert got == {tuple(r)[:4] for r in want} and len(want) > 100 and len({r.weather_description for r in want}) > 2
    assert not any(f"/{t}.parquet" in f for f in keys.inputFiles() for t in ("customer", "supplier"))


def test_fact_rows_fks_and_plan(spark):
    flights = B.star_flights(spark, SF_SMALL)
    w = star.build_warehouse(flights, B.stations(spark, SF_SMALL), B.carriers(spark, SF_SMALL),
                             B.aircraft(spark, SF_SMALL), B.LINEITEM_ORDER, load_ts="2024-02-01 00:00:00")
    fact = w["fact"]
    n = flights.count()
    assert fact.count() == n
    ids = fact.agg(F.min("FLIGHT_ID"), F.max("FLIGHT_ID"), F.countDistinct("FLIGHT_ID")).first()
    assert tuple(ids) == (1, n, n)
    gate = {r.fk_column: r.null_count for r in star.fk_completeness(fact).collect()}
    assert all(v == 0 for v in gate.values())
    lazy = star.build_warehouse(flights, B.stations(spark, SF_SMALL), B.carriers(spark, SF_SMALL),
                                B.aircraft(spark, SF_SMALL), B.LINEITEM_ORDER, fact_ids=False)["fact"]
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_fk_gate_raises(spark):
    fact = spark.createDataFrame([(1, None)], "FL_DATE_ID long, JUNK_ID long")
    try:
        star.fk_completeness(fact, ["FL_DATE_ID", "JUNK_ID"], on_fail="raise")
    except ValueError as e:
        assert "JUNK_ID" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_rollup_rejects_sum_of_non_additive(spark):
    df = spark.createDataFrame([(2022, 1, 5.0)], "YEAR int, MONTH int, WIND_SPD double")
    try:
        kpi.rollup(df, ["YEAR", "MONTH"], {"s": ("WIND_SPD", "SUM")}, kpi.MEASURE_ADDITIVITY)
    except ValueError:
        pass
    else:
        raise AssertionError("SUM over a non-additive measure must be refused")
    out = kpi.rollup(df, ["YEAR", "MONTH"], {"a": ("WIND_SPD", "AVG")}, kpi.MEASURE_ADDITIVITY)
    assert sorted(r.grouping_level for r in out.collect()) == [0, 1, 3]


def test_top_states_mean_of_monthly_means(spark):
    m = spark.createDataFrame([("A", 1, 10.0, 1), ("A", 2, 20.0, 99), ("B", 1, 14.0, 5)],
                              "ORIGIN_STATE string, MONTH int, avg_dep_delay double, n_flights long")
    rows = kpi.top_states(m, 10).collect()
    assert [(r.ORIGIN_STATE, r.avg_dep_delay, r.n_flights) for r in rows] == [("A", 15.0, 100), ("B", 14.0, 5)]


def _written(monkeypatch, module):
    """(tag, columns) of every table that ``module`` writes from now on."""
    from dwkit import session

    seen, write = [], session.materialize

    def record(df, tag="table"):
        seen.append((tag, df.columns))
        return write(df, tag)

    monkeypatch.setattr(module, "materialize", record)
    return seen


def test_ids_by_key_equal_sorted_ids(spark):
    from dwkit.operators.windows import with_dense_id, with_dense_id_by_key

    rows = [(5, "b", 1.0), (5, "a", None), (1, None, 2.0), (9, "x", 3.0), (None, "n", 4.0), (1, "c", 2.0), (5, "a", None), (-3, "z", 0.5)]
    df = spark.createDataFrame(rows, "k long, t string, v double").repartition(3)
    keys = spark.createDataFrame([(5,), (1,), (5,), (-3,), (None,), (77,)], "known long")
    want = with_dense_id(df.where("k IN (5, 1, -3)"), ["k", "t", "v"], "i")
    got = with_dense_id_by_key(df, keys, ["k", "t", "v"], "i")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert with_dense_id_by_key(df, keys.where("known = 77"), ["k", "t", "v"], "i").count() == 0


def test_flight_numbers_write_keys_only(spark, monkeypatch):
    from dwkit.operators import windows

    seen = _written(monkeypatch, windows)
    flights = B.star_flights(spark, SF_SMALL, with_seq=True)
    assert seen and all(len(columns) <= 3 for _, columns in seen)
    ids = flights.agg(F.count("*"), F.min("flight_seq"), F.max("flight_seq"), F.countDistinct("flight_seq")).first()
    assert ids[1] == 1 and ids[0] == ids[2] == ids[3]


def test_orders_and_customers_that_repeat_repeat_their_flights(spark, tmp_path):
    for t in ("lineitem", "orders", "customer", "supplier"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        (df.unionByName(df) if t in ("orders", "customer") else df).write.parquet(f"{tmp_path}/{t}.parquet")
    once, both = B.star_flights(spark, SF_SMALL, with_seq=True), B.star_flights(spark, str(tmp_path), with_seq=True)
    n = once.count()
    assert both.count() == 4 * n
    assert both.agg(F.max("flight_seq"), F.countDistinct("flight_seq")).first() == (n, n)


def test_gate_and_constraints_plan_the_fact_once(spark, monkeypatch):
    from dwkit import session
    from dwkit.plans import catalog

    seen = _written(monkeypatch, session)
    broken, gate = catalog._gated(spark, SF_SMALL)
    assert not [tag for tag, _ in seen if tag == "gate-input"]
    assert gate.counters["rows"] == broken.count() == gate.loaded.count() + gate.quarantined.count()
    found = catalog.QUERIES["H4_declared_constraints"](spark, SF_SMALL)
    assert [columns for tag, columns in seen if tag == "constraint-keys"] == [["FLIGHT_ID", *star.FK_COLS]]
    assert found.count() == 17 and found.agg(F.sum("violations")).first()[0] == 0


def test_orphans_are_counted_by_row(spark):
    from dwkit.plans.contract import declared_constraints

    table = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None), (4, 9)], "i long, k long")
    parent = spark.createDataFrame([(8,), (8,), (None,)], "p long")
    got = {r.constraint_type: r.violations for r in declared_constraints(table, "i", [], {"k": (parent, "p")}).collect()}
    assert got == {"PRIMARY KEY": 2, "REFERENCES": 3}
    assert declared_constraints(table.where("k = 8"), "i", [], {"k": (parent, "p")}).where("violations > 0").isEmpty()


def test_reconcile_writes_its_source_once(spark, monkeypatch):
    from dwkit.sources import reconcile as module

    seen = _written(monkeypatch, module)
    wide = spark.createDataFrame([(1, 20, "b", "x"), (2, 10, "a", "x"), (3, 20, "b", "y"), (3, 20, "b", "y"), (4, None, "c", None)], "r long, k long, a string, s string")
    out = module.reconcile(wide, {"part": (["k"], ["a"]), "flag": (["s"], [])}, "rows")
    assert [tag for tag, _ in seen] == ["reconcile-wide"]
    assert sorted(map(tuple, out["part"].select("part_id", "k", "a").collect())) == [(1, 10, "a"), (2, 20, "b"), (3, None, "c")]
    assert sorted(map(tuple, out["flag"].select("flag_id", "s").collect())) == [(1, "x"), (2, "y"), (3, None)]
    assert [r.r for r in out["rows"].orderBy("rows_id").collect()] == [1, 2, 3, 3, 4]
