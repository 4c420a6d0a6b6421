"""Declared layers, typed loading, data dictionary, stored contracts, dates and the load gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.functions.exprs import parse_date
from dwkit.operators import profile, star
from dwkit.plans.contract import ContractStore
from dwkit.sources import layers


def test_declared_layers():
    assert {layer: len(t) for layer, t in layers.LAYERS.items()} == {"original": 5, "reconciled": 7, "cleaned": 7, "dw": 7}
    assert len(layers.GLOSSARY) == 54 and len(layers.LAYERS["original"]["CompleteData"]) == 40
    tail = layers.LAYERS["reconciled"]["Aircrafts"]["tail_num"]
    assert tail.dataType == T.StringType() and not tail.nullable and tail.metadata["length"] == 20 and "Registration" in tail.metadata["comment"]


def test_typed_csv_keeps_codes_and_routes_unfit_rows(spark, tmp_path):
    schema = layers.declared("code varchar(4)!, n smallint, x double, d date, t timestamp, b boolean, m decimal(5,1)")
    (tmp_path / "T.csv").write_text("\n".join([
        "code,n,x,d,t,b,m", "007,12.0,1e3,20220105,2022-01-05 07:08:09,true,12.34", "012,NA,,NULL,,,", ' 01,7,nan,5 Jan 2022,2022-01-05T07:08,false,-1',
        "00001,1,1,2022-01-01,,,", "1,99999,1,2022-01-01,,,", "2,1.5,abc,2022-02-30,,maybe,100000", ",1,1,,,,", "3,1"]) + "\n")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("typed-load", "")
    loaded = layers.read_typed(spark, str(tmp_path / "T.csv"), "T", schema)
    assert len(jobs.getJobIdsForGroup("typed-load")) == 0 and loaded.rows.schema["code"].metadata["length"] == 4
    spark.sparkContext.setJobGroup("default", "")
    rows = {r.code: r for r in loaded.rows.collect()}
    assert set(rows) == {"007", "012", " 01"}
    a, b = rows["007"], rows["012"]
    assert (a.n, a.x, a.d, a.t, a.b, float(a.m)) == (12, 1000.0, dt.date(2022, 1, 5), dt.datetime(2022, 1, 5, 7, 8, 9), True, 12.3)
    assert b[1:] == (None,) * 6 and rows[" 01"].x is None and rows[" 01"].d == dt.date(2022, 1, 5)
    reasons = sorted(tuple(r.reasons) for r in loaded.rejected.collect())
    assert reasons == [("code: longer than 4",), ("code: missing",), ("n: not smallint",),
                       ("n: not smallint", "x: not double", "d: not date", "b: not boolean", "m: not decimal(5,1)"), ("record: wrong number of columns",)]
    assert all(r.table_name == "T" and r.record.startswith("{") for r in loaded.rejected.collect())


def test_rows_and_rejects_are_counted_in_one_short_pass(spark, tmp_path):
    # 40 columns of all kinds: one scan, and no method too long for the JIT
    schema = layers.declared(", ".join(f"a{i} int, b{i} varchar(3), c{i} decimal(5,1), d{i} date, e{i} timestamp" for i in range(8)))
    good = ["7", "abc", "1.25", "2022/1/5", "2022-01-05 07:08:09"] * 8
    rows = [good, ["NA"] * 40, ["7.0", *good[1:]], ["7.5", *good[1:]], [*good[:39], "2022-01-05 25:00:00"], good[:39], [good[0], "abcd", *good[2:]]]
    (tmp_path / "T.csv").write_text("\n".join([",".join(f.name for f in schema.fields), *[",".join(r) for r in rows]]) + "\n")
    loaded = layers.read_typed(spark, str(tmp_path / "T.csv"), "T", schema)
    assert tuple(loaded.counts.first()) == (3, 4) == (loaded.rows.count(), loaded.rejected.count())
    assert sorted(r.reasons for r in loaded.rejected.collect()) == [["a0: not int"], ["b0: longer than 3"], ["e7: not timestamp_ntz"], ["record: wrong number of columns"]]
    plan = loaded.counts._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Scan csv") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = layers.read_typed(spark, str(tmp_path / "T.csv"), "T", schema).counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    judged = [line for line in stages.splitlines() if "AS _unfit" in line]
    assert judged and not any("*(" in line for line in judged)  # outside whole-stage code


def test_layer_query_reads_every_file_once(spark, tmp_path):
    from dwkit.plans import catalog

    tables = {"Carriers": spark.createDataFrame([("AA", "x"), (None, "y")], "code string, description string")}
    for t, schema in layers.LAYERS["reconciled"].items():
        layers.write_typed(tables.get(t, spark.createDataFrame([], schema)), str(tmp_path / f"{t}.csv"), schema)
    got = catalog.layer_counts("reconciled", layers.load_layer(spark, "reconciled", str(tmp_path)))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 7
    rows = {r.table_name: (r.layer, r.n_rows, r.n_rejected) for r in got.collect()}
    assert rows.pop("Carriers") == ("reconciled", 1, 1) and set(rows.values()) == {("reconciled", 0, 0)} and len(rows) == 6


def test_round_trip_and_missing_files(spark, tmp_path):
    schema = layers.LAYERS["reconciled"]["Carriers"]
    df = spark.createDataFrame([("007", " padded "), ("AA", None), ("B,", 'quo"te'), ("C", "")], "code string, description string")
    layers.write_typed(df, str(tmp_path / "Carriers.csv"), schema)
    got = layers.load_layer(spark, "reconciled", str(tmp_path))
    assert set(got) == {"Carriers"}
    assert sorted(map(tuple, got["Carriers"].rows.collect()), key=str) == sorted([("007", " padded "), ("AA", None), ("B,", 'quo"te'), ("C", None)], key=str)
    with pytest.raises(ValueError):
        layers.load_layer(spark, "no such layer", str(tmp_path))


def test_dictionary_has_exact_counts_without_expand(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", -0.0), (2, None, None)], "flight_id long, origin string, distance double")
    got = profile.column_profile(layers.described(df).select("origin", "distance", "flight_id"))
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {r.column_name: r for r in got.collect()}
    assert [rows[c].n_unique for c in ("flight_id", "origin", "distance")] == [2, 1, 1] and rows["origin"].n_null == 1
    assert rows["origin"].description == layers.GLOSSARY["ORIGIN"] and rows["flight_id"].description == "N/A"
    empty = profile.column_profile(df.limit(0)).collect()
    assert all(r.n_unique == 0 and r.sample is None for r in empty)


def test_contract_versions_and_drift(spark, tmp_path):
    store = ContractStore(spark, str(tmp_path / "contracts"))
    with pytest.raises(ValueError):
        store.load()
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, None)], "k long, v string")
    assert store.save({"t": a}) == 1 and store.save({"t": a.where("v IS NOT NULL")}) == 2 and store.versions() == [1, 2]
    assert store.load(1).where("column_name = 'k'").first().n_rows == 3 and store.load().first().n_keys == 2
    assert store.drift({"t": a}, 1).count() == 0
    changed = a.select(F.col("v"), F.col("k").cast("int"), F.lit(1).alias("w"))
    got = {(r.column_name, r.change): (r.stored, r.found) for r in store.drift({"t": changed}, 2, {"t": "k"}).collect()}
    assert got == {("k", "type"): ("bigint", "int"), ("k", "position"): ("1", "2"), ("v", "position"): ("2", "1"), ("v", "nulls"): ("false", "true"),
                   ("w", "column new"): (None, "int"), ("k", "rows"): ("2", "3")}


@pytest.mark.parametrize("text", ["2022-01-05", "20220105", "2022-1-5", "5 Jan 2022", "05 jan 2022", "5-JAN-2022", "5 January 2022", "Jan 5, 2022", "January 5, 2022",
                                  "01/05/2022", "1/5/2022", "2022/01/05", "2022/1/5", "2022-1-5 7:08", "2022-01-05T07:08:09", "20220105070809", " 2022-01-05 "])
def test_dates_read_in_every_form(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(parse_date("t")).first()[0] == dt.date(2022, 1, 5)


def test_formats_left_out_by_their_separators_read_nothing(spark):
    # every format against texts with and without its separators: the same value as trying all formats
    from dwkit.functions.exprs import DATE_FORMATS, DATE_SHAPES, parse_timestamp

    days = ["2022-01-05", "2022/01/05", "01/05/2022", "2022-1-5", "20220105", "5 Jan 2022", "+12022-01-05", "2022-02-30", "not-a-date", "1/5/2022", "-", "", "12345"]
    times = ["", " ", "07:08", " 07:08", " 07:08:09", " 07:08:09.5", " 07:08:09.123456789", "T07:08", "T07:08:09", "T07:08:09.25", "T07:08:09Z", "T07:08:09+02:00", " 25:00", "T", ":", " 7:08:09", ".5"]
    df = spark.createDataFrame([(f"{pad}{d}{t}",) for d in days for t in times for pad in ("", " ")] + [(None,)], "t string")
    trimmed, by_shape = F.trim("t"), None
    for pattern, form in DATE_SHAPES:
        value = F.try_to_timestamp(F.initcap(trimmed) if "MMM" in form else trimmed, F.lit(form))
        by_shape = F.when(trimmed.rlike(pattern), value) if by_shape is None else by_shape.when(trimmed.rlike(pattern), value)
    every = F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f)) for f in DATE_FORMATS], by_shape)
    got = df.select("t", parse_timestamp("t").alias("a"), every.alias("b"))
    assert got.where("NOT a <=> b").collect() == [] and got.where("a IS NOT NULL").count() > 60
    alone = df.select("t", *[parse_timestamp("t", [f], []).alias(f"a{i}") for i, f in enumerate(DATE_FORMATS)],
                      *[F.try_to_timestamp(trimmed, F.lit(f)).alias(f"b{i}") for i, f in enumerate(DATE_FORMATS)])
    assert alone.where(" OR ".join(f"NOT a{i} <=> b{i}" for i in range(len(DATE_FORMATS)))).collect() == []


def test_unreadable_dates_are_null(spark):
    bad = ["2022-02-30", "20221305", "5 Foo 2022", "2022-13-1", "today", "", "12345678901"]
    assert spark.createDataFrame([(t,) for t in bad], "t string").where(parse_date("t").isNotNull()).count() == 0


def test_load_gate_writes_both_sides_once(spark, tmp_path):
    fact = spark.createDataFrame([(1, 1, 1), (2, None, 1), (3, None, None)], "id long, a long, b long")
    gate = star.load_gate(fact, str(tmp_path / "gate"), ["a", "b"])
    assert [r.id for r in gate.loaded.collect()] == [1] and gate.loaded.columns == fact.columns
    assert {r.id: r.FAILING_KEYS for r in gate.quarantined.collect()} == {2: ["a"], 3: ["a", "b"]}
    assert gate.counters == {"rows": 3, "loaded": 1, "a": 2, "b": 1}
    none = star.load_gate(fact.limit(0), str(tmp_path / "none"), ["a", "b"])
    assert none.loaded.count() == none.quarantined.count() == 0 and none.counters["rows"] == 0
    dim = star.with_unknown_row(spark.createDataFrame([(5, "x")], "id int, name string"), "id")
    assert {(r.id, r.name) for r in dim.collect()} == {(5, "x"), (-1, None)}
