"""Schema contracts (H1-H4), loaders (A1, A2) and the driver contract on sf0.001."""

import duckdb
import pytest

from conftest import SF_SMALL
from dwkit.plans.contract import SchemaContract
from dwkit.sources import io as IO


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, v double")
    c = SchemaContract().register("t", df, pk="k")
    assert c.overall(c.checks("t", df)) == "PASS"
    changed = spark.createDataFrame([("a", 1, "2", 1), ("b", 1, "3", 2)], "s string, k int, v string, extra int")
    checks = {name: (st, msg) for name, st, msg in c.checks("t", changed, strict=True)}
    assert checks["extra_columns"][0] == "FAIL" and checks["column_order"][0] == "WARN"
    assert checks["dtype_changes"][0] == "WARN" and checks["pk_uniqueness"] == ("FAIL", "1 surplus rows")
    assert {n: s for n, s, _ in c.checks("t", changed, strict=False)}["extra_columns"] == "WARN"
    assert c.checks("other", df) == [("registration", "SKIP", "no contract")]
    with pytest.raises(AssertionError):
        c.assert_valid("t", changed)


def test_load_tables_skips_missing_and_validates_source(spark, tmp_path):
    tables = IO.load_tables(spark, {"region": f"{SF_SMALL}/region.parquet", "nope": str(tmp_path / "x.parquet")})
    assert list(tables) == ["region"]
    with pytest.raises(ValueError):
        IO.load_tables(spark, "unknown-layer")
    with pytest.raises(TypeError):
        IO.load_tables(spark, 42)
    assert IO.normalize_columns(tables["region"], "upper").columns == ["R_REGIONKEY", "R_NAME"]
    with pytest.raises(ValueError):
        IO.normalize_name("x", "weird")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


ORACLE_KEYS = ["D34_delay_by_state_month", "D9_run_dqa", "E3_interpolate_temporal", "C11_fuzzy_duplicates",
               "D26_audit_log", "K7_build_fact", "D16_discover_fd", "C3_null_cooccurrence"]


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_query_matches_oracle_sf0001(spark, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_SMALL)
    srows = sorted(tuple("NULL" if v is None else (f"{v:.3f}" if isinstance(v, float) else str(v)) for v in r)
                   for r in df.select(sorted(df.columns)).collect())
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in IO.DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    drows = sorted(tuple("NULL" if r[i] is None else (f"{r[i]:.3f}" if isinstance(r[i], float) else str(r[i]))
                         for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert srows == drows


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2022, 1), (2, 2022, 2)], "id int, YEAR int, MONTH int")
    paths = IO.write_layer({"fact": df, "dim": df.select("id")}, str(tmp_path), partition_by={"fact": ["YEAR", "MONTH"]})
    assert spark.read.parquet(paths["fact"]).count() == 2
    IO.write_table(df, str(tmp_path / "r.csv"), fmt="csv")
    back = IO.read_table(spark, str(tmp_path / "r.csv"), fmt="csv")
    assert sorted(r.id for r in back.collect()) == [1, 2]
    inv = {r.table_name: (r.n_rows, r.n_columns) for r in IO.table_inventory(paths and {"x": df}).collect()}
    assert inv == {"x": (2, 3)}


def test_table_set_matches_model():
    from dwkit.plans.contract import WAREHOUSE_TABLES, check_table_set

    check_table_set(list(reversed(WAREHOUSE_TABLES)))
    with pytest.raises(AssertionError):
        check_table_set(WAREHOUSE_TABLES[:-1] + ["EXTRA"])
