"""C11 against brute force and DuckDB; statistics."""

import itertools
import math

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from dwkit.operators import fuzzy, iforest, missing, outliers, profile


WORDS = ["red plate", "red plat", "rd plate", "blue bolt", "blue bot", "green ring", "green rings", None, "", "x"]
TYPES = ["SMALL", "SMALL", "SMAL", "LARGE", None]


def fixture(spark):
    rows = []
    for i in range(90):
        rows.append((i, f"B{i % 3}", WORDS[i % len(WORDS)], TYPES[(i // 3) % len(TYPES)]))
    return spark.createDataFrame(rows, "k long, blk string, name string, typ string"), rows


def test_jaro_winkler_matches_duckdb():
    con = duckdb.connect()
    vals = [w for w in WORDS if w] + ["MARTHA", "MARHTA", "DIXON", "DICKSONX", "abc", "cba"]
    for a, b in itertools.product(vals, vals):
        ref = con.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(fuzzy.jaro_winkler(a, b) - ref) < 1e-12, (a, b)


def brute(rows, thr=1.75):
    out = set()
    for a, b in itertools.combinations(rows, 2):
        if a[1] != b[1]:
            continue
        s = fuzzy.jaro_winkler(a[2], b[2]) + fuzzy.jaro_winkler(a[3], b[3])
        if s > thr:
            out.add((min(a[0], b[0]), max(a[0], b[0]), round(s, 9)))
    return out


def test_near_duplicates_equal_brute_force_and_tiling(spark):
    df, rows = fixture(spark)
    exp = brute(rows)
    for tile in (512, 2):  # tile_size 2 forces many tiles per block (the skew path)
        got = {(r.k_1, r.k_2, round(r.Score, 9)) for r in fuzzy.near_duplicates(df, "k", "blk", ["name", "typ"],
                                                                                tile_size=tile).collect()}
        assert got == exp


def test_chi2_yates_and_pvalue(spark):
    # 2x2: group x missing flag; Yates applies
    rows = [("a", None)] * 10 + [("a", 1.0)] * 30 + [("b", None)] * 20 + [("b", 1.0)] * 20
    df = spark.createDataFrame(rows, "g string, v double")
    r = missing.chi2_statistic(df, "v", "g").first()
    o = [[30, 10], [20, 20]]
    n = 80
    rs, cs = [40, 40], [50, 30]
    stat = sum((max(abs(o[i][j] - rs[i] * cs[j] / n) - 0.5, 0)) ** 2 / (rs[i] * cs[j] / n) for i in range(2) for j in range(2))
    assert r.dof == 1 and abs(r.chi2 - round(stat, 4)) < 1e-9
    assert abs(missing.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(missing.chi2_sf(11.0705, 5) - 0.05) < 1e-5
    t = missing.mcar_chi2_test(df, "v", "g")
    assert t["verdict"] in ("Reject MCAR (MAR evidence)", "Cannot reject MCAR")


def test_missing_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0), (3.0, 1.0)], "t double, f double")
    r = missing.missing_correlation(df, "t", ["f"]).first()
    assert r.correlation_with_missingness is None


def test_missingness_summary_bands(spark):
    df = spark.createDataFrame([(i, None if i < 3 else 1.0, 1) for i in range(100)], "k int, v double, c int")
    rows = {r.column_name: r for r in profile.missingness_summary(df).collect()}
    assert set(rows) == {"v"} and rows["v"].missing_pct == 3.0 and rows["v"].status == "low (1-5%)"


def test_discover_fd(spark):
    df = spark.createDataFrame([(1, "a", "x", None), (2, "a", "x", None), (3, "b", "y", None), (4, "b", "y", 1)],
                               "id int, g string, h string, n int")
    got = {(r.determinant, r.dependent) for r in profile.discover_fd(df).collect()}
    assert ("g", "h") in got and ("h", "g") in got and ("id", "g") in got
    assert ("g", "n") in got        # one group all null, the other has one value
    assert ("n", "g") not in got    # n has a single value: below min_support


def test_outliers_iqr_modz_votes(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(i, v, 5.0) for i, v in enumerate(vals)], "id long, v double, c double")
    det = outliers.run_outliers(df, "t", {"v": 1.5, "c": 1.5}, ["v", "c"])
    flags = {r.id: (r.IQR_v, r.ModZ_v) for r in det.df.collect()}
    s = pd.Series(vals)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert flags[4][0] == (100.0 > q3 + 1.5 * (q3 - q1)) and flags[5] == (False, False)
    summ = {(r.method, r.column_name) for r in det.summary().collect()}
    assert ("Modified Z-score (t=3.5)", "c") not in summ   # MAD = 0 -> skipped
    assert det.flagged_rows(2).count() == 1


def test_isolation_forest_share(spark):
    df = spark.range(2000).select("id", (F.rand(1) * 10).alias("a"), (F.rand(2) * 10).alias("b"))
    df = df.withColumn("a", F.when(F.col("id") < 20, F.col("a") + 100).otherwise(F.col("a")))
    out = iforest.isolation_forest(df, "id", ["a", "b"], contamination=0.02)
    share = out.where("IsoForest_Outlier").count() / 2000
    assert abs(share - 0.02) <= 0.005
    top = {r.id for r in out.orderBy(F.col("anomaly_score").desc()).limit(20).collect()}
    assert len(top & set(range(20))) >= 15
    assert math.isclose(iforest.c_factor(2), 1.0)


def test_exact_quantiles_of_groups(spark):
    from dwkit.operators.quantiles import exact_quantiles, quantile_row

    rows = [(g, None if (i % 7 == 0) else float((i * 37) % 101)) for i in range(400) for g in (["a"] * 3 + ["b", None])[i % 5:i % 5 + 1]]
    rows += [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r.g: tuple(r[1:]) for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for g in ("a", "b", None):
        s = pd.Series([v for k, v in rows if k == g])
        assert all(abs(x - s.quantile(q)) < 1e-9 for x, q in zip(got[g], qs)), g
    assert got["empty"] == (None,) * 5  # a group without values stays, with nulls
    s = pd.Series([v for _, v in rows])
    one = quantile_row(df, {"m": ("v", 0.5), "p": ("v", 0.9)}).first()
    assert abs(one.m - s.quantile(0.5)) < 1e-9 and abs(one.p - s.quantile(0.9)) < 1e-9


def test_exact_quantiles_with_narrow_brackets(spark):
    """Enough rows for the approximate pass to bracket: ties, a hot value, several columns."""
    from pyspark.sql import functions as F

    from dwkit.operators.quantiles import quantile_row

    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % n) / 10.0).alias("a"),
                               F.sqrt("id").alias("b"))
    pdf = df.toPandas()
    specs = {f"{c}{i}": (c, q) for c in "ab" for i, q in enumerate((0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0))}
    row = quantile_row(df, specs).first()
    assert all(abs(row[k] - pdf[c].quantile(q)) < 1e-9 for k, (c, q) in specs.items())


def test_statistics_of_large_magnitudes(spark):
    from pyspark.sql import functions as F

    from dwkit.operators import missing as M

    rows = [(1.7e15 + i, None if i >= 6 else 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = M.missing_correlation(df, "y", ["x"]).first()[1]
    s = pd.DataFrame(rows, columns=["x", "y"])
    assert abs(got - round((s.x - 1.7e15).corr(s.y.isna().astype(float)), 4)) < 1e-9
    wide = spark.range(200).select(*[F.when((F.col("id") * (i + 3)) % 7 > 2, 1).alias(f"c{i}") for i in range(40)], F.lit(1).alias("full"))
    m = {(r.col_a, r.col_b): r.corr for r in M.comissing_matrix(wide, wide.columns).collect()}
    p = wide.toPandas().isna().astype(float).corr()
    assert len(m) == 41 * 41 and m["full", "c0"] is None and m["c39", "c0"] is None
    assert all(abs(m[a, b] - p.loc[a, b]) < 1e-9 for a in ("c0", "c7") for b in ("c1", "c38", "c0"))
    assert abs(M.chi2_sf(1e8, 10**8) - 0.5) < 1e-4 and abs(M.chi2_sf(1e10, 10**10) - 0.5) < 1e-4
    assert abs(M.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9 and abs(M.chi2_sf(20000, 20000) - 0.4981) < 1e-3


def test_forest_votes_with_the_other_methods(spark):
    import random

    from dwkit.operators import outliers as O

    rnd = random.Random(3)
    rows = [(i, rnd.gauss(0, 1) + (40 if i < 10 else 0), rnd.gauss(0, 1) + (40 if i < 10 else 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    det = O.run_outliers(df, "t", {"a": 1.5}, ["a"], forest=["a", "b"], key="id", contamination=0.02)
    top = {r.id for r in det.flagged_rows(3).collect()}
    assert top >= set(range(10)) and len(top) <= 20
    s = {r.method.split(" ")[0]: (r.column_name, r.n_flagged) for r in det.summary().collect()}
    assert len(s) == 3 and s["Isolation"][0] == "a, b" and 15 <= s["Isolation"][1] <= 20


def test_similarity_bound_is_a_bound():
    import random

    from dwkit.operators import fuzzy

    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcd é") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    bound = fuzzy._bound(words, words)
    assert all(fuzzy.jaro_winkler(a, b) <= bound[i, j] + 1e-12 for i, a in enumerate(words) for j, b in enumerate(words))


def test_dates_of_any_type(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from dwkit.functions import exprs as X
    from dwkit.operators import clean as C

    text = ["2022-01-05", "2022-01-05T10:00:00", "2022-01-05 10:00:00.5", "01/05/2022", "2022/01/05", "2022-01-05 10:00:00.123456", "nope", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in text], "t string").select(X.parse_date("t")).collect()]
    assert got == [dt.date(2022, 1, 5)] * 6 + [None] * 2
    flights = spark.createDataFrame([(1, "JFK", dt.datetime(2022, 1, 5, 7, 30, 0, 250000), 7, 7)], "id int, origin string, fl_date timestamp, dep_hour int, weather_observation_id int")
    obs = spark.createDataFrame([(7, "JFK", dt.date(2022, 1, 5), 7)], "obs_id int, origin_airport string, obs_date date, obs_hour int")
    out = C.fix_weather_observation_fk(flights, obs, "origin", "fl_date", "dep_hour", "weather_observation_id", "origin_airport", "obs_date", "obs_hour", "obs_id")
    assert out.first().weather_observation_id == 7
    from dwkit.functions import rules as R
    assert flights.select(R.parses_as_date()(F.col("fl_date"))).first()[0]


def test_csv_with_missing_value_tokens(spark, tmp_path):
    from dwkit.sources import io as IO

    (tmp_path / "t.csv").write_text("a,b,c,d\n1,1.5,x,NA\nNA,#N/A,None,\n3,2,NULL,nan\n")
    (tmp_path / "note.txt").write_text("no table")
    t = IO.load_tables(spark, str(tmp_path))
    assert list(t) == ["t"]
    assert [f.dataType.simpleString() for f in t["t"].schema.fields] == ["bigint", "double", "string", "string"]
    assert sorted(map(str, map(tuple, t["t"].collect()))) == sorted(["(1, 1.5, 'x', None)", "(None, None, None, None)", "(3, 2.0, None, None)"])


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from dwkit.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda k: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d)))


def test_near_duplicates_in_short_form(spark):
    df, rows = fixture(spark)
    rows = rows + [(1000 + i, "B0", WORDS[0], TYPES[0]) for i in range(300)] + [(2000, None, WORDS[0], TYPES[0]), (2001, "B0", None, TYPES[0])]
    df = spark.createDataFrame(rows, "k long, blk string, name string, typ string")
    short, members = fuzzy.near_duplicate_profiles(df, "k", "blk", ["name", "typ"], tile_size=2)
    pairs, of = short.collect(), {r.k: r.profile for r in members.collect()}
    assert short.count() < 200 and 2000 not in of  # 300 equal records are one profile; no block, no pair
    exp = brute([r for r in rows if r[1]])
    mates = {}
    for k, p in of.items():
        mates.setdefault(p, []).append(k)
    got = set()
    for r in pairs:
        assert r.n_1 == len(mates[r.k_1]) and r.n_2 == len(mates[r.k_2])
        pick = itertools.combinations(mates[r.k_1], 2) if r.k_1 == r.k_2 else itertools.product(mates[r.k_1], mates[r.k_2])
        got |= {(min(a, b), max(a, b), round(r.Score, 9)) for a, b in pick}
    assert got == exp


def test_record_pairs_are_dealt_evenly(spark):
    # one pair of profiles, 90,000 record pairs across and 89,700 within: no task may write most of them
    rows = [(i, "B0", WORDS[i % 2], TYPES[0]) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, blk string, name string, typ string")
    out = fuzzy.near_duplicates(df, "k", "blk", ["name", "typ"], chunk=30, task_pairs=20_000)
    got = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in got) == 600 * 599 // 2 and max(r.n for r in got) < 60_000
    assert out.select("k_1", "k_2").distinct().count() == 600 * 599 // 2 and out.where("k_1 >= k_2").count() == 0


def test_record_pairs_of_repeated_and_null_keys(spark):
    # equal keys and null keys pair across profiles, never within one
    rows = [(k, "B0", w, TYPES[0]) for k in (1, 2, 2, 3, 4, 5, None, None) for w in WORDS[:2]]
    df = spark.createDataFrame(rows, "k long, blk string, name string, typ string")
    s = fuzzy.jaro_winkler(WORDS[0], WORDS[1]) + 1
    assert s > 1.75
    for chunk in (512, 2):
        got = fuzzy.near_duplicates(df, "k", "blk", ["name", "typ"], chunk=chunk).collect()
        within, across = [r for r in got if r.name_1 == r.name_2], [r for r in got if r.name_1 != r.name_2]
        keys = [1, 2, 2, 3, 4, 5]
        assert sorted((r.k_1, r.k_2) for r in within) == sorted(2 * [(a, b) for a, b in itertools.product(keys, keys) if a < b])
        assert len(across) == 64 and sum(r.k_1 is None or r.k_2 is None for r in across) == 64 - 36
        assert sorted((r.k_1, r.k_2) for r in across if None not in (r.k_1, r.k_2)) == sorted((min(p), max(p)) for p in itertools.product(keys, keys))


def test_scores_are_rounded_for_pairs_of_profiles(spark, tmp_path):
    # the result's places are a matter of the few pairs of profiles, not of every pair of records
    import re

    from dwkit.plans import catalog

    part = spark.range(60).select(F.col("id").alias("p_partkey"), F.lit("B0").alias("p_brand"), F.lit("red plate").alias("p_name"), F.lit("SMALL").alias("p_type"))
    part.write.parquet(str(tmp_path / "part.parquet"))
    out = catalog.QUERIES["C11_fuzzy_duplicates"](spark, str(tmp_path))
    assert not re.search(r"\bround\(", out._jdf.queryExecution().optimizedPlan().toString())
    typos = [i % 9 == 0 for i in range(60)]
    names = ["rd plate" if t else "red plate" for t in typos]
    got = {(r.p_partkey_1, r.p_partkey_2): r.Score for r in out.collect()}
    assert got == {(a, b): round(fuzzy.jaro_winkler(names[a], names[b]) + 1, 4) for a, b in itertools.combinations(range(60), 2)}
    df, rows = fixture(spark)
    exact = {(r.k_1, r.k_2): r.Score for r in fuzzy.near_duplicates(df, "k", "blk", ["name", "typ"]).collect()}
    assert any(s != round(s, 4) for s in exact.values())  # without digits the scores stay as they are


def test_value_index_costs_values_not_profiles(spark):
    # 40 names x 40 kinds in one block: 1,600 profiles, 40 values a feature
    df = spark.range(1600).select("id", F.lit("hot").alias("blk"), F.concat(F.lit("name "), F.chr(F.col("id") % 40 + 65), F.chr(F.col("id") % 40 * 7 % 26 + 97)).alias("name"),
                                  F.concat(F.chr(F.floor(F.col("id") / 40) % 26 + 97), F.lit(" kind "), F.floor(F.col("id") / 40)).alias("typ"))
    recs = fuzzy._records(df, "id", "blk", ["name", "typ"])
    prof = recs.groupBy("_pid", "_blk", "name", "typ").agg(F.count(F.lit(1)).alias("_n"))
    similar = fuzzy.similar_values(prof, ["name", "typ"], 0.75)
    assert prof.count() == 1600 and similar.count() <= 2 * 40 * 40
    one = fuzzy.near_duplicates(df, "id", None, ["name"], threshold=0.85)
    exp = sum(fuzzy.jaro_winkler(a, b) > 0.85 for a, b in itertools.combinations([r.name for r in df.collect()], 2))
    assert one.count() == exp
