"""Value-repair and label expressions on hand-written edge rows."""

import pandas as pd
from pyspark.sql import functions as F

from dwkit.functions import exprs as X


def col(spark, values, t="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {t}")


def run(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_title_case_matches_python(spark):
    vals = ["  new york, NY ", "st. louis 2nd", "o'hare/ft worth", None, "\tx-ray\t", "NATION_1"]
    got = run(col(spark, vals), X.title_case(X.strip("v")))
    assert got == [None if v is None else v.strip().title() for v in vals]


def test_standardize_upper_and_nulls(spark):
    got = run(col(spark, [" ab ", None]), X.standardize_string("v", upper=True))
    assert got == ["AB", None]


def test_parse_dates(spark):
    vals = ["2022-02-30", "2022-02-03 10:00:00", "text", None, "2022-02-03"]
    got = run(col(spark, vals), X.parse_and_format_date("v"))
    assert got == [None, "2022-02-03", None, None, "2022-02-03"]


def test_patterns_sets_ranges(spark):
    df = col(spark, ["N123AB", "N1", "X12345", None])
    assert run(df, X.null_unless_match("v", r"^N[A-Z0-9]{2,5}$")) == ["N123AB", None, None, None]
    nums = col(spark, [1.0, 5.0, -1.0, None], "double")
    assert run(nums, X.null_outside_range("v", 0, 2)) == [1.0, None, None, None]
    assert run(nums, X.null_unless_in("v", [1.0, 5.0])) == [1.0, 5.0, None, None]


def test_snap_to_domain_ties_and_nulls(spark):
    df = col(spark, [0.5, 9.0, None, 2.4, 3.5], "double")
    assert run(df, X.snap_to_domain("v", [0, 1, 2, 3, 4])) == [0.0, 4.0, None, 2.0, 3.0]


def test_dew_gust_cloud(spark):
    df = spark.createDataFrame([(0, 10.0, 12.0), (1, 10.0, 10.0), (2, None, 5.0), (3, None, None)],
                               "i int, t double, d double")
    t, d = X.dew_point_swap("t", "d")
    rows = df.orderBy("i").select(t, d).collect()
    assert [tuple(r) for r in rows] == [(12.0, 10.0), (10.0, 10.0), (None, 5.0), (None, None)]
    g = spark.createDataFrame([(0, 10.0, 8.0), (1, None, 8.0), (2, 5.0, 9.0)], "i int, s double, g double")
    assert run(g, X.wind_gust_floor("s", "g")) == [10.0, 8.0, 9.0]
    c = spark.createDataFrame([(0, 0.0, None, 10000.0), (1, 0.0, 1.0, None), (2, 0.0, 0.0, 20000.0), (3, 2.0, 1.0, 5.0)],
                              "i int, c double, f double, l double")
    assert run(c, X.cloud_cover_fix("c", ["f"], "l")) == [1.0, 1.0, 0.0, 2.0]


def test_clean_city(spark):
    df = spark.createDataFrame([(0, "Petersburg, Ak", "Alaska", "AK"), (1, "Washington, D.C.", "District", "DC"),
                                (2, "Plain", "X", "XX"), (3, "A, B, Alaska", "Alaska", "AK"), (4, None, "X", "X")],
                               "i int, c string, s string, k string")
    assert run(df, X.clean_city("c", F.col("s"), F.col("k"))) == ["Petersburg", "Washington", "Plain", "A, B", None]


def test_time_band_boundaries(spark):
    hours = [0, 3, 4, 7, 8, 11, 12, 15, 16, 19, 20, 23]
    got = run(col(spark, hours, "int"), X.time_band("v"))
    assert got == ["Night", "Night", "Early Morning", "Early Morning", "Morning", "Morning", "Afternoon",
                   "Afternoon", "Evening", "Evening", "Late Evening", "Late Evening"]


def test_buckets(spark):
    vis = col(spark, [0.0, 2.0, 2.5, 10.0, 10.5, None, -1.0], "double")
    assert run(vis, X.visibility_bucket("v")) == ["0 mi", "0-2 mi", "2-4 mi", "8-10 mi", ">10 mi", ">10 mi", "0-2 mi"]
    assert run(vis, X.visibility_bucket("v", strict_null=True))[5] is None
    age = col(spark, [5, 6, 15, 16, 30, 31], "int")
    assert run(age, X.age_bucket("v")) == ["0-5 yr", "6-15 yr", "6-15 yr", "16-30 yr", "16-30 yr", "31+ yr"]


def test_cancelled_filter_null_passes(spark):
    df = col(spark, [0, 1, None], "int")
    assert df.where(X.not_cancelled_filter(F.col("v"))).count() == 2


def test_cancelled_air_time(spark):
    df = spark.createDataFrame([(0, None, 5.0), (1, 1, 5.0), (2, 1, 0.0), (3, 0, 5.0)], "i int, c int, a double")
    assert run(df, X.cancelled_air_time("c", "a")) == [5.0, None, 0.0, 5.0]


def test_title_case_pandas_parity(spark):
    vals = ["hello WORLD", "2nd ave", "mcdonald's"]
    got = run(col(spark, vals), X.title_case("v"))
    assert got == list(pd.Series(vals).str.title())
