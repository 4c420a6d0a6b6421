"""Window operators (E1-E6) on the fixture series and edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from dwkit.operators import windows as W

NAN = None


def series(spark, hours, values, station="S"):
    base = dt.date(2022, 1, 1)
    rows = [(i, station, base, h, v) for i, (h, v) in enumerate(zip(hours, values))]
    return spark.createDataFrame(rows, "id long, st string, d date, h int, v double")


def test_interpolation_reference_series(spark):
    hours = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 16, 17, 18]
    vals = [NAN, NAN, NAN, 5, NAN, NAN, NAN, NAN, NAN, 9, NAN, 3, NAN, NAN, NAN, NAN]
    exp = [NAN, 5, 5, 5, 5.667, 6.333, NAN, 7.667, 8.333, 9, 6, 3, 3, NAN, NAN, NAN]
    df = series(spark, hours, [None if v is None else float(v) for v in vals])
    out = W.interpolate_temporal(df, ["v"], ["st"], "d", "h", limit=2, max_gap_hours=3, row_id="id")
    got = [r.v for r in out.orderBy("id").collect()]
    assert [None if g is None else round(g, 3) for g in got] == exp


def test_interpolation_unsorted_and_single_time(spark):
    df = series(spark, [3, 0, 1], [None, 1.0, 3.0])
    out = W.interpolate_temporal(df, ["v"], ["st"], "d", "h", limit=None).orderBy("id").collect()
    assert [r.v for r in out] == [3.0, 1.0, 3.0]
    one = series(spark, [5], [None])
    assert W.interpolate_temporal(one, ["v"], ["st"], "d", "h").collect()[0].v is None


def test_interpolation_null_time_untouched(spark):
    rows = [(0, "S", dt.date(2022, 1, 1), 0, 1.0), (1, "S", None, 1, None), (2, "S", dt.date(2022, 1, 1), 2, 3.0),
            (3, "S", dt.date(2022, 1, 1), 1, None)]
    df = spark.createDataFrame(rows, "id long, st string, d date, h int, v double")
    out = {r.id: r.v for r in W.interpolate_temporal(df, ["v"], ["st"], "d", "h").collect()}
    assert out[1] is None and out[3] == 2.0


def test_dedup_and_duplicate_flag(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (1, "a", 2), (None, "b", 1), (None, "b", 2), (2, "c", 1)],
                               "k int, x string, o int")
    first = W.deduplicate(df, ["k", "x"], ["o"]).orderBy("x").collect()
    assert [(r.k, r.x, r.o) for r in first] == [(1, "a", 1), (None, "b", 1), (2, "c", 1)]
    joined = W.with_duplicate_flag(df, ["k"], "dup")
    # three copies of 1 and two nulls (nulls group together)
    assert joined.where("dup").count() == 5 and joined.count() == 6
    nulls_last = spark.createDataFrame([(1, None), (1, 2)], "k int, o int")
    assert W.deduplicate(nulls_last, ["k"], ["o"]).first().o == 2


def test_temporal_gaps(spark):
    base = dt.date(2022, 1, 1)
    rows = [("S", base, h) for h in [0, 1, 3, 3, 4, 9]]
    df = spark.createDataFrame(rows, "st string, d date, h int")
    gaps = W.detect_temporal_gaps(df.union(df.withColumn("st", F.lit("T"))), "d", "h", "st").where("st = 'S'").orderBy("gap_start").collect()
    assert [(g.gap_length_hours, g.gap_length_intervals) for g in gaps] == [(2.0, 2), (5.0, 5)]
    assert str(gaps[0].gap_start) == "2022-01-01 01:00:00"


def test_dense_ids_both_paths_agree(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    small = W.with_dense_id(df, ["g", "k"], "rid", bounded=True).collect()
    big = W.with_dense_id(df.repartition(7), ["g", "k"], "rid", bounded=False).collect()
    a = sorted((r.rid, r.g, r.k) for r in small)
    b = sorted((r.rid, r.g, r.k) for r in big)
    assert a == b
    assert [r[0] for r in a] == list(range(1, 5001))


def test_dense_ids_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    out = W.with_dense_id(df, ["x"], "id").orderBy("id").collect()
    assert [r.x for r in out] == ["a", "b", None]


def _interpolate_plain(rows, col, limit, max_gap):
    """Reference on plain rows (id, group, date, hour, v, w): {id: value}."""
    at = {"v": 4, "w": 5}[col]
    out, groups = {}, {}
    for r in rows:
        out[r[0]] = r[at]
        if r[2] is not None:
            groups.setdefault(r[1], []).append((((r[2] - dt.date(1970, 1, 1)).days * 24 + r[3]), r[0], r[at]))
    for g in groups.values():
        g.sort()
        known = [i for i, x in enumerate(g) if x[2] is not None]
        for i, (t, k, v) in enumerate(g):
            if v is not None or not known or len(g) < 2:
                continue
            p, n = max((j for j in known if j < i), default=None), min((j for j in known if j > i), default=None)
            if limit is not None and not ((p is not None and i - p <= limit) or (n is not None and n - i <= limit)):
                continue
            if max_gap is not None and len(known) >= 2 and min(abs(g[j][0] - t) for j in (p, n) if j is not None) > max_gap:
                continue
            if p is None or n is None:
                out[k] = g[n if p is None else p][2]
            else:
                out[k] = g[p][2] if g[n][0] == g[p][0] else g[p][2] + (g[n][2] - g[p][2]) * (t - g[p][0]) / (g[n][0] - g[p][0])
    return out


def test_segmented_interpolation_matches_plain(spark):
    import random

    rnd = random.Random(7)
    rows = []
    base = dt.date(2022, 1, 1)
    i = 0
    for st, n in [("HOT", 300), ("A", 40), (None, 30), ("B", 3), ("C", 1), ("NONE", 5)]:
        for h in sorted(rnd.sample(range(0, 2000), n)):
            v = None if st == "NONE" or rnd.random() < 0.45 else round(rnd.uniform(0, 50), 2)
            w = None if rnd.random() < 0.3 else float(h % 7)
            d = base + dt.timedelta(days=h // 24)
            rows.append((i, st, d if rnd.random() > 0.02 else None, h % 24, v, w))
            i += 1
    df = spark.createDataFrame(rows, "id long, st string, d date, h int, v double, w double").repartition(6)
    args = dict(cols=["v", "w"], date_col="d", hour_col="h", row_id="id")
    for groups, limit, gap, size in ((["st"], 2, 3, 17), (["st"], None, None, 5), ([], 2, 3, 17)):
        plain = rows if groups else [(r[0], "all", *r[2:]) for r in rows]
        got = {r.id: r for r in W.interpolate_temporal(df, group_cols=groups, limit=limit, max_gap_hours=gap, segment_rows=size, **args).collect()}
        assert len(got) == len(rows)
        for col in ("v", "w"):
            want = _interpolate_plain(plain, col, limit, gap)
            assert all((got[k][col] is None and x is None) or abs(got[k][col] - x) < 1e-9 for k, x in want.items()), (groups, limit, col)


def test_drop_materialized(spark):
    import os

    from dwkit.session import _WRITTEN, drop_materialized, materialize

    m = materialize(spark.range(10), "t")
    assert m.count() == 10
    path = _WRITTEN[-1]
    assert drop_materialized(spark) >= 1 and not _WRITTEN
    assert not os.path.exists(path.replace("file:", ""))
