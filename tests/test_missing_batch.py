"""Batched missingness tests against direct computations, and the forest against a plain walk over its node table."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dwkit.operators import iforest, missing


def _newton(x, y):
    z = np.concatenate([np.ones((len(x), 1)), (x - x.mean(0)) / x.std(0)], axis=1)
    b = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        b += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (y - p))
    m, s = z @ b, y.mean()
    return 1 - (y * m - np.logaddexp(0, m)).sum() / (len(y) * (s * math.log(s) + (1 - s) * math.log(1 - s)))


@pytest.fixture(scope="module")
def holes(spark):
    df = spark.range(4000).select("id", (F.rand(1) * 10).alias("a"), (F.rand(2) * 5).alias("b"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("g"), F.rand(3).alias("u"))
    return df.select("id", "a", "b", "g", F.when(F.col("u") > 0.3, F.col("a")).alias("random"), F.when(F.col("u") * 10 > F.col("a"), F.col("b")).alias("by_a"),
                     F.when(F.col("g") == "x", F.col("u")).alias("by_g"), F.when(F.col("id") != 5, F.lit(1.0)).alias("one_hole"), F.lit(None).cast("double").alias("nothing"))


def test_all_columns_at_once_equal_single_fits(spark, holes):
    pdf = holes.toPandas()
    got = {r.column_name: r for r in missing.classify_all(holes, ["g"], ["a", "b"]).collect()}
    assert set(got) == {"random", "by_a", "by_g", "one_hole", "nothing"}
    for c in ("random", "by_a", "by_g"):
        assert abs(got[c].mar_pseudo_r2 - _newton(pdf[["a", "b"]].to_numpy(), pdf[c].isna().to_numpy(dtype=float))) < 1e-4
        assert got[c].mcar_test == missing.mcar_chi2_test(holes, c, "g")["verdict"]
    assert (got["random"].mechanism, got["by_a"].mechanism, got["by_g"].mechanism) == ("MCAR", "MAR", "MNAR")
    assert got["one_hole"].mar_pseudo_r2 is None and got["nothing"].mar_pseudo_r2 is None and got["nothing"].missing_pct == 100.0


def test_jobs_do_not_grow_with_the_columns(spark, holes):
    def jobs(n):
        df = holes.select("a", "b", "g", *[F.when((F.col("id") * (i + 3)) % 11 > 2, F.col("b")).alias(f"c{i}") for i in range(n)])
        spark.sparkContext.setJobGroup(f"classify-{n}", "")
        assert missing.classify_all(df, ["g"], ["a", "b"]).count() == n
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"classify-{n}"))
        spark.sparkContext.setJobGroup("default", "")
        return found
    assert jobs(40) <= jobs(2) + 6


def test_separable_and_collinear_predictors(spark):
    df = spark.range(400).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("twice"), F.when(F.col("id") > 200, F.lit(1.0)).alias("t"),
                                 F.lit(3.0).alias("same"), F.when(F.col("id") % 2 == 0, F.lit(1.0)).alias("s"))
    gains = missing.logistic_gains(df, {"t": ["a", "twice"], "s": ["same"]})
    assert gains["t"] > 0.99 and gains["s"] == 0.0
    assert missing.mar_logistic_test(df, "t", ["nowhere"]) == {"error": "no such target, or none of the predictors"}


def test_chi2_tail_without_a_switch():
    for dof in (7, 100, 10_000, 200_000, 5_000_000):
        z = [missing.chi2_sf(dof + d * math.sqrt(2 * dof), dof) for d in (-1, 0, 1, 3)]
        assert 1 > z[0] > z[1] > z[2] > z[3] > 0
        if dof >= 100:  # nearly normal there
            assert abs(z[1] - 0.5) < 0.03 and abs(z[0] - 0.84) < 0.03
    assert abs(missing.chi2_sf(10, 4) - math.exp(-5) * (1 + 5)) < 1e-12


def test_forest_scores_follow_from_the_node_table(spark):
    df = spark.range(700).select("id", (F.rand(5) * 9).alias("a"), (F.rand(6) * 3).alias("b")).withColumn("b", F.when(F.col("id") % 50 != 1, F.col("b")))
    rows = {r.id: r for r in iforest.isolation_forest(df, "id", ["a", "b"], n_trees=20, max_samples=64).collect()}
    again = {r.id: r for r in iforest.isolation_forest(df.repartition(7), "id", ["a", "b"], n_trees=20, max_samples=64).collect()}
    assert rows == again  # nothing depends on how rows are dealt to tasks
    med = df.agg(F.expr("percentile(b, 0.5)")).first()[0]
    x = df.select(F.col("id").alias("_key"), F.col("a").alias("_x0"), F.coalesce("b", F.lit(med)).alias("_x1"))
    nodes = {(r.tree, r.node): r for r in iforest.grow_forest(x, "_key", ["_x0", "_x1"], 700, 20, 64, 42).collect()}
    assert max(n for _, n in nodes) < 2 ** 7
    for r in x.where("_key % 97 = 3").collect():
        total = 0.0
        for t in range(20):
            n = nodes[t, 1]
            while n.feature >= 0:
                n = nodes[t, 2 * n.node + (r[1 + n.feature] >= n.split)]
            total += n.path
        assert abs(rows[r[0]].anomaly_score - 2 ** (-total / 20 / iforest.c_factor(64))) < 1e-8
    assert iforest.isolation_forest(df.limit(0), "id", ["a", "b"]).count() == 0
