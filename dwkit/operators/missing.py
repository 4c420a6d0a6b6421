"""Missingness statistics.

Correlations come from merged co-moments or from whole counts; a constant column gives
null.  Test statistics are aggregates; only the final p-value of a (statistic, dof) pair is
evaluated on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quantiles import quantile_row


def _pearson(x: Column, y: Column) -> Column:
    """Pearson correlation from merged co-moments (no cancellation on large magnitudes); null when
    either side is constant."""
    x, y = x.cast("double"), y.cast("double")
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.when(spread > 0, spread))


def comissing_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of the null indicators of ``cols`` (all ordered pairs).

    Rows are counted by the set of columns that are null in them (partial aggregation), and only the
    pairs inside those sets are counted further.  The counts are whole numbers, so the
    correlation (n n_ab - n_a n_b) / sqrt(n_a (n - n_a) n_b (n - n_b)) has no cancellation.
    """
    cols = list(cols)
    absent = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(i)) for i, c in enumerate(cols)]))
    sets = df.groupBy(absent.alias("absent")).agg(F.count(F.lit(1)).alias("n"))
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"))
    single = sets.select("absent", "n", F.explode("absent").alias("i"))
    both = single.select("i", "n", F.explode("absent").alias("j")).groupBy("i", "j").agg(F.sum("n").alias("n_ab"))
    names = F.array(*[F.lit(c) for c in cols])
    every = total.select("n_all", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))).alias("i")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))))
    alone = both.where("i = j")
    pairs = (every.join(both, ["i", "j"], "left").join(alone.select("i", F.col("n_ab").alias("n_a")), "i", "left")
             .join(alone.select("j", F.col("n_ab").alias("n_b")), "j", "left").fillna(0, ["n_ab", "n_a", "n_b"]))
    n, n_a, n_b = (F.col(c).cast("double") for c in ("n_all", "n_a", "n_b"))
    spread = F.sqrt(n_a * (n - n_a)) * F.sqrt(n_b * (n - n_b))
    corr = F.when(spread > 0, (n * F.col("n_ab") - n_a * n_b) / spread)
    return pairs.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), corr.alias("corr"))


def columns_with_missing(df: DataFrame) -> list[str]:
    """Names of the columns holding a null (one aggregate, a few scalars to the driver)."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"_{i}"] > 0]


def missing_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation of the target's null flag with each median-filled feature (4 dp)."""
    meds = quantile_row(df, {f"_med{i}": (f, 0.5) for i, f in enumerate(features)})
    work = df.crossJoin(F.broadcast(meds))
    flag = F.col(target).isNull().cast("double")
    row = work.agg(*[_pearson(flag, F.coalesce(F.col(f).cast("double"), F.col(f"_med{i}"))).alias(f"_r{i}") for i, f in enumerate(features)])
    items = [F.struct(F.lit(f).alias("feature"), F.round(F.col(f"_r{i}"), 4).alias("correlation_with_missingness"))
             for i, f in enumerate(features)]
    return (row.select(F.explode(F.array(*items)).alias("s")).select("s.*")
               .orderBy(F.abs(F.col("correlation_with_missingness")).desc_nulls_last()))


def chi2_statistic(df: DataFrame, target: str, group: str, digits: int | None = 4) -> DataFrame:
    """D22 statistic: contingency of (group, null flag) with the null group as "MISSING".

    One row per group carries both cells (no cross product of categories);
    totals are a one-row broadcast.  Yates' correction applies when dof = 1.
    """
    g = F.coalesce(F.col(group).cast("string"), F.lit("MISSING"))
    flag = F.col(target).isNull()
    cells = df.groupBy(g.alias("_g")).agg(F.count_if(~flag).alias("_o0"), F.count_if(flag).alias("_o1"))
    tot = cells.agg(F.sum("_o0").alias("_c0"), F.sum("_o1").alias("_c1"), F.count(F.lit(1)).alias("_k"))
    tot = tot.withColumns({"_N": F.col("_c0") + F.col("_c1"),
                           "_cols": (F.col("_c0") > 0).cast("int") + (F.col("_c1") > 0).cast("int")})
    tot = tot.withColumn("_dof", (F.col("_k") - 1) * (F.col("_cols") - 1))
    w = cells.crossJoin(F.broadcast(tot))
    terms = []
    for j in (0, 1):
        e = (F.col("_o0") + F.col("_o1")) * F.col(f"_c{j}") / F.col("_N")
        diff = F.abs(F.col(f"_o{j}") - e)
        adj = F.when(F.col("_dof") == 1, F.greatest(diff - F.least(F.lit(0.5), diff), F.lit(0.0))).otherwise(diff)
        terms.append(F.when((F.col(f"_c{j}") > 0) & (e > 0), adj * adj / e).otherwise(F.lit(0.0)))
    chi2 = F.coalesce(F.sum(terms[0] + terms[1]), F.lit(0.0))
    return w.agg((F.round(chi2, digits) if digits is not None else chi2).alias("chi2"), F.first("_dof").cast("long").alias("dof"))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution, Q(dof / 2, x / 2).

    Below the mean the power series of the lower tail runs until it converges, above it the continued fraction
    of the upper tail; both take a few times sqrt(dof) terms.
    """
    if dof <= 0 or x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        total = term = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - total * front)
    tiny, b = 1e-300, z + 1 - a
    c, d = 1.0 / tiny, 1.0 / b
    h, i, step = d, 0, 0.0
    while abs(step - 1) > 1e-15:
        i += 1
        an, b = i * (a - i), b + 2
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = c * d
        h *= step
    return front * h


# Labels of the test results.
STARS = ((0.001, "***"), (0.01, "**"), (0.05, "*"))
REJECTED, KEPT = "Reject MCAR (MAR evidence)", "Cannot reject MCAR"
STRONG, WEAK = "MAR evidence (missingness predictable)", "Weak MAR signal"


def _graded(chi2: float, dof: int) -> dict:
    p = chi2_sf(float(chi2), int(dof))
    return {"chi2": round(float(chi2), 4), "p_value": round(p, 6), "dof": int(dof), "significance": next((mark for level, mark in STARS if p < level), "ns"),
            "verdict": REJECTED if p < STARS[-1][0] else KEPT}


def mcar_chi2_test(df: DataFrame, target: str, group: str) -> dict:
    """chi2, p-value (from the unrounded statistic), dof, stars and verdict at 0.05."""
    found = chi2_statistic(df, target, group, digits=None).first()
    return _graded(found["chi2"], found["dof"])


def mcar_tests(df: DataFrame, groups: dict[str, str]) -> dict[str, dict]:
    """D22 for many columns: {target: result} for {target: group column}; one aggregation per distinct group column,
    in which every group is one row with the null counts of all its targets."""
    out = {}
    for group in dict.fromkeys(groups.values()):
        targets = [t for t, g in groups.items() if g == group]
        cells = df.groupBy(F.coalesce(F.col(group).cast("string"), F.lit("MISSING")).alias("_g")).agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{t}`").isNull()).alias(f"_z{i}") for i, t in enumerate(targets)])
        long = cells.select("_n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_z{i}").alias("o1")) for i in range(len(targets))])).alias("s"))
        long = long.select("s.i", (F.col("_n") - F.col("s.o1")).alias("o0"), "s.o1")
        total = long.groupBy("i").agg(F.sum("o0").alias("c0"), F.sum("o1").alias("c1"), F.count(F.lit(1)).alias("k"))  # a row a target
        w = long.join(F.broadcast(total), "i").withColumns({"n": F.col("c0") + F.col("c1"), "dof": F.when((F.col("c0") > 0) & (F.col("c1") > 0), F.col("k") - 1).otherwise(0)})
        terms = F.lit(0.0)
        for j in (0, 1):
            e = (F.col("o0") + F.col("o1")) * F.col(f"c{j}") / F.col("n")
            off = F.abs(F.col(f"o{j}") - e)
            off = F.when(F.col("dof") == 1, off - F.least(F.lit(0.5), off)).otherwise(off)
            terms = terms + F.when(e > 0, off * off / e).otherwise(0.0)
        for r in w.groupBy("i").agg(F.sum(terms).alias("chi2"), F.first("dof").alias("dof")).collect():
            out[targets[r["i"]]] = _graded(r["chi2"], r["dof"])
    return out


#: Newton rounds of the logistic fits at most; they double the number of right digits each time.
ROUNDS = 25


def logistic_gains(df: DataFrame, predictors: dict[str, Sequence[str]]) -> dict[str, float | None]:
    """McFadden R2 of a logistic model of each target's null flag, {target: predictors}; None where the flag is constant.

    All fits advance together by iteratively re-weighted least squares: in a round every task adds up, for each
    target, the Gram matrix, score vector and likelihood of its rows, Spark adds the tasks, and the driver solves one small
    system a target.  The number of jobs depends on the rounds, not on the columns.  Predictors are median-filled and
    standardised; a collinear predictor gets the least-norm weight.
    """
    targets, names = list(predictors), list(dict.fromkeys(c for p in predictors.values() for c in p))
    if not targets:
        return {}
    medians = quantile_row(df, {f"_m{i}": (c, 0.5) for i, c in enumerate(names)})
    rows = df.crossJoin(F.broadcast(medians)).select(
        *[F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_m{i}"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(names)],
        *[F.col(f"`{t}`").isNull().alias(f"y{i}") for i, t in enumerate(targets)])
    rows = materialize(rows, "logistic-rows")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"a{i}") for i in range(len(names))], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(names))],
                     *[F.count_if(f"y{i}").alias(f"m{i}") for i in range(len(targets))]).first()
    center = np.array([stats[f"a{i}"] or 0.0 for i in range(len(names))])
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(len(names))])
    which = [[0, *[names.index(c) + 1 for c in predictors[t]]] for t in targets]
    beta, done = [np.zeros(len(w)) for w in which], [stats[f"m{i}"] in (0, stats["n"]) for i in range(len(targets))]
    level: list[float | None] = [None] * len(targets)

    def sums(open_: list[int], weights: list) -> dict[int, np.ndarray]:
        def run(batches):
            total = {i: np.zeros((len(which[i]) + 1) ** 2) for i in open_}
            for pdf in batches:
                x = (pdf[[f"x{i}" for i in range(len(names))]].to_numpy(dtype=float) - center) / scale
                x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                for i in open_:
                    z, y = x[:, which[i]], pdf[f"y{i}"].to_numpy(dtype=float)
                    m = z @ weights[i]
                    p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
                    k = len(which[i])
                    part = total[i].reshape(k + 1, k + 1)
                    part[:k, :k] += (z * (p * (1 - p))[:, None]).T @ z
                    part[:k, k] += z.T @ (y - p)
                    part[k, k] += float((y * m - np.logaddexp(0, m)).sum())
            yield pd.DataFrame([(i, j, v) for i, t in total.items() for j, v in enumerate(t.tolist())], columns=["i", "j", "v"])

        found = rows.mapInPandas(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
        return {int(i): g.sort_values("j")["v"].to_numpy().reshape(len(which[i]) + 1, -1) for i, g in found.groupby("i")}

    for _ in range(ROUNDS):
        open_ = [i for i in range(len(targets)) if not done[i]]
        if not open_:
            break
        for i, part in sums(open_, beta).items():
            k, ll = len(which[i]), float(part[-1, -1])
            done[i] = level[i] is not None and abs(ll - level[i]) <= 1e-10 * max(1.0, abs(ll))
            level[i] = ll
            if not done[i]:
                beta[i] = beta[i] + np.linalg.lstsq(part[:k, :k], part[:k, k], rcond=1e-12)[0]
    out: dict[str, float | None] = {}
    for i, t in enumerate(targets):
        n, m = stats["n"], stats[f"m{i}"]
        out[t] = None if level[i] is None else round(1 - level[i] / (m * math.log(m / n) + (n - m) * math.log(1 - m / n)), 4)
    return out


def mar_logistic_test(df: DataFrame, target: str, predictors: Sequence[str], min_missing: int = 10) -> dict:
    """Logistic fit of the null flag on median-filled predictors; McFadden R2 (see ``logistic_gains``)."""
    known = [c for c in predictors if c in df.columns]
    if not known or target not in df.columns:
        return {"error": "no such target, or none of the predictors"}
    missing = df.agg(F.count_if(F.col(target).isNull()).alias("m")).first()["m"]
    if missing < min_missing:
        return {"error": f"{missing} missing values, the fit needs {min_missing}"}
    r2 = logistic_gains(df, {target: known})[target]
    return {"pseudo_r2": r2, "predictors": known, "verdict": STRONG if (r2 or 0.0) > 0.05 else WEAK}


def classify_all(df: DataFrame, group_cols: Sequence[str] = (), predictors: Sequence[str] = (),
                 config: dict[str, dict] | None = None, min_missing: int = 10) -> DataFrame:
    """(column_name, mechanism, confidence, missing_pct, mcar_test, mar_pseudo_r2) of every column that holds a null.

    The chi-square and logistic tests of all columns run together.  ``config`` may name ``group_cols`` and
    ``predictors`` of single columns; of the group columns the first that exists counts.

    | predictable (R2 > 0.05) | MCAR rejected | mechanism | confidence |
    | --- | --- | --- | --- |
    | yes | any | MAR | R2 / 0.3, at most 1 |
    | no | no | MCAR | 0.7 |
    | no | yes | MNAR | 0.6 |
    """
    spark, config = df.sparkSession, config or {}
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    missing = {c: row[f"_{i}"] for i, c in enumerate(df.columns) if row[f"_{i}"] > 0}
    groups, fits = {}, {}
    for c in missing:
        own = config.get(c, {})
        if g := next((g for g in own.get("group_cols", group_cols) if g in df.columns), None):
            groups[c] = g
        if known := [p for p in own.get("predictors", predictors) if p in df.columns]:
            if missing[c] >= min_missing:
                fits[c] = known
    tests, gains = mcar_tests(df, groups), logistic_gains(df, fits)
    out = []
    for c, m in missing.items():
        verdict, r2 = tests.get(c, {}).get("verdict", KEPT), gains.get(c)
        if (r2 or 0.0) > 0.05:
            kind, confidence = "MAR", min(r2 / 0.3, 1.0)
        else:
            kind, confidence = ("MCAR", 0.7) if verdict == KEPT else ("MNAR", 0.6)
        out.append((c, kind, round(confidence, 2), round(m / row["n"] * 100, 2), verdict, r2))
    return spark.createDataFrame(out, "column_name string, mechanism string, confidence double, missing_pct double, mcar_test string, mar_pseudo_r2 double")


def classify_mechanism(df: DataFrame, target: str, group_cols: Sequence[str] | None = None,
                       predictors: Sequence[str] | None = None) -> dict:
    """D24 for one column: COMPLETE / MCAR / MAR / MNAR (see ``classify_all``)."""
    if target not in df.columns:
        return {"error": "no such target"}
    needed = list(dict.fromkeys([target, *(group_cols or []), *(predictors or [])]))
    found = classify_all(df.select(*[F.col(f"`{c}`") for c in needed if c in df.columns]), group_cols or (), predictors or ()).where(
        F.col("column_name") == target).first()
    if found is None:
        return {"mechanism": "COMPLETE", "confidence": 1.0, "missing_pct": 0.0}
    return {k: found[k] for k in ("mechanism", "confidence", "missing_pct", "mcar_test", "mar_pseudo_r2")}
