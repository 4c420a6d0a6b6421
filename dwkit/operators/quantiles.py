"""Exact quantiles with linear interpolation (pandas ``quantile``, SQL ``quantile_cont``).

Spark's exact ``percentile`` merges a map of every distinct value into the one task that finishes
the aggregate.  Here two passes over the (once written, narrow) values do the same without a
global sort:

1. ``percentile_approx`` brackets each wanted position per group; its rank error has a
   guaranteed bound, so the exact value lies between the two bracket values.
2. Values below a bracket are only counted, those inside are counted by value (both with partial
   aggregation, so a hot group or value costs a row per task), those above are dropped.  A
   running count over the few values inside finds the two that the position falls on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ACCURACY = 10_000  # rank error of the approximate pass: at most n / ACCURACY


def _quantiles_long(values: DataFrame, group_cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(groups, _qi, _qval) for ``values`` (groups, _qv); every group appears, null without values."""
    gk = [f"_qg{i}" for i in range(len(group_cols))]
    base = values.select(*[F.col(c).alias(g) for c, g in zip(group_cols, gk)], "_qv")
    slack = 2.0 / ACCURACY
    probs = [p for q in qs for p in (max(float(q) - slack, 0.0), min(float(q) + slack, 1.0))]
    stats = base.groupBy(*gk).agg(
        F.count("_qv").alias("_qn"), F.min("_qv").alias("_qmin"), F.max("_qv").alias("_qmax"),
        F.percentile_approx("_qv", probs, ACCURACY).alias("_qa"))
    # a bracket must reach a few ranks beyond the position: below that many values it is the whole range
    few = F.col("_qn") * slack < 4
    wanted = F.array(*[F.struct(
        F.lit(i).alias("i"), (F.lit(float(q)) * (F.col("_qn") - 1)).alias("pos"),
        (F.col("_qmin") if q <= slack else F.when(few, F.col("_qmin")).otherwise(F.col("_qa")[2 * i])).alias("lo"),
        (F.col("_qmax") if q >= 1 - slack else F.when(few, F.col("_qmax")).otherwise(F.col("_qa")[2 * i + 1])).alias("hi"))
        for i, q in enumerate(qs)])
    brackets = materialize(stats.select(*gk, wanted.alias("_qw"), "_qn"), "quantile-brackets")
    bg = [f"_b{g}" for g in gk]
    cond = F.lit(True)
    for g, b in zip(gk, bg):
        cond = cond & F.col(g).eqNullSafe(F.col(b))
    side = brackets.select(*[F.col(g).alias(b) for g, b in zip(gk, bg)], "_qw")
    some = base.where(F.col("_qv").isNotNull())
    near = some.join(side, cond) if gk else some.crossJoin(F.broadcast(side))  # without groups: one row
    hits = near.select(*gk, "_qv", F.explode("_qw").alias("w")).where(F.col("_qv") <= F.col("w.hi"))
    counted = hits.select(*gk, "w.i", F.when(F.col("_qv") >= F.col("w.lo"), F.col("_qv")).alias("v")) \
        .groupBy(*gk, "i", "v").agg(F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy(*gk, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("c").over(run))
    pos = brackets.select(*[F.col(g).alias(b) for g, b in zip(gk, bg)], F.explode("_qw").alias("w")).select(*bg, F.col("w.i").alias("_bi"), "w.pos")
    cond = F.col("i") == F.col("_bi")
    for g, b in zip(gk, bg):
        cond = cond & F.col(g).eqNullSafe(F.col(b))
    # a value holds the ranks upto - c .. upto - 1
    held = pos.join(ranked, cond, "left")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto")), F.col("v")))

    picked = held.groupBy(*bg, F.col("_bi"), "pos").agg(at(F.floor("pos")).alias("lo"), at(F.ceil("pos")).alias("hi"))
    # same arithmetic as Spark's percentile aggregate
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        (F.ceil("pos") - F.col("pos")) * F.col("lo") + (F.col("pos") - F.floor("pos")) * F.col("hi"))
    return picked.select(*[F.col(b).alias(c) for c, b in zip(group_cols, bg)], F.col("_bi").alias("_qi"), value.alias("_qval"))


def exact_quantiles(df: DataFrame, value: Column | str, qs: Sequence[float], group_cols: Sequence[str] = (),
                    prefix: str = "_q") -> DataFrame:
    """One row per group (one row without groups): ``<prefix>0 .. <prefix>k`` for ``qs``.

    Nulls are ignored; a group (or table) without values gives nulls, a null key is a group.
    """
    v = F.col(value) if isinstance(value, str) else value
    values = materialize(df.select(*[F.col(g) for g in group_cols], v.cast("double").alias("_qv")), "quantile-values")
    found = _quantiles_long(values, group_cols, qs)
    picks = [F.max(F.when(F.col("_qi") == i, F.col("_qval"))).alias(f"{prefix}{i}") for i in range(len(qs))]
    return found.groupBy(*group_cols).agg(*picks)


def exact_median(df: DataFrame, value: Column | str, group_cols: Sequence[str] = (), name: str = "_median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], group_cols, prefix=name).withColumnRenamed(f"{name}0", name)


def quantile_row(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """One-row frame ``{alias: quantile q of column c}`` for ``specs = {alias: (c, q)}``.

    All columns share the two passes: a row becomes one (column, value) row per column.
    """
    cols = {}
    for alias, (c, q) in specs.items():
        cols.setdefault(c if isinstance(c, str) else str(c), (c, []))[1].append((alias, float(q)))
    qs = sorted({q for _, items in cols.values() for _, q in items})
    wide = df.select(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"_p{k}") for k, (c, _) in enumerate(cols.values())])
    long = materialize(wide, "quantile-values").select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("_qc"), F.col(f"_p{k}").alias("_qv")) for k in range(len(cols))])).alias("s")).select("s.*")
    found = _quantiles_long(long, ["_qc"], qs)
    return found.agg(*[F.max(F.when((F.col("_qc") == k) & (F.col("_qi") == qs.index(q)), F.col("_qval"))).alias(alias)
                       for k, (_, items) in enumerate(cols.values()) for alias, q in items])
