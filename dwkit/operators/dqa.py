"""Data-quality scoring.

``run_dqa`` compiles a table's rules into **one aggregate** over the table
(completeness, validity, consistency, timeliness and accuracy counters side by
side) plus one partial-aggregated ``groupBy(keys).count()`` for uniqueness;
the two one-row results are combined and unpivoted into the scorecard.
Score = 1 - issues / total (0.0 for an empty table), rounded to 4 places;
status PASS >= 0.95, WARN >= 0.80, else FAIL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import parse_timestamp
from ..functions.rules import TableRules, compile_consistency, validity_invalid

# Wording of the report's details column.
MISSING, DUPLICATES, INVALID, VIOLATIONS = "Missing per column: {%s}", "Duplicate rows on %s: ", " invalid", " rows violate rules"
FUTURE, STALE, COMPARED, INACCURATE = "Future dates: ", " | Stale (>%dd): ", "%s vs %s (tol=%s): ", " inaccurate"
DIMENSIONS = ["Completeness", "Uniqueness", "Validity", "Consistency", "Timeliness", "Accuracy"]


def score(issues: Column, total: Column) -> Column:
    return F.round(F.when(total > 0, F.lit(1.0) - issues.cast("double") / total.cast("double"))
                   .otherwise(F.lit(0.0)), 4)


def status(score_col: Column) -> Column:
    return F.when(score_col >= 0.95, "PASS").when(score_col >= 0.80, "WARN").otherwise("FAIL")


def _py_list(cols: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{c}'" for c in cols) + "]"


def timeliness_flags(ts: Column, as_of: str, max_age_days: int, allow_future: bool) -> tuple[Column, Column]:
    """(stale, future).  Age is whole days (floor) between ``as_of`` and the value."""
    now = F.lit(as_of).cast("timestamp")
    t = ts.cast("timestamp")
    age_days = F.floor((F.unix_seconds(now) - F.unix_seconds(t)) / 86400)
    stale = F.coalesce(age_days > max_age_days, F.lit(False))
    future = F.lit(False) if allow_future else F.coalesce(t > now, F.lit(False))
    return stale, future


def _parse_ts(c: Column) -> Column:
    return parse_timestamp(c)


def quality_counters(df: DataFrame, rules: TableRules, refs: Mapping[str, DataFrame] | None = None,
                     as_of: str = "2024-02-01", max_age_days: int = 1825, allow_future: bool = False,
                     dims: Sequence[str] = DIMENSIONS) -> tuple[DataFrame, dict]:
    """The fused one-row aggregate of every counter, and the metadata to read it."""
    meta: dict = {"dims": []}
    work, cons = compile_consistency(df, rules.consistency, refs) if "Consistency" in dims and rules.consistency \
        else (df, {})
    aggs = [F.count(F.lit(1)).alias("_n")]
    if "Completeness" in dims:
        req = rules.req_cols or df.columns
        missing = [c for c in req if c not in df.columns]
        if missing:
            raise KeyError(f"required columns not in table: {missing}")
        meta["req"] = list(req)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_miss_{i}") for i, c in enumerate(req)]
        meta["dims"].append("Completeness")
    if "Uniqueness" in dims:
        meta["dims"].append("Uniqueness")
    if "Validity" in dims and rules.validity:
        inv = validity_invalid(df, rules.validity)
        meta["validity"] = list(inv)
        aggs += [F.count_if(v).alias(f"_inv_{i}") for i, v in enumerate(inv.values())]
        any_inv = F.lit(False)
        for v in inv.values():
            any_inv = any_inv | v
        aggs.append(F.count_if(any_inv).alias("_inv_any"))
        meta["dims"].append("Validity")
    if "Consistency" in dims and rules.consistency:
        ok = F.lit(True)
        for v in cons.values():
            ok = ok & v
        aggs.append(F.count_if(~ok).alias("_incons"))
        meta["dims"].append("Consistency")
    if "Timeliness" in dims and rules.time_col and rules.time_col in df.columns:
        stale, future = timeliness_flags(_parse_ts(F.col(rules.time_col)), as_of, max_age_days, allow_future)
        aggs += [F.count_if(stale).alias("_stale"), F.count_if(future).alias("_future"),
                 F.count_if(stale | future).alias("_late")]
        meta["dims"].append("Timeliness")
        meta["max_age"] = max_age_days
    if "Accuracy" in dims and rules.accuracy:
        acc = {}
        for c, spec in rules.accuracy.items():
            ref, tol = spec["reference"], spec.get("tolerance", 0)
            if c in df.columns and ref in df.columns:
                acc[(c, ref, tol)] = F.coalesce((F.abs(F.col(c) - F.col(ref)) > tol), F.lit(False))
        if acc:
            meta["accuracy"] = list(acc)
            aggs += [F.count_if(v).alias(f"_acc_{i}") for i, v in enumerate(acc.values())]
            any_acc = F.lit(False)
            for v in acc.values():
                any_acc = any_acc | v
            aggs.append(F.count_if(any_acc).alias("_acc_any"))
            meta["dims"].append("Accuracy")
    row = work.agg(*aggs)
    if "Uniqueness" in meta["dims"]:
        keys = rules.unique_keys or ([rules.pk] if rules.pk else list(df.columns))
        meta["keys"] = keys
        # Partial aggregation: the shuffle carries one row per key per task.
        dup = (df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_k"))
                 .agg(F.coalesce(F.sum(F.when(F.col("_k") > 1, F.col("_k"))), F.lit(0)).alias("_dups")))
        row = row.crossJoin(dup)
    return row, meta


def scorecard_from_counters(row: DataFrame, meta: dict, table: str) -> DataFrame:
    """Unpivot the one-row counters into (Table, Dimension, Score, Issues, Status, Details)."""
    n = F.col("_n")
    entries = []
    for d in meta["dims"]:
        if d == "Completeness":
            req = meta["req"]
            issues = sum((F.col(f"_miss_{i}") for i in range(len(req))), F.lit(0))
            total = n * F.lit(len(req))
            parts = [F.when(F.col(f"_miss_{i}") > 0, F.concat(F.lit(f"'{c}': "), F.col(f"_miss_{i}").cast("string")))
                     for i, c in enumerate(req)]
            details = F.concat(F.lit(MISSING.split("%s")[0]), F.concat_ws(", ", *parts), F.lit(MISSING.split("%s")[1]))
        elif d == "Uniqueness":
            issues, total = F.col("_dups"), n
            details = F.concat(F.lit(DUPLICATES % _py_list(meta["keys"])), F.col("_dups").cast("string"))
        elif d == "Validity":
            issues, total = F.col("_inv_any"), n
            details = F.concat_ws(" | ", *[F.concat(F.lit(f"{c}: "), F.col(f"_inv_{i}").cast("string"), F.lit(INVALID))
                                           for i, c in enumerate(meta["validity"])])
        elif d == "Consistency":
            issues, total = F.col("_incons"), n
            details = F.concat(F.col("_incons").cast("string"), F.lit(VIOLATIONS))
        elif d == "Timeliness":
            issues, total = F.col("_late"), n
            details = F.concat(F.lit(FUTURE), F.col("_future").cast("string"),
                               F.lit(STALE % meta["max_age"]), F.col("_stale").cast("string"))
        else:  # Accuracy
            issues, total = F.col("_acc_any"), n
            details = F.concat_ws(" | ", *[F.concat(F.lit(COMPARED % (c, r, t)), F.col(f"_acc_{i}").cast("string"),
                                                    F.lit(INACCURATE))
                                           for i, (c, r, t) in enumerate(meta["accuracy"])])
        entries.append(F.struct(F.lit(d).alias("Dimension"), score(issues, total).alias("Score"),
                                issues.cast("long").alias("Issues"), details.alias("Details")))
    out = row.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("Table"), "e.Dimension", "e.Score", "e.Issues", status(F.col("e.Score")).alias("Status"),
        "e.Details")
    return out


def run_dqa(df: DataFrame, table: str, rules: TableRules, refs: Mapping[str, DataFrame] | None = None,
            as_of: str = "2024-02-01", max_age_days: int = 1825, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Scorecard of one table from its rules; steps without configuration are skipped."""
    row, meta = quality_counters(df, rules, refs, as_of, max_age_days, dims=dims)
    return scorecard_from_counters(row, meta, table)


def overall_score(scorecard: DataFrame) -> DataFrame:
    """Mean of the rounded dimension scores per table (0.0 when none)."""
    return scorecard.groupBy("Table").agg(F.round(F.coalesce(F.avg("Score"), F.lit(0.0)), 4).alias("overall_score"))


def compare_scorecards(before: DataFrame, after: DataFrame) -> DataFrame:
    """before/after per dimension; Delta rounded to 4; Improved YES / = / NO."""
    b = before.select("Dimension", F.col("Score").alias("Score_before"), F.col("Issues").alias("Issues_before"),
                      F.col("Status").alias("Status_before"))
    a = after.select("Dimension", F.col("Score").alias("Score_after"), F.col("Issues").alias("Issues_after"),
                     F.col("Status").alias("Status_after"))
    j = b.join(a, "Dimension", "inner")
    delta = F.round(F.col("Score_after") - F.col("Score_before"), 4)
    return j.select("Dimension", "Score_before", "Issues_before", "Status_before", "Score_after", "Issues_after",
                    "Status_after", delta.alias("Delta"),
                    F.when(delta > 0, "YES").when(delta == 0, "=").otherwise("NO").alias("Improved"))


def scorecard_pivot(scorecards: DataFrame, order: Sequence[str] = DIMENSIONS[:5]) -> DataFrame:
    """Table x Dimension score matrix, scores clipped to [0, 1]."""
    p = scorecards.groupBy("Table").pivot("Dimension", list(order)).agg(F.first("Score"))
    return p.select("Table", *[F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)).alias(c) for c in order])


def _comparable(c: Column, numeric: bool) -> Column:
    return (c.cast("double") if numeric else c).cast("string")


def rule_report(df: DataFrame, table: str, rules: TableRules, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """D10 + D11 rule by rule: (table_name, kind, rule, n_violations, n_rows).

    Predicates and value rules are counters of one aggregate.  Foreign keys and values that must not repeat go in
    long form, (rule, value), and are counted by value first, so a hot value reaches the join with its parent's
    distinct keys as one row a task.  Rules whose columns or parent are absent have no violations.
    """
    refs = refs or {}
    kinds = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema.fields}
    values = validity_invalid(df, rules.validity)
    here = [r for r in rules.consistency if all(c in df.columns for c in r.needs)]
    plain = {r.name: r.predicate() for r in here if r.predicate is not None}
    keyed = [r for r in here if r.unique_col or (r.fk and r.fk[1] in refs and r.fk[2] in refs[r.fk[1]].columns)]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(v).alias(f"_v{i}") for i, v in enumerate(values.values())],
                 *[F.count_if(~F.coalesce(p, F.lit(False))).alias(f"_p{i}") for i, p in enumerate(plain.values())])
    items = [("validity", c, F.col(f"_v{i}")) for i, c in enumerate(values)] + [("consistency", n, F.col(f"_p{i}")) for i, n in enumerate(plain)]
    items += [("consistency", r.name, F.lit(0)) for r in rules.consistency if r.name not in plain]
    out = row.select("_n", F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("rule"), n.cast("long").alias("n_violations"))
                                              for kind, name, n in items])).alias("s"))
    if keyed:
        pairs, parents = [], None
        for r in keyed:
            col = r.unique_col or r.fk[0]
            numeric = kinds[col]
            if r.fk:
                keys = refs[r.fk[1]].select(F.col(r.fk[2]).alias("k"))
                numeric = numeric and isinstance(keys.schema["k"].dataType, T.NumericType)
                keys = keys.where(F.col("k").isNotNull()).select(F.lit(r.name).alias("_rule"), _comparable(F.col("k"), numeric).alias("_value"), F.lit(True).alias("_hit")).distinct()
                parents = keys if parents is None else parents.unionByName(keys)
            pairs.append(F.struct(F.lit(r.name).alias("_rule"), _comparable(F.col(col), numeric).alias("_value"), F.lit(r.fk is not None).alias("_fk")))
        by = df.select(F.explode(F.array(*pairs)).alias("s")).select("s.*").where(F.col("_value").isNotNull())
        by = by.groupBy("_rule", "_fk", "_value").agg(F.count(F.lit(1)).alias("_k"))
        by = by.join(parents, ["_rule", "_value"], "left") if parents is not None else by.withColumn("_hit", F.lit(None).cast("boolean"))
        bad = F.when(F.col("_fk") & F.col("_hit").isNull() | ~F.col("_fk") & (F.col("_k") > 1), F.col("_k")).otherwise(0)
        found = by.groupBy("_rule").agg(F.sum(bad).alias("_bad"))  # a row a rule
        out = out.join(F.broadcast(found), F.col("s.rule") == F.col("_rule"), "left")
    else:
        out = out.withColumn("_bad", F.lit(None).cast("long"))
    return out.select(F.lit(table).alias("table_name"), "s.kind", "s.rule", F.coalesce("_bad", "s.n_violations").alias("n_violations"), F.col("_n").alias("n_rows"))
