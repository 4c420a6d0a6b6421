"""DuckDB SQL of the statistics that end in more than one aggregate: chi-square p-values, logistic fits by unrolled
Newton rounds, and the isolation forest as tables (see ``oracle_sql``)."""

from __future__ import annotations

from dwkit.sources.reconciled import view_sql
from oracle_sql import EVENTS_DIRTY, OBS_DIRTY


def chi2_ctes(p: str, src: str, target: str, group: str) -> list[str]:
    """CTE {p}chi: chi2, dof, p (the lower tail's series with log-gamma, all terms positive)."""
    return [
        f"{p}cells AS (SELECT coalesce(CAST({group} AS VARCHAR), 'MISSING') AS g, count(*) FILTER (WHERE {target} IS NOT NULL) AS o0, count(*) FILTER (WHERE {target} IS NULL) AS o1 FROM {src} GROUP BY 1)",
        f"{p}tot AS (SELECT sum(o0) AS c0, sum(o1) AS c1, sum(o0) + sum(o1) AS nn, (count(*) - 1) * CAST(sum(o0) > 0 AND sum(o1) > 0 AS BIGINT) AS dof FROM {p}cells)",
        f"""{p}dev AS (SELECT dof, (o0 + o1) * c0 / nn AS e0, (o0 + o1) * c1 / nn AS e1, abs(o0 - (o0 + o1) * c0 / nn) AS d0, abs(o1 - (o0 + o1) * c1 / nn) AS d1 FROM {p}cells, {p}tot)""",
        f"""{p}stat AS (SELECT any_value(dof) AS dof, sum(CASE WHEN e0 > 0 THEN (d0 - CASE WHEN dof = 1 THEN least(0.5, d0) ELSE 0 END) ** 2 / e0 ELSE 0 END
            + CASE WHEN e1 > 0 THEN (d1 - CASE WHEN dof = 1 THEN least(0.5, d1) ELSE 0 END) ** 2 / e1 ELSE 0 END) AS chi2 FROM {p}dev)""",
        f"""{p}chi AS (SELECT chi2, dof, CASE WHEN dof <= 0 OR chi2 <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 3000),
            lambda n: exp((dof / 2.0 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + n + 1))))) END AS p FROM {p}stat)"""]


VERDICT = "CASE WHEN p < 0.05 THEN 'Reject MCAR (MAR evidence)' ELSE 'Cannot reject MCAR' END"


def logit_ctes(p: str, src: str, target: str, predictors: list[str], rounds: int = 9) -> list[str]:
    """CTE {p}r2: McFadden's R2 of the target's null flag, by Newton rounds with the normal equations solved by elimination."""
    k, names = len(predictors) + 1, [f"x{i}" for i in range(len(predictors) + 1)]
    medians = ", ".join(f"median({c}) AS m{i}" for i, c in enumerate(predictors, 1))
    fill = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m{i}) AS f{i}" for i, c in enumerate(predictors, 1))
    spread = ", ".join(f"avg(f{i}) AS a{i}, CASE WHEN stddev_pop(f{i}) > 0 THEN stddev_pop(f{i}) ELSE 1 END AS s{i}" for i in range(1, k))
    scaled = ", ".join(f"(f{i} - a{i}) / s{i} AS x{i}" for i in range(1, k))
    out = [f"{p}med AS MATERIALIZED (SELECT {medians} FROM {src})", f"{p}fill AS MATERIALIZED (SELECT CAST({target} IS NULL AS DOUBLE) AS y, {fill} FROM {src}, {p}med)",
           f"{p}sp AS MATERIALIZED (SELECT {spread} FROM {p}fill)", f"{p}x AS MATERIALIZED (SELECT y, 1.0 AS x0, {scaled} FROM {p}fill, {p}sp)",
           f"{p}b0 AS MATERIALIZED (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS b{i}" for i in range(k)) + ")"]
    margin = " + ".join(f"b{i} * x{i}" for i in range(k))
    for r in range(rounds):
        gram = ", ".join(f"sum(q * (1 - q) * {names[i]} * {names[j]}) AS a{i}_{j}" for i in range(k) for j in range(i, k))
        score = ", ".join(f"sum({names[i]} * (y - q)) AS g{i}" for i in range(k))
        out.append(f"{p}s{r}_0 AS MATERIALIZED (SELECT {gram}, {score} FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS q FROM {p}x, {p}b{r}) t)")
        for v in range(k - 1):  # symmetric elimination of column v below its pivot
            keep = [f"a{i}_{j}" for i in range(v + 1) for j in range(i, k)] + [f"g{i}" for i in range(v + 1)]
            new = [f"a{i}_{j} - a{v}_{i} / a{v}_{v} * a{v}_{j} AS a{i}_{j}" for i in range(v + 1, k) for j in range(i, k)]
            new += [f"g{i} - a{v}_{i} / a{v}_{v} * g{v} AS g{i}" for i in range(v + 1, k)]
            out.append(f"{p}s{r}_{v + 1} AS MATERIALIZED (SELECT {', '.join(keep + new)} FROM {p}s{r}_{v})")
        solved, at = f"{p}s{r}_{k - 1}", None
        for i in reversed(range(k)):
            rest = "".join(f" - a{i}_{j} * d{j}" for j in range(i + 1, k))
            at = f"{p}d{r}_{i}"
            out.append(f"{at} AS MATERIALIZED (SELECT *, (g{i}{rest}) / a{i}_{i} AS d{i} FROM {solved})")
            solved = at
        out.append(f"{p}b{r + 1} AS MATERIALIZED (SELECT " + ", ".join(f"b.b{i} + d.d{i} AS b{i}" for i in range(k)) + f" FROM {p}b{r} b, {at} d)")
    out.append(f"{p}r2 AS MATERIALIZED (SELECT round(1 - ll / (n * (s * ln(s) + (1 - s) * ln(1 - s))), 4) AS r2 FROM (SELECT sum(y * ({margin}) - ln(1 + exp({margin}))) AS ll, "
               f"avg(y) AS s, count(*) AS n FROM {p}x, {p}b{rounds}) t)")
    return out


def classified(column: str, r2: str | None, chi: str, src: str) -> str:
    """One row of D24."""
    gain = f"(SELECT r2 FROM {r2})" if r2 else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, CASE WHEN coalesce(r2, 0) > 0.05 THEN 'MAR' WHEN verdict = 'Cannot reject MCAR' THEN 'MCAR' ELSE 'MNAR' END AS mechanism,
  CASE WHEN coalesce(r2, 0) > 0.05 THEN round(least(r2 / 0.3, 1.0), 2) WHEN verdict = 'Cannot reject MCAR' THEN 0.7 ELSE 0.6 END AS confidence,
  (SELECT round(count(*) FILTER (WHERE {column} IS NULL) / count(*) * 100, 2) FROM {src}) AS missing_pct, verdict AS mcar_test, r2 AS mar_pseudo_r2
FROM (SELECT {gain} AS r2, {VERDICT} AS verdict FROM {chi}) q"""


def _with(*parts) -> str:
    return "WITH " + ",\n".join(parts)


def classify_weather_sql() -> str:
    src, ctes, rows = "rec_weather_observations", [view_sql()], []
    for c in ("visibility", "wind_gust", "dew_point", "lowest_cloud_layer", "altimeter"):
        group, predictors = ("obs_hour", ["altimeter"]) if c == "visibility" else ("origin_airport", ["obs_hour", "obs_id"])
        ctes += chi2_ctes(f"{c}_", src, c, group) + logit_ctes(f"{c}_", src, c, predictors, rounds=8)
        rows.append(classified(c, f"{c}_r2", f"{c}_chi", src))
    return _with(*ctes) + " " + " UNION ALL ".join(rows)


def forest_ctes(src: str, key: str, cols: list[str], n_trees: int = 100, samples: int = 256, seed: int = 42, contamination: float = 0.02) -> list[str]:
    """CTE scored: key, anomaly_score, IsoForest_Outlier.  Splits follow from MD5; depth 8 is that of 129 to 256 rows a tree."""
    k, depth = len(cols), 8
    xs = [f"x{i}" for i in range(k)]

    def share(kind):
        return f"((CAST(('0x' || substr(md5('{seed}|' || tree || '|' || node || '|{kind}'), 1, 8)) AS BIGINT) + 0.5) / 4294967296.0)"

    def c(n):
        return f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1) + 0.5772156649015329) - 2.0 * ({n} - 1) / {n} END)"

    out = [f"fmed AS (SELECT {', '.join(f'median({x}) AS m{i}' for i, x in enumerate(cols))} FROM {src})",
           f"fbase AS MATERIALIZED (SELECT {key} AS k, {', '.join(f'coalesce(CAST({x} AS DOUBLE), m{i}) AS x{i}' for i, x in enumerate(cols))} FROM {src}, fmed)",
           f"fsize AS MATERIALIZED (SELECT least({samples}, count(*)) AS psi, least(count(*), {n_trees} * least({samples}, count(*))) AS m FROM fbase)",
           f"franked AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5(CAST(k AS VARCHAR) || '|{seed}'), CAST(k AS VARCHAR)) - 1 AS r FROM fbase)",
           f"""lv0 AS MATERIALIZED (SELECT t.tree, CAST(1 AS BIGINT) AS node, {', '.join(xs)} FROM franked, fsize, (SELECT unnest(range({n_trees})) AS tree) t
               WHERE r < m AND (((r - t.tree * psi) % m) + m) % m < psi)"""]
    for d in range(depth):
        spans = ", ".join(f"min(x{i}) AS l{i}, max(x{i}) AS h{i}" for i in range(k))
        varies = " || ".join(f"CASE WHEN h{i} > l{i} THEN [{i}] ELSE [] END" for i in range(k))
        lows, highs = "[" + ", ".join(f"l{i}" for i in range(k)) + "]", "[" + ", ".join(f"h{i}" for i in range(k)) + "]"
        out.append(f"st{d} AS MATERIALIZED (SELECT *, {varies} AS u FROM (SELECT tree, node, count(*) AS n, {spans} FROM lv{d} GROUP BY tree, node) g)")
        out.append(f"""sp{d} AS MATERIALIZED (SELECT tree, node, n, f, {lows}[f + 1] + {share('split')} * ({highs}[f + 1] - {lows}[f + 1]) AS s
            FROM (SELECT *, CASE WHEN n > 1 AND len(u) > 0 THEN u[CAST(floor({share('feature')} * len(u)) AS BIGINT) + 1] END AS f FROM st{d}) g)""")
        out.append(f"lv{d + 1} AS MATERIALIZED (SELECT a.tree, 2 * a.node + CASE WHEN [{', '.join(xs)}][f + 1] >= s THEN 1 ELSE 0 END AS node, {', '.join(xs)} "
                   f"FROM lv{d} a JOIN sp{d} b ON a.tree = b.tree AND a.node = b.node WHERE f IS NOT NULL)")
    leaves = [f"SELECT tree, node, {d} + {c('n')} AS path FROM sp{d} WHERE f IS NULL" for d in range(depth)]
    leaves.append(f"SELECT tree, node, {depth} + {c('n')} AS path FROM (SELECT tree, node, count(*) AS n FROM lv{depth} GROUP BY tree, node) g")
    out.append("fleaf AS MATERIALIZED (" + " UNION ALL ".join(leaves) + ")")
    out.append("fsplit AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, node, f, s FROM sp{d} WHERE f IS NOT NULL" for d in range(depth)) + ")")
    out.append(f"wk0 AS (SELECT k, {', '.join(xs)}, t.tree, CAST(1 AS BIGINT) AS node FROM fbase, (SELECT unnest(range({n_trees})) AS tree) t)")
    for d in range(depth):
        out.append(f"wk{d + 1} AS (SELECT k, {', '.join(xs)}, a.tree, CASE WHEN f IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN [{', '.join(xs)}][f + 1] >= s THEN 1 ELSE 0 END END AS node "
                   f"FROM wk{d} a LEFT JOIN fsplit b ON a.tree = b.tree AND a.node = b.node)")
    out.append(f"fscore AS MATERIALIZED (SELECT a.k, round(power(2.0, -avg(path) / any_value({c('psi')})), 9) AS anomaly_score FROM wk{depth} a "
               "JOIN fleaf b ON a.tree = b.tree AND a.node = b.node, fsize GROUP BY a.k)")
    out.append(f"scored AS MATERIALIZED (SELECT k, anomaly_score, anomaly_score > (SELECT quantile_cont(anomaly_score, {1 - contamination}) FROM fscore) AS IsoForest_Outlier FROM fscore)")
    return out


_OBS_FOREST = _with(OBS_DIRTY, *forest_ctes("obs_dirty", "obs_id", ["spd", "gust", "low"]))
_THREE = _OBS_FOREST + """,
gq AS (SELECT quantile_cont(gust, 0.25) AS q1, quantile_cont(gust, 0.75) AS q3, median(gust) AS med FROM obs_dirty),
gm AS (SELECT median(abs(coalesce(gust, med) - med)) AS mad FROM obs_dirty, gq),
three AS (SELECT o.obs_id, coalesce(gust < q1 - 2.5 * (q3 - q1) OR gust > q3 + 2.5 * (q3 - q1), FALSE) AS a,
  CASE WHEN mad <> 0 THEN coalesce(abs(0.6745 * (coalesce(gust, med) - med) / mad) > 3.5, FALSE) ELSE FALSE END AS b, IsoForest_Outlier AS c
  FROM obs_dirty o JOIN scored ON o.obs_id = k, gq, gm)"""

SQL = {
    "D22_mcar_test": _with(EVENTS_DIRTY, *chi2_ctes("", "events_dirty", "value", "event_type")) + f""" SELECT round(chi2, 4) AS chi2, round(p, 6) AS p_value, CAST(dof AS BIGINT) AS dof,
CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance, {VERDICT} AS verdict FROM chi""",
    "D23_mar_logistic": _with(EVENTS_DIRTY, *logit_ctes("", "events_dirty", "value", ["user_id", "event_hour", "status"])) + """
SELECT r2 AS pseudo_r2, CASE WHEN r2 > 0.05 THEN 'MAR evidence (missingness predictable)' ELSE 'Weak MAR signal' END AS verdict FROM r2""",
    "D24_classify_all": _with(EVENTS_DIRTY, *[x for c in ("value", "status") for x in chi2_ctes(f"{c}_", "events_dirty", c, "event_type") + logit_ctes(
        f"{c}_", "events_dirty", c, ["event_hour", "user_id"])]) + " " + " UNION ALL ".join(classified(c, f"{c}_r2", f"{c}_chi", "events_dirty") for c in ("value", "status")),
    "D24_classify_weather": classify_weather_sql(),
    "D30_forest_scores": _OBS_FOREST + " SELECT k AS obs_id, round(anomaly_score, 4) AS anomaly_score, IsoForest_Outlier FROM scored",
    "D30_isolation_forest": _OBS_FOREST + " SELECT IsoForest_Outlier, count(*) AS n_rows FROM scored GROUP BY 1",
    "D31_consensus_three_methods": _THREE + " SELECT CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(c AS INTEGER) AS votes, count(*) AS n_rows FROM three GROUP BY 1",
    "D32_summary_three_methods": _THREE + """
SELECT 'obs_dirty' AS table_name, 'IQR (k=2.5)' AS method, 'gust' AS column_name, round(q1 - 2.5 * (q3 - q1), 4) AS lower_fence, round(q3 + 2.5 * (q3 - q1), 4) AS upper_fence,
  (SELECT count(*) FROM three WHERE a) AS n_flagged, (SELECT round(count(*) FILTER (WHERE a) / count(*) * 100, 2) FROM three) AS pct_flagged FROM gq
UNION ALL SELECT 'obs_dirty', 'Modified Z-score (t=3.5)', 'gust', NULL, NULL, (SELECT count(*) FROM three WHERE b), (SELECT round(count(*) FILTER (WHERE b) / count(*) * 100, 2) FROM three) FROM gm WHERE mad <> 0
UNION ALL SELECT 'obs_dirty', 'Isolation forest (share=0.02)', 'spd, gust, low', NULL, NULL, (SELECT count(*) FROM three WHERE c), (SELECT round(count(*) FILTER (WHERE c) / count(*) * 100, 2) FROM three)""",
}
