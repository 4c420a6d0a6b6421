"""Isolation-forest outlier flags.

MLlib has no isolation forest.  Every choice follows from hashes, so the same forest grows on any
cluster, and in any SQL engine with MD5:

* rows ordered by MD5(key|seed) are a fixed permutation; the first ``n_trees * max_samples`` of them (a bound
  that does not depend on the table) are dealt to the trees in windows of ``max_samples``,
  which start over when the rows run out;
* a node's split feature (among those that vary in it) and split point follow from
  MD5(seed|tree|node|...); nodes are numbered 1, 2 n, 2 n + 1, and a tree's rows grow in one task;
* the node table (at most ``n_trees * (2 * max_samples - 1)`` rows) holds for a leaf its path length with the
  correction for its rows; it is collected into arrays indexed by (tree, node), and scorers
  walk all trees at once, level by level, on Arrow batches of the key and the values only;
* the flag cut is the exact quantile of the scores (to 9 places) at 1 - contamination.

Standardising is skipped: splits between a node's least and largest value don't depend on a
column's scale.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .quantiles import quantile_row

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, split double, path double"


def c_factor(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def hash_share(text: str) -> float:
    """(0, 1) from the first 32 bits of the text's MD5."""
    return (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296.0


def _grow(pdf: pd.DataFrame, cols: Sequence[str], max_depth: int, seed: int) -> pd.DataFrame:
    tree, x, nodes = int(pdf["_tree"].iloc[0]), pdf[list(cols)].to_numpy(dtype=float), []
    todo = [(1, 0, x)]
    while todo:
        node, depth, rows = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        varies = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(varies):
            nodes.append((tree, node, -1, 0.0, depth + c_factor(len(rows))))
            continue
        f = int(varies[int(hash_share(f"{seed}|{tree}|{node}|feature") * len(varies))])
        split = low[f] + hash_share(f"{seed}|{tree}|{node}|split") * (high[f] - low[f])
        nodes.append((tree, node, f, split, 0.0))
        right = rows[:, f] >= split
        todo += [(2 * node, depth + 1, rows[~right]), (2 * node + 1, depth + 1, rows[right])]
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "path"])


def grow_forest(filled: DataFrame, key: str, xcols: Sequence[str], n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """The node table of the forest: (tree, node, feature or -1, split, path length of a leaf)."""
    m = max(1, min(n, n_trees * psi))
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    first = filled.select(order.alias("_h"), F.col(key).cast("string").alias("_k"), *xcols).orderBy("_h", "_k").limit(m)
    ranked = first.withColumn("_r", F.row_number().over(Window.orderBy("_h", "_k")) - 1)  # m rows, bounded by the parameters
    mine = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.pmod(F.col("_r") - t * psi, F.lit(m)) < psi)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    dealt = ranked.withColumn("_tree", F.explode(mine)).select("_tree", *xcols)
    return dealt.groupBy("_tree").applyInPandas(lambda p: _grow(p, xcols, depth, seed), NODES)


def _scorer(nodes: pd.DataFrame, n_trees: int, depth: int, psi: int):
    feature = np.full((n_trees, 2 ** (depth + 1)), -1, dtype=np.int32)
    split, path = np.zeros(feature.shape), np.zeros(feature.shape)
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], split[at], path[at] = nodes["feature"], nodes["split"], nodes["path"]
    trees, cn = np.arange(n_trees)[None, :], c_factor(psi)

    def run(batches):
        for pdf in batches:
            scores = []
            x = pdf.drop(columns="_key").to_numpy(dtype=float)
            for i in range(0, len(x), 2048):
                part = x[i:i + 2048]
                node, row = np.ones((len(part), n_trees), dtype=np.int64), np.arange(len(part))[:, None]
                for _ in range(depth):
                    f = feature[trees, node]
                    node = np.where(f < 0, node, 2 * node + (part[row, np.maximum(f, 0)] >= split[trees, node]))
                scores.append(np.round(np.power(2.0, -path[trees, node].mean(axis=1) / cn), 9) if cn > 0 else np.full(len(part), 0.5))
            yield pd.DataFrame({"_key": pdf["_key"], "anomaly_score": np.concatenate(scores) if scores else np.empty(0)})
    return run


def isolation_forest(df: DataFrame, key: str, cols: Sequence[str], contamination: float = 0.02,
                     n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """Add ``anomaly_score`` and ``IsoForest_Outlier``; needs at least two columns.

    ``key`` names the rows (unique); nulls count as the column's median; without rows there are no scores.
    """
    cols = [c for c in cols if c in df.columns]
    if len(cols) < 2:
        return df.withColumn("IsoForest_Outlier", F.lit(False))
    meds = quantile_row(df, {f"_m{i}": (c, 0.5) for i, c in enumerate(cols)})
    xcols = [f"_x{i}" for i in range(len(cols))]
    filled = df.crossJoin(F.broadcast(meds)).select(F.col(key).alias("_key"), *[
        F.coalesce(F.col(c).cast("double"), F.col(f"_m{i}")).alias(x) for i, (c, x) in enumerate(zip(cols, xcols))])
    filled = materialize(filled, "forest-input")  # key and values only: read for the count, the sample and the scores
    n = filled.count()
    psi = min(max_samples, n)
    nodes = grow_forest(filled, "_key", xcols, n, n_trees, psi, seed).toPandas()
    depth = int(math.ceil(math.log2(max(psi, 2))))
    kind = filled.schema["_key"].dataType.simpleString()
    scored = materialize(filled.mapInPandas(_scorer(nodes, n_trees, depth, psi), f"_key {kind}, anomaly_score double"), "forest-scores")
    cut = quantile_row(scored, {"_cut": ("anomaly_score", 1.0 - contamination)})
    flagged = scored.crossJoin(F.broadcast(cut)).select("_key", "anomaly_score", (F.col("anomaly_score") > F.col("_cut")).alias("IsoForest_Outlier"))
    return df.join(flagged, F.col(key) == F.col("_key"), "left").drop("_key")
