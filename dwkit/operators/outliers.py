"""Outlier detection.

Fences and medians are exact quantiles (``quantiles.quantile_row``); the modified
z-score needs two passes (median, then median absolute deviation).  Each
method adds a boolean flag column; the summary is a one-row aggregate of the
flags unpivoted per (method, column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import quantile_row


# Names of the methods in the summary.
IQR_NAME, MODZ_NAME, FOREST_NAME = "IQR (k=%s)", "Modified Z-score (t=%s)", "Isolation forest (share=%s)"


class OutlierDetector:
    def __init__(self, df: DataFrame, table: str):
        self.table = table
        self.df = df
        self.flags: list[str] = []
        self.records: list[dict] = []   # method, column, fence column names

    def detect_iqr(self, col: str, k: float = 1.5):
        """Flag values outside [Q1 - k IQR, Q3 + k IQR]; nulls never flagged.

        An all-null column gets a false flag and no summary record.
        """
        q = quantile_row(self.df, {f"_q1_{col}": (col, 0.25), f"_q3_{col}": (col, 0.75)})
        lo = F.col(f"_q1_{col}") - k * (F.col(f"_q3_{col}") - F.col(f"_q1_{col}"))
        hi = F.col(f"_q3_{col}") + k * (F.col(f"_q3_{col}") - F.col(f"_q1_{col}"))
        flag = f"IQR_{col}"
        self.df = (self.df.crossJoin(F.broadcast(q))
                   .withColumns({f"_lo_{flag}": lo, f"_hi_{flag}": hi})
                   .withColumn(flag, F.coalesce((F.col(col) < F.col(f"_lo_{flag}")) | (F.col(col) > F.col(f"_hi_{flag}")),
                                                F.lit(False)))
                   .drop(f"_q1_{col}", f"_q3_{col}"))
        self.flags.append(flag)
        self.records.append({"method": IQR_NAME % k, "column": col, "flag": flag, "fences": True,
                             "present": f"_q_present_{col}"})
        return self

    def detect_modified_zscore(self, col: str, threshold: float = 3.5):
        """0.6745 (x - med) / MAD on the median-filled column; MAD = 0 -> skipped."""
        med = quantile_row(self.df, {f"_med_{col}": (col, 0.5)})
        work = self.df.crossJoin(F.broadcast(med))
        filled = F.coalesce(F.col(col).cast("double"), F.col(f"_med_{col}"))
        mad = quantile_row(work.select(F.abs(filled - F.col(f"_med_{col}")).alias("_dev")), {f"_mad_{col}": ("_dev", 0.5)})
        flag = f"ModZ_{col}"
        z = F.lit(0.6745) * (filled - F.col(f"_med_{col}")) / F.col(f"_mad_{col}")
        self.df = (work.crossJoin(F.broadcast(mad))
                   .withColumn(flag, F.when(F.col(f"_mad_{col}") != 0, F.coalesce(F.abs(z) > threshold, F.lit(False))))
                   .drop(f"_med_{col}"))
        self.flags.append(flag)
        self.records.append({"method": MODZ_NAME % threshold, "column": col, "flag": flag,
                             "fences": False, "mad": f"_mad_{col}"})
        return self

    def detect_forest(self, key: str, cols: Sequence[str], contamination: float = 0.02, **options) -> "OutlierDetector":
        """D30 as one more vote (all columns together)."""
        from .iforest import isolation_forest

        self.df = isolation_forest(self.df, key, cols, contamination, **options)
        self.flags.append("IsoForest_Outlier")
        self.records.append({"method": FOREST_NAME % contamination, "column": cols[0], "label": ", ".join(cols),
                             "flag": "IsoForest_Outlier", "fences": False, "mad": None})
        return self

    def votes(self) -> DataFrame:
        """Number of flags set per row (a skipped method counts as not set)."""
        n = sum((F.coalesce(F.col(f), F.lit(False)).cast("int") for f in self.flags), F.lit(0))
        return self.df.withColumn("votes", n)

    def flagged_rows(self, min_votes: int = 2) -> DataFrame:
        """Rows with at least ``min_votes`` flags, with their flags."""
        return self.votes().where(F.col("votes") >= min_votes)

    def summary(self) -> DataFrame:
        """Method, column, fences (4 dp), flagged count, pct (2 dp); one aggregate."""
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, r in enumerate(self.records):
            aggs.append(F.count_if(F.coalesce(F.col(r["flag"]), F.lit(False))).alias(f"_f{i}"))
            aggs.append(F.count(F.col(r["column"])).alias(f"_p{i}"))
            if r["fences"]:
                aggs += [F.first(F.col(f"_lo_{r['flag']}")).alias(f"_lo{i}"), F.first(F.col(f"_hi_{r['flag']}")).alias(f"_hi{i}")]
            elif r.get("mad"):
                aggs.append(F.first(F.col(r["mad"])).alias(f"_mad{i}"))
        row = self.df.agg(*aggs)
        items = []
        for i, r in enumerate(self.records):
            keep = F.coalesce(F.col(f"_mad{i}") != 0, F.lit(False)) if r.get("mad") else F.col(f"_p{i}") > 0
            items.append(F.when(keep, F.struct(
                F.lit(self.table).alias("table_name"), F.lit(r["method"]).alias("method"),
                F.lit(r.get("label", r["column"])).alias("column_name"),
                (F.round(F.col(f"_lo{i}"), 4) if r["fences"] else F.lit(None).cast("double")).alias("lower_fence"),
                (F.round(F.col(f"_hi{i}"), 4) if r["fences"] else F.lit(None).cast("double")).alias("upper_fence"),
                F.col(f"_f{i}").alias("n_flagged"),
                F.when(F.col("_n") > 0, F.round(F.col(f"_f{i}") / F.col("_n") * 100, 2)).otherwise(F.lit(0.0)).alias("pct_flagged"))))
        return row.select(F.explode(F.array(*items)).alias("s")).where(F.col("s").isNotNull()).select("s.*")


def run_outliers(df: DataFrame, table: str, iqr: Mapping[str, float], modz: Sequence[str] = (),
                 threshold: float = 3.5, forest: Sequence[str] = (), key: str | None = None,
                 contamination: float = 0.02) -> OutlierDetector:
    """All detectors asked for; ``forest`` names the columns of the isolation forest (needs ``key``)."""
    det = OutlierDetector(df, table)
    for c, k in iqr.items():
        det.detect_iqr(c, k)
    for c in modz:
        det.detect_modified_zscore(c, threshold)
    if forest:
        det.detect_forest(key, forest, contamination)
    return det
