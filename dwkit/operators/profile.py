"""Profiling and dependency checks.

Every profile is one aggregate over the table (dependency discovery: one over part of
the groups and one over all), unpivoted with ``explode(array(struct))``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .star import small_side

# Fixed band edges and labels of the missingness summary (right-closed).
MISSING_BANDS = [(0, "complete"), (1, "negligible (<1%)"), (5, "low (1-5%)"), (15, "moderate (5-15%)"),
                 (100, "high (>15%)")]


def _unpivot(row: DataFrame, items: Sequence[tuple[str, dict]]) -> DataFrame:
    structs = [F.struct(*[v.alias(k) for k, v in fields.items()]) for _, fields in items]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def missing_band(pct):
    expr = None
    for edge, label in MISSING_BANDS:
        expr = F.when(pct <= edge, label) if expr is None else expr.when(pct <= edge, label)
    return expr


def missingness_summary(df: DataFrame) -> DataFrame:
    """Per column missing count, pct (2 dp), present count, dtype, band; only columns with missing."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}")
                                                  for i, c in enumerate(df.columns)])
    items = []
    for i, c in enumerate(df.columns):
        pct = F.when(F.col("_n") > 0, F.round(F.col(f"_m{i}") / F.col("_n") * 100, 2)).otherwise(F.lit(0.0))
        items.append((c, {"column_name": F.lit(c), "missing_count": F.col(f"_m{i}"), "missing_pct": pct,
                          "present_count": F.col("_n") - F.col(f"_m{i}"), "dtype": F.lit(types[c]),
                          "status": missing_band(pct)}))
    return _unpivot(row, items).where(F.col("missing_count") > 0)


def distinct_counts(df: DataFrame) -> DataFrame:
    """(_i, n_unique): exact number of distinct non-null values of every column, by its position.

    One aggregation over (column, value hash) with a second over its groups: tasks send one row a distinct value, and
    no row is expanded once per column before it is counted.  Values are told apart by 128 bits of hashes.
    """
    pairs = [F.struct(F.lit(i).alias("_i"), *[h.alias(x) for x, h in zip("hg", _fingerprints(f.name, f.dataType))]) for i, f in enumerate(df.schema.fields)]
    values = df.select(F.explode(F.filter(F.array(*pairs), lambda s: s["h"].isNotNull())).alias("s")).select("s.*").distinct()
    return values.groupBy("_i").agg(F.count(F.lit(1)).alias("n_unique"))


def column_profile(df: DataFrame, glossary: Mapping[str, str] | None = None, sample_chars: int = 30) -> DataFrame:
    """Dtype, distinct count, null count, a deterministic sample (min) and description.

    The description is the glossary's, else the column's own comment (field metadata), else N/A.
    """
    glossary, items, aggs = glossary or {}, [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"_z{i}"), F.min(c.cast("string")).alias(f"_s{i}")]
        items.append((f.name, {"_i": F.lit(i), "column_name": F.lit(f.name), "dtype": F.lit(f.dataType.simpleString()), "n_null": F.col(f"_z{i}"),
                               "sample": F.substring(F.col(f"_s{i}"), 1, sample_chars),
                               "description": F.lit(glossary.get(f.name, f.metadata.get("comment", "N/A")))}))
    rows = _unpivot(df.agg(*aggs), items).join(F.broadcast(distinct_counts(df)), "_i", "left")  # a row a column
    return rows.select("column_name", "dtype", F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "n_null", "sample", "description")


def data_dictionary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """D13 of several tables: table_name and the profile of each of its columns."""
    out = None
    for name, df in tables.items():
        part = column_profile(df).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


#: Of a determinant's groups one in so many is looked at first: a violation there settles a dependency.
FIRST_GROUPS = 64


def _fingerprints(c: str, kind: T.DataType) -> tuple:
    """Two 64-bit hashes of a value, null for null; equal values (0.0 and -0.0 too) have equal hashes."""
    v = F.col(f"`{c}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        v = v + F.lit(0.0)
    return tuple(F.when(v.isNotNull(), F.xxhash64(F.lit(seed), v)) for seed in (1, 2))


def _dependency_groups(hashed: DataFrame, determinants: Sequence[int], dependents: Sequence[int], part: int) -> DataFrame:
    """Per determinant: its groups (one in ``part`` of them), and for each dependent the groups that have a value and
    those that have several.  One scan, one shuffle keyed by (determinant, hash of its value); a task sends a row a group."""
    keys = F.filter(F.array(*[F.struct(F.lit(i).alias("a"), F.col(f"_h{i}").alias("h"), F.col(f"_g{i}").alias("g")) for i in determinants]),
                    lambda s: s["h"].isNotNull() & (F.pmod(s["h"], F.lit(part)) == 0))
    both = [f"_{x}{j}" for j in dependents for x in "hg"]
    by = hashed.select(F.explode(keys).alias("k"), *both).groupBy("k.a", "k.h", "k.g").agg(
        *[x for c in both for x in (F.min(c).alias(f"lo{c}"), F.max(c).alias(f"hi{c}"))])
    return by.groupBy("a").agg(F.count(F.lit(1)).alias("groups"), *[x for j in dependents for x in (
        F.count(f"lo_h{j}").alias(f"one{j}"),
        F.count_if((F.col(f"lo_h{j}") != F.col(f"hi_h{j}")) | (F.col(f"lo_g{j}") != F.col(f"hi_g{j}"))).alias(f"many{j}"))])


def discover_fd(df: DataFrame, min_support: int = 2, exclude: Sequence[str] = ()) -> DataFrame:
    """All A -> B where every A group has at most one distinct non-null B and at
    least one group has exactly one; null A dropped; A needs >= ``min_support`` values.

    All determinants share one pass: a row becomes one (determinant, value hash) row for each of them.  A first pass
    over one in ``FIRST_GROUPS`` groups of every determinant refutes most pairs (a violation in some groups is one
    in all), so the second, over all groups, carries only the surviving determinants and dependents.
    Values are compared by 128 bits of hashes.
    """
    spark, fields = df.sparkSession, [f for f in df.schema.fields if f.name not in exclude]
    cols = [f.name for f in fields]
    hashed = df.select(*[h.alias(f"_{x}{i}") for i, f in enumerate(fields) for x, h in zip("hg", _fingerprints(f.name, f.dataType))])
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if i != j]
    for part in (FIRST_GROUPS, 1):
        if not pairs:
            break
        found = _dependency_groups(hashed, sorted({i for i, _ in pairs}), sorted({j for _, j in pairs}), part)
        seen = {r["a"]: r for r in found.collect()}  # a row a column
        pairs = [(i, j) for i, j in pairs if (i not in seen and part > 1) or (i in seen and seen[i][f"many{j}"] == 0 and (
            part > 1 or (seen[i][f"one{j}"] > 0 and seen[i]["groups"] >= min_support)))]
    return spark.createDataFrame([(cols[i], cols[j]) for i, j in pairs], "determinant string, dependent string")


def fd_violations(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Groups of the compound key and the groups where some column takes more
    than one value (null counts as a value); rows with a null key are dropped."""
    cols = [c for c in (cols or df.columns) if c not in keys]
    keyed = df.where(F.lit(True) if not keys else F.greatest(*[F.col(k).isNull() for k in keys] + [F.lit(False)]) == F.lit(False))
    g = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                 *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("k")).alias(f"_c{i}")
                                   for i, c in enumerate(cols)])
    bad = F.lit(False)
    for i, _ in enumerate(cols):
        s = f"_c{i}"
        bad = bad | (F.col(f"{s}.lo") != F.col(f"{s}.hi")) | ((F.col(f"{s}.k") > 0) & (F.col(f"{s}.k") < F.col("_n")))
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.coalesce(bad, F.lit(False))).alias("n_violations"))


def mapping_cardinality(df: DataFrame, a: str, b: str, name: str | None = None) -> DataFrame:
    """How many A values map to more than one B (a null B counts as a value)."""
    g = df.where(F.col(a).isNotNull()).groupBy(a).agg(
        (F.count_distinct(b) + F.max(F.col(b).isNull().cast("int"))).alias("_k"))
    return g.agg(F.lit(name or f"{a}->{b}").alias("mapping"), F.count(F.lit(1)).alias("n_keys"),
                 F.count_if(F.col("_k") > 1).alias("n_multi"))


def category_variants(df: DataFrame, col: str, mapping: DataFrame | None = None) -> DataFrame:
    """Distinct non-null variants with their row counts and canonical form.

    ``mapping`` (variant, canonical) is applied by a join; without one the
    canonical form is the trimmed lower-case text.
    """
    v = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("variant")).agg(F.count(F.lit(1)).alias("n_rows"))
    if mapping is None:
        return v.withColumn("canonical", F.lower(F.trim(F.col("variant"))))
    m = mapping.select(F.col("variant").alias("_v"), F.col("canonical"))
    return v.join(small_side(m), F.col("variant") == F.col("_v"), "left").drop("_v")


def apply_mapping(df: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """``col`` in its canonical form, by a join with (variant, canonical); values without a mapping stay as they are.

    The mapping is reduced to one canonical form a variant (the smallest), so no row is multiplied.
    """
    m = mapping.where(F.col("variant").isNotNull()).groupBy(F.col("variant").alias("_v")).agg(F.min("canonical").alias("_c"))
    out = df.join(small_side(m), F.col(f"`{col}`") == F.col("_v"), "left")
    return out.withColumn(col, F.coalesce("_c", F.col(f"`{col}`"))).select(*[F.col(f"`{c}`") for c in df.columns])
