"""Schema contracts (H1-H4).

A contract is the expected layout of a table: column names in order, type and null occurrence of
each, row count, key.  It is captured from ``df.schema`` plus one aggregate.  Validation walks a table
of checks; each is a function of (expected layout, frame) that returns the difference it sees, and
a grade for a difference.  Only the key check runs a job, a partial-aggregated count per key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "table_name string, check string, status string, message string"
# Grades, mildest first; a table's grade is its worst check.
GRADES = ("PASS", "WARN", "FAIL")
SKIPPED = "SKIP"


@dataclass
class Layout:
    """Expected form of a table; ``columns`` maps name -> (type, has nulls), in order."""
    table: str
    columns: dict[str, tuple[str, bool]] = field(default_factory=dict)
    n_rows: int | None = None
    key: str | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def _listed(names) -> str:
    return ", ".join(sorted(names))


def _width(want: Layout, df: DataFrame) -> str:
    return "" if len(df.columns) == len(want.columns) else f"{len(df.columns)} instead of {len(want.columns)}"


def _absent(want: Layout, df: DataFrame) -> str:
    return _listed(set(want.columns) - set(df.columns))


def _foreign(want: Layout, df: DataFrame) -> str:
    return _listed(set(df.columns) - set(want.columns))


def _reordered(want: Layout, df: DataFrame) -> str:
    shared = [c for c in df.columns if c in want.columns]
    return "" if shared == [c for c in want.columns if c in set(shared)] else " < ".join(shared)


def _retyped(want: Layout, df: DataFrame) -> str:
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"{c} {old} -> {now[c]}" for c, (old, _) in want.columns.items() if now.get(c, old) != old)


def _repeated(want: Layout, df: DataFrame) -> str:
    if want.key not in df.columns:
        return ""
    surplus = df.groupBy(want.key).agg((F.count(F.lit(1)) - 1).alias("_surplus")).agg(F.coalesce(F.sum("_surplus"), F.lit(0)).alias("d")).first()["d"]
    return f"{surplus} surplus rows" if surplus else ""


#: check name -> (difference, grade of a difference; None: strictness decides)
CHECKS: dict[str, tuple[Callable[[Layout, DataFrame], str], str | None]] = {
    "column_count": (_width, "FAIL"), "missing_columns": (_absent, "FAIL"), "extra_columns": (_foreign, None),
    "column_order": (_reordered, "WARN"), "dtype_changes": (_retyped, "WARN"), "pk_uniqueness": (_repeated, "FAIL"),
}


class SchemaContract:
    def __init__(self):
        self._layouts: dict[str, Layout] = {}

    def register(self, table: str, df: DataFrame, pk: str | None = None, count_rows: bool = True):
        """H1: capture names, types, nullability (any null present) and row count."""
        nulls = {f.name: f.nullable for f in df.schema.fields}
        n_rows = None
        if count_rows:
            flags = [F.coalesce(F.bool_or(F.col(f"`{c}`").isNull()), F.lit(False)).alias(f"_z{i}") for i, c in enumerate(df.columns)]
            seen = df.agg(F.count(F.lit(1)).alias("_n"), *flags).first()
            n_rows, nulls = seen["_n"], {c: seen[f"_z{i}"] for i, c in enumerate(df.columns)}
        columns = {f.name: (f.dataType.simpleString(), nulls[f.name]) for f in df.schema.fields}
        self._layouts[table] = Layout(table, columns, n_rows, pk)
        return self

    @property
    def registered_tables(self) -> list[str]:
        return list(self._layouts)

    def checks(self, table: str, df: DataFrame, strict: bool = True) -> list[tuple[str, str, str]]:
        """(check, status, message) rows; the key check needs a key that the frame has."""
        want = self._layouts.get(table)
        if want is None:
            return [("registration", SKIPPED, "no contract")]
        due = [c for c in CHECKS if c != "pk_uniqueness" or (want.key and want.key in df.columns)]
        found = [(c, CHECKS[c][0](want, df), CHECKS[c][1] or ("FAIL" if strict else "WARN")) for c in due]
        return [(c, grade if seen else "PASS", seen or "as agreed") for c, seen, grade in found]

    @staticmethod
    def overall(checks: Sequence[tuple[str, str, str]]) -> str:
        grades = [status for _, status, _ in checks]
        return SKIPPED if grades == [SKIPPED] else max((g for g in grades if g in GRADES), key=GRADES.index, default="PASS")

    def validate(self, spark: SparkSession, table: str, df: DataFrame, strict: bool = True) -> DataFrame:
        """H2: one row per check (table, check, status, message)."""
        return spark.createDataFrame([(table, *c) for c in self.checks(table, df, strict)], RESULT_SCHEMA)

    def validate_all(self, spark: SparkSession, dfs: Mapping[str, DataFrame], strict: bool = True):
        """H3: every registered table present in ``dfs``; returns (details frame, failures)."""
        each = {t: self.checks(t, dfs[t], strict) for t in self._layouts if t in dfs}
        details = spark.createDataFrame([(t, *c) for t, found in each.items() for c in found], RESULT_SCHEMA)
        return details, sum(self.overall(found) == "FAIL" for found in each.values())

    def assert_valid(self, table: str, df: DataFrame, strict: bool = True) -> None:
        broken = {c: seen for c, status, seen in self.checks(table, df, strict) if status == "FAIL"}
        if broken:
            raise AssertionError(f"{table} breaks its contract: {broken}")


# ------------------------------------------------------------------ stored contracts

STORED_SCHEMA = ("table_name string, version int, position int, column_name string, data_type string, has_nulls boolean, is_key boolean, "
                 "n_rows long, n_keys long")


def contract_columns(tables: Mapping[str, DataFrame], keys: Mapping[str, str] | None = None) -> DataFrame:
    """H1 as a table: a row per column with its type, whether it holds nulls, and the table's rows and distinct
    keys (the first column unless ``keys`` names another); one aggregate and one key count a table, all lazy."""
    out = None
    for name, df in tables.items():
        key = (keys or {}).get(name, df.columns[0])
        seen = df.agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.bool_or(F.col(f"`{c}`").isNull()), F.lit(False)).alias(f"_z{i}") for i, c in enumerate(df.columns)])
        n_keys = df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("k")).agg(F.lit(1).alias("one")).agg(F.count("one").alias("_k"))
        items = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                          F.col(f"_z{i}").alias("has_nulls"), F.lit(f.name == key).alias("is_key")) for i, f in enumerate(df.schema.fields)]
        part = seen.crossJoin(n_keys).select(F.lit(name).alias("table_name"), F.explode(F.array(*items)).alias("c"), "_n", "_k").select(
            "table_name", "c.*", F.col("_n").alias("n_rows"), F.col("_k").alias("n_keys"))
        out = part if out is None else out.unionByName(part)
    return out


class ContractStore:
    """Versions of a layer's contract as JSON files in a shared folder, one folder a version; versions are never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit())

    def save(self, tables: Mapping[str, DataFrame], keys: Mapping[str, str] | None = None) -> int:
        """Capture the tables as the next version."""
        version = max(self.versions(), default=0) + 1
        contract_columns(tables, keys).write.mode("error").json(f"{self.path}/version={version}")
        return version

    def load(self, version: int | None = None) -> DataFrame:
        """A stored version, the latest by default; without one a ValueError."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"no contract version {version or ''} in {self.path}")
        version = version or known[-1]
        columns = ", ".join(c for c in STORED_SCHEMA.split(", ") if not c.startswith("version"))
        return self.spark.read.schema(columns).json(f"{self.path}/version={version}").withColumn("version", F.lit(version))

    def drift(self, tables: Mapping[str, DataFrame], version: int | None = None, keys: Mapping[str, str] | None = None) -> DataFrame:
        """(table_name, column_name, change, stored, found) between a stored version and the tables as they are now:
        tables and columns that are gone or new, types, positions, nulls where none were, and row and key counts."""
        old, new = self.load(version).drop("version"), contract_columns(tables, keys)
        j = old.select(F.struct(*old.columns).alias("o"), "table_name", "column_name").join(
            new.select(F.struct(*new.columns).alias("n"), "table_name", "column_name"), ["table_name", "column_name"], "full")

        def change(name, when, a, b):
            return F.when(when, F.struct(F.lit(name).alias("change"), a.cast("string").alias("stored"), b.cast("string").alias("found")))

        both = F.col("o").isNotNull() & F.col("n").isNotNull()
        once = both & F.col("o.is_key")  # a table's counts are told at its key

        def differs(c):
            return ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))

        found = F.array_compact(F.array(
            change("column gone", F.col("n").isNull(), F.col("o.data_type"), F.lit(None)), change("column new", F.col("o").isNull(), F.lit(None), F.col("n.data_type")),
            change("type", both & differs("data_type"), F.col("o.data_type"), F.col("n.data_type")),
            change("position", both & differs("position"), F.col("o.position"), F.col("n.position")),
            change("nulls", both & ~F.col("o.has_nulls") & F.col("n.has_nulls"), F.col("o.has_nulls"), F.col("n.has_nulls")),
            change("rows", once & differs("n_rows"), F.col("o.n_rows"), F.col("n.n_rows")), change("keys", once & differs("n_keys"), F.col("o.n_keys"), F.col("n.n_keys"))))
        return j.select("table_name", "column_name", F.explode(found).alias("x")).select("table_name", "column_name", "x.*")


def declared_constraints(table: DataFrame, pk: str, not_null: Sequence[str] = (),
                         fks: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """H4: PRIMARY KEY, NOT NULL and REFERENCES checks as violation counts.

    PK: rows in duplicated key groups (partial aggregation); NOT NULL: one
    aggregate; REFERENCES: one ``left_anti`` join per foreign key of its counted values
    against the parent's keys.  Each check plans ``table`` anew: hand in a written one if it is costly.
    """
    spark_parts = []
    dup = (table.groupBy(pk).agg(F.count(F.lit(1)).alias("_k"))
                .agg(F.coalesce(F.sum(F.when(F.col("_k") > 1, F.col("_k"))), F.lit(0)).alias("violations"))
                .select(F.lit("PRIMARY KEY").alias("constraint_type"), F.lit(pk).alias("column_name"), "violations"))
    spark_parts.append(dup)
    if not_null:
        nn = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        spark_parts.append(nn.select(F.explode(F.array(*[
            F.struct(F.lit("NOT NULL").alias("constraint_type"), F.lit(c).alias("column_name"),
                     F.col(c).cast("long").alias("violations")) for c in not_null])).alias("s")).select("s.*"))
    for col, (parent, key) in (fks or {}).items():
        keys = parent.select(F.col(key).alias("_pk")).where(F.col("_pk").isNotNull())
        values = table.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_fk")).agg(F.count(F.lit(1)).alias("_k"))
        orphans = values.join(keys, F.col("_fk") == F.col("_pk"), "left_anti")
        spark_parts.append(orphans.agg(F.lit("REFERENCES").alias("constraint_type"), F.lit(col).alias("column_name"),
                                       F.coalesce(F.sum("_k"), F.lit(0)).alias("violations")))
    out = spark_parts[0]
    for p in spark_parts[1:]:
        out = out.unionByName(p)
    return out


# The modelled warehouse tables (one fact, six dimensions).
WAREHOUSE_TABLES = ["DIM_FL_DATES", "DIM_DEP_HOURS", "DIM_STATIONS", "DIM_CARRIERS", "DIM_JUNK", "DIM_AIRCRAFTS",
                    "FLIGHTS"]


def check_table_set(actual: Sequence[str], modelled: Sequence[str] = WAREHOUSE_TABLES) -> None:
    """H3: the set of built tables must equal the modelled set (metadata only; raises)."""
    missing, extra = set(modelled) - set(actual), set(actual) - set(modelled)
    if missing or extra:
        raise AssertionError(f"warehouse tables differ from the model: missing {sorted(missing)}, extra {sorted(extra)}")
