"""Readers and sinks."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed table list of the driver layer (TPC-H-like star plus side tables).
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def normalize_name(name: str, mode: str = "lower") -> str:
    """A2: lower / upper / strip a header; inner blanks become ``_``."""
    if mode == "lower":
        out = name.strip().lower()
    elif mode == "upper":
        out = name.strip().upper()
    elif mode == "strip":
        out = name.strip()
    else:
        raise ValueError(f"unknown normalize mode {mode!r}")
    return re.sub(r"\s+", "_", out)


def normalize_columns(df: DataFrame, mode: str = "lower") -> DataFrame:
    """A2: rename every column at once (a projection, no job)."""
    return df.toDF(*[normalize_name(c, mode) for c in df.columns])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


# Text that means a missing value.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
             "NaN", "None", "n/a", "nan", "null")


def _typed(df: DataFrame) -> DataFrame:
    """Text columns whose values all read as whole numbers, or all as numbers, become that (one aggregate)."""
    def fits(c, kind):
        value = F.col(f"`{c}`")
        return F.coalesce(F.bool_and(F.when(value.isNotNull(), value.try_cast(kind).isNotNull())), F.lit(False))

    checks = [x for i, c in enumerate(df.columns) for x in (
        fits(c, "bigint").alias(f"w{i}"), fits(c, "double").alias(f"d{i}"),
        F.coalesce(F.bool_or(F.col(f"`{c}`").contains(".")), F.lit(False)).alias(f"p{i}"))]
    seen = df.agg(*checks).first() if checks else None
    cols = []
    for i, c in enumerate(df.columns):
        kind = "bigint" if seen[f"w{i}"] and not seen[f"p{i}"] else "double" if seen[f"d{i}"] else "string"
        cols.append(F.col(f"`{c}`").cast(kind).alias(c))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema=None, na_values=NA_TOKENS) -> DataFrame:
    """One table, lazily.  CSV values are read as text, missing-value tokens become null (also in
    numeric columns), then the columns get the types of ``schema`` or, without one, the narrowest
    of bigint, double and string that holds all values.  NaN becomes null."""
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
        if na_values:
            df = df.select(*[F.when(~F.trim(F.col(f"`{c}`")).isin(list(na_values)), F.col(f"`{c}`")).alias(c) for c in df.columns])
        if schema is None:
            return _typed(df)
        if isinstance(schema, str):
            schema = spark.createDataFrame([], schema).schema
        return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def _tables_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """name -> path of every ``.parquet`` or ``.csv`` file (or folder) in a folder, by name."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
    return {n.rsplit(".", 1)[0]: f"{folder.rstrip('/')}/{n}" for n in names if n.lower().endswith((".parquet", ".csv"))}


def load_tables(spark: SparkSession, source, normalize_cols: str | None = None,
                layers: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, DataFrame]:
    """A1: lazily read every table of a layer.

    ``source`` is a layer name (looked up in ``layers``), a directory holding
    ``<table>.parquet`` / ``<table>.csv`` files, or a mapping name -> path.
    Unknown layer names raise ValueError, other types TypeError; a missing file
    is skipped.
    """
    if isinstance(source, Mapping):
        paths = dict(source)
    elif isinstance(source, str):
        if layers and source in layers:
            paths = dict(layers[source])
        elif os.path.isdir(source) or "://" in source:
            paths = _tables_in(spark, source)
        else:
            raise ValueError(f"unknown source {source!r}")
    else:
        raise TypeError(f"source must be a layer name, a directory or a mapping, not {type(source).__name__}")
    out = {}
    for name, path in paths.items():
        if not _exists(spark, path):
            continue
        df = read_table(spark, path)
        out[name] = normalize_columns(df, normalize_cols) if normalize_cols else df
    return out


def table_inventory(tables: Mapping[str, DataFrame], with_pk: bool = False) -> DataFrame:
    """One row per table (rows, columns[, pk = first column]).

    Each row is a global ``count`` (parquet answers it from footers), unioned
    into one plan.
    """
    parts = []
    for name, df in tables.items():
        cols = [F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                F.lit(len(df.columns)).cast("long").alias("n_columns")]
        if with_pk:
            cols.append(F.lit(df.columns[0]).alias("pk"))
        parts.append(df.agg(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> None:
    """Write a layer table or a report (overwrite, no index)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)  # text as it is
    else:
        w.format(fmt).save(path)


def write_layer(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet",
                partition_by: Mapping[str, list] | None = None) -> dict[str, str]:
    out = {}
    for name, df in tables.items():
        path = os.path.join(base, f"{name}.{fmt}" if fmt == "csv" else name)
        write_table(df, path, fmt, (partition_by or {}).get(name))
        out[name] = path
    return out
