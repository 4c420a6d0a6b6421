"""Window operators: first-per-key, duplicate flags, dense surrogate keys,
time-weighted interpolation and temporal gaps (E1-E6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW33 = (1 << 33) - 1


def _order_cols(order_cols: Sequence, nulls_last: bool = True) -> list[Column]:
    out = []
    for c in order_cols:
        if isinstance(c, Column):
            out.append(c)
        else:
            out.append(F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first())
    return out


# ------------------------------------------------------------------ E6

def with_dense_id(df: DataFrame, order_cols: Sequence, id_col: str = "id", bounded: bool = False,
                  first_position: bool = True, stage_input: bool = False) -> DataFrame:
    """Ids 1..n following ``order_cols`` (ascending, nulls last).

    ``bounded=True`` is for callers that know a bound of the row count from the
    value domain (dates, hours, flag pairs): one window without partitioning.

    The general path never moves the data through one task: the frame is range
    partitioned by the order (``orderBy``), each row gets its in-partition rank
    from ``monotonically_increasing_id`` (partition index in the upper bits,
    row position in the lower 33), the sorted frame is written as a parquet
    table under the shared checkpoint folder (cuts the lineage, so a lost
    executor never re-runs the sort; columnar, so the count pass reads one
    column), per-partition counts are summed into offsets (one row per
    partition: the broadcast is bounded by the partition count, not the data)
    and added back.

    ``stage_input=True`` first writes the (unsorted) input: the range
    partitioner samples its input before the sort, so an expensive input
    plan (joins, lookups) would otherwise run twice; staged, the sample pass
    reads only the key columns from parquet.
    """
    order = _order_cols(order_cols)
    if bounded:
        out = df.withColumn(id_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    else:
        src = materialize(df, "dense-ids-input") if stage_input else df
        order = _order_cols(order_cols)
        ranked = materialize(src.orderBy(*order).withColumn("_dw_mono", F.monotonically_increasing_id()), "dense-ids")
        pid = F.shiftright(F.col("_dw_mono"), 33)
        counts = ranked.groupBy(pid.alias("_dw_pid")).agg(F.count(F.lit(1)).alias("_dw_n"))
        offsets = counts.select(
            "_dw_pid",
            F.coalesce(F.sum("_dw_n").over(Window.orderBy("_dw_pid").rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("_dw_off"))
        out = (ranked.join(F.broadcast(offsets), pid == F.col("_dw_pid"), "inner")
               .withColumn(id_col, (F.col("_dw_off") + F.col("_dw_mono").bitwiseAND(F.lit(_LOW33)) + 1).cast("long"))
               .drop("_dw_mono", "_dw_pid", "_dw_off"))
    if first_position:
        out = out.select(id_col, *[c for c in df.columns if c != id_col])
    return out


def with_dense_id_by_key(df: DataFrame, keys: DataFrame, order_cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """E6 for rows in many small groups: the rows whose first order column occurs in ``keys`` (one column; null keys go),
    with the ids 1..n that ``with_dense_id`` gives them.

    Only one pair (key, rows) per key is sorted globally and written, with the number of rows before it.  The rows meet their
    key's number and are counted on inside their key, in the one shuffle by key that a later join on the
    key needs too; they are neither range partitioned nor written.
    """
    key, rest = order_cols[0], list(order_cols[1:])
    known = keys.select(F.col(keys.columns[0]).alias("_dw_key"))
    sizes = df.groupBy(F.col(key).alias("_dw_key")).agg(F.count(F.lit(1)).alias("_dw_n")).join(known, "_dw_key", "left_semi")
    ranged = materialize(sizes.repartitionByRange("_dw_key").withColumn("_dw_pid", F.spark_partition_id()), "dense-ids-keys")
    totals = ranged.groupBy("_dw_pid").agg(F.sum("_dw_n").alias("_dw_t"))  # one row per partition
    offsets = totals.select("_dw_pid", F.coalesce(F.sum("_dw_t").over(Window.orderBy("_dw_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_dw_off"))
    before = F.sum("_dw_n").over(Window.partitionBy("_dw_pid").orderBy("_dw_key").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranged.withColumn("_dw_before", F.coalesce(before, F.lit(0))).join(F.broadcast(offsets), "_dw_pid").select(
        "_dw_key", (F.col("_dw_off") + F.col("_dw_before")).alias("_dw_start"))
    inside = F.row_number().over(Window.partitionBy(key).orderBy(*_order_cols(rest)))
    out = df.join(starts, F.col(key) == F.col("_dw_key")).withColumn(id_col, (F.col("_dw_start") + inside).cast("long"))
    return out.select(id_col, *[c for c in df.columns if c != id_col])


# ------------------------------------------------------------------ E1 / E2

def deduplicate(df: DataFrame, keys: Sequence[str], order_cols: Sequence | None = None) -> DataFrame:
    """Keep the first row per key; "first" follows ``order_cols`` (ascending, nulls last).

    Written as an aggregate, ``min(struct(order..., row))`` per key, rather
    than a ranking window: the partial aggregate keeps one candidate per key
    per task before the shuffle, so a key holding a third of the rows costs
    no more than any other.  Without an order every non-key column orders the
    copies, so the survivor is deterministic.
    """
    order = list(order_cols) if order_cols is not None else [c for c in df.columns if c not in keys]
    if any(not isinstance(c, str) for c in order):
        w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_order_cols(order))
        return df.withColumn("_dw_rn", F.row_number().over(w)).where(F.col("_dw_rn") == 1).drop("_dw_rn")
    rest = [c for c in df.columns if c not in keys]
    parts = []
    for i, c in enumerate(order):
        parts += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    packed = F.struct(*parts, F.struct(*[F.col(c) for c in rest]).alias("_row"))
    first = df.groupBy(*[F.col(k) for k in keys]).agg(F.min(packed).alias("_dw_first"))
    return first.select(*keys, "_dw_first._row.*").select(*df.columns)


def with_duplicate_flag(df: DataFrame, keys: Sequence[str], name: str = "is_dup") -> DataFrame:
    """Flag every copy of a duplicated key (nulls equal).

    Keys are counted with partial aggregation, only the duplicated ones are
    kept and joined back null-safely; a hot key is one row on the small side,
    and AQE's skew handling splits the big side of that join.
    """
    dup = (df.groupBy(*[F.col(k).alias(f"_dk{i}") for i, k in enumerate(keys)])
             .agg(F.count(F.lit(1)).alias("_dn")).where(F.col("_dn") > 1)
             .select(*[f"_dk{i}" for i in range(len(keys))], F.lit(True).alias(name)))
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_dk{i}"))
        cond = c if cond is None else cond & c
    out = df.join(dup, cond, "left").drop(*[f"_dk{i}" for i in range(len(keys))])
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


# ------------------------------------------------------------------ E3

def temporal_seconds(date_col, hour_col=None) -> Column:
    """Seconds since the epoch of date + whole hours, computed without a time zone."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    secs = F.unix_date(d.cast("date")).cast("long") * 86400
    if hour_col is not None:
        h = F.col(hour_col) if isinstance(hour_col, str) else hour_col
        secs = secs + h.cast("long") * 3600
    return secs


def seconds_to_ntz(secs: Column) -> Column:
    """Inverse of ``temporal_seconds`` as TIMESTAMP_NTZ (wall clock, no zone)."""
    days = F.floor(secs / 86400).cast("int")
    rem = (secs - days.cast("long") * 86400).cast("long")
    return (F.date_from_unix_date(days).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), rem.cast("decimal(18,6)")))


def _null_safe(keys: Sequence[str], tag: str) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"{tag}{i}"))
    return cond


def _next_known(column: str, keys: Sequence[str], order: str) -> Column:
    """The first non-null value after a row, in the same sorted pass as running frames of that order."""
    part = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    return F.expr(f"lead(`{column}`) IGNORE NULLS OVER ({part}ORDER BY `{order}`)")


def _fill_value(c, prev, nxt, rn_gap_prev, rn_gap_next, s, n_known, n_valid, valid, limit, max_gap_hours):
    known = F.col(c).isNotNull()
    interp = (F.when(prev.isNotNull() & nxt.isNotNull(),
                     F.when(nxt["s"] == prev["s"], prev["v"]).otherwise(
                         prev["v"] + (nxt["v"] - prev["v"]) * (s - prev["s"]) / (nxt["s"] - prev["s"])))
              .when(prev.isNotNull(), prev["v"])
              .otherwise(nxt["v"]))
    allowed = F.lit(True)
    if limit is not None:
        allowed = F.coalesce(rn_gap_prev <= limit, F.lit(False)) | F.coalesce(rn_gap_next <= limit, F.lit(False))
    if max_gap_hours is not None:
        d_prev = F.when(prev.isNotNull(), (s - prev["s"]) / 3600.0)
        d_next = F.when(nxt.isNotNull(), (nxt["s"] - s) / 3600.0)
        near = F.least(F.coalesce(d_prev, F.lit(float("inf"))), F.coalesce(d_next, F.lit(float("inf"))))
        allowed = allowed & ((n_known < 2) | (near <= F.lit(float(max_gap_hours))))
    fill_ok = valid & (n_valid >= 2) & ~known & allowed
    return F.when(known, F.col(c).cast("double")).when(fill_ok, interp)


def interpolate_temporal(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str], date_col: str,
                         hour_col: str | None = None, limit: int | None = None,
                         max_gap_hours: float | None = None, row_id: str | None = None,
                         segment_rows: int = 1_000_000) -> DataFrame:
    """Time-weighted linear interpolation per group, edges filled flat.

    Semantics (per group; nulls are a group, no group columns are one group; rows with a
    null time and groups with fewer than two valid times are left alone):
    * a null between two known values gets ``v0 + (v1 - v0) * (t - t0) / (t1 - t0)``;
      before the first / after the last known value it gets that value;
    * ``limit``: only the first ``limit`` nulls after a known value and the
      last ``limit`` before one are filled (direction "both");
    * ``max_gap_hours``: when the column has >= 2 known values in the group, a
      filled value farther than the limit from both known neighbours is undone.

    A distributed segmented scan:

    1. rows get a global rank over (time known, group, time, id) from the range-partitioned
       dense-id pass (a hot group spans many partitions); the input is planned once;
    2. ranks are cut into segments of ``segment_rows``; inside each (segment, group) one sorted
       pass finds the last known point before and the first known point after a row;
    3. one aggregate per (segment, group) has the first and last known point and the
       counts; a pass over these few rows carries the last known point of earlier segments, the
       first of later ones and the group's totals to every segment.
    Rows with a null time come last, are no points and pass through unchanged.
    """
    gk = list(group_cols)
    tie = [row_id] if row_id else []
    work = df.withColumn("_dw_s", temporal_seconds(date_col, hour_col)).withColumn("_dw_null", F.col("_dw_s").isNull())
    ranked = with_dense_id(work, ["_dw_null", *gk, "_dw_s", *tie], "_dw_r", first_position=False)
    ranked = ranked.withColumn("_dw_seg", F.floor((F.col("_dw_r") - 1) / segment_rows).cast("long"))
    points = [F.when(F.col(c).isNotNull() & ~F.col("_dw_null"), F.struct(F.col("_dw_r").alias("r"), F.col("_dw_s").alias("s"), F.col(c).cast("double").alias("v")))
              for c in cols]
    order = Window.partitionBy("_dw_seg", *gk).orderBy("_dw_r")
    until_here = order.rowsBetween(Window.unboundedPreceding, 0)
    local = ranked.withColumns({f"_dw_pt{i}": p for i, p in enumerate(points)})
    local = local.withColumns({x: y for i in range(len(cols)) for x, y in (
        (f"_dw_lp{i}", F.last(f"_dw_pt{i}", ignorenulls=True).over(until_here)),
        (f"_dw_lx{i}", _next_known(f"_dw_pt{i}", ["_dw_seg", *gk], "_dw_r")))})
    per_seg = ranked.groupBy("_dw_seg", *gk).agg(
        F.count("_dw_s").alias("_dw_nt"),
        *[x for i, p in enumerate(points) for x in (F.max(p).alias(f"_dw_sl{i}"), F.min(p).alias(f"_dw_sf{i}"),  # structs order by rank first
                                                    F.count(p).alias(f"_dw_k{i}"))])
    g_part = Window.partitionBy(*gk)
    before = g_part.orderBy("_dw_seg").rowsBetween(Window.unboundedPreceding, -1)
    carries = per_seg.select(
        F.col("_dw_seg").alias("_dw_cseg"), *[F.col(k).alias(f"_dw_cg{i}") for i, k in enumerate(gk)], F.sum("_dw_nt").over(g_part).alias("_dw_nt"),
        *[x for i in range(len(cols)) for x in (
            F.last(f"_dw_sl{i}", ignorenulls=True).over(before).alias(f"_dw_cp{i}"),
            _next_known(f"_dw_sf{i}", gk, "_dw_seg").alias(f"_dw_cx{i}"), F.sum(f"_dw_k{i}").over(g_part).alias(f"_dw_k{i}"))])
    # null groups are groups: a null-safe join
    j = local.join(carries, (F.col("_dw_seg") == F.col("_dw_cseg")) & _null_safe(gk, "_dw_cg"), "left")
    outs = {}
    for i, c in enumerate(cols):
        prev = F.coalesce(F.col(f"_dw_lp{i}"), F.col(f"_dw_cp{i}"))
        nxt = F.coalesce(F.col(f"_dw_lx{i}"), F.col(f"_dw_cx{i}"))
        outs[c] = _fill_value(c, prev, nxt, F.col("_dw_r") - prev["r"], nxt["r"] - F.col("_dw_r"), F.col("_dw_s"),
                              F.col(f"_dw_k{i}"), F.col("_dw_nt"), ~F.col("_dw_null"), limit, max_gap_hours)
    return j.withColumns(outs).select(*df.columns)


# ------------------------------------------------------------------ E5

def detect_temporal_gaps(df: DataFrame, date_col: str, hour_col: str | None = None,
                         group_col: str | None = None, step_hours: float = 1.0) -> DataFrame:
    """E5: gaps longer than 1.5 steps between consecutive distinct times per group.

    Output: group, gap_start, gap_end, gap_length_hours, gap_length_intervals.
    The distinct times are ranked globally (range-partitioned, so a hot group spans
    many tasks) and each is paired with the one ranked just before it by an equi-join
    on the rank.
    """
    secs = temporal_seconds(date_col, hour_col)
    keys = [group_col] if group_col else []
    times = df.select(*[F.col(k) for k in keys], secs.alias("_dw_e")).where(F.col("_dw_e").isNotNull()).distinct()
    ranked = with_dense_id(times, [*keys, "_dw_e"], "_dw_r")
    prev = ranked.select((F.col("_dw_r") + 1).alias("_dw_r"), F.col("_dw_e").alias("_dw_b"),
                         *[F.col(k).alias(f"_dw_pk{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_dw_pk{i}"))
    pairs = ranked.join(prev, "_dw_r", "left").withColumn("_dw_b", F.when(same, F.col("_dw_b")))
    hours = (F.col("_dw_e") - F.col("_dw_b")) / 3600.0
    return (pairs.where(F.col("_dw_b").isNotNull() & (hours > 1.5 * step_hours))
            .select(*[F.col(k) for k in keys],
                    seconds_to_ntz(F.col("_dw_b")).alias("gap_start"),
                    seconds_to_ntz(F.col("_dw_e")).alias("gap_end"),
                    hours.alias("gap_length_hours"),
                    F.floor(hours / F.lit(step_hours)).cast("long").alias("gap_length_intervals")))
