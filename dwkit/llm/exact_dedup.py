"""Exact duplicates through an extendible-hash index kept in shared files.

The text is normalised (runs of ASCII white space become one space) and hashed to 64
bits.  An index over the *distinct* keys is built as follows.

* Rows are reduced to one chain element per (hash, digest): smallest id and number of rows.
* ``grow_directory`` doubles a directory of hash prefixes until no bucket holds more keys
  than its capacity; only overfull buckets are split, so buckets have different depths.  A bucket
  that is still overfull at the greatest depth stays one longer bucket.
* The elements go to the task that owns their bucket's range of keys.  It chains elements of one
  hash (the element's place in the chain is part of its key) and writes them, sorted, to the shared folder.
* Elements with several rows are confirmed on their bytes.  Texts that differ although
  hash and digest agree become further chain elements, each with its own group.
* Every row looks its group up in the index: the directory gives the bucket of its hash, the bucket
  its element.

Everything is DataFrame expressions.  Elements with at least one row in ``HOT_ELEMENTS`` are that many at
most; they are broadcast where rows meet the index, so that no task gets the rows of a hot group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

WHITE = "[\\x20\\x09-\\x0D]+"
BUCKET_CAPACITY = 4096
MAX_DEPTH = 40
HOT_ELEMENTS = 1024


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str, hash_bits: int, digest_chars: int) -> DataFrame:
    norm = docs.select(F.col(f"`{id_col}`").alias("id"), normalised(F.col(f"`{text_col}`")).alias("norm"))
    sha = F.sha2("norm", 256)
    return norm.select("id", "norm", F.shiftrightunsigned(F.xxhash64("norm"), 64 - hash_bits).alias("h"),
                       sha.alias("sha"), F.substring(sha, 1, digest_chars).alias("digest"))


def grow_directory(keys: DataFrame, n_keys: int, hash_bits: int = 64, capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, int]:
    """(leaf, depth, bucket) rows and the leaf width in bits for distinct hashes ``h``.

    A bucket at depth ``d`` holds the keys that share ``d`` leading bits.  Starting with one
    bucket, each overfull bucket is split in two until it fits (or the leaves are reached):
    that is the smallest depth at which the prefix's load is within ``capacity``.
    """
    width = min(hash_bits, MAX_DEPTH, max(1, math.ceil(math.log2(max(1, n_keys) / capacity)) + 3)) if n_keys > capacity else 0
    leaves = keys.groupBy(_leaf(hash_bits, width).alias("leaf")).agg(F.count("*").alias("n"))
    levels = leaves.select("leaf", "n", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(leaf, {width} - depth)"))
    load = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("load"))
    fitting = load.where((F.col("load") <= capacity) | (F.col("depth") == width)).select("depth", "prefix")
    directory = levels.join(fitting, ["depth", "prefix"]).groupBy("leaf").agg(F.min("depth").alias("depth"))
    first = F.expr(f"shiftleft(shiftright(leaf, {width} - depth), {width} - depth)")
    return directory.select("leaf", "depth", first.alias("bucket")), width


def _matching(rows: DataFrame, elements: DataFrame, total: int, keys: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``elements`` (keys, group_size, ...), hot elements by broadcast, the others by shuffle."""
    hot = elements.where(F.col("group_size") * HOT_ELEMENTS >= total)  # at most HOT_ELEMENTS rows
    cold = elements.where(F.col("group_size") * HOT_ELEMENTS < total)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold.hint("merge"), keys))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY,
                hash_bits: int = 64, digest_chars: int = 64) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(entries, index, directory, width), the first two written to the shared folder.

    entries: one row per input row (id, h, digest, chain, sha).  index: one row per group of
    equal texts (bucket, depth, h, digest, chain, place, keep_id, group_size), dealt to owner tasks by
    bucket range.  ``hash_bits`` and ``digest_chars`` shorten the keys; tests use that to force
    collisions.
    """
    keyed = _keyed(docs, id_col, text_col, hash_bits, digest_chars)
    entries = materialize(keyed.select("id", "h", "digest", "sha"), "dedup-entries")
    groups = materialize(entries.groupBy("h", "digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")),
                         "dedup-groups")
    total = entries.count()
    # equal bytes within a chain element <=> its smallest text is its largest (a task sends two texts an element)
    several = groups.where("group_size > 1").select("h", "digest", "group_size")
    members = _matching(keyed.select("id", "norm", "h", "digest"), several, total, ["h", "digest"])
    differing = materialize(members.groupBy("h", "digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
                            .where("lo != hi").select("h", "digest"), "dedup-collisions")
    groups = groups.withColumn("chain", F.lit("").cast("string"))
    entries = entries.withColumn("chain", F.lit("").cast("string"))
    if not differing.isEmpty():
        # the byte comparison failed for these keys: one chain element per distinct text
        text_key = F.concat_ws("-", F.sha2(F.col("norm"), 512), F.md5("norm"))
        apart = keyed.join(differing, ["h", "digest"], "left_semi").withColumn("chain", text_key)
        groups = groups.join(differing, ["h", "digest"], "left_anti").unionByName(
            apart.groupBy("h", "digest", "chain").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")))
        entries = entries.join(differing, ["h", "digest"], "left_anti").unionByName(
            apart.select("id", "h", "digest", "sha", "chain"))
    directory, width = grow_directory(groups.select("h").distinct(), groups.count(), hash_bits, capacity)
    directory = materialize(directory, "dedup-directory")
    owned = groups.withColumn("leaf", _leaf(hash_bits, width)).join(directory, "leaf").drop("leaf")
    owned = owned.repartitionByRange(F.col("bucket"), F.col("h")).sortWithinPartitions("bucket", "h", "digest", "chain")
    in_chain = Window.partitionBy("bucket", "h").orderBy("digest", "chain")  # within its owner task
    return entries, materialize(owned.withColumn("place", F.row_number().over(in_chain)), "dedup-index"), directory, width


def _leaf(hash_bits: int, width: int):
    return F.shiftrightunsigned("h", hash_bits - width) if width else F.lit(0).cast("long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64, **options) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Of equal texts the row with the smallest id stays.  Null text counts as empty; null ids
    are ordered after all others (a group of null ids only keeps the null).  Rows that repeat
    id and text are all marked alike and counted each.  Other columns of ``docs`` are not
    read, an empty table gives an empty result.
    """
    entries, index, directory, width = build_index(docs, id_col, text_col, hash_bits=hash_bits, **options)
    total = index.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    hot = index.where(F.col("group_size") * HOT_ELEMENTS >= total).select("h", "digest", "chain", "keep_id", "group_size")  # at most HOT_ELEMENTS rows
    cold = index.where(F.col("group_size") * HOT_ELEMENTS < total).select("bucket", "h", "digest", "chain", "keep_id", "group_size")
    element = ["h", "digest", "chain"]
    rest = entries.join(F.broadcast(hot.select(*element)), element, "left_anti").withColumn("leaf", _leaf(hash_bits, width))
    rest = rest.join(directory.select("leaf", "bucket").hint("merge"), "leaf").join(cold.hint("merge"), ["bucket", *element])
    names = ["id", "sha", "keep_id", "group_size"]
    found = entries.join(F.broadcast(hot), element).select(*names).unionByName(rest.select(*names))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without later copies, same columns; of rows that repeat id and text one stays."""
    kept = exact_dedup(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha")).distinct()
    names = docs.columns
    rows = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, text = F.col(f"_c{names.index(id_col)}"), F.col(f"_c{names.index(text_col)}")
    rows = rows.withColumn("_sha", F.sha2(normalised(text), 256))
    rows = rows.join(kept.hint("merge"), i.eqNullSafe(F.col("id")) & (F.col("_sha") == F.col("sha")), "left_semi")
    once = Window.partitionBy(i, "_sha").orderBy("_sha")
    rows = rows.withColumn("_copy", F.row_number().over(once)).where("_copy = 1").drop("_copy", "_sha")
    return rows.toDF(*names)
