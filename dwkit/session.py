"""Session helpers: a tuned local/cluster session and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at 100 TB as much as on a laptop: adaptive execution
# (coalescing, skew-join splitting, runtime broadcast), UTC session clock so
# date/hour keys agree with the parquet writer, and Arrow for pandas UDFs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dwkit", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine defaults applied.

    On a cluster ``master`` stays None and the submitter decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder (a shared file system path); it is read from
    the session.  Only when it is unset and the master is local a private folder is
    made; on a cluster that is an error, since executors could not read each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="dwkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


BATCH_ROWS = 1000  # rows of whole texts that a Python worker holds at once


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows, unless the session asks for smaller ones.

    Spark's 10,000 rows of whole texts take a worker tens of MB, several times over (as Arrow, as Python texts, and the
    next batch beside it); nothing here depends on where a batch ends.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def materialize(df, tag: str = "table"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor never recomputes the input plan)
    and, unlike an RDD checkpoint, stays columnar so later passes read only
    the columns they use.  The schema is known, so reading back starts no job.
    """
    import uuid

    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), tag, uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def drop_materialized(spark: SparkSession) -> int:
    """Delete the intermediate tables written by ``materialize`` in this process.

    Frames returned by the operators read these tables lazily, so call this
    only after the actions that use them have run.  Returns the number removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dwkit`` importable in Python workers (``addPyFile`` of a zip of the package).

    Arrow UDF tasks (fuzzy matching, isolation forest) unpickle functions that
    live in this package; on a cluster the executors do not have it unless it
    is shipped, exactly as ``spark-submit --py-files`` would.  Done once per
    SparkContext.
    """
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="dwkit-pyfiles-"), "dwkit.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("dwkit", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
