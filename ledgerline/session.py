"""Session construction and shared scratch locations."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# HotSpot interprets methods of more than 8000 bytes for good. A stage whose generated code is longer (cleaning a row
# of many columns is) runs operator by operator instead, in methods that are compiled.
COMPILED_ONLY = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# A skewed join is split by AQE also where the split costs the steps behind it another shuffle, as a dedupe by the join's key does.
SKEW_SAFE = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}

# Spark notes the call site of every column expression for its error messages, by walking the stack. The cleaners make
# thousands of expressions a batch; the notes cost the driver more than the expressions.
NO_CALL_SITES = {"spark.sql.dataFrameQueryContext.enabled": "false"}

# Settings every job relies on. Timestamps are TIMESTAMP_NTZ throughout, so the
# session zone only matters for `current_timestamp()`; UTC keeps audit columns
# comparable across machines.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    **COMPILED_ONLY,
    **SKEW_SAFE,
    **NO_CALL_SITES,
}


def with_compiled_code(spark: SparkSession) -> SparkSession:
    """The session with the code length limit, the splitting of skewed joins and no call sites, also where it was not made by :func:`build_session`."""
    for key, value in {**COMPILED_ONLY, **SKEW_SAFE, **NO_CALL_SITES}.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions``
    so that one shuffle partition holds roughly 128-256 MB; AQE then coalesces
    small ones and splits skewed join partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context). When neither is set, a ``local`` master gets a fresh private
    folder; on any other master this raises, because executors would not see a
    folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    resolved = sc.getCheckpointDir() or configured
    return resolved.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique directory under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more, in whatever store it lies."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Its cleaner does so once the driver's collectors have found such a frame, which on a large heap may be never: between steps
    that each shuffle much, disk then holds the files of all of them.
    """
    gc.collect()  # the Python side's references first
    spark.sparkContext._jvm.java.lang.System.gc()
