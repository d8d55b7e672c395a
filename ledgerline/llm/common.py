"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerline
from ledgerline.session import checkpoint_root, drop_unused_shuffles  # noqa: F401 - operators take it from here


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow frame in the shared checkpoint folder and go on from there.

    Recomputed tasks of later jobs then read the same rows, also when an executor is lost.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def hex_sha256(column) -> "F.Column":
    return F.sha2(column, 256)


def blank_if_null(name: str):
    return F.coalesce(F.col(name), F.lit(""))


#: Empties the caches that operators keep in a Python worker from task to task; each operator adds its own.
FORGET: list[Callable[[], None]] = []


def release_memory(forget: bool = True) -> None:
    """Give memory of this Python worker back to the machine: workers serve many stages and would keep it.

    With ``forget`` also what other operators' tasks left in their caches.
    """
    for empty in FORGET if forget else ():
        empty()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[..., Iterator], forget: bool = True) -> Callable[..., Iterator]:
    """A mapInArrow function that releases its worker's memory when its task ends."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory(forget)

    return tidied


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context.

    Spark's own file distribution carries it, so executors need no installation and no common folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_shipped", False):
        return
    root = Path(ledgerline.__file__).parent
    folder = Path(SparkFiles.getRootDirectory()) / "packages"  # the driver's own folder for files to distribute
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / "ledgerline.zip", "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(path.relative_to(root.parent)))
    sc.addPyFile(str(folder / "ledgerline.zip"))
    sc._ledgerline_shipped = True


#: Python workers and the JVM each hold a few Arrow batches; Spark's default of 64 MB is much for executors of 3 GB.
ARROW_BATCH = "8m"


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage whose first argument is the session, run with the package at the workers and bounded Arrow batches."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
        return query(spark, *args)

    return run
