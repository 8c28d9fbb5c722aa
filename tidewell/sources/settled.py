"""Tables that a job writes in the shared folder and reads again: lineage ends there.

The folder is the one that the cluster names in spark.checkpoint.dir, so all executors and the
driver see it; a lost executor costs no more than the step at hand.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.  Where it is unset, a local master gets a
    local folder; on a cluster that would be another folder on each machine, so it raises."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_settled: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_open: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Lists the tables that are settled inside; those not in the list yielded go at the end, so put there
    what later plans read."""
    made: list[DataFrame] = []
    kept: list[DataFrame] = []
    _open.append(made)
    try:
        yield kept
    finally:
        _open.pop()
        for table in made:
            if not any(table is k for k in kept):
                release(table)
            elif _open:
                _open[-1].append(table)


def settle(df: DataFrame, name: str, dense: bool = False) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there, so a lost
    executor costs no recomputation and no plan is run twice.  The table goes when the driver ends.
    dense: for whole texts, compressed harder than usual."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidewell-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd" if dense else None)
    atexit.register(discard, spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    _settled[table] = path
    if _open:
        _open[-1].append(table)
    return table


def release(table: DataFrame) -> None:
    """Removes a settled table that no later step reads."""
    if path := _settled.pop(table, None):
        discard(table.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a settled table that nothing reads any more."""
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session is gone, and with it the way to delete
        return
