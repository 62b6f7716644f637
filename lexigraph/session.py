"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexigraph")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEXIGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names.

    ``spark.checkpoint.dir`` is set by the cluster and must be reachable from every
    executor. Only a local session may fall back to a temporary folder of the machine.
    """
    path = lasting_dir(spark, f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


_LOCAL_BASE: list[str] = []


def lasting_dir(spark: SparkSession, name: str) -> str:
    """The same path at every call, below the shared folder, for what later runs are to find."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL_BASE:
            _LOCAL_BASE.append(tempfile.mkdtemp(prefix="lexigraph-"))
            atexit.register(shutil.rmtree, _LOCAL_BASE[0], ignore_errors=True)
        base = _LOCAL_BASE[0]
    return f"{base.rstrip('/')}/{name}"


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has named so far, and return their number.

    Call it when nothing that reads them is needed any more.
    """
    n = 0
    while _SCRATCH:
        n += delete_path(spark, _SCRATCH.pop())
    return n


def delete_path(spark: SparkSession, name: str) -> bool:
    """Delete a file or folder, and return whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run in here go as soon as it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def input_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def jvm_class(spark: SparkSession, name: str):
    """A class of the JVM, for Hadoop's input and output formats."""
    lang = spark._jvm.java.lang
    return lang.Class.forName(name, True, lang.Thread.currentThread().getContextClassLoader())


def widen(scan: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores by ``key`` if it has fewer input splits than cores.

    Meant for small files under costly expressions; large inputs pass through unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan
