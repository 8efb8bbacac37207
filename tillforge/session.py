"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results; the rest is sizing and belongs to the cluster.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Adaptive execution picks join strategies from measured sizes and splits hot keys.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def create_session(app_name: str = "tillforge", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **ADAPTIVE_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_result_settings(spark: SparkSession) -> SparkSession:
    """Set the result-deciding options on a session that somebody else built."""
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is used if all tasks run on this
    machine, as in tests; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        java_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = java_dir.get() if java_dir.isDefined() else None
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tillforge-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/tillforge/{label}-{uuid.uuid4().hex}"


#: What written copies and loaded tables are compressed with; a third smaller than the default.
COMPACT = {"compression": "zstd"}
#: For writes of many small files. On a local disk Hadoop puts a checksum file beside each
#: and starts a process for the rights of either; the plain local file system makes the file
#: alone. Other storage takes no notice.
MANY_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a query that runs in here go when it ends, not when the driver's
    collector finds its plan. They are of no use after a write: its copy is read instead."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def folders_listed(spark: SparkSession):
    """A read that is set up in here lists its folders in a few tasks a core; Spark starts a
    task for each of the first 10,000 folders."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return _set(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


_open = threading.local()


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Copies that :func:`write_through` makes in here are deleted at its end: for work that
    leaves nothing behind which still reads them. Paths added to the list go as well."""
    outer, own = getattr(_open, "paths", None), []
    _open.paths = own
    try:
        yield own
    finally:
        _open.paths = outer
        for path in own:
            delete(spark, path)


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write a result once to the shared folder and go on from the written copy.

    Cuts the lineage and survives lost executors; readers can still prune columns.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    with shuffles_dropped(spark):
        df.write.mode("error").options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
