"""Reading the given tables and keeping intermediate results in the shared folder."""

from __future__ import annotations

import gc
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import tillforge
from tillforge.session import work_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and go on from the copy: lineage ends there, and a lost
    executor costs a read. ``checkpoint()`` writes the same bytes, but readers of Parquet
    can prune columns. Spark drops the shuffle files of a finished job when its plan is
    collected as garbage, which an idle driver does late; it is asked to here."""
    return _written(df, label)[0]


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Kept copies that only one computation reads: gone when its own result is written."""

    def __init__(self):
        self.copies: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        copy, path = _written(df, label)
        self.copies.append((copy, path))
        return copy

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for copy, path in self.copies:
            context = copy.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: dict[int, object] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if _shipped.get(id(context)) is not context:
        package = Path(tillforge.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="tillforge-code-")) / "tillforge"
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped[id(context)] = context
    return spark
