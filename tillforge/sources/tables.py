"""Readers for the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillforge.session import pin_result_settings


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One table; timestamps stay zone-free so that no session zone can shift them."""
    pin_result_settings(spark)
    return spark.read.option("inferTimestampNTZ", "true").parquet(f"{base_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a scan over all cores when its files give fewer tasks than cores.

    A table in one row group is read by one task, and all row work after it would stay
    there. Inputs with enough splits, i.e. any large table, are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
