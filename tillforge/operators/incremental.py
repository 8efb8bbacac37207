"""Which files and rows are new: fingerprints, classification, watermarks, manifests.

``incoming`` frames hold one row per file: ``file_name, file_hash, file_time, batch_id,
is_replay, is_present``. ``registry`` frames hold one row per processing event:
``file_name, file_hash, status, processed_at, batch_id, run_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C

PROCESSED = ["SUCCESS", "REPROCESSED"]
STRATEGIES = ["TIMESTAMP", "FILE_HASH", "BATCH_ID", "COMPOSITE", "FULL_RELOAD"]


def processed(registry: DataFrame) -> DataFrame:
    """Events after which a file counts as processed; a replayed file stays processed."""
    return registry.filter(F.col("status").isin(PROCESSED))


def latest_watermark(registry: DataFrame) -> DataFrame:
    """Latest successful processing time, the epoch when there is none."""
    epoch = F.lit(C.EPOCH).cast("timestamp_ntz")
    return processed(registry).agg(F.coalesce(F.max("processed_at"), epoch).alias("watermark"))


def files_already_processed(incoming: DataFrame, registry: DataFrame) -> DataFrame:
    known = processed(registry).select("file_hash").distinct()
    return incoming.join(known, "file_hash", "left_semi")


def classify_files(incoming: DataFrame, registry: DataFrame, stale_before: Column | None = None) -> DataFrame:
    """Add ``classification``; precedence missing, replay, known content, stale, known name.

    Known hashes and names are made distinct first, so each file meets at most one row
    however many copies the registry holds.
    """
    done = processed(registry)
    hashes = done.select(F.col("file_hash").alias("_hash")).distinct()
    names = done.select(F.col("file_name").alias("_name")).distinct()
    joined = incoming.join(hashes, F.col("file_hash") == F.col("_hash"), "left").join(
        names, F.col("file_name") == F.col("_name"), "left"
    )
    old = F.lit(False) if stale_before is None else F.col("file_time") < stale_before
    label = (
        F.when(~F.col("is_present"), "STALE")
        .when(F.col("is_replay"), "REPROCESS")
        .when(F.col("_hash").isNotNull(), "DUPLICATE")
        .when(old, "STALE")
        .when(F.col("_name").isNotNull(), "MODIFIED")
        .otherwise("NEW")
    )
    return joined.withColumn("classification", label).drop("_hash", "_name")


def select_incremental(incoming: DataFrame, registry: DataFrame, strategy: str) -> DataFrame:
    """Files to process under one of the five strategies."""
    done = processed(registry)

    def newer(df: DataFrame) -> DataFrame:
        return df.filter(F.col("file_time") > latest_watermark(registry).scalar())

    def unknown(df: DataFrame, key: str) -> DataFrame:
        return df.join(done.select(key).distinct(), key, "left_anti").select(*incoming.columns)

    if strategy == "TIMESTAMP":
        return newer(incoming)
    if strategy == "FILE_HASH":
        return unknown(incoming, "file_hash")
    if strategy == "BATCH_ID":
        return unknown(incoming, "batch_id")
    if strategy == "COMPOSITE":
        return unknown(newer(incoming), "file_hash")
    if strategy == "FULL_RELOAD":
        return incoming
    raise ValueError(f"unknown strategy {strategy!r}; one of {', '.join(STRATEGIES)}")


def registry_state(events: DataFrame) -> DataFrame:
    """Current row per content hash: first name, last time, REPROCESSED after a second load.

    Aggregates only, so a hash with very many events costs one partial row per task.
    """
    moment = F.struct("processed_at", "file_name")
    return (
        processed(events)
        .groupBy("file_hash")
        .agg(
            F.min(moment)["file_name"].alias("file_name"),
            F.max("processed_at").alias("processed_at"),
            F.count(F.lit(1)).alias("loads"),
        )
        .withColumn("status", F.when(F.col("loads") > 1, "REPROCESSED").otherwise("SUCCESS"))
    )


def run_manifest(
    classified: DataFrame, run_id: str, strategy: str = "FILE_HASH", extra: list[str] | None = None
) -> DataFrame:
    """One manifest row per evaluated file; needs ``rows_in_file``. A column ``rows_written``
    holds what a load really wrote; without it, every row of a loaded file counts."""
    written = F.col("rows_written" if "rows_written" in classified.columns else "rows_in_file")
    load = F.col("classification").isin("NEW", "MODIFIED", "REPROCESS")
    return classified.select(
        F.lit(run_id).alias("run_id"),
        "batch_id",
        F.col("file_name").alias("filename"),
        "file_hash",
        F.col("rows_in_file").alias("rows_read"),
        F.when(load, written).otherwise(0).alias("rows_loaded"),
        F.lit(strategy).alias("processing_strategy"),
        "classification",
        F.lit(C.APPLICATION_VERSION).alias("pipeline_version"),
        F.when(load, "SUCCESS").otherwise("SKIPPED").alias("status"),
        *(extra or []),
    )


def incremental_report(classified: DataFrame, registry: DataFrame, now: str, strategy: str = "FILE_HASH") -> DataFrame:
    def files(*kinds: str) -> Column:
        return F.count_if(F.col("classification").isin(*kinds))

    return classified.agg(
        files("NEW", "MODIFIED", "REPROCESS").alias("files_processed"),
        files("DUPLICATE").alias("files_skipped"),
        files("DUPLICATE").alias("duplicate_count"),
        files("REPROCESS").alias("replay_count"),
        files("STALE").alias("stale_count"),
        files("MODIFIED").alias("modified_count"),
    ).select(
        F.lit(strategy).alias("strategy_used"),
        latest_watermark(registry).scalar().alias("watermark_before"),
        F.lit(now).cast("timestamp_ntz").alias("watermark_after"),
        "*",
    )


def replay_selection(
    incoming: DataFrame, registry: DataFrame, run_id: str | None = None, file_hash: str | None = None
) -> DataFrame:
    """Incoming files whose content an earlier run (or one hash) covers, marked for replay."""
    if run_id is None and file_hash is None:
        raise ValueError("a replay needs a run id or a file hash")
    chosen = registry
    if run_id is not None:
        chosen = chosen.filter(F.col("run_id") == run_id)
    if file_hash is not None:
        chosen = chosen.filter(F.col("file_hash") == file_hash)
    hashes = chosen.select("file_hash").distinct()
    return incoming.join(hashes, "file_hash", "left_semi").withColumn("is_replay", F.lit(True))


# --- row level ---------------------------------------------------------------


def store_watermark(sales: DataFrame, time: Column, entity: str = "sales") -> DataFrame:
    """Highest transaction time per store."""
    return (
        sales.groupBy("store_id")
        .agg(F.max(time).alias("last_processed_timestamp"))
        .select(F.lit(entity).alias("entity_name"), "store_id", "last_processed_timestamp")
    )


def rows_after_watermark(sales: DataFrame, time: Column, watermarks: DataFrame) -> DataFrame:
    """Rows newer than their store's watermark; stores without one pass whole."""
    marks = watermarks.select(F.col("store_id").alias("_store"), F.col("last_processed_timestamp").alias("_mark"))
    return (
        sales.join(marks, F.col("store_id") == F.col("_store"), "left")
        .filter(F.col("_mark").isNull() | (time > F.col("_mark")))
        .drop("_store", "_mark")
    )
