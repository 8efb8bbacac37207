"""Audit events and runs: append, summaries, recent and failed runs, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.money import from_cents, half_up

DURATION = "decimal(18,2)"
EVENT_SCHEMA = (
    "event_id string, run_id string, event_name string, severity string, event_time timestamp_ntz, "
    "stage string, duration_ms decimal(18,2), message string, failure_category string"
)


def check_event(event_name: str, severity: str, failure_category: str | None = None) -> None:
    """Refuse names outside the declared lists before anything is written."""
    for value, allowed in (
        (event_name, C.LIFECYCLE_EVENTS),
        (severity, C.SEVERITIES),
        (failure_category, [None, *C.FAILURE_CATEGORIES]),
    ):
        if value not in allowed:
            raise ValueError(f"{value!r} is not one of {allowed}")


def record_events(spark, path: str, events: list[tuple]) -> None:
    """Append a run's events (tuples in ``EVENT_SCHEMA`` order) to the event table."""
    for event in events:
        check_event(event[2], event[3], event[8])
    spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def event_counts(events: DataFrame) -> DataFrame:
    """Events per name and severity, with a flag for names outside the declared lists."""
    return (
        events.groupBy("event_name", "severity")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("duration_ms").cast(DURATION).alias("duration_ms"))
        .withColumn("is_declared", F.col("event_name").isin(C.LIFECYCLE_EVENTS) & F.col("severity").isin(C.SEVERITIES))
    )


def alerts(events: DataFrame) -> DataFrame:
    return events.filter(F.col("severity").isin(C.ALERT_SEVERITIES))


def events_json(events: DataFrame, run: dict[str, str]) -> DataFrame:
    """Events as JSON log lines of twelve fields; ``run`` gives the context fields."""
    fields = F.struct(
        F.col("event_time").cast("string").alias("timestamp"),
        F.col("severity").alias("level"),
        F.lit("audit").alias("module"),
        F.lit("record_event").alias("function"),
        F.col("event_id").alias("line"),
        F.col("event_name").alias("message"),
        F.col("run_id").cast("string").alias("pipeline_run_id"),
        F.lit(run["batch_id"]).alias("batch_id"),
        F.lit(run["source_filename"]).alias("source_filename"),
        F.col("event_name").alias("execution_stage"),
        F.lit(run["environment"]).alias("environment"),
        F.lit(C.APPLICATION_VERSION).alias("application_version"),
    )
    return events.select("event_id", F.to_json(fields).alias("log_line"))


# --- per run -----------------------------------------------------------------


def last_stage(stages: DataFrame) -> DataFrame:
    """Stage to resume after: the last one recorded per run."""
    return stages.groupBy("run_id").agg(
        F.max_by("stage", F.struct("event_time", "event_id")).alias("last_successful_stage")
    )


def stage_bucket(stage: Column) -> Column:
    """Metric a stage's time counts toward, by its name."""
    name = F.lower(stage)
    return (
        F.when(name.contains("database"), "database_time_ms")
        .when(name.contains("validation"), "validation_time_ms")
        .when(name.contains("transformation"), "transformation_time_ms")
        .when(name.contains("load"), "loading_time_ms")
    )


def stage_durations(stages: DataFrame, names: list[str]) -> DataFrame:
    """Time per run in each named stage; one column per stage."""
    zero = F.lit(0).cast(DURATION)
    return stages.groupBy("run_id").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("duration_ms"))).cast(DURATION), zero).alias(f"{s}_ms")
            for s in names
        ],
        F.sum("duration_ms").cast(DURATION).alias("total_ms"),
    )


def throughput(rows: Column, milliseconds: Column) -> Column:
    """Rows per second, two decimals; 0 for an empty span."""
    per_second = from_cents(half_up(rows * 100000, F.greatest(milliseconds, F.lit(1))), DURATION)
    return F.when(milliseconds > 0, per_second).otherwise(F.lit(0).cast(DURATION))


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two zone-free timestamps."""
    def micros(t: Column) -> Column:
        return F.unix_micros(t.cast("timestamp"))

    return F.floor((micros(end) - micros(start)) / 1000).cast("bigint")


def run_log(events: DataFrame) -> DataFrame:
    """Audit runs from events: one row per run and day with counts and outcome."""
    return (
        events.groupBy("run_id", F.to_date("event_time").alias("run_date"))
        .agg(
            F.min("event_time").alias("started_at"),
            F.max("event_time").alias("completed_at"),
            F.count(F.lit(1)).alias("records_read"),
            F.count_if(F.col("severity") == "ERROR").alias("records_rejected"),
        )
        .select(
            F.concat(
                F.lit("RUN-"), F.col("run_id").cast("string"), F.lit("-"), F.date_format("run_date", "yyyyMMdd")
            ).alias("pipeline_run_id"),
            F.concat(F.lit("store-feed-"), (F.col("run_id") % 4).cast("string")).alias("pipeline_name"),
            "started_at",
            "completed_at",
            elapsed_ms(F.col("started_at"), F.col("completed_at")).alias("duration_ms"),
            "records_read",
            "records_rejected",
            (F.col("records_read") - F.col("records_rejected")).alias("records_loaded"),
            F.when(F.col("records_rejected") * 2 > F.col("records_read"), "FAILED")
            .when(F.col("records_rejected") > 0, "PARTIAL_SUCCESS")
            .otherwise("SUCCESS")
            .alias("execution_status"),
        )
    )


def execution_summary(events: DataFrame) -> DataFrame:
    """One row per run: span, rows, throughput, warnings, errors, outcome, balance.

    The timeline of a run is not folded into its row, since a run may have any number of
    events; :func:`execution_timeline` returns it as rows.
    """
    errors = F.count_if(F.col("severity").isin("ERROR", "CRITICAL"))
    per_run = events.groupBy("run_id").agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(~F.col("severity").isin("ERROR", "CRITICAL")).alias("rows_loaded"),
        errors.alias("rows_rejected"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings_count"),
        errors.alias("errors_count"),
    )
    read = F.col("rows_processed")
    duration = elapsed_ms(F.col("start_time"), F.col("end_time"))
    balanced = (read == 0) | (read == F.col("rows_loaded") + F.col("rows_rejected"))
    return per_run.withColumn("duration_ms", duration).select(
        "*",
        throughput(F.col("rows_loaded"), F.col("duration_ms")).alias("throughput_rows_per_sec"),
        F.when(F.col("errors_count") * 2 > read, "FAILED").otherwise("SUCCESS").alias("final_status"),
        F.when(balanced, "RECONCILED").otherwise("UNRECONCILED").alias("reconciliation_status"),
    )


def execution_timeline(events: DataFrame) -> DataFrame:
    """Events in run and time order; the range sort splits a long run over several tasks."""
    return events.select("run_id", "event_time", "event_id", "event_name", "severity", "duration_ms").orderBy(
        "run_id", "event_time", "event_id"
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return (
        runs.select("pipeline_run_id", "execution_status", "records_loaded", "started_at")
        .orderBy(F.desc("started_at"), "pipeline_run_id")
        .limit(limit)
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    return (
        runs.filter(F.col("execution_status") == "FAILED")
        .select("pipeline_run_id", "execution_status", F.col("records_rejected").alias("error_count"), "started_at")
        .orderBy(F.desc("started_at"), "pipeline_run_id")
    )


def get_run(runs: DataFrame, pipeline_run_id: str) -> DataFrame:
    return runs.filter(F.col("pipeline_run_id") == pipeline_run_id)
