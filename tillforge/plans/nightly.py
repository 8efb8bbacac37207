"""One nightly run: feed folder in, facts, quarantine and run records out.

Write order is the commit protocol: bronze, silver, quarantine, staged facts, changes, the
fact table's commit, then records, and the file registry last. A file counts as processed
only once its registry row is there. Every stage ends with a row in the stage log that holds
what the stage counted and a fingerprint of what it was made from; a run that broke off is
run again under its name, starts after the last stage whose fingerprint is still the same,
and ends as if it had not broken off. Lines that stand in the table unchanged are not added
twice; corrected and replayed files replace their lines and take away those they leave out.

Rows are counted while they are written; reports of a run read no table.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tillforge import constants as C
from tillforge.functions.text import parse_timestamp
from tillforge.operators import audit, incremental, keys, load, observed, rules, transform, validate
from tillforge.operators.key_store import KeyStore
from tillforge.operators.scorecard import score_of
from tillforge.session import scratch
from tillforge.sources import feed_files

REGISTRY_SCHEMA = (
    "file_name string, file_hash string, status string, processed_at timestamp_ntz, batch_id string, run_id string"
)
WATERMARK_SCHEMA = "entity_name string, store_id string, last_processed_timestamp timestamp_ntz, run_id string"
AUDIT_SCHEMA = (
    "run_id bigint, pipeline_run_id string, batch_id string, source_folder string, execution_stage string, "
    "records_read bigint, records_valid bigint, records_rejected bigint, records_loaded bigint, "
    "execution_status string, started_at timestamp_ntz, completed_at timestamp_ntz, application_version string, "
    "error_summary string"
)
FILE_MONTHS_SCHEMA = "file_name string, tx_month string, run_id string"
STAGE_SCHEMA = "run_id string, stage string, fingerprint string, metrics string, event_time timestamp_ntz, event_id bigint, duration_ms bigint"
LINE_INDEX = StructType([StructField(load.LINE, BinaryType()), StructField(load.MONTH, StringType())])
LOADED = ["NEW", "MODIFIED", "REPROCESS"]


@dataclass(frozen=True)
class Run:
    """What one run is called, when it happens and how much error it accepts."""

    run_id: str
    batch_id: str
    as_of: str
    audit_run_id: int
    replay: bool = False
    max_error_percentage: float = C.MAX_ERROR_PERCENTAGE
    #: Replay only files that this run, or a file of this hash, loaded before.
    replay_run_id: str | None = None
    replay_file_hash: str | None = None


class NotReconciled(RuntimeError):
    """The table does not hold what passed validation; the files stay unprocessed."""


def feed_rules(as_of: str) -> list[rules.Rule]:
    """What a run checks unless it is given other rules."""
    return [rules.malformed_rule(), *rules.feed_rules(as_of), *rules.range_rules(), rules.duplicate_rule()]


class ValidationFailed(ValueError):
    """Too many bad rows; they are in the quarantine and nothing was loaded."""


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def incoming(spark: SparkSession, feed_dir: str, run: Run, registry: DataFrame) -> DataFrame:
    """The files of the feed folder in the shape the classification wants."""
    files = feed_files.fingerprints(spark, feed_dir).select(
        "path",
        "source_file",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "file_hash",
        "header",
        F.col("modified").cast("timestamp_ntz").alias("file_time"),
        F.lit(run.batch_id).alias("batch_id"),
        F.lit(run.replay).alias("is_replay"),
        F.lit(True).alias("is_present"),
    )
    if run.replay_run_id is None and run.replay_file_hash is None:
        return files
    again = incremental.replay_selection(files, registry, run.replay_run_id, run.replay_file_hash)
    chosen = again.select("path", F.lit(True).alias("_chosen"))
    return files.join(chosen, "path", "left").withColumn("is_replay", F.coalesce("_chosen", "is_replay")).drop("_chosen")


@dataclass
class Stages:
    """The stage log of one run, and its lifecycle events."""

    spark: SparkSession
    meta: str
    run: Run
    done: dict = field(default_factory=dict)
    events: int = 0

    def __post_init__(self):
        log = read_or_empty(self.spark, f"{self.meta}/stages", STAGE_SCHEMA).filter(F.col("run_id") == self.run.run_id)
        # A few rows per attempt of this run.
        self.done = {(r.stage, r.fingerprint): json.loads(r.metrics) for r in log.orderBy("event_time").collect()}

    def event(self, name: str, severity: str = "INFO", milliseconds: int = 0, message: str = "", category: str | None = None) -> None:
        self.events += 1
        row = (f"{self.run.run_id}-{self.events}", self.run.run_id, name, severity, _clock(), name.split("_")[0], None, message, category)
        row = (*row[:6], decimal_ms(milliseconds), *row[7:])
        audit.record_events(self.spark, f"{self.meta}/events", [row])

    def run_once(self, stage: str, fingerprint: str, work: Callable[[], dict]) -> dict:
        """What ``work`` counted, now or in an earlier attempt over the same input."""
        if (stage, fingerprint) in self.done:
            return self.done[(stage, fingerprint)]
        started = _clock()
        if f"{stage}_STARTED" in C.LIFECYCLE_EVENTS:
            self.event(f"{stage}_STARTED")
        metrics = {k: int(v) for k, v in work().items()}
        spent = int((_clock() - started).total_seconds() * 1000)
        row = (self.run.run_id, stage, fingerprint, json.dumps(metrics), _clock(), len(self.done), spent)
        self.spark.createDataFrame([row], STAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.meta}/stages")
        self.done[(stage, fingerprint)] = metrics
        if f"{stage}_COMPLETED" in C.LIFECYCLE_EVENTS:
            self.event(f"{stage}_COMPLETED", milliseconds=spent)
        return metrics


def decimal_ms(milliseconds: int) -> Decimal:
    return Decimal(milliseconds).quantize(Decimal("0.01"))


def fingerprint_of(files: DataFrame, run: Run, run_rules: list[rules.Rule]) -> str:
    """Of the files, their contents and classes, and of what decides about their rows."""
    what = F.xxhash64("path", "file_hash", "classification").cast("decimal(38,0)")
    sums = files.agg(F.count(F.lit(1)).alias("n"), F.sum(what).alias("sum")).first()
    checks = ",".join(f"{r.code}:{r.fails}" for r in run_rules)
    return sha256(f"{sums.n}|{sums.sum}|{run.as_of}|{run.audit_run_id}|{checks}".encode()).hexdigest()


def _clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def log_run(
    spark: SparkSession, meta: str, feed_dir: str, run: Run, started: datetime, stage: str, report, loaded: int, error: str
) -> None:
    """Append the run's row to the audit log."""
    status = "FAILED" if error else "PARTIAL_SUCCESS" if report.failed_rows else "SUCCESS"
    row = (
        run.audit_run_id, run.run_id, run.batch_id, feed_dir, stage,
        report.total_rows, report.passed_rows, report.failed_rows, loaded,
        status, started, _clock(), C.APPLICATION_VERSION, error,
    )
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{meta}/etl_audit_log")


def write_manifest(files: DataFrame, flagged: DataFrame | None, changes: DataFrame | None, meta: str, run: Run) -> None:
    """One row per evaluated file: its class, its rows read, loaded and rejected."""
    counts = ["rows_in_file", "rows_rejected", "rows_written"]
    counted = files
    if flagged is None:
        counted = counted.withColumns({c: F.lit(0).cast("bigint") for c in counts})
    else:
        rows = flagged.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("rows_in_file"), F.count_if("failed").alias("rows_rejected")
        )
        written = changes.groupBy("source_file").agg(F.count_if(F.col("change").isin(load.WRITTEN)).alias("rows_written"))
        counted = counted.join(rows, "source_file", "left").join(written, "source_file", "left").fillna(0, counts)
    incremental.run_manifest(counted, run.run_id, extra=["rows_rejected"]).write.mode("overwrite").parquet(
        f"{meta}/manifest/run_id={run.run_id}"
    )


def write_run_report(spark: SparkSession, warehouse: str, run: Run, run_rules: list[rules.Rule], counts: DataFrame) -> None:
    """Beside the quarantine: totals of the run, and one line per validator."""
    validate.report_of(counts, {"is_valid": run.max_error_percentage}).coalesce(1).write.mode("overwrite").json(
        f"{warehouse}/quarantine_report/summary/run_id={run.run_id}"
    )
    validate.validator_lines(counts, run_rules).coalesce(1).write.mode("overwrite").json(
        f"{warehouse}/quarantine_report/validators/run_id={run.run_id}"
    )


def run_feed(
    spark: SparkSession,
    feed_dir: str,
    warehouse: str,
    dims: dict[str, DataFrame],
    run: Run,
    run_rules: list[rules.Rule] | None = None,
) -> dict:
    """Process what is new in ``feed_dir``; returns the run's figures.

    ``dims`` are the current dimension tables, ``run_rules`` the rules in place of
    :func:`feed_rules`. Only one-row figures, calendar months and the list of new file names
    reach the driver.
    """
    stages = Stages(spark, f"{warehouse}/meta", run)
    stages.event("PIPELINE_STARTED")
    try:
        figures = _run_stages(spark, feed_dir, warehouse, dims, run, run_rules or feed_rules(run.as_of), stages)
    except Exception as error:
        category = "VALIDATION" if isinstance(error, (ValidationFailed, validate.SchemaError)) else "UNKNOWN"
        stages.event("PIPELINE_FAILED", "ERROR", message=str(error)[:1000], category=category)
        raise
    stages.event("PIPELINE_COMPLETED")
    return figures


def _run_stages(spark, feed_dir, warehouse, dims, run, run_rules, stages) -> dict:
    started = _clock()
    meta = f"{warehouse}/meta"
    silver = f"{warehouse}/silver/run_id={run.run_id}"
    facts_path = f"{warehouse}/gold/fact_sales"
    registry = read_or_empty(spark, f"{meta}/file_registry", REGISTRY_SCHEMA)

    files_path = f"{warehouse}/bronze/files/run_id={run.run_id}"
    incremental.classify_files(incoming(spark, feed_dir, run, registry), registry).write.mode("overwrite").parquet(files_path)
    files = spark.read.parquet(files_path)
    # One name per store file; Spark lists the same names on the driver when it reads them.
    paths = [r.path for r in files.filter(F.col("classification").isin(LOADED)).select("path").toLocalIterator()]
    if not paths:
        write_manifest(files, None, None, meta, run)
        return {"run_id": run.run_id, "status": "SKIPPED", "files": 0}

    headers = files.filter(F.col("classification").isin(LOADED)).select("source_file", "header")
    missing = feed_files.lacking_columns(headers)
    if missing:
        raise validate.SchemaError(f"{C.MISSING_COLUMN}: {', '.join(missing)}")
    fingerprint = fingerprint_of(files, run, run_rules)

    def judge() -> dict:
        """Bronze to silver: judge every row once, keep the verdicts, count on the way."""
        bronze = feed_files.land_feed(spark, paths, f"{warehouse}/bronze/feed/run_id={run.run_id}", headers)
        bronze = bronze.withColumn(load.LINE, load.line_key())
        ids = Observation("ids")
        verdicts = validate.flag_feed(
            bronze, feed_files.FILE_ORDER, run.as_of, run_rules, keys=[load.LINE],
            ids=lambda feed: observed.count_ids(feed, "transaction_id", ids),
        )
        verdicts, seen = observed.observed(verdicts, "silver", observed.feed_metrics(run_rules))
        verdicts.write.mode("overwrite").partitionBy("failed").parquet(silver)
        flagged = spark.read.schema(verdicts.schema).parquet(silver)
        validate.write_quarantine(
            flagged, run_rules, f"{warehouse}/quarantine", run.run_id, F.col("source_file"), run.as_of, mode="overwrite"
        )
        return {**seen.get, **(ids.get if any(r.code == C.DUPLICATE for r in run_rules) else {"ids": 0})}

    judged = stages.run_once("VALIDATION", fingerprint, judge)
    flagged = spark.read.parquet(silver)
    counts = observed.one_row(spark, judged)
    write_run_report(spark, warehouse, run, run_rules, counts)
    report = validate.report_of(counts, {"is_valid": run.max_error_percentage}).first()
    if not report.is_valid:
        error = f"{report.failed_rows} of {report.total_rows} rows failed"
        log_run(spark, meta, feed_dir, run, started, "ROW_VALIDATION", report, 0, error)
        raise ValidationFailed(error)

    passed = validate.passed_rows(flagged, [*C.FEED_COLUMNS, load.LINE, "source_file"])
    cleaned = transform.normalize(transform.clean(passed, C.FEED_COLUMNS))
    staged = f"{warehouse}/silver/facts/run_id={run.run_id}"

    def make_facts() -> dict:
        resolved = transform.enrich(keys.resolve_keys(transform.timed(cleaned), dims))
        fact = transform.fact_projection(resolved, run.audit_run_id, extra=[load.LINE, "source_file"])
        fact = fact.withColumn(load.SOURCE, F.element_at(F.split("source_file", "/"), -1))
        fact, seen = observed.observed(load.with_month(fact), "facts", [F.count(F.lit(1)).alias("transformed_rows")])
        fact.write.mode("overwrite").parquet(staged)
        return seen.get

    made = stages.run_once("TRANSFORMATION", fingerprint, make_facts)
    fact = spark.read.parquet(staged)

    # What the load changes depends on the table as it stands.
    commit, _ = load.current(spark, facts_path)
    at_commit = f"{fingerprint}@{commit}"
    changes_path = f"{warehouse}/silver/changes/run_id={run.run_id}"
    lines = KeyStore(f"{meta}/lines", LINE_INDEX, [load.LINE])

    def compare() -> dict:
        """The months in question are those of the lines, those in which the same lines stand,
        and those in which the same files were loaded."""
        known = read_or_empty(spark, f"{meta}/file_months", FILE_MONTHS_SCHEMA)
        by_file = known.join(files.select("file_name").distinct(), "file_name", "left_semi").select(load.MONTH)
        by_line = lines.earlier(fact.select(load.LINE), commit).join(fact.select(load.LINE), load.LINE, "left_semi").select(load.MONTH)
        own = fact.select(load.MONTH)
        months = [r[0] for r in own.union(by_file).union(by_line).distinct().collect()]  # calendar months: few
        corrected = files.filter(F.col("classification").isin("MODIFIED", "REPROCESS")).select("file_name")
        with scratch(spark):
            changes = load.line_changes(fact, load.read_table(spark, facts_path, months), corrected)
            kinds = [F.count_if(F.col("change") == k).alias(k.lower()) for k in KINDS]
            changes, seen = observed.observed(changes, "changes", kinds)
            changes.write.mode("overwrite").parquet(changes_path)
            return seen.get

    kinds = stages.run_once("CHANGES", at_commit, compare)
    changes = spark.read.parquet(changes_path)

    def commit_load() -> dict:
        written = changes.filter(F.col("change").isin(load.WRITTEN))
        lines.add(written, commit)
        own = fact.select(load.SOURCE, load.MONTH).distinct()
        own.write.mode("overwrite").parquet(f"{meta}/file_months/run_id={run.run_id}")
        return load.commit_changes(spark, changes, facts_path)

    loaded = stages.run_once("LOADING", at_commit, commit_load)

    # Figures, then the registry as commit marker.
    balance = load.balance_of(
        observed.one_row(
            spark,
            {
                "source_rows": judged["total_rows"],
                "validated_rows": judged["passed_rows"],
                "rejected_rows": judged["failed_rows"],
                "duplicate_rows": judged["n"] - judged["lines"],
                "transformed_rows": made["transformed_rows"],
                "loaded_rows": loaded["written"] + kinds["unchanged"],
            },
        ),
        run.run_id,
    ).first()
    stages.event("RECONCILIATION_COMPLETED")
    if not balance.is_reconciled:
        error = f"{balance.loaded_rows} of {balance.validated_rows} valid rows are in the table"
        log_run(spark, meta, feed_dir, run, started, "LOAD", report, loaded["written"], error)
        raise NotReconciled(error)
    score = score_of(counts, limit=run.max_error_percentage).first()
    marks = incremental.store_watermark(cleaned, parse_timestamp(F.col("transaction_time")))
    marks.write.mode("overwrite").parquet(f"{meta}/store_watermark/run_id={run.run_id}")
    stages.event("WATERMARK_UPDATED")
    write_manifest(files, flagged, changes, meta, run)
    log_run(spark, meta, feed_dir, run, started, "COMPLETED", report, loaded["written"], "")
    now = F.lit(run.as_of).cast("timestamp_ntz")
    files.filter(F.col("classification").isin(LOADED)).select(
        "file_name",
        "file_hash",
        F.when(F.col("classification") == "REPROCESS", "REPROCESSED").otherwise("SUCCESS").alias("status"),
        now.alias("processed_at"),
        "batch_id",
        F.lit(run.run_id).alias("run_id"),
    ).write.mode("append").parquet(f"{meta}/file_registry")
    return {
        **balance.asDict(),
        **kinds,
        "status": "SUCCESS",
        "files": len(paths),
        "overall_quality_score": score.overall_quality_score,
    }


KINDS = ["ADDED", "REPLACED", "UNCHANGED", "REMOVED"]
