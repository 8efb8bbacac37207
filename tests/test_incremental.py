import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillforge.operators import audit, incremental
from tillforge.operators.incremental import STRATEGIES

INCOMING = "file_name string, file_hash string, file_time timestamp_ntz, batch_id string, is_replay boolean, is_present boolean"
REGISTRY = "file_name string, file_hash string, status string, processed_at timestamp_ntz, batch_id string, run_id string"


def day(n):
    return dt.datetime(2026, 7, n)


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [
            ("a.csv", "h1", "SUCCESS", day(10), "B1", "R1"),
            ("a.csv", "h1", "REPROCESSED", day(11), "B1", "R2"),
            ("b.csv", "h2", "FAILED", day(20), "B2", "R2"),
            ("c.csv", "h3", "REPROCESSED", day(5), "B3", "R3"),
        ],
        REGISTRY,
    )


def incoming(spark, *rows):
    return spark.createDataFrame([(n, h, day(t), b, r, p) for n, h, t, b, r, p in rows], INCOMING)


@pytest.mark.parametrize(
    "row, want",
    [
        (("x.csv", "h9", 15, "B9", False, True), "NEW"),
        (("x.csv", "h1", 15, "B9", False, True), "DUPLICATE"),
        (("x.csv", "h3", 15, "B9", False, True), "DUPLICATE"),  # replayed files stay processed
        (("x.csv", "h2", 15, "B9", False, True), "NEW"),  # a failed load does not count
        (("a.csv", "h9", 15, "B9", False, True), "MODIFIED"),
        (("x.csv", "h1", 15, "B9", True, True), "REPROCESS"),  # replay beats duplicate
        (("x.csv", "h1", 15, "B9", True, False), "STALE"),  # missing beats replay
        (("x.csv", "h9", 1, "B9", False, True), "STALE"),
    ],
)
def test_classification(spark, registry, row, want):
    limit = F.lit("2026-07-03 00:00:00").cast("timestamp_ntz")
    assert incremental.classify_files(incoming(spark, row), registry, limit).first().classification == want


def test_many_copies_do_not_multiply_files(spark, registry):
    many = registry
    for _ in range(4):
        many = many.unionByName(many)
    files = incoming(spark, ("a.csv", "h1", 15, "B1", False, True))
    assert incremental.classify_files(files, many).count() == 1


def test_watermark_defaults_to_epoch(spark, registry):
    assert incremental.latest_watermark(registry).first()[0] == day(11)
    assert incremental.latest_watermark(registry.limit(0)).first()[0] == dt.datetime(1970, 1, 1)


@pytest.mark.parametrize(
    "strategy, want",
    list(zip(STRATEGIES, [{"new", "late"}, {"new", "old"}, {"new", "old"}, {"new"}, {"new", "old", "late", "same"}])),
)
def test_strategies(spark, registry, strategy, want):
    files = incoming(
        spark,
        ("new", "h8", 15, "B8", False, True),
        ("old", "h7", 2, "B7", False, True),
        ("late", "h1", 15, "B1", False, True),
        ("same", "h1", 2, "B1", False, True),
    )
    assert {r.file_name for r in incremental.select_incremental(files, registry, strategy).collect()} == want


def test_unknown_strategy(spark, registry):
    with pytest.raises(ValueError, match="unknown strategy"):
        incremental.select_incremental(registry, registry, "GUESS")


def test_registry_state(spark, registry):
    rows = {r.file_hash: r for r in incremental.registry_state(registry).collect()}
    assert (rows["h1"].status, rows["h1"].loads, rows["h1"].processed_at) == ("REPROCESSED", 2, day(11))
    assert rows["h3"].status == "SUCCESS" and "h2" not in rows


def test_report_counts(spark, registry):
    files = incoming(spark, ("n", "h8", 15, "B", False, True), ("d", "h1", 15, "B", False, True), ("r", "h1", 15, "B", True, True))
    report = incremental.incremental_report(incremental.classify_files(files, registry), registry, "2026-12-01 00:00:00").first()
    assert (report.files_processed, report.files_skipped, report.replay_count, report.watermark_before) == (2, 1, 1, day(11))


def test_replay_selection(spark, registry):
    files = incoming(spark, ("x", "h1", 15, "B", False, True), ("y", "h3", 15, "B", False, True))
    assert [r.file_name for r in incremental.replay_selection(files, registry, run_id="R3").collect()] == ["y"]
    assert [r.file_name for r in incremental.replay_selection(files, registry, file_hash="h1").collect()] == ["x"]
    with pytest.raises(ValueError):
        incremental.replay_selection(files, registry)


def test_rows_after_store_watermark(spark):
    sales = spark.createDataFrame([("A", day(1)), ("A", day(9)), ("B", day(1))], "store_id string, t timestamp_ntz")
    marks = spark.createDataFrame([("A", day(5))], "store_id string, last_processed_timestamp timestamp_ntz")
    assert {tuple(r) for r in incremental.rows_after_watermark(sales, F.col("t"), marks).collect()} == {("A", day(9)), ("B", day(1))}


# --- audit ---------------------------------------------------------------------


def test_events_are_recorded_and_checked(spark, tmp_path):
    path = str(tmp_path / "events")
    event = ("e1", "run-1", "PIPELINE_STARTED", "INFO", day(1), "INIT", None, "go", None)
    audit.record_events(spark, path, [event])
    audit.record_events(spark, path, [("e2", "run-1", "PIPELINE_FAILED", "CRITICAL", day(1), "LOAD", None, "no", "DATABASE")])
    events = spark.read.parquet(path)
    assert events.count() == 2 and [r.event_id for r in audit.alerts(events).collect()] == ["e2"]
    for bad in (("e", "r", "LUNCH", "INFO", day(1), "", None, "", None), ("e", "r", "PIPELINE_STARTED", "INFO", day(1), "", None, "", "WEATHER")):
        with pytest.raises(ValueError):
            audit.record_events(spark, path, [bad])


@pytest.mark.parametrize(
    "stage, want",
    [("VALIDATION", "validation_time_ms"), ("Database load", "database_time_ms"), ("LOADING", "loading_time_ms"), ("TRANSFORMATION", "transformation_time_ms"), ("OTHER", None)],
)
def test_stage_bucket(spark, stage, want):
    assert spark.createDataFrame([(stage,)], "s string").select(audit.stage_bucket(F.col("s"))).first()[0] == want


def test_last_stage_and_recent_runs(spark):
    stages = spark.createDataFrame([(1, "A", day(1), 1), (1, "B", day(1), 2), (2, "C", day(3), 3)], "run_id int, stage string, event_time timestamp_ntz, event_id int")
    assert {tuple(r) for r in audit.last_stage(stages).collect()} == {(1, "B"), (2, "C")}
    runs = spark.createDataFrame([(f"R{i}", "FAILED" if i % 2 else "SUCCESS", 1, 2, day(i)) for i in range(1, 6)], "pipeline_run_id string, execution_status string, records_loaded int, records_rejected int, started_at timestamp_ntz")
    assert [r.pipeline_run_id for r in audit.recent_runs(runs, 2).collect()] == ["R5", "R4"]
    assert [r.pipeline_run_id for r in audit.failed_runs(runs).collect()] == ["R5", "R3", "R1"]
    assert audit.get_run(runs, "R2").count() == 1
