"""Runs that break off, correct, leave out and move lines; figures without a read."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_runs import BAD, GOOD, dims, facts, line, run, write_csv

from tillforge import constants as C
from tillforge.operators import load, observed, validate
from tillforge.operators.scorecard import score_of, scorecard
from tillforge.plans import catalog, nightly
from tillforge.sources import feed_files

from decimal import Decimal  # noqa: E402

D5 = Decimal("5.00")
KEEP = ["transaction_id", "quantity", "unit_price", "tx_month"]


def held(spark, tmp_path):
    return Counter(tuple(r) for r in facts(spark, tmp_path).select(*KEEP).collect())


def events(spark, tmp_path):
    return [r.event_name for r in spark.read.parquet(str(tmp_path / "wh/meta/events")).orderBy("event_time").collect()]


BREAKS = {
    "silver": (validate, "write_quarantine"),
    "facts": (load, "line_changes"),
    "index": (nightly.KeyStore, "add"),
    "commit": (load, "commit_changes"),
    "records": (nightly, "write_manifest"),
}


@pytest.mark.parametrize("name, after", [("silver", False), ("index", True), ("commit", True), ("records", False)])
def test_a_run_broken_anywhere_ends_the_same(spark, tmp_path, monkeypatch, name, after):
    """Broken before and after each write; the next attempt ends as if nothing had happened."""
    feed = tmp_path / "feed/store_001_sales_20260724.csv"
    write_csv(feed, line(1), line(2), line(3))
    run(spark, tmp_path, "run-1", 1)
    write_csv(feed, line(1, quantity="5"), line(2, time="2026-04-02 09:30:00"), line(9))
    owner, method = BREAKS[name]
    whole = getattr(owner, method)

    def broken(*a, **kw):
        if after:
            whole(*a, **kw)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, method, broken)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, tmp_path, "run-2", 2)
    got = run(spark, tmp_path, "run-2", 2)
    assert got["is_reconciled"] and got["loaded_rows"] == 3
    assert sorted((r.transaction_id, r.quantity, r.tx_month) for r in facts(spark, tmp_path).collect()) == [
        ("TX-1", 5, "2026-03"), ("TX-2", 1, "2026-04"), ("TX-9", 1, "2026-03"),
    ]
    assert "PIPELINE_FAILED" in events(spark, tmp_path) and events(spark, tmp_path)[-1] == "PIPELINE_COMPLETED"


def test_a_run_starts_after_its_last_stage(spark, tmp_path, monkeypatch):
    feed = write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD, BAD)
    with monkeypatch.context() as patch:
        patch.setattr(load, "commit_changes", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, tmp_path, "run-1", 1)
    with monkeypatch.context() as patch:
        patch.setattr(feed_files, "land_feed", lambda *a: 1 / 0)
        got = run(spark, tmp_path, "run-1", 1)
    assert (got["source_rows"], got["loaded_rows"], got["is_reconciled"]) == (3, 2, True)
    log = [(r.stage, json.loads(r.metrics)) for r in spark.read.parquet(str(tmp_path / "wh/meta/stages")).orderBy("event_time").collect()]
    assert [s for s, _ in log] == ["VALIDATION", "TRANSFORMATION", "CHANGES", "LOADING"]
    # Other contents are another fingerprint: nothing of the old attempt is taken.
    write_csv(feed, GOOD[0])
    with monkeypatch.context() as patch:
        patch.setattr(feed_files, "land_feed", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, tmp_path, "run-1", 1)


def test_lines_left_out_leave_and_lines_that_move_stand_once(spark, tmp_path):
    one, two = (tmp_path / f"feed/store_00{k}_sales_20260724.csv" for k in (1, 2))
    write_csv(one, line(1), line(2), line(3))
    write_csv(two, line(4))
    run(spark, tmp_path, "run-1", 1)
    # TX-2 is left out, TX-3 now stands in the other file, in another month.
    write_csv(one, line(1))
    write_csv(two, line(4), line(3, time="2026-06-02 09:30:00"))
    got = run(spark, tmp_path, "run-2", 2)
    assert (got["added"], got["replaced"], got["unchanged"], got["removed"]) == (0, 1, 2, 1)
    assert held(spark, tmp_path) == Counter(
        {("TX-1", 1, D5, "2026-03"): 1, ("TX-3", 1, D5, "2026-06"): 1, ("TX-4", 1, D5, "2026-03"): 1}
    )
    # A new file with a line of an old one in another month: found by the line index alone.
    write_csv(tmp_path / "feed/store_003_sales_20260725.csv", line(4, time="2026-09-02 09:30:00"))
    assert run(spark, tmp_path, "run-3", 3)["replaced"] == 1
    assert {r.transaction_id: r.tx_month for r in facts(spark, tmp_path).collect()} == {"TX-1": "2026-03", "TX-3": "2026-06", "TX-4": "2026-09"}


def test_a_month_that_loses_all_lines(spark, tmp_path):
    feed = tmp_path / "feed/store_001_sales_20260724.csv"
    write_csv(feed, line(1), line(2, time="2026-05-02 09:30:00"))
    run(spark, tmp_path, "run-1", 1)
    write_csv(feed, line(1))
    run(spark, tmp_path, "run-2", 2)
    assert {r.tx_month for r in facts(spark, tmp_path).collect()} == {"2026-03"}
    assert load.current(spark, str(tmp_path / "wh/gold/fact_sales")) == (2, [("2026-03", 1)])


def test_replay_of_one_run_or_one_file(spark, tmp_path):
    one, two = (tmp_path / f"feed/store_00{k}_sales_20260724.csv" for k in (1, 2))
    write_csv(one, line(1))
    run(spark, tmp_path, "run-1", 1)
    write_csv(two, line(2))
    run(spark, tmp_path, "run-2", 2)
    got = run(spark, tmp_path, "run-3", 3, replay_run_id="run-1")
    assert (got["files"], got["unchanged"]) == (1, 1)
    prints = {r.path.split("/")[-1]: r.file_hash for r in feed_files.fingerprints(spark, str(tmp_path / "feed")).collect()}
    got = run(spark, tmp_path, "run-4", 4, replay_file_hash=prints[two.name])
    assert (got["files"], got["unchanged"]) == (1, 1) and facts(spark, tmp_path).count() == 2


def test_reports_of_a_run_stand_beside_its_quarantine(spark, tmp_path):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD, BAD)
    run(spark, tmp_path, "run-1", 1)
    summary = spark.read.json(str(tmp_path / "wh/quarantine_report/summary")).first()
    assert (summary.total_rows, summary.passed_rows, summary.failed_rows, summary.run_id) == (3, 2, 1, "run-1")
    failed = {r.validator_name: r.records_failed for r in spark.read.json(str(tmp_path / "wh/quarantine_report/validators")).collect()}
    assert failed["BusinessRuleValidator"] == 1
    assert events(spark, tmp_path)[:3] == ["PIPELINE_STARTED", "VALIDATION_STARTED", "VALIDATION_COMPLETED"]


# --- observed metrics ----------------------------------------------------------


def test_reports_from_metrics_equal_those_from_the_table_and_run_no_job(spark, base, tmp_path):
    checks = validate.default_rules(catalog.AS_OF)
    ids = observed.Observation("ids")
    flagged = validate.flag_feed(
        catalog.feed(spark, base), catalog.FEED_ORDER, catalog.AS_OF, checks, ids=lambda f: observed.count_ids(f, "transaction_id", ids)
    )
    flagged, seen = observed.observed(flagged, "silver", observed.feed_metrics(checks))
    flagged.write.parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver"))
    want = [validate.validation_report(stored).collect(), validate.validator_results(stored, checks).collect(), scorecard(stored).collect()]
    spark.sparkContext.setJobGroup("from metrics", "")
    counts = observed.one_row(spark, {**seen.get, **ids.get})
    got = [validate.report_of(counts).collect(), validate.validator_lines(counts, checks).collect(), score_of(counts).collect()]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("from metrics")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == want and len(jobs) <= 3
    assert all(j is None or len(j.stageIds) == 1 for j in map(spark.sparkContext.statusTracker().getJobInfo, jobs))


def test_repeats_are_found_without_sorting_the_feed(spark, base):
    counted = catalog.feed(spark, base).groupBy(*C.DUPLICATE_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text
    whole = catalog.flagged(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in whole
