"""Files, loads, whole runs, streams and plans."""

import hashlib
import struct
from decimal import Decimal as D
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.operators import keys, load, validate
from tillforge.plans import catalog, nightly
from tillforge.sources import feed_files
from tillforge.streaming import ingest

HEADER = ",".join(C.FEED_COLUMNS)
AS_OF = "2026-12-01 00:00:00"


def write_csv(path: Path, *lines: str, header: str = HEADER) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return path


def dims(spark):
    ids = {"store": ["STR-001", "STR-002"], "product": ["PROD-001", "PROD-002"], "employee": ["EMP-001"], "customer": ["CUST-0001"]}
    return {e: spark.createDataFrame([(i + 1, v) for i, v in enumerate(ids[e])], f"{e}_sk bigint, {e}_id string") for e in keys.LOOKUPS}


GOOD = [
    "tx-001,STR-001,PROD-001,EMP-001,CUST-0001,2,10.00,0.00,2026-07-24 10:00:00",
    "TX-002,STR-002,PROD-002,EMP-001,,1,10.00,0.00,2026-07-24 10:05:00",
]
BAD = "TX-003,STR-001,PROD-001,EMP-001,CUST-0001,-5,10.00,0.00,2026-07-24 10:10:00"


def run(spark, tmp_path, run_id, audit_run_id, **kw):
    options = {"max_error_percentage": 50, **kw}
    return nightly.run_feed(
        spark, str(tmp_path / "feed"), str(tmp_path / "wh"), dims(spark),
        nightly.Run(run_id, "batch-1", AS_OF, audit_run_id, **options),
    )


def facts(spark, tmp_path):
    return load.read_table(spark, str(tmp_path / "wh/gold/fact_sales"))


def test_nightly_run_then_duplicate_then_replay(spark, tmp_path):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD, BAD)
    first = run(spark, tmp_path, "run-1", 1)
    assert (first["source_rows"], first["validated_rows"], first["loaded_rows"], first["rejected_rows"]) == (3, 2, 2, 1)
    assert first["is_reconciled"] and first["status"] == "SUCCESS"
    loaded = facts(spark, tmp_path)
    assert loaded.agg(F.sum("net_sales_amount")).first()[0] == D("30.00")
    assert {r.date_sk for r in loaded.collect()} == {20260724}
    assert validate.read_quarantine(spark, str(tmp_path / "wh/quarantine")).first().raw_record.transaction_id == "TX-003"

    manifest = spark.read.parquet(str(tmp_path / "wh/meta/manifest")).first()
    assert (manifest.rows_read, manifest.rows_loaded, manifest.rows_rejected, manifest.status) == (3, 2, 1, "SUCCESS")
    logged = spark.read.parquet(str(tmp_path / "wh/meta/etl_audit_log")).first()
    assert (logged.records_read, logged.records_loaded, logged.execution_status) == (3, 2, "PARTIAL_SUCCESS")

    assert run(spark, tmp_path, "run-2", 2)["status"] == "SKIPPED"
    replayed = run(spark, tmp_path, "run-3", 3, replay=True)
    assert replayed["files"] == 1 and facts(spark, tmp_path).count() == 2
    assert (replayed["unchanged"], replayed["loaded_rows"], replayed["is_reconciled"]) == (2, 2, True)
    third = spark.read.parquet(str(tmp_path / "wh/meta/manifest")).filter("run_id = 'run-3'").first()
    assert (third.rows_read, third.rows_loaded) == (3, 0)


def test_run_broken_before_its_commit_marker_is_repeatable(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD)
    with monkeypatch.context() as broken:
        broken.setattr(nightly.incremental, "store_watermark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, tmp_path, "run-1", 1)
    assert facts(spark, tmp_path).count() == 2
    again = run(spark, tmp_path, "run-1", 1)
    assert again["is_reconciled"] and facts(spark, tmp_path).count() == 2


def test_too_many_errors_load_nothing(spark, tmp_path):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD, BAD)
    with pytest.raises(nightly.ValidationFailed, match="1 of 3"):
        run(spark, tmp_path, "run-1", 1, max_error_percentage=5)
    assert not (tmp_path / "wh/gold").exists() and (tmp_path / "wh/quarantine").exists()


def test_missing_column_aborts_the_run(spark, tmp_path):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", "TX-1,STR-001", header="transaction_id,store_id")
    with pytest.raises(validate.SchemaError, match="quantity"):
        run(spark, tmp_path, "run-1", 1)


def line(number, quantity="1", price="5.00", time="2026-03-02 09:30:00"):
    return f"TX-{number},STR-001,PROD-001,EMP-001,CUST-0001,{quantity},{price},0.00,{time}"


SAMPLES = {
    "duplicates": ([line(7), line(7)], {C.DUPLICATE: 1}),
    "invalid": (
        [line(1, quantity="-1"), line(2, price="-0.01"), line(3, time="2088-05-06 07:08:09")],
        {C.NEGATIVE_QUANTITY: 1, C.NEGATIVE_PRICE: 1, C.FUTURE_TIME: 1},
    ),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_sample_feeds(spark, tmp_path, name):
    """Identical lines differ only in their place in the file; one of them stays."""
    lines, want = SAMPLES[name]
    header = "transaction_id,store_id,product_id,employee_id,customer_id,quantity,unit_price,discount_amount,transaction_time"
    write_csv(tmp_path / "in/f.csv", *lines, header=header)
    bronze = feed_files.land_feed(spark, str(tmp_path / "in"), str(tmp_path / "bronze"))
    flagged = validate.flag_feed(bronze, feed_files.FILE_ORDER, AS_OF)
    got = {r.code: r.hits for r in validate.failure_reasons(flagged, validate.default_rules(AS_OF)).collect()}
    assert got == want


def test_scan_keeps_white_space_and_marks_short_lines(spark, tmp_path):
    write_csv(tmp_path / "f.csv", "  tx-1 ,S,P,E,,1,2,,t", "short,line")
    rows = feed_files.scan_feed(spark, str(tmp_path / "f.csv")).orderBy("source_row").collect()
    assert (rows[0].transaction_id, rows[0].customer_id, rows[0]._corrupt) == ("  tx-1 ", None, None)
    assert rows[1].transaction_id == "short" and rows[1]._corrupt == "short,line"


def test_scan_takes_columns_by_name(spark, tmp_path):
    """Another order, a column less, one more, and a surplus field, in one folder."""
    write_csv(tmp_path / "in/a.csv", GOOD[0])
    turned = ["transaction_time", "quantity", "product_id", "unit_price", "store_id", "extra", "employee_id", "transaction_id"]
    write_csv(tmp_path / "in/b c.csv", "2026-07-24 10:00:00,3,PROD-002,4.00,STR-002,x,EMP-001,TX-9", header=",".join(turned))
    write_csv(tmp_path / "in/d.csv", GOOD[1] + ",surplus")
    (tmp_path / "in/empty.csv").write_text("")
    rows = {r.transaction_id: r for r in feed_files.scan_feed(spark, str(tmp_path / "in")).collect()}
    assert len(rows) == 3 and rows["tx-001"].product_id == "PROD-001"
    other = rows["TX-9"]
    assert (other.store_id, other.product_id, other.quantity, other.unit_price) == ("STR-002", "PROD-002", "3", "4.00")
    assert other.discount_amount is None and other.customer_id is None and other._corrupt is None
    assert rows["TX-002"]._corrupt is not None


def test_a_second_file_that_lacks_columns_aborts_the_run(spark, tmp_path):
    write_csv(tmp_path / "feed/store_001_sales_20260724.csv", *GOOD)
    write_csv(tmp_path / "feed/store_002_sales_20260724.csv", "TX-1,STR-001", header="transaction_id,store_id")
    with pytest.raises(validate.SchemaError, match="quantity"):
        run(spark, tmp_path, "run-1", 1)


def test_values_out_of_range_are_quarantined(spark, tmp_path):
    write_csv(
        tmp_path / "feed/store_001_sales_20260724.csv",
        line(1, price="250000000.00"), line(2, quantity="3000000000"), line(3, quantity="2000000", price="99999.99"),
        line(4, price="99999999.99"), line(5) + ",surplus",
    )
    got = run(spark, tmp_path, "run-1", 1, max_error_percentage=90)
    assert (got["rejected_rows"], got["loaded_rows"], got["is_reconciled"]) == (4, 1, True)
    assert facts(spark, tmp_path).first().unit_price == D("99999999.99")


def test_corrected_file_replaces_its_lines(spark, tmp_path):
    """A changed quantity, a changed month, an unknown product and a missing transaction."""
    name = tmp_path / "feed/store_001_sales_20260724.csv"
    odd = "TX-5,STR-001,NOWHERE,EMP-001,,1,3.00,0.00,2026-07-24 10:00:00"
    none = ",STR-001,PROD-001,EMP-001,,1,2.00,0.00,2026-07-24 10:00:00"
    write_csv(name, line(1), line(2), line(3), odd, none)
    run(spark, tmp_path, "run-1", 1)
    write_csv(name, line(1, quantity="5"), line(2, time="2026-04-02 09:30:00"), line(3), odd.replace(",1,3", ",4,3"), none, " tx-3 " + line(3)[4:])
    got = run(spark, tmp_path, "run-2", 2)
    assert (got["added"], got["replaced"], got["unchanged"], got["is_reconciled"]) == (0, 3, 2, True)
    rows = sorted((str(r.transaction_id), r.quantity, r.tx_month, r.audit_run_id) for r in facts(spark, tmp_path).collect())
    assert rows == [
        ("None", 1, "2026-07", 1), ("TX-1", 5, "2026-03", 2), ("TX-2", 1, "2026-04", 2), ("TX-3", 1, "2026-03", 1), ("TX-5", 4, "2026-07", 2),
    ]
    manifest = spark.read.parquet(str(tmp_path / "wh/meta/manifest")).filter("run_id = 'run-2'").first()
    assert (manifest.rows_read, manifest.rows_loaded, manifest.classification) == (6, 3, "MODIFIED")
    write_csv(name, *(line(k, time="2026-05-02 09:30:00") for k in (1, 2, 3)))
    assert run(spark, tmp_path, "run-3", 3)["replaced"] == 3
    assert {r.tx_month for r in facts(spark, tmp_path).collect()} == {"2026-05"}  # the other lines are left out


def plain_digest(content: bytes) -> str:
    """The digest of a file, line by line."""
    lines = content.removesuffix(b"\n").split(b"\n")
    seed = xxhash.xxh64(struct.pack("<i", 1), seed=42).intdigest()
    sums = [0] * 8
    for place, text in enumerate(lines):
        hashes = [xxhash.xxh64(text, seed=s).intdigest() for s in (42, seed)]
        for i, half in enumerate(half for h in hashes for half in (h & 0xFFFFFFFF, h >> 32)):
            sums[i] += half
            sums[4 + i] += half % feed_files.PRIME * place
    figures = [len(content), len(lines), *(s % feed_files.PRIME for s in sums)]
    return hashlib.sha256("|".join(map(str, figures)).encode()).hexdigest()


def digests_of(spark, folder):
    return {Path(r.source_file).name: r for r in feed_files.digests(spark, str(folder)).collect()}


def test_digests_do_not_depend_on_blocks(spark, tmp_path):
    """Long enough for many blocks; several tasks read one file, and the digest is the plain one."""
    lines = [line(i, price=f"{i % 97}.00") for i in range(3000)]
    contents = {
        "a": "\n".join([HEADER, *lines]) + "\n",
        "open": "\n".join([HEADER, *lines]),
        "crlf": "\r\n".join([HEADER, *lines]) + "\r\n",
        "blank": "\n\n" + "\n".join([HEADER, *lines[:3], "", ""]),
        "moved": "\n".join([HEADER, lines[1], lines[0], *lines[2:]]) + "\n",
        "byte": "\n".join([HEADER, *lines[:-1], lines[-1][:-1] + "1"]) + "\n",
        "nameless": "x,y\n" + "\n".join(lines[:5]) + f"\n{HEADER}\n",
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    whole = digests_of(spark, tmp_path)
    small = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        read = spark.read.text(str(tmp_path / "a.csv"))
        assert read.rdd.getNumPartitions() > 5
        cut = digests_of(spark, tmp_path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, text in contents.items():
        assert whole[f"{name}.csv"].file_hash == cut[f"{name}.csv"].file_hash == plain_digest(text.encode()), name
        assert whole[f"{name}.csv"].header == cut[f"{name}.csv"].header == ("" if name == "nameless" else HEADER), name
    assert len({r.file_hash for r in whole.values()}) == len(contents)


def test_fifty_headers_are_one_scan(spark, tmp_path):
    """Headers turned by k places, with one or two columns more; short and long lines are
    marked by the length of their own header, a quote left open ends with its line."""
    good = GOOD[0].split(",")
    for k in range(50):
        turned = C.FEED_COLUMNS[k % 9 :] + C.FEED_COLUMNS[: k % 9]
        values = dict(zip(C.FEED_COLUMNS, good)) | {"transaction_id": f"TX-{k}"}
        extra = ([f"x{k}"], ["more, \"\"quoted\"\""]) if k % 3 == 0 else ([f"y{k}", f"z{k}"], ["", ""])
        row = [values[c] for c in turned] + [f'"{e}"' if e else "" for e in extra[1]]
        width = len(row)
        bad = ["short,a", ",".join(["surplus"] * (width + 1)), ",".join(["open"] * (width - 1) + ['"open'])]
        write_csv(tmp_path / f"in/f{k}.csv", ",".join(row), *bad, header=",".join(turned + extra[0]))
    scan = feed_files.scan_feed(spark, str(tmp_path / "in"))
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" csv") == 1, plan
    rows = scan.collect()
    kept = [r for r in rows if r.transaction_id is not None and r.transaction_id.startswith("TX-")]
    assert len(rows) == 200 and len(kept) == 50
    for r in kept:
        assert [r[c] for c in C.FEED_COLUMNS[1:]] == good[1:] and r[feed_files.CORRUPT] is None
    marked = [r[feed_files.CORRUPT].split(",")[0] for r in rows if r[feed_files.CORRUPT]]
    assert sorted(marked) == ["short"] * 50 + ["surplus"] * 50


def test_too_many_headers_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_files, "MAX_HEADERS", 2)
    for k in range(3):
        write_csv(tmp_path / f"in/f{k}.csv", GOOD[0] + ",x", header=f"{HEADER},x{k}")
    with pytest.raises(ValueError, match="f[012].csv"):
        feed_files.scan_feed(spark, str(tmp_path / "in"))


def test_fingerprints_and_file_checks(spark, tmp_path):
    full = write_csv(tmp_path / "store_001_sales_20260724.csv", GOOD[0])
    (tmp_path / "store_002_sales_20260724.csv").write_text("")
    prints = {Path(r.path).name: r for r in feed_files.fingerprints(spark, str(tmp_path)).collect()}
    assert prints[full.name].file_hash == plain_digest(full.read_bytes())
    assert (prints[full.name].header, prints[full.name].lines) == (HEADER, 2)
    found = feed_files.files_by_store(spark, str(tmp_path))
    assert {(r.store, r.business_date) for r in found.collect()} == {("001", "20260724"), ("002", "20260724")}
    expected = spark.createDataFrame([("001",), ("002",), ("003",)], "store string")
    got = {r.store: r.error_code for r in feed_files.check_files(expected, found).collect()}
    assert got == {"001": "", "002": C.HEADER_MISMATCH, "003": C.FILE_NOT_FOUND}


def test_batches(spark):
    fact = spark.range(10).withColumn("transaction_time", F.lit("2026-07-01 00:00:00").cast("timestamp_ntz"))
    row = load.batch_stats(fact, 4).first()
    assert (row.tx_month, row.rows, row.batches, row.last_batch_rows) == ("2026-07", 10, 3, 2)


def test_synthetic_feed_scenarios(spark):
    numbers = spark.range(1, 101).withColumnRenamed("id", "i")
    clean = feed_files.synthetic_feed(numbers, AS_OF, 0, 0, 0, 0)
    assert validate.validation_report(validate.flag_feed(clean, ["copy"], AS_OF)).first().failed_rows == 0
    dirty = validate.flag_feed(feed_files.synthetic_feed(numbers, AS_OF), ["copy"], AS_OF)
    report = validate.validation_report(dirty).first()
    assert (report.total_rows, report.failed_rows) == (105, 9)


# --- streams --------------------------------------------------------------------


def test_stream_equals_batch_over_several_micro_batches(spark, base, tmp_path):
    path, schema, files = catalog._landed_parquet(spark, base)
    stream = ingest.feed_stream(spark, path, schema, files)
    paths = [str(tmp_path / p) for p in ("clean", "bad", "checkpoint")]
    for _ in range(2):  # the second start finds nothing new
        ingest.validate_stream(stream, catalog.FEED_ORDER, AS_OF, *paths).awaitTermination()
    batch = catalog.flagged(spark, base)
    clean, bad = spark.read.parquet(f"{paths[0]}/rows"), spark.read.parquet(paths[1])
    assert len(list((tmp_path / "clean/rows").glob("batch=*"))) >= 4
    assert bad.count() == batch.filter("failed").count()
    assert clean.select(*C.FEED_COLUMNS).exceptAll(validate.passed_rows(batch)).count() == 0
    assert clean.count() == batch.filter("not failed").count()


def test_stream_dedupe_keeps_one_row_per_key(spark, base):
    """Brute force, over several micro-batches: the kept keys are exactly the distinct keys."""
    rows = catalog.QUERIES["stream_dedupe"](spark, base).select(*C.DUPLICATE_KEY).collect()
    every = catalog.feed(spark, base).select(*C.DUPLICATE_KEY).collect()
    assert len(rows) == len(set(rows)) and set(rows) == set(every)


# --- plans ------------------------------------------------------------------------

HEAVY = [n for n in catalog.QUERIES if n.startswith("report_")] + ["fact_sales", "validation_report", "classify_files", "scd1_delta_product"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_plan_stays_in_the_jvm_without_cross_joins_or_windows(spark, base, name):
    text = plan(catalog.QUERIES[name](spark, base))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert node not in text, node


def test_feed_is_not_shuffled_for_keys_or_duplicates(spark, base):
    text = plan(catalog.fact(spark, base))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 5


def test_month_filter_prunes_partitions_and_columns(spark, base):
    text = plan(catalog.QUERIES["fact_pruned_month"](spark, base))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(tx_month" in scan
    assert "ReadSchema: struct<date_sk:int,transaction_time:timestamp_ntz,net_sales_amount:decimal(12,2)>" in scan


def test_reports_read_only_what_they_need(spark, base):
    text = plan(catalog.QUERIES["store_watermark"](spark, base))
    assert "p_retailprice" in text and "p_name" not in text


def csv_stream(spark, tmp_path):
    out = tmp_path / "out"
    ingest.validate_csv_stream(
        ingest.file_stream(spark, str(tmp_path / "in")), AS_OF, f"{out}/clean", f"{out}/bad", f"{out}/checkpoint"
    ).awaitTermination()
    clean = spark.read.parquet(f"{out}/clean/rows").select("transaction_id").collect()
    bad = spark.read.parquet(f"{out}/bad").select("transaction_id", "error_codes").collect()
    return sorted(r[0] for r in clean), sorted((r[0], r[1]) for r in bad)


def test_csv_stream_takes_any_header_and_goes_on_where_it_ended(spark, tmp_path):
    turned = [*C.FEED_COLUMNS[3:], *C.FEED_COLUMNS[:3], "extra"]
    values = dict(zip(C.FEED_COLUMNS, line(3).split(","))) | {"extra": "x"}
    write_csv(tmp_path / "in/a.csv", line(1), line(2, quantity="-1"), "short,line")
    write_csv(tmp_path / "in/b.csv", ",".join(values[c] for c in turned), header=",".join(turned))
    (tmp_path / "in/empty.csv").write_text("")
    clean, bad = csv_stream(spark, tmp_path)
    assert clean == ["TX-1", "TX-3"] and ("TX-2", C.NEGATIVE_QUANTITY) in bad
    short = next(codes for name, codes in bad if name == "short")
    assert C.MALFORMED_LINE in short.split(",")
    write_csv(tmp_path / "in/c.csv", line(4), line(1))
    clean, bad = csv_stream(spark, tmp_path)
    assert clean == ["TX-1", "TX-3", "TX-4"] and ("TX-1", C.DUPLICATE) in bad and len(bad) == 3


def test_csv_stream_stops_at_a_file_without_required_columns(spark, tmp_path):
    write_csv(tmp_path / "in/a.csv", "TX-1,STR-001", header="transaction_id,store_id")
    with pytest.raises(Exception, match=C.MISSING_COLUMN):
        csv_stream(spark, tmp_path)
