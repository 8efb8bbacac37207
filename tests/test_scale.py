"""Plans that must not do per row, or per file, what is needed once."""

from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions import text
from tillforge.operators import load
from tillforge.plans import catalog
from tillforge.session import shared_dir
from tillforge.sources import feed_files
from tillforge.streaming import ingest


def test_a_line_is_parsed_once_for_its_fields_and_is_not_gathered_by_file(spark, tmp_path):
    names = [*C.FEED_COLUMNS]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(f"a{i}" for i in range(9)) + "\nshort,line\n")
    (tmp_path / "b.csv").write_text(",".join([*names[::-1], "more"]) + "\n" + ",".join(f"b{i}" for i in range(9)) + ',"x, y"\n')
    scan = feed_files.scan_feed(spark, str(tmp_path))
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert "SortMergeJoin" not in scan._jdf.queryExecution().executedPlan().toString()
    rows = {(r.transaction_id, r.transaction_time, r._corrupt is None) for r in scan.collect()}
    assert rows == {("a0", "a8", True), ("b8", "b0", True), ("short", None, False)}


def _facts(spark, *rows):
    schema = f"{load.FACT_SCHEMA}, {load.LINE} binary, {load.SOURCE} string"
    made = [
        (t, 20260105, None, 1, 1, 1, None, q, None, None, None, 1, "2026-01", line, "f")
        for t, q, line in rows
    ]
    return spark.createDataFrame(made, schema)


def test_a_first_load_compares_nothing(spark, tmp_path):
    sent = _facts(spark, ("A", 1, b"a"), ("A", 2, b"a"), ("B", 1, b"b"), ("C", 1, None))
    empty = load.read_table(spark, str(tmp_path / "none"))
    changes = load.line_changes(sent, empty)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert sorted((r.transaction_id, r.quantity, r.change, r.old_months) for r in changes.collect()) == [
        ("A", 1, "ADDED", []), ("A", 2, "ADDED", []), ("B", 1, "ADDED", []),
    ]


def test_later_loads_compare_with_every_version(spark):
    held = _facts(spark, ("A", 1, b"a"), ("B", 1, b"b"), ("D", 1, b"d"), ("D", 1, b"d"))
    sent = _facts(spark, ("A", 1, b"a"), ("B", 2, b"b"), ("D", 1, b"d"), ("E", 1, b"e"), ("C", 1, None))
    changes = load.line_changes(sent, held).collect()
    assert sorted((r.transaction_id, r.change, r.old_months) for r in changes) == [
        ("A", "UNCHANGED", []), ("B", "REPLACED", ["2026-01"]), ("D", "REPLACED", []), ("E", "ADDED", []),
    ]


def test_one_look_at_a_plain_text_changes_no_result(spark):
    values = ["abc", "abc\n", "abc\r", "abc\x85", " a b ", "a b", "a\tb", "\x7fa", "é", "", " ", "n/a", "N/A ", "undefined", "undefinedx", "a\x00b", "~", None, " x"]
    rows = spark.createDataFrame([(v,) for v in values], "t string").select(
        text.stripped(F.col("t")).alias("now"), text.strip_control(text.strip_blank(F.col("t"))).alias("before"),
        text.null_words(F.col("t")).alias("word"), F.when(~F.lower("t").isin(C.NULL_WORDS), F.col("t")).alias("word_before"),
    )
    assert all(r.now == r.before and r.word == r.word_before for r in rows.collect())


def _copies(spark):
    """Labels of the written copies in the shared folder."""
    return Counter(p.name.rpartition("-")[0] for p in Path(shared_dir(spark), "tillforge").glob("*"))


def test_versions_of_a_line_are_dealt_once(spark):
    """sent and stored lines meet in one shuffle, whatever files are corrected; repeated
    lines, lines in other months and lines without a key end as they did."""
    held = _facts(spark, ("A", 1, b"a"), ("B", 1, b"b"), ("D", 1, b"d"), ("D", 2, b"d"), ("G", 1, b"g"), ("N", 1, None))
    sent = _facts(spark, ("A", 1, b"a"), ("A", 2, b"a"), ("B", 2, b"b"), ("D", 1, b"d"), ("E", 1, b"e"), ("C", 1, None))
    changes = load.line_changes(sent, held, spark.createDataFrame([("f",)], "file_name string"))
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(line_key") == 1 and "SortMergeJoin" not in plan, plan
    assert sorted((r.transaction_id, r.quantity, r.change, r.old_months) for r in changes.collect()) == [
        ("A", 1, "REPLACED", ["2026-01"]), ("A", 2, "REPLACED", ["2026-01"]), ("B", 2, "REPLACED", ["2026-01"]),
        ("D", 1, "REPLACED", ["2026-01"]), ("E", 1, "ADDED", []), ("G", 1, "REMOVED", ["2026-01"]), ("N", 1, "REMOVED", ["2026-01"]),
    ]
    left = load.line_changes(sent, held, spark.createDataFrame([("other",), (None,)], "file_name string"))
    assert left.filter("change = 'REMOVED'").isEmpty()


def _copies_left(spark, base, name):
    before = _copies(spark)
    catalog.QUERIES[name](spark, base).collect()
    return set(_copies(spark) - before)


def test_a_reload_leaves_no_copies(spark, base):
    """nothing but the table itself is left, and its first load was not written before."""
    assert _copies_left(spark, base, "reload_with_lines_left_out") == {"left-out"}


def test_lookups_shuffle_neither_texts_nor_columns_made_of_others(spark, base):
    """what goes through the joins by key is narrow."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalog.feed(spark, base).select(*C.FEED_COLUMNS)
        lines = catalog.fact_of(catalog.normalized(spark, base, rows), catalog.dims(spark, base))
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    last = next(line for line in plan.splitlines() if "Exchange hashpartitioning(coalesce(customer_id" in line)
    assert "product_id" not in last and "_lane" in last
    assert not any("Exchange" in line and "net_sales_amount" in line for line in plan.splitlines())


def test_store_files_lie_alone_and_headers_are_counted_by_hash(spark, base, tmp_path):
    """no checksum file beside a store's file; of lines, only those that name a column are
    told apart, and the first line of a file that names none is found as well."""
    feed_files.write_store_files(catalog.feed(spark, base), str(tmp_path / "stores"), "20260105")
    assert list((tmp_path / "stores").glob("feed=*/*.csv")) and not list((tmp_path / "stores").glob("feed=*/.*.crc"))
    header = ",".join(C.FEED_COLUMNS)
    texts = {"a": f"{header}\na,b\nquantity\n", "b": "x,y\nstore_id\n", "c": f"\n{header}\n", "d": "", "e": f"{header},more"}
    for name, content in texts.items():
        (tmp_path / f"{name}.csv").write_text(content)
    heads = feed_files.feed_headers(spark, [str(tmp_path / f"{n}.csv") for n in texts])
    assert {Path(r.source_file).stem: r.header for r in heads.collect()} == {"a": header, "b": "x,y", "c": "", "e": f"{header},more"}
    assert "SortAggregate" not in feed_files.feed_headers(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().executedPlan().toString()


def test_a_corrected_reload_leaves_no_copies(spark, base):
    """F3."""
    assert _copies_left(spark, base, "reload_corrected") == {"corrected"}


def test_a_csv_stream_leaves_rows_and_keys_alone(spark, tmp_path):
    """copies that only a micro-batch itself reads are gone when it is done."""
    (tmp_path / "in").mkdir()
    good = "TX-1,STR-001,PROD-001,EMP-001,CUST-0001,2,10.00,0.00,2026-07-24 10:00:00"
    (tmp_path / "in/a.csv").write_text("\n".join([",".join(C.FEED_COLUMNS), good, good]) + "\n")
    before = _copies(spark)
    out = [str(tmp_path / p) for p in ("clean", "bad", "checkpoint")]
    ingest.validate_csv_stream(ingest.file_stream(spark, str(tmp_path / "in")), "2026-12-01 00:00:00", *out).awaitTermination()
    assert spark.read.parquet(f"{out[0]}/rows").count() == spark.read.parquet(out[1]).count() == 1
    assert not list((tmp_path / "clean").glob("landed/batch=*")) and not list((tmp_path / "clean").glob("flagged/batch=*"))
    assert _copies(spark) == before


def test_a_refreshed_report_leaves_no_copies_of_lines(spark, base):
    """neither the first load nor the changes stay beside the table."""
    left = _copies_left(spark, base, "report_monthly_refreshed")
    assert not left & {"feed", "judged", "changes", "numbered"} and "refreshed" in left


def test_new_lines_are_found_by_their_keys_alone(spark, base, tmp_path):
    """who asks for new lines shuffles no values."""
    path = str(tmp_path / "t")
    load.commit_changes(spark, load.line_changes(_facts(spark, ("A", 1, b"a"), ("B", 1, b"b")), load.read_table(spark, path)), path)
    table = load.read_table(spark, path)
    new = load.line_changes(table, table.filter("transaction_id = 'A'")).agg(F.count_if(F.col("change") == "ADDED").alias("n"))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "quantity" not in plan and "unit_price" not in plan, plan
    assert new.first().n == 1
    assert _copies_left(spark, base, "idempotent_reload") == {"reloaded", "sent"}


def test_of_a_night_its_digests_are_left(spark, base):
    """F7."""
    assert _copies_left(spark, base, "changed_files") == {"night-1-digests", "night-2-digests"}


def test_a_landed_feed_is_not_kept_twice(spark, base):
    """F8: the copy that lots are cut from goes when they have landed."""
    assert _copies_left(spark, base, "stream_dedupe") == {"landed", "stream-dedupe"}
