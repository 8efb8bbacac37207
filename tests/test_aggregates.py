"""Aggregates kept beside a versioned fact table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.operators import aggregates, load
from tillforge.plans import reports


def lines(spark, *rows):
    """Rows of (transaction, store, day, net, change, old months)."""
    made = [
        (t, int(day.replace("-", "")), None, 1, store, 1, f"{day} 10:00:00", 1, net, "0.00", net, 1, f"{t}-{net}".encode(), "f", change, old)
        for t, store, day, net, change, old in rows
    ]
    names = [*load.KEYED_COLUMNS, "change", "old_months"]
    schema = "a string, b int, c bigint, d bigint, e bigint, f bigint, g string, h int, i string, j string, k string, l bigint, m binary, n string, o string, p array<string>"
    df = spark.createDataFrame(made, schema).toDF(*names)
    money = {c: F.col(c).cast("decimal(10,2)") for c in ("unit_price", "discount_amount")}
    return load.with_month(
        df.withColumns({**money, "net_sales_amount": F.col("net_sales_amount").cast("decimal(12,2)"), "transaction_time": F.col("transaction_time").cast("timestamp_ntz")})
    )


def per_store(spark, path):
    stores = spark.createDataFrame([(1, "N", "one"), (2, "N", "two")], "store_sk bigint, region string, store_name string")
    rows = aggregates.region_store(spark, path, stores).collect()
    return {r.store_name: (r.total_transactions, r.total_units_sold, str(r.total_net_revenue)) for r in rows}


def test_orders_of_several_months_and_stores_count_once(spark, tmp_path, monkeypatch):
    facts, path = str(tmp_path / "facts"), str(tmp_path / "aggregates")
    first = lines(
        spark, ("A", 1, "2026-01-05", "1.00", "ADDED", []), ("A", 1, "2026-02-05", "2.00", "ADDED", []), ("A", 2, "2026-02-05", "4.00", "ADDED", []),
        ("B", 1, "2026-02-07", "8.00", "ADDED", []), (None, 1, "2026-02-08", "16.00", "ADDED", []),
    )
    load.commit_changes(spark, first, facts)
    aggregates.refresh(spark, facts, path)
    assert per_store(spark, path) == {"one": (2, 4, "27.00"), "two": (1, 1, "4.00")}

    # A line of January leaves, a new order of an old and of a new id comes to March.
    second = lines(spark, ("A", 1, "2026-03-01", "32.00", "ADDED", []), ("C", 2, "2026-03-02", "64.00", "ADDED", []))
    gone = lines(spark, ("A", 1, "2026-01-05", "1.00", "REMOVED", ["2026-01"]))
    load.commit_changes(spark, second.union(gone), facts)
    opened = []
    whole = load.read_table
    monkeypatch.setattr(aggregates, "read_table", lambda s, p, months=None: opened.append(months) or whole(s, p, months))
    with monkeypatch.context() as patch:
        patch.setattr(aggregates, "_write", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            aggregates.refresh(spark, facts, path, ["2026-01", "2026-03"])
    assert per_store(spark, path) == {"one": (2, 4, "27.00"), "two": (1, 1, "4.00")}
    aggregates.refresh(spark, facts, path, ["2026-01", "2026-03"])
    assert per_store(spark, path) == {"one": (2, 4, "58.00"), "two": (2, 2, "68.00")}
    assert opened == [["2026-01", "2026-03"]] * 2
    assert load.current(spark, path) == (2, [("2026-02", 1), ("2026-03", 2)])
    keys = spark.read.schema(aggregates.ORDER_KEYS).parquet(f"{path}/order_keys/open/batch=*")
    assert Counter((r.transaction_id, r.order_no) for r in keys.collect()) == Counter({("A", 1): 1, ("B", 2): 1, ("C", 3): 1})
    assert C.FACT_COLUMNS == load.read_table(spark, facts).columns[: len(C.FACT_COLUMNS)]


def test_a_day_reads_one_month_folder(spark, tmp_path):
    facts = str(tmp_path / "facts")
    load.commit_changes(spark, lines(spark, *((f"T{m}", 1, f"2026-0{m}-05", "1.00", "ADDED", []) for m in range(1, 6))), facts)
    files = load.read_table(spark, facts, ["2026-03"]).inputFiles()
    assert files and all("tx_month=2026-03" in f for f in files)


def test_growth_needs_the_calendar_month_before(spark):
    months = [(1996, 12, "100.00"), (1997, 1, "150.01"), (1997, 3, "0.00"), (1997, 4, "7.00"), (1997, 5, "-7.00"), (1997, 6, "1.00")]
    table = spark.createDataFrame(months, "year int, month int, revenue string")
    table = table.select("year", "month", F.col("revenue").cast("decimal(28,2)").alias("monthly_revenue"))
    got = reports.monthly_growth(table)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    figures = [(r.month, *(None if x is None else str(x) for x in (r.previous_revenue, r.growth, r.growth_percent))) for r in got.collect()]
    assert figures == [
        (6, "-7.00", "8.00", None),
        (5, "7.00", "-14.00", "-200.00"),
        (4, "0.00", "7.00", None),
        (3, None, None, None),
        (1, "100.00", "50.01", "50.01"),
        (12, None, None, None),
    ]


def test_orders_take_no_more_room_than_pairs_of_key_and_order(spark, tmp_path):
    """Orders far apart in number: a bitmap for each would be 4 KB."""
    facts, path = str(tmp_path / "facts"), str(tmp_path / "aggregates")
    load.commit_changes(spark, lines(spark, *((f"T{i:04}", i % 2 + 1, "2026-01-05", "1.00", "ADDED", []) for i in range(400))), facts)
    aggregates.refresh(spark, facts, path)
    held = aggregates.orders(spark, path, "store_sk")
    assert dict(held.dtypes)["word"] == "bigint"
    assert held.count() == 14  # words 0 to 6 of 64 orders, of two stores
    assert held.agg(F.sum(F.bit_count("word"))).first()[0] == 400
    assert per_store(spark, path) == {"one": (200, 200, "200.00"), "two": (200, 200, "200.00")}
    plan = held.groupBy("number").agg(F.bit_or("word"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
