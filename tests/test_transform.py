from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillforge.functions import money, text
from tillforge.operators import keys, scd, transform


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        (" str-001 ", "str-001"),
        ("N/A", None),
        (" \t NULL  ", None),
        ("", None),
        (None, None),
        ("a\x00b\x85c", "abc"),
        ("\x01 a", " a"),  # no second trim after control characters are gone
        ("nilly", "nilly"),
        ("<null>", None),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


@pytest.mark.parametrize(
    "raw, want",
    [("149.989", "149.99"), ("2.675", "2.68"), ("-0.005", "-0.01"), ("x", "0.00"), (None, "0.00"), ("5d", "0.00"), ("1e2", "100.00")],
)
def test_money(spark, raw, want):
    assert one(spark, raw, transform.to_money) == D(want)


@pytest.mark.parametrize("raw, want", [("2", 2), ("2.7", 2), ("-2.7", -2), ("abc", 1), (None, 1), ("1e3", 1000), ("9e99", 1)])
def test_quantity(spark, raw, want):
    assert one(spark, raw, transform.to_quantity) == want


@pytest.mark.parametrize("n, d, want", [(5, 2, 3), (-5, 2, -3), (5, -2, -3), (4, 3, 1), (0, 7, 0), (10**20, 10**3, 10**17)])
def test_half_up(spark, n, d, want):
    df = spark.createDataFrame([(D(n), D(d))], "n decimal(38,0), d decimal(18,0)")
    assert df.select(money.half_up(F.col("n"), F.col("d"))).first()[0] == want


def test_normalize(spark):
    row = transform.normalize(
        spark.createDataFrame([("str-001", "Alice.Smith@Example.COM", "149.989", "2")], "store_id string, email string, unit_price string, quantity string")
    ).first()
    assert (row.store_id, row.email, row.unit_price, row.quantity, row.discount_amount) == (
        "STR-001", "alice.smith@example.com", D("149.99"), 2, D("0.00"),
    )


@pytest.mark.parametrize(
    "quantity, price, discount, want",
    [
        ("5", "10.00", "5.00", ("50.00", "45.00", "10.00", "9.00")),
        ("1", "10.00", "12.50", ("10.00", "-2.50", "125.00", "-2.50")),
        ("3", "0.00", "1.00", ("0.00", "-1.00", "0.00", "-0.33")),
        ("0", "9.99", "0.50", ("0.00", "-0.50", "0.00", "-0.50")),
        ("-2", "5.00", "0.00", ("-10.00", "-10.00", "0.00", "5.00")),
    ],
)
def test_enrich(make_feed, quantity, price, discount, want):
    feed = make_feed({"quantity": quantity, "unit_price": price, "discount_amount": discount})
    r = transform.enrich(transform.normalize(feed)).first()
    got = (r.gross_sales_amount, r.net_sales_amount, r.discount_percentage, r.effective_unit_price)
    assert got == tuple(D(w) for w in want)
    assert r.transaction_line_total == r.net_sales_amount


@pytest.mark.parametrize(
    "message, want",
    [
        ("password='secret_password_123' ok", "password='********' ok"),
        ("TOKEN = abc123token&x=1", "TOKEN = ********&x=1"),
        ("postgres://user:pw@host/db", "postgres://user:********@host/db"),
        ("api_key: k1, secret: s1", "api_key: ******** secret: ********"),
        ("nothing here", "nothing here"),
    ],
)
def test_redaction(spark, message, want):
    assert one(spark, message, text.redact) == want


DIM = "k bigint, id string"


def dims(spark, **members):
    return {
        e: spark.createDataFrame(members.get(e, [(1, f"{e}-1")]), f"{e}_sk bigint, {e}_id string")
        for e in keys.LOOKUPS
    }


def test_keys_hit_miss_and_missing_customer(spark, make_feed):
    feed = make_feed({}, {"customer_id": None, "store_id": "UNKNOWN"}, {"customer_id": "CUST-9", "transaction_time": "soon"})
    known = dims(spark, store=[(7, "STR-001")], product=[(8, "PROD-001")], employee=[(9, "EMP-001")], customer=[(5, "CUST-0001")])
    rows = keys.resolve_keys(feed, known).orderBy("line").collect()
    assert [(r.store_sk, r.product_sk, r.employee_sk, r.customer_sk, r.date_sk) for r in rows] == [
        (7, 8, 9, 5, 20260115), (-1, 8, 9, None, 20260115), (7, 8, 9, -1, 19700101),
    ]
    found = {r.dimension: (r.hits, r.misses, r.failures) for r in keys.lookup_failures(keys.resolve_keys(feed, known)).collect()}
    assert found["store"] == (2, 1, 1) and found["customer"] == (1, 1, 0) and found["date"] == (2, 0, 1)


def test_unknown_member_strategies(spark, make_feed):
    known = dims(spark, store=[(7, "STR-001")], product=[(8, "PROD-001")], employee=[(9, "EMP-001")], customer=[(5, "CUST-0001")])
    feed = make_feed({}, {"store_id": "STR-B"}, {"store_id": "STR-A"}, {"store_id": "STR-B"})
    created = {r.store_id: r.store_sk for r in keys.auto_create(feed, known["store"], "store").collect()}
    assert created == {"STR-A": 8, "STR-B": 9}
    good, bad = keys.reject_unknown(keys.resolve_keys(feed, known))
    assert (good.count(), bad.count()) == (1, 3)


def test_assigned_keys_are_dense_and_ordered(spark):
    members = spark.range(5000).select(F.concat(F.lit("M-"), F.lpad((F.col("id") * 37 % 5000).cast("string"), 6, "0")).alias("nk"))
    rows = keys.assign_keys(members.repartition(7), "nk", "sk", 100).orderBy("nk").collect()
    assert [r.sk for r in rows] == list(range(101, 5101))


def test_calendar(spark):
    span = spark.sql("select date'2026-07-24' first_day, date'2026-07-26' last_day")
    friday, saturday, sunday = keys.calendar(span, fiscal_start_month=7).collect()
    assert (friday.date_sk, friday.day_name, friday.is_weekend, friday.fiscal_year) == (20260724, "Friday", False, 2027)
    assert saturday.is_weekend and sunday.is_weekend


STORE = "store_id string, store_name string, city string"


def test_scd1(spark):
    now, later = "2026-01-01 00:00:00", "2026-02-01 00:00:00"
    existing = spark.createDataFrame([(1, "S1", "One", None), (2, "S2", "Two", "Rome")], "store_sk bigint, " + STORE).withColumns(
        {c: F.lit(now).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    )
    incoming = spark.createDataFrame([("S1", "One", None), ("S2", "Zwei", "Rome"), ("S3", "Three", "Oslo")], STORE)
    tracked = ["store_name", "city"]
    delta = scd.scd1_delta(incoming, existing, "store_id", tracked)
    assert {r.store_id: r.change for r in delta.collect()} == {"S1": "UNCHANGED", "S2": "UPDATE", "S3": "INSERT"}
    m = scd.scd1_metrics(delta).first()
    assert (m.rows_compared, m.rows_inserted, m.rows_changed, m.rows_unchanged) == (3, 1, 1, 1)
    rows = {r.store_id: r for r in scd.scd1_apply(incoming, existing, "store_id", "store_sk", tracked, later).collect()}
    assert [(rows[s].store_sk, rows[s].store_name) for s in ("S1", "S2", "S3")] == [(1, "One"), (2, "Zwei"), (3, "Three")]
    assert rows["S1"].updated_at.month == 1 and rows["S2"].updated_at.month == 2 and rows["S2"].created_at.month == 1


def test_scd1_new_row_with_empty_first_attribute_is_not_an_insert(spark):
    existing = spark.createDataFrame([("S1", None, "Rome")], STORE)
    incoming = spark.createDataFrame([("S1", None, "Rome")], STORE)
    assert scd.scd1_delta(incoming, existing, "store_id", ["store_name", "city"]).first().change == "UNCHANGED"


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, v int, t string")
    assert {tuple(r) for r in scd.latest_per_key(df, "k", ["v"]).collect()} == {("a", 2, "y"), ("b", 1, None)}
