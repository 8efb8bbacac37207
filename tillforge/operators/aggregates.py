"""Partial aggregates by month and key, kept beside a versioned fact table.

For every key there is one row of sums per month, and the orders of a month as words of 64
bits over dense order numbers, so that different orders are counted exactly over any months:
words are put together by OR, sums by addition. Only words with a bit set are rows, so there
are never more of them than pairs of a key and an order, however thinly a key's orders lie. A refresh reads the months that a load touched and
no others; order numbers are looked up in a key store and given on to new orders.

Like the fact table, nothing is written over: a refresh writes a new folder and then one small
file that names the folder of each month. Rows are written as the aggregate leaves them, sorted
by month, so that months are found by row group and no second shuffle gathers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillforge.functions.money import TOTAL, cents, from_cents, half_up
from tillforge.operators.key_store import KeyStore
from tillforge.operators.keys import assign_keys
from tillforge.operators.load import COMMIT_SCHEMA, MONTH, current, read_table
from tillforge.session import scratch, shuffles_dropped, write_through

#: Keys with orders counted, and those with sums only.
COUNTED = ["date_sk", "store_sk", "employee_sk", "customer_sk"]
SUMMED = [*COUNTED, "product_sk"]
SUMS_SCHEMA = "{key} bigint, lines bigint, quantity bigint, net_sales_amount decimal(28,2), discount_amount decimal(28,2), tx_month string, load int"
ORDERS_SCHEMA = "{key} bigint, number bigint, word bigint, tx_month string, load int"
ORDER_KEYS = StructType([StructField("transaction_id", StringType()), StructField("order_no", LongType())])


def _numbered(spark: SparkSession, fact: DataFrame, path: str, last: int) -> DataFrame:
    """``fact`` with ``order_no``, dense over all orders seen so far; NULL without an id."""
    ids = fact.select("transaction_id").filter("transaction_id is not null").distinct()
    store = KeyStore(f"{path}/order_keys", ORDER_KEYS, ["transaction_id"])
    held = store.earlier(ids, last).join(ids, "transaction_id", "left_semi")
    known = write_through(held.groupBy("transaction_id").agg(F.min("order_no").alias("order_no")), "known-orders")
    highest = spark.read.parquet(f"{path}/highest/commit={last}").first()[0] if last else 0
    new = assign_keys(ids.join(known, "transaction_id", "left_anti"), "transaction_id", "order_no", highest)
    # Written before they are used; a refresh that breaks off is repeated from the old highest.
    store.add(new.select("transaction_id", "order_no"), last)
    new = spark.read.schema(ORDER_KEYS).parquet(store._batch(last))
    top = new.agg(F.coalesce(F.max("order_no"), F.lit(highest)).alias("highest"))
    top.coalesce(1).write.mode("overwrite").parquet(f"{path}/highest/commit={last + 1}")
    return fact.join(known.unionByName(new), "transaction_id", "left")


def refresh(spark: SparkSession, facts_path: str, path: str, months: list[str] | None = None) -> None:
    """Bring the aggregates of ``months`` (all, if none are named) to the state of the table."""
    there = sorted({m for m, _ in current(spark, facts_path)[1]})
    last, held = current(spark, path)
    touched = there if months is None else sorted(set(months))
    fact = read_table(spark, facts_path, touched)
    with scratch(spark), shuffles_dropped(spark):
        # Only what is counted meets the order numbers; sums are made of the table itself.
        counted = _numbered(spark, fact.select("transaction_id", MONTH, *COUNTED), path, last).filter("order_no is not null")
        counted = write_through(counted.select(MONTH, *COUNTED, "order_no"), "numbered")
        for key in SUMMED:
            known = _keyed(fact, key)
            sums = known.groupBy(MONTH, key).agg(
                F.count(F.lit(1)).alias("lines"),
                F.sum("quantity").cast("bigint").alias("quantity"),
                F.sum("net_sales_amount").cast(TOTAL).alias("net_sales_amount"),
                F.sum("discount_amount").cast(TOTAL).alias("discount_amount"),
            )
            _write(sums, f"{path}/{key}/sums/load={last + 1}")
            if key in COUNTED:
                words = _keyed(counted, key).groupBy(MONTH, key, F.shiftright("order_no", 6).alias("number"))
                _write(words.agg(F.bit_or(F.expr("shiftleft(1L, cast(order_no & 63 as int))")).alias("word")), f"{path}/{key}/orders/load={last + 1}")
    pointers = [(m, n) for m, n in held if m not in touched] + [(m, last + 1) for m in touched if m in there]
    spark.createDataFrame([*pointers, (None, last + 1)], COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/commits/commit={last + 1}"
    )


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("bigint"))


def _write(rows: DataFrame, path: str) -> None:
    rows.sortWithinPartitions(MONTH).write.mode("overwrite").parquet(path)


def _read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Current rows: a month counts only in the load that its pointer names."""
    _, held = current(spark, path)
    loads = sorted({n for _, n in held})
    if not loads:
        return spark.createDataFrame([], schema).drop("load")
    rows = spark.read.schema(schema).option("basePath", f"{path}/{table}").parquet(*[f"{path}/{table}/load={n}" for n in loads])
    named = [(F.col("load") == n) & F.col(MONTH).isin([m for m, k in held if k == n]) for n in loads]
    wanted = named[0]
    for one in named[1:]:
        wanted = wanted | one
    return rows.filter(wanted).drop("load")


def sums(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Sums per month and key; the column names are those of the fact table, so that reports
    of sums take it in place of the facts."""
    return _read(spark, path, f"{key}/sums", SUMS_SCHEMA.format(key=key))


def orders(spark: SparkSession, path: str, key: str) -> DataFrame:
    return _read(spark, path, f"{key}/orders", ORDERS_SCHEMA.format(key=key))


def _per_group(spark, path: str, key: str, dim: DataFrame, groups: list[str], *more: Column) -> DataFrame:
    """``groups`` with the number of different orders and further aggregates of sums."""
    words = orders(spark, path, key).join(dim, key).groupBy(*groups, "number").agg(F.bit_or("word").alias("word"))
    counted = words.groupBy(*groups).agg(F.sum(F.bit_count("word")).alias("_orders"))
    added = sums(spark, path, key).join(dim, key).groupBy(*groups).agg(
        F.sum("net_sales_amount").cast(TOTAL).alias("_net"), F.sum("lines").alias("_lines"), F.sum("quantity").cast("bigint").alias("_units"), *more
    )
    same = [added[g].eqNullSafe(counted[g]) for g in groups]
    joined = added.join(counted, same, "left").select(added["*"], F.coalesce("_orders", F.lit(0)).cast("bigint").alias("_orders"))
    return joined.withColumn("_average", from_cents(half_up(cents(F.col("_net")), F.col("_lines"))))


def monthly(spark, path: str, date: DataFrame) -> DataFrame:
    days = date.select("date_sk", "year", "month", "month_name")
    rows = _per_group(spark, path, "date_sk", days, ["year", "month", "month_name"])
    return rows.select("year", "month", "month_name", F.col("_orders").alias("order_volume"), F.col("_net").alias("monthly_revenue")).orderBy(
        F.desc("year"), F.desc("month")
    )


def weekend(spark, path: str, date: DataFrame) -> DataFrame:
    rows = _per_group(spark, path, "date_sk", date.select("date_sk", "is_weekend"), ["is_weekend"])
    return rows.select("is_weekend", F.col("_orders").alias("total_orders"), F.col("_net").alias("total_revenue"), F.col("_average").alias("avg_order_value"))


def region_store(spark, path: str, store: DataFrame) -> DataFrame:
    rows = _per_group(spark, path, "store_sk", store.select("store_sk", "region", "store_name"), ["region", "store_name"])
    return rows.select(
        "region",
        "store_name",
        F.col("_orders").alias("total_transactions"),
        F.col("_units").alias("total_units_sold"),
        F.col("_net").alias("total_net_revenue"),
        F.col("_average").alias("avg_transaction_line_value"),
    ).orderBy(F.desc("total_net_revenue"), "region", "store_name")


def store_line_value(spark, path: str, store: DataFrame) -> DataFrame:
    rows = sums(spark, path, "store_sk").join(store.select("store_sk", "store_name"), "store_sk").groupBy("store_name").agg(
        F.sum("net_sales_amount").cast(TOTAL).alias("_net"),
        F.sum("lines").alias("_lines"),
        F.sum("discount_amount").cast(TOTAL).alias("total_discounts_given"),
    )
    value = from_cents(half_up(cents(F.col("_net")), F.col("_lines"))).alias("avg_line_item_value")
    return rows.select("store_name", value, "total_discounts_given").orderBy(F.desc("avg_line_item_value"), "store_name")


def employee_sales(spark, path: str, employee: DataFrame) -> DataFrame:
    name = F.concat_ws(" ", "first_name", "last_name").alias("employee_name")
    people = employee.select("employee_sk", "store_id", "employee_id", name)
    rows = _per_group(spark, path, "employee_sk", people, ["store_id", "employee_id", "employee_name"])
    return rows.select(
        "store_id", "employee_id", "employee_name", F.col("_orders").alias("transactions_processed"), F.col("_net").alias("total_sales_generated")
    ).orderBy(F.desc("total_sales_generated"), "employee_id")


def repeat_customers(spark, path: str, customer: DataFrame) -> DataFrame:
    name = F.concat_ws(" ", "first_name", "last_name").alias("customer_name")
    people = customer.filter("customer_sk > 0").select("customer_sk", "customer_id", name)
    rows = _per_group(spark, path, "customer_sk", people, ["customer_id", "customer_name"])
    return (
        rows.filter("_orders > 1")
        .select("customer_id", "customer_name", F.col("_orders").alias("lifetime_orders"), F.col("_net").alias("lifetime_spend"))
        .orderBy(F.desc("lifetime_spend"), "customer_id")
    )
