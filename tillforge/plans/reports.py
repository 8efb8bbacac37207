"""Sales reports over the star schema; inner joins, so unknown members drop out.

Ties are broken by the natural key, which makes top-k reports repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.functions.money import TOTAL, average, cents, from_cents, half_up, total



def _orders():
    return F.count_distinct("transaction_id")


def _net():
    return total(F.col("net_sales_amount"))


def _units():
    return F.sum("quantity").cast("bigint")


def region_store(fact: DataFrame, store: DataFrame) -> DataFrame:
    return (
        fact.join(store, "store_sk")
        .groupBy("region", "store_name")
        .agg(
            _orders().alias("total_transactions"),
            _units().alias("total_units_sold"),
            _net().alias("total_net_revenue"),
            average(F.col("net_sales_amount")).alias("avg_transaction_line_value"),
        )
        .orderBy(F.desc("total_net_revenue"), "region", "store_name")
    )


def top_categories_products(fact: DataFrame, product: DataFrame, k: int = 5) -> DataFrame:
    """Top k over all (category, product) pairs, not per category."""
    return (
        fact.groupBy("product_sk")
        .agg(_units().alias("units"), _net().alias("revenue"))
        .join(product.select("product_sk", "category", "product_name"), "product_sk")
        .groupBy("category", "product_name")
        .agg(
            F.sum("units").cast("bigint").alias("total_quantity_sold"),
            F.sum("revenue").cast(TOTAL).alias("category_revenue"),
        )
        .orderBy(F.desc("category_revenue"), "category", "product_name")
        .limit(k)
    )


def audit_by_status(runs: DataFrame) -> DataFrame:
    mean_ms = half_up(F.sum("duration_ms"), F.count("duration_ms"))
    return runs.groupBy("pipeline_name", F.col("execution_status").alias("status")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.sum("records_read").alias("aggregate_rows_read"),
        F.sum("records_loaded").alias("aggregate_rows_loaded"),
        F.sum("records_rejected").alias("aggregate_rows_rejected"),
        (mean_ms.cast("decimal(15,0)") / 1000).cast("decimal(18,3)").alias("avg_run_duration_sec"),
    )


def daily_store(fact: DataFrame, date: DataFrame, store: DataFrame, as_of: str) -> DataFrame:
    """Revenue per store of the day before ``as_of``; ``fact`` may be month-partitioned."""
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    day_key = F.date_format(yesterday, "yyyyMMdd").cast("int")
    return (
        fact.filter(F.col("date_sk") == day_key)
        .join(date.filter(F.col("calendar_date") == yesterday).select("date_sk", "calendar_date"), "date_sk")
        .join(store.select("store_sk", "store_id", "store_name"), "store_sk")
        .groupBy("calendar_date", "store_id", "store_name")
        .agg(_orders().alias("total_orders"), _net().alias("daily_revenue"))
        .orderBy(F.desc("daily_revenue"), "store_id")
    )


def top_products(fact: DataFrame, product: DataFrame, k: int = 10) -> DataFrame:
    return (
        fact.groupBy("product_sk")
        .agg(_units().alias("total_units_sold"), _net().alias("total_revenue"))
        .join(product.select("product_sk", "product_id", "product_name", "category"), "product_sk")
        .select("product_id", "product_name", "category", "total_units_sold", "total_revenue")
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(k)
    )


def monthly(fact: DataFrame, date: DataFrame) -> DataFrame:
    return (
        fact.join(date.select("date_sk", "year", "month", "month_name"), "date_sk")
        .groupBy("year", "month", "month_name")
        .agg(_orders().alias("order_volume"), _net().alias("monthly_revenue"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


def monthly_growth(months: DataFrame) -> DataFrame:
    """Rows of ``monthly`` beside the calendar month before; NULL where that one has no sales,
    and no percentage of a revenue that is not positive. Months meet by number: a lag over
    all of them would gather the table in one partition."""
    numbered = months.withColumn("number", F.col("year") * 12 + F.col("month"))
    before = numbered.select((F.col("number") + 1).alias("number"), F.col("monthly_revenue").alias("previous_revenue"))
    revenue, previous = cents(F.col("monthly_revenue")), cents(F.col("previous_revenue"))
    change = half_up((revenue - previous).cast("decimal(30,0)") * 10000, previous)
    return (
        numbered.join(before, "number", "left")
        .select(
            "year",
            "month",
            "monthly_revenue",
            "previous_revenue",
            (F.col("monthly_revenue") - F.col("previous_revenue")).cast(TOTAL).alias("growth"),
            F.when(F.col("previous_revenue") > 0, from_cents(change, "decimal(18,2)")).alias("growth_percent"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def employee_sales(fact: DataFrame, employee: DataFrame) -> DataFrame:
    return (
        fact.groupBy("employee_sk")
        .agg(_orders().alias("transactions_processed"), _net().alias("total_sales_generated"))
        .join(employee, "employee_sk")
        .select(
            "store_id",
            "employee_id",
            F.concat_ws(" ", "first_name", "last_name").alias("employee_name"),
            "transactions_processed",
            "total_sales_generated",
        )
        .orderBy(F.desc("total_sales_generated"), "employee_id")
    )


def repeat_customers(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Customers with more than one order; NULL and unknown customers are left out early."""
    return (
        fact.filter("customer_sk > 0")
        .groupBy("customer_sk")
        .agg(_orders().alias("lifetime_orders"), _net().alias("lifetime_spend"))
        .filter("lifetime_orders > 1")
        .join(customer, "customer_sk")
        .select(
            "customer_id",
            F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
            "lifetime_orders",
            "lifetime_spend",
        )
        .orderBy(F.desc("lifetime_spend"), "customer_id")
    )


def weekend(fact: DataFrame, date: DataFrame) -> DataFrame:
    return (
        fact.join(date.select("date_sk", "is_weekend"), "date_sk")
        .groupBy("is_weekend")
        .agg(
            _orders().alias("total_orders"),
            _net().alias("total_revenue"),
            average(F.col("net_sales_amount")).alias("avg_order_value"),
        )
    )


def region(fact: DataFrame, store: DataFrame) -> DataFrame:
    """Per region: stores that sold, revenue, revenue per store."""
    per_store = fact.groupBy("store_sk").agg(_net().alias("revenue"))
    revenue = F.sum("revenue").cast(TOTAL)
    return (
        per_store.join(store.select("store_sk", "store_id", "region"), "store_sk")
        .groupBy("region")
        .agg(
            F.count_distinct("store_id").alias("store_count"),
            revenue.alias("regional_revenue"),
        )
        .withColumn(
            "avg_revenue_per_store",
            from_cents(half_up(cents(F.col("regional_revenue")), F.col("store_count"))),
        )
        .orderBy(F.desc("regional_revenue"), "region")
    )


def category(fact: DataFrame, product: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_sk").agg(_units().alias("units"), _net().alias("revenue"))
    return (
        per_product.join(product.select("product_sk", "category"), "product_sk")
        .groupBy("category")
        .agg(
            F.count_distinct("product_sk").alias("distinct_products"),
            F.sum("units").cast("bigint").alias("total_units_sold"),
            F.sum("revenue").cast(TOTAL).alias("total_category_revenue"),
        )
        .orderBy(F.desc("total_category_revenue"), "category")
    )


def store_line_value(fact: DataFrame, store: DataFrame) -> DataFrame:
    return (
        fact.join(store.select("store_sk", "store_name"), "store_sk")
        .groupBy("store_name")
        .agg(
            average(F.col("net_sales_amount")).alias("avg_line_item_value"),
            total(F.col("discount_amount")).alias("total_discounts_given"),
        )
        .orderBy(F.desc("avg_line_item_value"), "store_name")
    )


def top_stores(fact: DataFrame, store: DataFrame, k: int = 10) -> DataFrame:
    return (
        fact.groupBy("store_sk")
        .agg(_net().alias("annual_store_revenue"))
        .join(store, "store_sk")
        .select("store_id", "store_name", "city", "state", "annual_store_revenue")
        .orderBy(F.desc("annual_store_revenue"), "store_id")
        .limit(k)
    )
