"""The retail shapes over the given tables: sales feed, dimensions, master feeds.

Anomalies are placed by a fixed formula over the line keys, so every run and every
engine sees the same bad rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillforge.functions.text import padded
from tillforge.sources.tables import spread, table

# Total order of the lines inside one duplicate key.
FEED_ORDER = ["l_linenumber", "l_suppkey", "l_shipdate", "l_quantity"]
AS_OF = "2026-12-01 00:00:00"
LOADED_AT = "2026-11-30 00:00:00"


def sales_feed(spark: SparkSession, base_dir: str) -> DataFrame:
    """Raw point-of-sale lines, all text, plus the columns that give their order."""
    lines = table(spark, base_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_discount", *FEED_ORDER
    )
    lines = spread(lines, "l_orderkey", "l_linenumber")
    orders = table(spark, base_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, base_dir, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("price")
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    h = (
        F.col("l_orderkey") * 7
        + F.col("l_partkey") * 13
        + F.col("l_suppkey") * 17
        + F.col("l_linenumber")
    )

    def every(n: int, rest: int = 0) -> Column:
        return h % n == rest

    transaction = padded(F.col("l_orderkey"), 9)
    quantity = F.col("l_quantity").cast("int").cast("string")
    return joined.select(
        F.when(every(11), F.concat(F.lit("  tx-"), transaction, F.lit(" ")))
        .otherwise(F.concat(F.lit("TX-"), transaction))
        .alias("transaction_id"),
        F.when(every(71), F.lit("STR-999999"))
        .otherwise(F.concat(F.lit("STR-"), padded(F.col("l_suppkey"), 6)))
        .alias("store_id"),
        F.concat(F.lit("prod-"), padded(F.col("l_partkey"), 6)).alias("product_id"),
        F.concat(F.lit("EMP-"), padded(F.col("l_orderkey") % 50, 3)).alias("employee_id"),
        F.when(every(4), F.lit(None).cast("string"))
        .when(every(23), F.lit("N/A"))
        .otherwise(F.concat(F.lit("CUST-"), padded(F.col("o_custkey"), 6)))
        .alias("customer_id"),
        F.when(every(397), F.lit("abc"))
        .when(every(50), F.concat(F.lit("-"), quantity))
        .otherwise(quantity)
        .alias("quantity"),
        F.when(every(100, 1), F.lit("-10.00"))
        .otherwise(F.col("price").cast("string"))
        .alias("unit_price"),
        F.when(
            every(3),
            (F.col("price") * F.col("l_discount").cast("decimal(4,2)"))
            .cast("decimal(14,4)")
            .cast("string"),
        ).alias("discount_amount"),
        F.when(every(401), F.lit("not-a-date"))
        .when(every(100, 2), F.lit("2099-01-15 10:10:00"))
        .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 19))
        .alias("transaction_time"),
        *FEED_ORDER,
    )


def _stamped(df: DataFrame) -> DataFrame:
    loaded = F.lit(LOADED_AT).cast("timestamp_ntz")
    return df.withColumns({"created_at": loaded, "updated_at": loaded})


def dim_store(spark: SparkSession, base_dir: str) -> DataFrame:
    supplier = table(spark, base_dir, "supplier")
    nation = table(spark, base_dir, "nation")
    region = table(spark, base_dir, "region")
    return _stamped(
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            (F.col("s_suppkey") + 1).alias("store_sk"),
            F.concat(F.lit("STR-"), padded(F.col("s_suppkey"), 6)).alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("city"),
            F.upper(F.substring("n_name", 1, 2)).alias("state"),
        )
    )


def dim_product(spark: SparkSession, base_dir: str) -> DataFrame:
    return _stamped(
        table(spark, base_dir, "part").select(
            (F.col("p_partkey") + 1).alias("product_sk"),
            F.concat(F.lit("PROD-"), padded(F.col("p_partkey"), 6)).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        )
    )


def dim_customer(spark: SparkSession, base_dir: str) -> DataFrame:
    dotted = F.replace("c_name", F.lit("#"), F.lit("."))
    return _stamped(
        table(spark, base_dir, "customer").select(
            (F.col("c_custkey") + 1).alias("customer_sk"),
            F.concat(F.lit("CUST-"), padded(F.col("c_custkey"), 6)).alias("customer_id"),
            F.col("c_mktsegment").alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(F.col("c_custkey") % 13 == 0, F.concat(dotted, F.lit("Example.COM")))
            .otherwise(F.concat(dotted, F.lit("@Example.COM")))
            .alias("email"),
            F.lit(None).cast("string").alias("phone"),
        )
    )


def dim_employee(spark: SparkSession, base_dir: str) -> DataFrame:
    n = F.col("n")
    return _stamped(
        table(spark, base_dir, "orders")
        .select((F.col("o_orderkey") % 50).alias("n"))
        .distinct()
        .select(
            (n + 1).alias("employee_sk"),
            F.concat(F.lit("EMP-"), padded(n, 3)).alias("employee_id"),
            F.concat(F.lit("First"), n.cast("string")).alias("first_name"),
            F.concat(F.lit("Last"), n.cast("string")).alias("last_name"),
            F.when(n % 3 == 0, "Shift Lead").when(n % 3 == 1, "Cashier").otherwise("Manager").alias("role"),
            F.concat(F.lit("STR-"), padded(n, 6)).alias("store_id"),
        )
    )


def dim_date(spark: SparkSession, base_dir: str, fiscal_start_month: int = 1) -> DataFrame:
    """Calendar rows between the first and the last order date."""
    from tillforge.operators.keys import calendar

    orders = table(spark, base_dir, "orders")
    span = orders.agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
    )
    return calendar(span, fiscal_start_month)


DIMENSIONS = {
    "store": dim_store,
    "product": dim_product,
    "customer": dim_customer,
    "employee": dim_employee,
}
# Attributes a type-1 change overwrites, the first one being altered in master feeds.
TRACKED = {
    "store": ["store_name", "region", "city", "state"],
    "product": ["product_name", "category", "brand", "unit_price"],
    "customer": ["first_name", "last_name", "email", "phone"],
    "employee": ["first_name", "last_name", "role", "store_id"],
}


def incoming_master(spark: SparkSession, base_dir: str, entity: str) -> DataFrame:
    """Fresh master feed: every seventh member carries a changed attribute."""
    dim = DIMENSIONS[entity](spark, base_dir)
    changed = TRACKED[entity][0]
    value = F.when(
        F.col(f"{entity}_sk") % 7 == 0, F.concat(F.col(changed), F.lit(" (renamed)"))
    ).otherwise(F.col(changed))
    return dim.withColumn(changed, value).select(f"{entity}_id", *TRACKED[entity])


def existing_dimension(spark: SparkSession, base_dir: str, entity: str) -> DataFrame:
    """Current snapshot: every eleventh member is not known yet."""
    return DIMENSIONS[entity](spark, base_dir).filter(F.col(f"{entity}_sk") % 11 != 0)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- files, events ------------------------------------------------------------

FILES_EPOCH = "2026-01-01 00:00:00"


def _minutes_after_epoch(minutes: Column) -> Column:
    return F.lit(FILES_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), minutes.cast("int")
    )


def _document_files(spark: SparkSession, base_dir: str) -> DataFrame:
    """Every document as a feed file: name, content hash, size, lines, batch."""
    doc = F.col("doc_id")
    return table(spark, base_dir, "documents").select(
        "doc_id",
        F.concat("source", F.lit("_"), (doc % 31).cast("string")).alias("file_name"),
        F.sha2("text", 256).alias("file_hash"),
        F.octet_length("text").cast("bigint").alias("length"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
        .cast("bigint")
        .alias("rows_in_file"),
        F.concat(F.lit("BATCH-"), (doc % 71).cast("string")).alias("batch_id"),
    )


def file_fingerprints(spark: SparkSession, base_dir: str) -> DataFrame:
    return _document_files(spark, base_dir).select("doc_id", "file_name", "length", "file_hash")


def file_registry(spark: SparkSession, base_dir: str) -> DataFrame:
    """Files processed so far: the even documents; some failed, some were replayed."""
    doc = F.col("doc_id")
    return (
        _document_files(spark, base_dir)
        .filter(doc % 2 == 0)
        .select(
            "file_name",
            "file_hash",
            F.when(doc % 20 == 0, "FAILED").when(doc % 20 == 10, "REPROCESSED").otherwise("SUCCESS").alias("status"),
            _minutes_after_epoch(doc % 40000).alias("processed_at"),
            "batch_id",
            F.concat(F.lit("RUN-"), (doc % 10).cast("string")).alias("run_id"),
        )
    )


def incoming_files(spark: SparkSession, base_dir: str) -> DataFrame:
    """Files waiting: the odd documents; some marked for replay, some gone missing."""
    doc = F.col("doc_id")
    return (
        _document_files(spark, base_dir)
        .filter(doc % 2 == 1)
        .select(
            "doc_id",
            "file_name",
            "file_hash",
            "rows_in_file",
            "batch_id",
            _minutes_after_epoch(doc * 2 % 40000).alias("file_time"),
            (doc % 97 == 0).alias("is_replay"),
            (doc % 89 != 1).alias("is_present"),
        )
    )


def audit_events(spark: SparkSession, base_dir: str) -> DataFrame:
    return table(spark, base_dir, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("event_name"),
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "signup", "WARNING")
        .otherwise("INFO")
        .alias("severity"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("stage"),
        F.col("value").cast("decimal(18,2)").alias("duration_ms"),
    )


def versioned_master(spark: SparkSession, base_dir: str, entity: str) -> DataFrame:
    """Master feed that names some members twice: the old row and its changed successor."""
    old = DIMENSIONS[entity](spark, base_dir).select(f"{entity}_id", *TRACKED[entity])
    new = incoming_master(spark, base_dir, entity)
    changed = F.col(TRACKED[entity][0]).endswith(" (renamed)")
    return old.withColumn("version", F.lit(1)).unionByName(
        new.filter(changed).withColumn("version", F.lit(2))
    )
