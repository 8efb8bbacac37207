"""Cleaning, normalising, enriching and the fact projection; narrow row work only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillforge import constants as C
from tillforge.functions.money import AMOUNT, MONEY, WIDE, cents, from_cents, half_up
from tillforge.functions.text import (
    NUMBER,
    clean_text,
    null_words,
    parse_number,
    redact,
    stripped,
    timestamp_of,
)

CODE_COLUMNS = ["store_id", "product_id", "employee_id", "customer_id", "transaction_id"]
MONEY_COLUMNS = ["unit_price", "discount_amount"]


def clean(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim, strip control characters and NULL words in all (or the named) text columns."""
    texts = columns or [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    # Two projections: one over all columns compiles to a method too long for the JIT.
    plain = df.withColumns({c: stripped(F.col(c)) for c in texts})
    return plain.withColumns({c: null_words(F.col(c)) for c in texts})


def to_money(text: Column) -> Column:
    """Two decimals, half up; what is no number becomes 0.00."""
    amount = F.when(text.rlike(NUMBER), F.trim(text).try_cast(MONEY))
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def to_quantity(text: Column) -> Column:
    """Whole number, cut toward zero; what is no number becomes 1."""
    return F.coalesce(parse_number(text).try_cast("int"), F.lit(1))


def normalize(df: DataFrame) -> DataFrame:
    """Upper-case codes, lower-case e-mail, exact money, integer quantity."""
    if "discount_amount" not in df.columns:
        df = df.withColumn("discount_amount", F.lit("0"))
    changes = {c: F.upper(F.col(c)) for c in CODE_COLUMNS}
    changes |= {c: to_money(F.col(c).cast("string")) for c in MONEY_COLUMNS}
    changes["quantity"] = to_quantity(F.col("quantity").cast("string"))
    lowered = F.lower(F.col("email")) if "email" in df.columns else None
    if lowered is not None:
        changes["email"] = F.when(lowered != "none", lowered)
    return df.withColumns({c: v for c, v in changes.items() if c in df.columns})


def timed(df: DataFrame) -> DataFrame:
    """The transaction time as the fact holds it: eight bytes in place of a text."""
    return df.withColumn("transaction_time", timestamp_of(df, "transaction_time"))


def enrich(df: DataFrame) -> DataFrame:
    """Gross, net, discount percentage, effective unit price and line total."""
    quantity = F.col("quantity")
    gross, net = F.col("gross_sales_amount"), F.col("net_sales_amount")
    divisor = F.when(quantity == 0, 1).otherwise(quantity)
    rate = from_cents(half_up(cents(F.col("discount_amount")) * 10000, cents(gross)), "decimal(16,2)")
    return (
        df.withColumn("gross_sales_amount", (quantity * F.col("unit_price")).cast(WIDE))
        .withColumn("net_sales_amount", (gross - F.col("discount_amount")).cast(WIDE))
        .withColumns(
            {
                "discount_percentage": F.when(gross > 0, rate).otherwise(F.lit(0).cast("decimal(16,2)")),
                "effective_unit_price": from_cents(half_up(cents(net), divisor), WIDE),
                "transaction_line_total": net,
            }
        )
    )


def fact_projection(resolved: DataFrame, audit_run_id: int, extra: list[str] | None = None) -> DataFrame:
    """The twelve fact columns, typed and in loading order, and ``extra`` ones as they are."""
    typed = resolved.withColumns(
        {
            "transaction_time": timestamp_of(resolved, "transaction_time"),
            "net_sales_amount": F.col("net_sales_amount").cast(AMOUNT),
            "audit_run_id": F.lit(audit_run_id).cast("bigint"),
        }
    )
    return typed.select(*C.FACT_COLUMNS, *(extra or []))


def clean_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", clean_text(F.col("text")).alias("text"))


def redact_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", redact(F.col("text")).alias("text"))


def redaction_counts(texts: dict[str, Column | DataFrame]) -> DataFrame:
    """Rows and rows changed by redaction, per named table with a ``text`` column."""
    from tillforge.sources.retail import union_all

    return union_all(
        [
            df.agg(
                F.count(F.lit(1)).alias("texts"),
                F.count_if(redact(F.col("text")) != F.col("text")).alias("redacted"),
            ).select(F.lit(name).alias("source_table"), "texts", "redacted")
            for name, df in texts.items()
        ]
    )
