"""Table constraints as audit queries: CHECK, UNIQUE, NOT NULL, foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.operators.rules import count_violations
from tillforge.sources.retail import union_all

NOT_NULL_FACT = [c for c in C.FACT_COLUMNS if c not in ("customer_sk", "audit_run_id")]


def outside(column: str, low: int, high: int):
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


# A CHECK constraint lets NULL pass, hence the coalesce to false.
CHECKS = {
    "dim_date": lambda: {
        "quarter_range": outside("quarter", 1, 4),
        "month_range": outside("month", 1, 12),
        "week_range": outside("week", 1, 53),
        "day_range": outside("day", 1, 31),
    },
    "dim_product": lambda: {"unit_price_not_negative": F.coalesce(F.col("unit_price") < 0, F.lit(False))},
    "fact_sales": lambda: {
        "quantity_positive": F.coalesce(F.col("quantity") <= 0, F.lit(False)),
        "unit_price_not_negative": F.coalesce(F.col("unit_price") < 0, F.lit(False)),
        "discount_not_negative": F.coalesce(F.col("discount_amount") < 0, F.lit(False)),
    },
    "etl_audit_log": lambda: {
        "status_declared": F.coalesce(~F.col("execution_status").isin(C.RUN_STATUSES), F.lit(False))
    },
    "file_registry": lambda: {
        "status_declared": F.coalesce(
            ~F.col("status").isin("SUCCESS", "FAILED", "REPROCESSED"), F.lit(False)
        )
    },
}


def _named(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("table_name"), "*")


def check_audit(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [_named(name, count_violations(df, CHECKS[name]())) for name, df in tables.items()]
    )


def not_null_audit(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return union_all(
        [
            _named(name, count_violations(df, {c: F.col(c).isNull() for c in columns}))
            for name, (df, columns) in tables.items()
        ]
    )


def unique_audit(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: keys held by more than one row, and the rows beyond the first."""
    frames = []
    for name, (df, keys) in tables.items():
        repeated = (
            df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        )
        frames.append(
            repeated.agg(
                F.count(F.lit(1)).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"),
                "repeated_keys",
                "surplus_rows",
            )
        )
    return union_all(frames)


def members_in_use(fact: DataFrame, dim: DataFrame, sk: str) -> DataFrame:
    """Members that facts refer to and that must not be deleted."""
    return dim.join(fact.select(sk).distinct(), sk, "left_semi")
