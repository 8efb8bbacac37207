"""Data quality scorecard over six dimensions, with exact integer arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.money import from_cents, half_up, percent
from tillforge.operators.validate import within_limit

PERCENT = "decimal(9,2)"


def score_counts(columns: list[str] | None = None) -> list[Column]:
    """Rows, empty cells, rows passed and rows that repeat no line."""
    empty_cells = reduce(add, [F.col(c).isNull().cast("int") for c in columns or C.FEED_COLUMNS])
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(empty_cells), F.lit(0)).alias("empty"),
        F.count_if(~F.col("failed")).alias("passed"),
        F.count_if(~F.col(C.DUPLICATE)).alias("lines"),
    ]


def scorecard(flagged: DataFrame, columns: list[str] | None = None, limit: float = C.MAX_ERROR_PERCENTAGE) -> DataFrame:
    """One row of percentages and the weighted index; an empty feed scores 100.

    Weights: completeness 25, validity 30, uniqueness 20, consistency 10, conformity 10,
    freshness 5. Uniqueness looks at ``transaction_id`` alone; ``uniqueness_line_pct`` is
    the same figure per basket line.
    """
    no_id = F.coalesce(F.max(F.col("transaction_id").isNull().cast("int")), F.lit(0))
    ids = (F.count_distinct("transaction_id") + no_id).alias("ids")
    return score_of(flagged.agg(*score_counts(columns), ids), len(columns or C.FEED_COLUMNS), limit)


def score_of(counts: DataFrame, width: int = len(C.FEED_COLUMNS), limit: float = C.MAX_ERROR_PERCENTAGE) -> DataFrame:
    """The same from one row of :func:`score_counts` and ``ids``, the number of different
    transactions; ``width`` is the number of columns."""
    n = F.col("n")
    cells = n * width
    filled = cells - F.col("empty")
    valid = within_limit(n - F.col("passed"), n, limit)
    conformity = F.when(valid, 100).otherwise(80)
    # Hundredths of a percent over the common denominator "cells".
    weighted = (
        filled * 25
        + (F.col("passed") * 30 + F.col("ids") * 20) * width
        + cells * (F.lit(15) + conformity / 10).cast("bigint")
    )
    full = F.lit(100).cast(PERCENT)

    def scored(value):
        return F.when(n == 0, full).otherwise(value.cast(PERCENT))

    return counts.select(
        n.alias("total_records"),
        scored(percent(filled, cells)).alias("completeness_pct"),
        scored(percent(F.col("passed"), n)).alias("validity_pct"),
        scored(percent(F.col("ids"), n)).alias("uniqueness_pct"),
        scored(percent(F.col("lines"), n)).alias("uniqueness_line_pct"),
        full.alias("consistency_pct"),
        scored(conformity).alias("conformity_pct"),
        full.alias("freshness_pct"),
        scored(from_cents(half_up(weighted * 100, F.greatest(cells, F.lit(1))), PERCENT)).alias("overall_quality_score"),
    )
