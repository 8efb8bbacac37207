"""Figures of a run as observed metrics: counted while its tables are written.

Each set of figures is a list of aggregates that a write observes, and a function that
makes the report out of their one row. Reports therefore read no table. The observed
operator has to be the last one before the write: there Spark counts every row once, also
when tasks or stages are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillforge.operators.rules import Rule
from tillforge.operators.scorecard import score_counts
from tillforge.operators.validate import report_counts, validator_counts


def feed_metrics(rules: list[Rule]) -> list[Column]:
    """What all reports over a flagged feed need, but for the number of transactions,
    which a write cannot observe (:func:`count_ids` does)."""
    return [*report_counts(), *validator_counts(rules), *score_counts()]


def observed(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, *metrics), seen


def one_row(spark: SparkSession, metrics: dict[str, int]) -> DataFrame:
    """Metrics as a table of one row; it is made on the driver, no job is run for it."""
    names = sorted(metrics)
    return spark.createDataFrame([tuple(metrics[n] for n in names)], ", ".join(f"`{n}` bigint" for n in names))


def count_ids(feed: DataFrame, column: str, seen: Observation) -> DataFrame:
    """No rows, but a write of it observes ``ids``, the number of different values of
    ``column``, NULL being one of them."""
    each = feed.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return each.observe(seen, F.count(F.lit(1)).alias("ids")).filter("_rows < 0").select(column)
