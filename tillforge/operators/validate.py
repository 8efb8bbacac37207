"""Row routing: flag every row once, then split, quarantine and report.

A flagged feed is the feed plus one boolean column per rule code. All splits and all
reports are plain filters and aggregates over those columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.money import percent
from tillforge.operators.rules import Rule, duplicate_rule, feed_rules, parse_feed
from tillforge.session import write_through

HELPERS = ["_quantity", "_price", "_time", "_repeated"]


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """Required columns the frame lacks; looks at the schema only."""
    return [c for c in required or C.REQUIRED_COLUMNS if c not in df.columns]


class SchemaError(ValueError):
    """The feed lacks required columns, so no row of it can be judged."""


def first_of_repeated(feed: DataFrame, keys: list[str], order_by: list[str], ids: Callable | None = None) -> DataFrame:
    """One row per key that occurs more than once, with the order of its first row.

    Two phases. The first counts rows per key, a hash aggregate whose partial counts make a
    key with a third of all rows one row per task; the keys that repeat are written, so that
    the planner knows how few they are. The second looks for the first row among the rows of
    those keys alone. ``ids(feed)`` may give a table without rows whose write observes more.
    """
    counted = feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    often = counted.filter(F.col("_copies") > 1).select(*keys)
    if ids is not None:
        often = often.unionByName(ids(feed), allowMissingColumns=True).select(*keys)
    often = write_through(often, "often").withColumnsRenamed({k: f"_key_{k}" for k in keys})
    rows = feed.select(*keys, F.struct(*order_by).alias("_first"))
    rows = rows.join(often, [rows[k].eqNullSafe(often[f"_key_{k}"]) for k in keys], "left_semi")
    return rows.groupBy(*keys).agg(F.min("_first").alias("_first"))


def mark_repeats(feed: DataFrame, keys: list[str], order_by: list[str], ids: Callable | None = None) -> DataFrame:
    """Add ``_repeated``: true on all but the first row of a key; NULL keys are one key.

    ``order_by`` must be a total order within a key. The first rows are written out, so the
    planner knows their true size: few of them are broadcast and the feed is not shuffled
    at all; many are joined by key, where adaptive execution splits the hot ones.
    """
    firsts = write_through(first_of_repeated(feed, keys, order_by, ids), "repeats")
    firsts = firsts.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same_key = [feed[k].eqNullSafe(firsts[f"_key_{k}"]) for k in keys]
    later = F.coalesce(F.struct(*order_by) > F.col("_first"), F.lit(False))
    return (
        feed.join(firsts, same_key, "left")
        .withColumn("_repeated", later)
        .drop("_first", *[f"_key_{k}" for k in keys])
    )


def default_rules(as_of: str) -> list[Rule]:
    return [*feed_rules(as_of), duplicate_rule()]


def flag_feed(
    feed: DataFrame,
    order_by: list[str],
    as_of: str,
    rules: list[Rule] | None = None,
    keys: list[str] | None = None,
    ids: Callable | None = None,
) -> DataFrame:
    """The feed with one boolean column per rule code and ``failed``, their union.

    Missing required columns abort the run; any rule list can be given instead of the
    default one.
    """
    missing = missing_columns(feed)
    if missing:
        raise SchemaError(f"{C.MISSING_COLUMN}: {', '.join(missing)}")
    rules = rules or default_rules(as_of)
    if any(rule.code == C.DUPLICATE for rule in rules):
        feed = mark_repeats(feed, keys or C.DUPLICATE_KEY, order_by, ids)
    flagged = parse_feed(feed).withColumns({rule.code: rule.fails for rule in rules})
    # A count, not a chain of ORs: the optimizer would break the chain up and push each
    # rule below the join and into the scan, where its text parsing is repeated.
    broken = reduce(add, [F.col(rule.code).cast("int") for rule in rules])
    return flagged.withColumn("failed", broken > 0).drop(*HELPERS)


def passed_rows(flagged: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return flagged.filter(~F.col("failed")).select(*(columns or C.FEED_COLUMNS))


def error_codes(rules: list[Rule]) -> Column:
    """Codes of the broken rules, in rule order, as one comma-separated text."""
    return F.concat_ws(",", *[F.when(F.col(r.code), F.lit(r.code)) for r in rules])


def error_messages(rules: list[Rule]) -> Column:
    return F.concat_ws("; ", *[F.when(F.col(r.code), F.lit(r.message)) for r in rules])


def failed_rows(flagged: DataFrame, rules: list[Rule], columns: list[str] | None = None) -> DataFrame:
    """Rows for the quarantine, with every reason they failed for."""
    return flagged.filter("failed").select(
        *(columns or C.FEED_COLUMNS),
        error_codes(rules).alias("error_codes"),
        error_messages(rules).alias("error_messages"),
    )


def write_quarantine(
    flagged: DataFrame,
    rules: list[Rule],
    path: str,
    run_id: str,
    source_file: Column,
    quarantined_at: str,
    columns: list[str] | None = None,
    mode: str = "append",
) -> None:
    """Write the failed rows as JSON lines below ``run_id=``, raw values nested.

    With ``mode="overwrite"`` only the folder of this run is replaced, so a repeated run
    leaves one copy.
    """
    columns = columns or C.FEED_COLUMNS
    record = flagged.filter("failed").select(
        F.lit(run_id).alias("run_id"),
        source_file.alias("source_file"),
        F.struct(*columns).alias("raw_record"),
        F.split(error_codes(rules), ",").alias("error_codes"),
        F.split(error_messages(rules), "; ").alias("error_messages"),
        F.lit(quarantined_at).alias("quarantined_at"),
    )
    writer = record.write.option("partitionOverwriteMode", "dynamic").mode(mode)
    writer.partitionBy("run_id").json(path)


QUARANTINE_SCHEMA = (
    "source_file string, raw_record struct<{fields}>, error_codes array<string>, "
    "error_messages array<string>, quarantined_at string, run_id string"
).format(fields=", ".join(f"{c}: string" for c in C.FEED_COLUMNS))


def read_quarantine(spark, path: str) -> DataFrame:
    """Quarantined rows of all runs; filter on ``run_id`` to prune folders."""
    return spark.read.schema(QUARANTINE_SCHEMA).json(path)


# --- reports over a flagged feed --------------------------------------------


def rule_hits(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows hit per rule, rules without hits included. A row may count several times."""
    counts = flagged.agg(*[F.count_if(F.col(r.code)).alias(r.code) for r in rules])
    described = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(r.code).alias("code"),
                    F.lit(r.validator).alias("validator"),
                    F.lit(r.severity).alias("severity"),
                    F.col(r.code).alias("hits"),
                )
                for r in rules
            ]
        )
    )
    return counts.select(described)


def failure_reasons(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Histogram of reasons that occurred."""
    return rule_hits(flagged, rules).filter("hits > 0").select("code", "hits")


def _validators(rules: list[Rule]) -> dict[str, list[Rule]]:
    groups: dict[str, list[Rule]] = {}
    for r in rules:
        groups.setdefault(r.validator, []).append(r)
    return groups


def validator_counts(rules: list[Rule]) -> list[Column]:
    """Rows, rows failed per validator and rows hit per rule."""
    return [
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(reduce(or_, [F.col(r.code) for r in members])).alias(name)
            for name, members in _validators(rules).items()
        ],
        *[F.count_if(F.col(r.code)).alias(r.code) for r in rules],
    ]


def validator_results(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per validator: checked, failed, status, severity and reason counts."""
    return validator_lines(flagged.agg(*validator_counts(rules)), rules)


def validator_lines(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same from one row of :func:`validator_counts`.

    The file and schema checks come first; they judge no rows, and a feed that reaches
    this point has passed them.
    """

    def line(name: str, severity: str, failed: Column, summary: Column) -> Column:
        return F.struct(
            F.lit(name).alias("validator_name"),
            F.when(failed > 0, "FAILED").otherwise("PASSED").alias("status"),
            F.lit(severity).alias("severity"),
            F.col("_rows").alias("records_checked"),
            failed.alias("records_failed"),
            summary.alias("error_summary"),
        )

    none = F.lit(0).cast("bigint")
    lines = [line("FileValidator", "CRITICAL", none, F.lit("")), line("SchemaValidator", "INFO", none, F.lit(""))]
    for name, members in _validators(rules).items():
        summary = F.concat_ws(
            ",",
            *[
                F.when(F.col(r.code) > 0, F.concat(F.lit(f"{r.code}="), F.col(r.code).cast("string")))
                for r in members
            ],
        )
        lines.append(line(name, members[0].severity, F.col(name), summary))
    return counts.select(F.inline(F.array(*lines)))


def within_limit(failed: Column, rows: Column, max_error_percentage: float) -> Column:
    """The validity gate: the failure rate does not exceed the allowed percentage."""
    limit = F.lit(str(max_error_percentage)).cast("decimal(9,4)")
    return (failed == 0) | (failed.cast("decimal(20,0)") * 100 <= rows.cast("decimal(20,0)") * limit)


def report_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("failed")).alias("passed_rows"),
        F.count_if("failed").alias("failed_rows"),
    ]


def validation_report(flagged: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """One row: totals, failure rate and the gate for each named limit."""
    return report_of(flagged.agg(*report_counts()), limits)


def report_of(counts: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """The same from one row of ``report_counts``."""
    limits = limits or {"is_valid": C.MAX_ERROR_PERCENTAGE}
    rows, failed = F.col("total_rows"), F.col("failed_rows")
    return counts.select(
        "total_rows",
        "passed_rows",
        "failed_rows",
        F.coalesce(percent(failed, rows), F.lit(0).cast("decimal(9,2)")).alias("failure_rate_pct"),
        *[within_limit(failed, rows, limit).alias(name) for name, limit in limits.items()],
    )


def store_failure_rate(flagged: DataFrame, limit: float = C.MAX_ERROR_PERCENTAGE) -> DataFrame:
    """The same report per store."""
    rows, failed = F.col("total_rows"), F.col("failed_rows")
    return (
        flagged.groupBy("store_id")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("failed").alias("failed_rows"))
        .select(
            "store_id",
            "total_rows",
            "failed_rows",
            percent(failed, rows).alias("failure_rate_pct"),
            within_limit(failed, rows, limit).alias("is_valid"),
        )
    )


def schema_check(feed: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row with the outcome of the required-column check."""
    missing = missing_columns(feed, required)
    return feed.agg(F.count(F.lit(1)).alias("records_checked")).select(
        F.lit("SchemaValidator").alias("validator_name"),
        F.lit("FAILED" if missing else "PASSED").alias("status"),
        F.lit("CRITICAL" if missing else "INFO").alias("severity"),
        "records_checked",
        F.lit(len(missing)).cast("bigint").alias("records_failed"),
        F.lit(",".join(missing)).alias("missing_columns"),
    )
