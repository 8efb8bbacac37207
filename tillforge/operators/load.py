"""Writing and reading the fact table, load figures, reconciliation."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.text import clean_text
from tillforge.session import COMPACT, shuffles_dropped, write_through

MONTH = "tx_month"
#: Identity of a business line, from its natural keys.
LINE = "line_key"


def month_of(time: Column) -> Column:
    """``yyyy-MM``; year and month as numbers keep it cheap."""
    return F.concat_ws(
        "-",
        F.lpad(F.year(time).cast("string"), 4, "0"),
        F.lpad(F.month(time).cast("string"), 2, "0"),
    )


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, month_of(F.col("transaction_time")))


def line_key() -> Column:
    """The identity of a feed line: transaction and product as they are cleaned for the
    fact, so that spellings of one key are one line; a missing key equals a missing key."""
    parts = [F.coalesce(F.upper(clean_text(F.col(c))), F.lit("\x00")) for c in C.DUPLICATE_KEY]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def append_facts(fact: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Append to the month-partitioned fact table.

    Rows are gathered by month before writing, otherwise every task would leave a file
    in every month. ``rebalance`` also splits months that are too large for one task.
    Inside a file rows are sorted by store, so that store filters skip row groups.
    """
    (
        with_month(fact.select(*C.FACT_COLUMNS))
        .hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, "store_sk")
        .write.mode("append")
        .partitionBy(MONTH)
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


FACT_SCHEMA = (
    "transaction_id string, date_sk int, customer_sk bigint, product_sk bigint, store_sk bigint, "
    "employee_sk bigint, transaction_time timestamp_ntz, quantity int, unit_price decimal(10,2), "
    "discount_amount decimal(10,2), net_sales_amount decimal(12,2), audit_run_id bigint, tx_month string"
)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path)


def facts_between(fact: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Facts of the days ``first_day`` to ``last_day``; also names the months, which prunes."""
    time = F.col("transaction_time")
    start = F.lit(first_day).cast("timestamp_ntz")
    end = F.lit(last_day).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return fact.filter(
        F.col(MONTH).between(first_day[:7], last_day[:7]) & (time >= start) & (time < end)
    )


def partition_label(declared_months: list[str]) -> Column:
    """Month partition of a row, ``default`` outside the declared months."""
    return F.when(F.col(MONTH).isin(declared_months), F.col(MONTH)).otherwise("default")


def partition_counts(fact: DataFrame, declared_months: list[str]) -> DataFrame:
    return (
        with_month(fact)
        .groupBy(partition_label(declared_months).alias("partition_name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def batch_stats(fact: DataFrame, batch_size: int = C.BATCH_SIZE) -> DataFrame:
    """Rows, batches and size of the last batch per month partition."""
    rows = F.col("rows")
    batches = F.ceil(rows / batch_size).cast("bigint")
    return (
        with_month(fact)
        .groupBy(MONTH)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            MONTH,
            "rows",
            batches.alias("batches"),
            (rows - (batches - 1) * batch_size).alias("last_batch_rows"),
        )
    )


SOURCE = "file_name"
KEYED_SCHEMA = f"{FACT_SCHEMA}, {LINE} binary, {SOURCE} string"
KEYED_COLUMNS = [*C.FACT_COLUMNS, LINE, SOURCE]
COMMIT_SCHEMA = "tx_month string, load int"
GONE = ["REPLACED", "REMOVED"]
WRITTEN = ["ADDED", "REPLACED"]


def line_changes(fact: DataFrame, stored: DataFrame, corrected: DataFrame | None = None) -> DataFrame:
    """What a load changes: ``fact`` rows with ``change`` ADDED, REPLACED or UNCHANGED, stored
    rows with REMOVED, and ``old_months``, the months in which the table holds other versions
    of the line.

    Both sides carry LINE and SOURCE; ``stored`` is limited by the caller to the months that
    can hold the lines. ``corrected`` lists the SOURCE files that are delivered whole again:
    their stored lines that no file delivers are removed.

    Both sides are dealt by line together, once, and all versions of a line are looked at
    where they meet. A line has one version in the table, or a few where a load broke off.
    """
    sent = fact.filter(F.col(LINE).isNotNull())
    columns = [LINE, *(c for c in fact.columns if c != LINE)]
    if _no_rows(stored):
        return sent.select(*columns, F.array().cast("array<string>").alias("old_months"), F.lit("ADDED").alias("change"))
    held = stored
    if corrected is not None:
        # Written, so that a short list of files is broadcast.
        files = write_through(corrected.select(SOURCE).distinct(), "corrected")
        held = stored.join(files.withColumn("_left_out", F.lit(True)), SOURCE, "left")
    met = sent.withColumn("_is_sent", F.lit(True)).unionByName(
        held.filter(F.col(LINE).isNotNull()).withColumn("_is_sent", F.lit(False)), allowMissingColumns=True
    )
    of_line, is_sent = Window.partitionBy(LINE), F.col("_is_sent")
    values = F.struct(*(c for c in C.FACT_COLUMNS if c != "audit_run_id"), SOURCE)
    met = met.withColumns(
        {
            "_sent": F.count_if(is_sent).over(of_line),
            "_held": F.count_if(~is_sent).over(of_line),
            "_least": F.min(F.when(is_sent, values)).over(of_line),
            "_most": F.max(F.when(is_sent, values)).over(of_line),
        }
    )
    same = values.eqNullSafe(F.col("_least")) & values.eqNullSafe(F.col("_most"))
    other = ~is_sent & (F.col("_sent") > 0) & ~same
    met = met.withColumn("old_months", F.collect_set(F.when(other, F.col(MONTH))).over(of_line))
    # One IF in the other: whoever asks for new lines alone pays for no value of theirs.
    change = F.expr("if(_held = 0, 'ADDED', if(_sent = 1 and _held = 1 and size(old_months) = 0, 'UNCHANGED', 'REPLACED'))")
    changes = met.filter(is_sent).select(*columns, "old_months", change.alias("change"))
    if corrected is None:
        return changes
    removed = (F.array(MONTH).alias("old_months"), F.lit("REMOVED").alias("change"))
    left_out = F.coalesce("_left_out", F.lit(False))
    kinds = met.filter(is_sent | (left_out & (F.col("_sent") == 0))).select(
        *columns,
        F.when(is_sent, F.col("old_months")).otherwise(F.array(MONTH)).alias("old_months"),
        F.when(is_sent, change).otherwise("REMOVED").alias("change"),
    )
    # A stored line without a key equals none; it is not dealt with all others of its kind.
    nameless = held.filter(F.col(LINE).isNull() & left_out).select(*stored.columns, *removed)
    return kinds.unionByName(nameless, allowMissingColumns=True)


def _no_rows(df: DataFrame) -> bool:
    """Whether the planner knows that there are no rows; nothing is run."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


def current(spark: SparkSession, path: str) -> tuple[int, list[tuple[str, int]]]:
    """Number of the last commit of a versioned table, and the (month, load) folders it
    consists of; 0 and none before the first."""
    try:
        commits = spark.read.schema(f"{COMMIT_SCHEMA}, commit int").parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    last = commits.agg(F.max("commit")).first()[0] or 0
    rows = commits.filter(F.col("commit") == last).filter("tx_month is not null").collect()
    return last, sorted((r.tx_month, r.load) for r in rows)


def read_table(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The committed rows of a versioned table, of some ``months`` or all; only the folders
    of these months are opened."""
    held = [(m, n) for m, n in current(spark, path)[1] if months is None or m in months]
    if not held:
        # The filter tells the planner that there are no rows; joins with them fall away.
        return spark.createDataFrame([], KEYED_SCHEMA).filter(F.lit(False))
    folders = [f"{path}/data/load={n}/{MONTH}={m}" for m, n in held]
    rows = spark.read.schema(f"{KEYED_SCHEMA}, load int").option("basePath", f"{path}/data").parquet(*folders)
    return rows.drop("load")


def commit_changes(spark: SparkSession, changes: DataFrame, path: str) -> dict[str, int]:
    """Bring a versioned table to the state of ``changes``, a stored result of
    :func:`line_changes`; returns the rows ``written`` and the old rows ``kept`` beside them.

    Nothing is written over. New rows go to a folder of their own; months that hold rows to
    be replaced or removed are written anew there without them. One small file then names
    the folders each month consists of, and only with it the load is there. A load that
    breaks off before leaves a folder nobody reads, which the next load writes over.
    """
    gone = changes.filter(F.col("change").isin(GONE))
    months = [r[0] for r in gone.select(F.explode("old_months")).distinct().collect()]  # calendar months: few
    last, held = current(spark, path)
    new = changes.filter(F.col("change").isin(WRITTEN)).select(*KEYED_COLUMNS, F.lit(True).alias("_new"))
    rows = new
    if months:
        stay = read_table(spark, path, months).join(gone.select(LINE).distinct(), LINE, "left_anti")
        rows = new.unionByName(stay.select(*KEYED_COLUMNS, F.lit(False).alias("_new")))
    seen = Observation(f"load {last + 1}")
    target = f"{path}/data/load={last + 1}"
    with shuffles_dropped(spark):
        (
            with_month(rows)
            .hint("rebalance", MONTH)
            .sortWithinPartitions(MONTH, "store_sk")
            .observe(seen, F.count_if("_new").alias("written"), F.count_if(~F.col("_new")).alias("kept"))
            .drop("_new")
            .write.mode("overwrite").options(**COMPACT).partitionBy(MONTH).parquet(target)
        )
    files = spark.read.schema(KEYED_SCHEMA).parquet(target).inputFiles()
    there = {unquote(f).split(f"/{MONTH}=")[1].split("/")[0] for f in files}
    pointers = [(m, n) for m, n in held if m not in months] + [(m, last + 1) for m in sorted(there)]
    # The row without a month marks a commit of an empty table.
    spark.createDataFrame([*pointers, (None, last + 1)], COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/commits/commit={last + 1}"
    )
    return dict(seen.get)


def reconciliation(flagged: DataFrame, fact: DataFrame, loaded: DataFrame, run_id: str) -> DataFrame:
    """Row counts of all stages side by side: nothing lost, nothing invented."""
    from tillforge.sources.retail import union_all

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        return df.agg(*[counts.get(n, zero).alias(n) for n in BALANCE])

    every = F.count(F.lit(1))
    stages = union_all(
        [
            counted(
                flagged,
                source_rows=every,
                validated_rows=F.count_if(~F.col("failed")),
                rejected_rows=F.count_if("failed"),
                duplicate_rows=F.count_if(C.DUPLICATE),
            ),
            counted(fact, transformed_rows=every),
            counted(loaded, loaded_rows=every),
        ]
    )
    return balance_of(stages.agg(*[F.sum(c).alias(c) for c in stages.columns]), run_id)


BALANCE = ["source_rows", "validated_rows", "transformed_rows", "loaded_rows", "rejected_rows", "duplicate_rows"]


def balance_of(counts: DataFrame, run_id: str) -> DataFrame:
    """The same from one row of the ``BALANCE`` counts."""
    balanced = (F.col("source_rows") == F.col("validated_rows") + F.col("rejected_rows")) & (
        F.col("validated_rows") == F.col("loaded_rows")
    )
    return counts.select(F.lit(run_id).alias("run_id"), *BALANCE, balanced.alias("is_reconciled"))


def load_report(
    deltas: list[DataFrame], flagged: DataFrame, fact: DataFrame, run_id: str, batch_size: int = C.BATCH_SIZE
) -> DataFrame:
    """Dimension changes, facts loaded and rejected, and batches, in one row."""
    from tillforge.sources.retail import union_all

    names = ["dimensions_inserted", "dimensions_updated", "dimensions_unchanged", "facts_loaded", "facts_rejected"]

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        return df.agg(*[counts.get(n, F.lit(0).cast("bigint")).alias(n) for n in names])

    def changes(kind: str) -> Column:
        return F.count_if(F.col("change") == kind)

    parts = [
        counted(
            delta.select("change"),
            dimensions_inserted=changes("INSERT"),
            dimensions_updated=changes("UPDATE"),
            dimensions_unchanged=changes("UNCHANGED"),
        )
        for delta in deltas
    ]
    parts.append(counted(flagged, facts_rejected=F.count_if("failed")))
    parts.append(counted(fact, facts_loaded=F.count(F.lit(1))))
    total = union_all(parts).agg(*[F.sum(n).alias(n) for n in names])
    return total.select(
        F.lit(run_id).alias("run_id"),
        "*",
        F.ceil(F.col("facts_loaded") / batch_size).cast("bigint").alias("batches_processed"),
    )


def transformation_report(received: DataFrame, resolved: DataFrame, run_id: str) -> DataFrame:
    """Rows in, rows out, rows skipped and failed lookups of the transformation."""
    failures = sum(
        [F.count_if(F.col(f"{e}_sk") == C.UNKNOWN_KEY) for e in ("product", "employee")],
        F.count_if(F.col("store_sk") == C.UNKNOWN_KEY),
    ) + F.count_if(F.col("date_sk") == C.UNKNOWN_DATE_KEY)
    zero = F.lit(0).cast("bigint")
    before = received.agg(F.count(F.lit(1)).alias("rows_received"), zero.alias("rows_transformed"), zero.alias("lookup_failures"))
    after = resolved.agg(zero.alias("rows_received"), F.count(F.lit(1)).alias("rows_transformed"), failures.alias("lookup_failures"))
    total = before.unionByName(after).agg(
        *[F.sum(c).alias(c) for c in ("rows_received", "rows_transformed", "lookup_failures")]
    )
    return total.select(
        F.lit(run_id).alias("run_id"),
        "rows_received",
        "rows_transformed",
        (F.col("rows_received") - F.col("rows_transformed")).alias("rows_skipped"),
        F.col("rows_transformed").alias("facts_generated"),
        "lookup_failures",
    )
