"""Every query by name: ``name -> (spark, table folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.text import parse_timestamp
from tillforge.operators import aggregates, audit, constraints, incremental, keys, load, rules, scd, transform, validate
from tillforge.operators.scorecard import scorecard
from tillforge.plans import reports
from tillforge.session import COMPACT, delete, scratch, shuffles_dropped, work_dir, write_through
from tillforge.sources import feed_files, retail
from tillforge.sources.retail import AS_OF, FEED_ORDER, TRACKED, union_all
from tillforge.sources.tables import table
from tillforge.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_ID = "run-0001"
AUDIT_RUN_ID = 1
BUSINESS_DATE = "20010801"
# Months that have a partition of their own; all others are in the default one.
DECLARED_MONTHS = ["1998-07", "1998-08"]
REPORT_DAY = "1998-07-16"
STORED_UNTIL = "2000-01-01 00:00:00"
LOST_MONTH = "1998-07"
# Layouts of feed files in one folder.
HEADERS = 7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- stages of the sales feed ---------------------------------------------------


def feed(spark: SparkSession, base: str) -> DataFrame:
    return retail.sales_feed(spark, base)


def stored_feed(spark: SparkSession, base: str) -> DataFrame:
    """The feed written once, for work that passes over it several times: its joins run once."""
    return write_through(feed(spark, base), "feed")


def flagged(spark: SparkSession, base: str) -> DataFrame:
    return validate.flag_feed(stored_feed(spark, base), FEED_ORDER, AS_OF)


def judged(spark: SparkSession, base: str) -> DataFrame:
    """The flagged feed as a stored table, for queries that read it more than once."""
    return write_through(flagged(spark, base), "judged")


def passed(spark: SparkSession, base: str) -> DataFrame:
    return validate.passed_rows(flagged(spark, base))


def normalized(spark: SparkSession, base: str, rows: DataFrame | None = None) -> DataFrame:
    rows = passed(spark, base) if rows is None else rows
    return transform.normalize(transform.clean(rows))


def enriched(spark: SparkSession, base: str, rows: DataFrame | None = None) -> DataFrame:
    return transform.enrich(normalized(spark, base, rows))


Dims = dict[str, DataFrame]


def dims(spark: SparkSession, base: str) -> Dims:
    """The dimensions as stored tables.

    Store and employee are derived by a join and a distinct, whose size the planner can
    only guess. Written out, all four have a known size: small ones are broadcast, large
    ones joined by key.
    """
    known = {entity: make(spark, base) for entity, make in retail.DIMENSIONS.items()}
    for entity in ("store", "employee"):
        known[entity] = write_through(known[entity], f"dim-{entity}")
    return known


def resolved(
    spark: SparkSession, base: str, known: Dims | None = None, rows: DataFrame | None = None
) -> DataFrame:
    return transform.enrich(keys.resolve_keys(normalized(spark, base, rows), known or dims(spark, base)))


def fact_of(rows: DataFrame, known: Dims, extra: list[str] | None = None) -> DataFrame:
    """Facts of normalised rows; through the joins go no columns that are made of others."""
    rows = transform.enrich(keys.resolve_keys(transform.timed(rows), known))
    return transform.fact_projection(rows, AUDIT_RUN_ID, extra)


def fact(
    spark: SparkSession, base: str, known: Dims | None = None, rows: DataFrame | None = None
) -> DataFrame:
    return fact_of(normalized(spark, base, rows), known or dims(spark, base))


def unchecked_fact(spark: SparkSession, base: str) -> DataFrame:
    """Facts of all rows, the bad ones too: what the constraint audits look at."""
    return fact_of(normalized(spark, base, feed(spark, base).select(*C.FEED_COLUMNS)), dims(spark, base))


# --- sources and sinks ------------------------------------------------------------


@query
def feed_scan(spark, base):
    path = work_dir(spark, "feed-csv")
    feed_files.write_feed_csv(feed(spark, base), path)
    return feed_files.scan_feed(spark, path).select(*C.FEED_COLUMNS)


@query
def file_fingerprint(spark, base):
    return retail.file_fingerprints(spark, base)


@query
def feed_scan_headers(spark, base):
    """The feed in folders whose files differ in the order of columns and in columns more."""
    path, rows = work_dir(spark, "feed-headers"), stored_feed(spark, base)
    for turn in range(HEADERS):
        _turned(rows.filter(F.col(FEED_ORDER[0]) % HEADERS == turn), turn).write.options(
            **feed_files.CSV_OPTIONS
        ).csv(f"{path}/turn={turn}")
    return feed_files.scan_feed(spark, path).select(*C.FEED_COLUMNS, feed_files.CORRUPT)


def _turned(rows, turn):
    """Feed columns from another first one on, with ``turn`` columns more."""
    columns = [*C.FEED_COLUMNS[turn:], *C.FEED_COLUMNS[:turn]]
    return rows.select(*columns, *(F.lit("a, b").alias(f"extra_{i}") for i in range(turn)))


@query
def changed_files(spark, base):
    """Feeds of two nights, one file a store; in the second every third store has one column
    other. Files whose digest was not there the night before are changed."""
    number = F.regexp_extract("store_id", r"([0-9]+)$", 1)
    other = F.when(number.cast("bigint") % 3 == 0, F.lit("EMP-CHANGED")).otherwise(F.col("employee_id"))

    def night(label, rows):
        path = work_dir(spark, label)
        name = F.concat(F.lit("store_"), number, F.lit(f"_sales_{BUSINESS_DATE}.csv"))
        # A store's lines are gathered by its number and named behind the shuffle; sorted, so
        # that equal feeds are equal files.
        named = rows.repartition(number).withColumn("feed", name).sortWithinPartitions("feed", *C.FEED_COLUMNS)
        with shuffles_dropped(spark):
            named.write.partitionBy("feed").options(**feed_files.CSV_OPTIONS, **feed_files.MANY_FILES).csv(path)
        found = write_through(feed_files.digests(spark, path), f"{label}-digests")
        # Of a night the digests are left, as in a registry.
        delete(spark, path)
        return found

    with scratch(spark) as copies:
        first = write_through(feed(spark, base).select(*C.FEED_COLUMNS), "feed")
        nights = night("night-1", first), night("night-2", first.withColumn("employee_id", other))
        copies[:] = copies[:1]
    before = nights[0].select("file_hash").distinct().withColumn("known", F.lit(True))
    after = nights[1]
    return after.join(before, "file_hash", "left").select(
        feed_files.feed_store(F.col("source_file")).alias("store"),
        (F.col("lines") - 1).alias("rows"),
        F.col("known").isNull().alias("changed"),
    )


def _store_files(spark, base):
    path = work_dir(spark, "store-files")
    feed_files.write_store_files(feed(spark, base), path, BUSINESS_DATE)
    return path


@query
def feed_files_by_store(spark, base):
    path = _store_files(spark, base)
    found = feed_files.files_by_store(spark, path).select("store", "business_date")
    rows = (
        feed_files.scan_feed(spark, path)
        .groupBy(feed_files.feed_store(F.col("source_file")).alias("store"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return found.join(rows, "store")


@query
def feed_file_checks(spark, base):
    path = _store_files(spark, base)
    stores = retail.dim_store(spark, base).select(F.regexp_extract("store_id", "([0-9]+)$", 1).alias("store"))
    # Stores numbered from 900000 on have not delivered.
    late = retail.dim_store(spark, base).select((F.col("store_sk") + 900000).cast("string").alias("store"))
    return feed_files.check_files(stores.unionByName(late), feed_files.files_by_store(spark, path))


@query
def quarantine_rows(spark, base):
    path = work_dir(spark, "quarantine")
    checks = validate.default_rules(AS_OF)
    source = F.concat(F.lit("store_"), F.col("store_id"), F.lit(f"_sales_{BUSINESS_DATE}.csv"))
    validate.write_quarantine(flagged(spark, base), checks, path, RUN_ID, source, AS_OF)
    return (
        validate.read_quarantine(spark, path)
        .filter(F.col("run_id") == RUN_ID)
        .select(
            "run_id",
            "source_file",
            *[F.col(f"raw_record.{c}").alias(c) for c in C.FEED_COLUMNS],
            F.array_join("error_codes", ",").alias("error_codes"),
            F.array_join("error_messages", "; ").alias("error_messages"),
        )
    )


def _stored_fact(spark, base, facts=None):
    path = work_dir(spark, "fact-sales")
    load.append_facts(fact(spark, base) if facts is None else facts, path)
    return load.read_facts(spark, path)


@query
def fact_load(spark, base):
    return _stored_fact(spark, base)


@query
def load_batch_stats(spark, base):
    return load.batch_stats(fact(spark, base))


@query
def fact_partition_counts(spark, base):
    return load.partition_counts(fact(spark, base), DECLARED_MONTHS)


@query
def fact_pruned_month(spark, base):
    days = load.facts_between(_stored_fact(spark, base), "1998-07-01", "1998-07-31")
    return days.groupBy("date_sk").agg(
        F.count(F.lit(1)).alias("rows"), reports.total(F.col("net_sales_amount")).alias("net")
    )


@query
def seed_dim_insert_only(spark, base):
    def seeded(entity):
        nk = f"{entity}_id"
        old = retail.existing_dimension(spark, base, entity)
        new = scd.insert_if_absent(retail.incoming_master(spark, base, entity), old, nk)
        both = old.select(nk, F.lit("existing").alias("origin")).unionByName(
            new.select(nk, F.lit("seeded").alias("origin"))
        )
        return both.select(F.lit(entity).alias("entity"), F.col(nk).alias("natural_key"), "origin")

    return union_all([seeded(entity) for entity in TRACKED])


@query
def run_manifest(spark, base):
    return incremental.run_manifest(_classified(spark, base), RUN_ID)


@query
def last_successful_stage(spark, base):
    return audit.last_stage(retail.audit_events(spark, base))


@query
def synthetic_feed_profile(spark, base):
    numbers = table(spark, base, "orders").select((F.col("o_orderkey") + 1).alias("i"))
    made = feed_files.synthetic_feed(numbers, AS_OF)
    return validate.flag_feed(made, ["copy"], AS_OF).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("transaction_id").alias("transactions"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_if(C.NEGATIVE_QUANTITY).alias("bad_quantity"),
        F.count_if(C.NEGATIVE_PRICE).alias("bad_price"),
        F.count_if(C.FUTURE_TIME).alias("future_time"),
        F.count_if(C.DUPLICATE).alias("duplicates"),
        F.count_if("failed").alias("failed"),
        F.sum(transform.to_money(F.col("unit_price"))).cast("decimal(28,2)").alias("price_total"),
        F.sum(transform.to_money(F.col("discount_amount"))).cast("decimal(28,2)").alias("discount_total"),
        F.sum(transform.to_quantity(F.col("quantity"))).cast("bigint").alias("quantity_total"),
    )


# --- rules and contracts ------------------------------------------------------------


@query
def schema_check(spark, base):
    whole = feed(spark, base)
    lacking = whole.drop("employee_id", "unit_price")
    return union_all(
        [
            validate.schema_check(df).select(F.lit(name).alias("feed"), "*")
            for name, df in {"whole": whole, "lacking": lacking}.items()
        ]
    )


@query
def rule_hits(spark, base):
    data_rules = rules.feed_rules(AS_OF)
    return validate.rule_hits(validate.flag_feed(feed(spark, base), FEED_ORDER, AS_OF, data_rules), data_rules)


@query
def range_rule_hits(spark, base):
    """Quantities and prices of some lines are blown up by zeros, to and beyond the bounds."""
    last = F.substring("transaction_id", -1, 1)
    large = feed(spark, base).withColumns(
        {
            "quantity": F.when(last == "3", F.concat("quantity", F.lit("00000000"))).when(last == "5", F.concat("quantity", F.lit("000000"))).otherwise(F.col("quantity")),
            "unit_price": F.when(last == "7", F.concat(F.lit("9000"), F.col("unit_price"))).otherwise(F.col("unit_price")),
        }
    )
    limits = rules.range_rules()
    return validate.rule_hits(validate.flag_feed(large, FEED_ORDER, AS_OF, limits), limits)


@query
def contract_violations_sale(spark, base):
    return rules.contract_violations(feed(spark, base), "sale")


@query
def contract_violations_customer(spark, base):
    return rules.contract_violations(retail.dim_customer(spark, base), "customer")


@query
def contract_violations_product(spark, base):
    return rules.contract_violations(retail.dim_product(spark, base), "product")


@query
def contract_violations_store(spark, base):
    return rules.contract_violations(retail.dim_store(spark, base), "store")


@query
def contract_violations_employee(spark, base):
    return rules.contract_violations(retail.dim_employee(spark, base), "employee")


@query
def email_rule(spark, base):
    customers = retail.dim_customer(spark, base)
    return customers.filter(rules.invalid_email(F.col("email"))).select(
        "customer_id", "email", F.lit(C.INVALID_EMAIL).alias("error_code")
    )


@query
def store_id_rule(spark, base):
    columns = ["store_id", "employee_id"]
    return rules.count_violations(
        feed(spark, base), {c: rules.invalid_store_id(F.col(c)) for c in columns}
    )


@query
def null_key_rule(spark, base):
    columns = ["transaction_id", "store_id", "product_id", "employee_id", "customer_id"]
    return rules.count_violations(feed(spark, base), {c: rules.null_key(F.col(c)) for c in columns}).withColumn(
        "error_code", F.lit(C.NULL_KEY)
    )


@query
def fk_orphans(spark, base):
    # Four looks at the same rows: store the four columns once.
    rows = write_through(
        enriched(spark, base).select("store_id", "product_id", "employee_id", "customer_id"), "natural-keys"
    )
    known = dims(spark, base)
    known["customer"] = retail.existing_dimension(spark, base, "customer")
    return union_all(
        [
            keys.unknown_keys(rows, known[e], e).select(
                F.lit(e).alias("dimension"), F.col(f"{e}_id").alias("natural_key"), "rows"
            )
            for e in keys.LOOKUPS
        ]
    )


@query
def check_constraint_audit(spark, base):
    return constraints.check_audit(
        {
            "dim_date": retail.dim_date(spark, base),
            "dim_product": retail.dim_product(spark, base),
            "fact_sales": unchecked_fact(spark, base),
            "etl_audit_log": audit.run_log(retail.audit_events(spark, base)),
            "file_registry": retail.file_registry(spark, base),
        }
    )


@query
def unique_constraint_audit(spark, base):
    marks = incremental.store_watermark(
        passed(spark, base), parse_timestamp(F.col("transaction_time"))
    )
    tables = {f"dim_{e}": (d, [f"{e}_id"]) for e, d in dims(spark, base).items()}
    tables["dim_date"] = (retail.dim_date(spark, base), ["calendar_date"])
    tables["etl_watermark"] = (marks, ["entity_name", "store_id"])
    tables["file_registry"] = (retail.file_registry(spark, base), ["file_hash"])
    return constraints.unique_audit(tables)


@query
def not_null_audit(spark, base):
    customer = ["customer_sk", "customer_id", "first_name", "last_name", "phone"]
    return constraints.not_null_audit(
        {
            "fact_sales": (unchecked_fact(spark, base), constraints.NOT_NULL_FACT),
            "dim_customer": (retail.dim_customer(spark, base), customer),
        }
    )


# --- routing and reports on quality ---------------------------------------------------


@query
def duplicate_rows(spark, base):
    return flagged(spark, base).filter(C.DUPLICATE).select(*C.FEED_COLUMNS, *FEED_ORDER)


@query
def duplicates_after_cleaning(spark, base):
    """Lines that become equal only once trimmed and upper-cased."""
    lines = feed(spark, base).select(
        *[F.upper(transform.clean_text(F.col(c))).alias(c) for c in C.DUPLICATE_KEY]
    )
    repeated = lines.groupBy(*C.DUPLICATE_KEY).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("repeated_lines"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


@query
def rows_with_errors(spark, base):
    checks = validate.default_rules(AS_OF)
    return (
        flagged(spark, base)
        .filter("failed")
        .groupBy(validate.error_codes(checks).alias("error_codes"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def clean_rows(spark, base):
    return passed(spark, base)


@query
def failure_reasons(spark, base):
    return validate.failure_reasons(flagged(spark, base), validate.default_rules(AS_OF))


@query
def validator_results(spark, base):
    return validate.validator_results(flagged(spark, base), validate.default_rules(AS_OF))


@query
def validation_report(spark, base):
    limits = {"is_valid": C.MAX_ERROR_PERCENTAGE, "is_valid_production": 2, "is_valid_testing": 0}
    return validate.validation_report(flagged(spark, base), limits)


@query
def store_failure_rate(spark, base):
    return validate.store_failure_rate(flagged(spark, base))


@query
def scorecard_report(spark, base):
    return scorecard(flagged(spark, base))


QUERIES["scorecard"] = QUERIES.pop("scorecard_report")


# --- projections --------------------------------------------------------------------


@query
def clean_feed(spark, base):
    return transform.clean(feed(spark, base).select(*C.FEED_COLUMNS))


@query
def clean_documents(spark, base):
    return transform.clean_documents(table(spark, base, "documents"))


@query
def normalize_customers(spark, base):
    customers = retail.dim_customer(spark, base).select("customer_id", "first_name", "last_name", "email", "phone")
    return transform.normalize(transform.clean(customers)).drop("discount_amount")


@query
def normalize_feed(spark, base):
    return transform.normalize(transform.clean(feed(spark, base).select(*C.FEED_COLUMNS)))


@query
def enrich_feed(spark, base):
    return enriched(spark, base)


@query
def fact_sales(spark, base):
    return fact(spark, base)


@query
def redact_documents(spark, base):
    return transform.redact_documents(table(spark, base, "documents"))


@query
def redaction_counts(spark, base):
    names = ["documents", "conversations"]
    return transform.redaction_counts({n: table(spark, base, n).select("text") for n in names})


@query
def audit_events_json(spark, base):
    context = {"batch_id": "BATCH-1", "source_filename": "events", "environment": "testing"}
    return audit.events_json(retail.audit_events(spark, base), context)


# --- keys and dimensions --------------------------------------------------------------


@query
def resolve_keys(spark, base):
    return resolved(spark, base).select(
        "transaction_id", "product_id", "transaction_time", *[f"{e}_sk" for e in keys.LOOKUPS], "date_sk"
    )


@query
def lookup_failures(spark, base):
    return keys.lookup_failures(resolved(spark, base))


@query
def unknown_use_key(spark, base):
    return (
        resolved(spark, base)
        .filter(F.col("store_sk") == C.UNKNOWN_KEY)
        .groupBy("store_id", "store_sk")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def unknown_auto_create(spark, base):
    known = retail.existing_dimension(spark, base, "store")
    created = keys.auto_create(enriched(spark, base), known, "store")
    return created.select("store_id", "store_sk")


@query
def unknown_reject_row(spark, base):
    _, bad = keys.reject_unknown(resolved(spark, base))
    return bad.select("transaction_id", "product_id", "store_id", "unknown_members", "error_codes")


def _delta(spark, base, entity):
    return scd.scd1_delta(
        retail.incoming_master(spark, base, entity),
        retail.existing_dimension(spark, base, entity),
        f"{entity}_id",
        TRACKED[entity],
    )


def _apply(spark, base, entity):
    return scd.scd1_apply(
        retail.incoming_master(spark, base, entity),
        retail.existing_dimension(spark, base, entity),
        f"{entity}_id",
        f"{entity}_sk",
        TRACKED[entity],
        AS_OF,
    )


@query
def scd1_delta_store(spark, base):
    return _delta(spark, base, "store")


@query
def scd1_delta_product(spark, base):
    return _delta(spark, base, "product")


@query
def scd1_metrics(spark, base):
    return union_all(
        [
            scd.scd1_metrics(_delta(spark, base, e)).select(F.lit(e).alias("dimension"), "*")
            for e in ("store", "product")
        ]
    )


@query
def scd1_apply_store(spark, base):
    return _apply(spark, base, "store")


@query
def scd1_apply_product(spark, base):
    return _apply(spark, base, "product")


@query
def scd1_apply_customer(spark, base):
    return _apply(spark, base, "customer")


@query
def scd1_apply_employee(spark, base):
    return _apply(spark, base, "employee")


@query
def dim_rows_in_use(spark, base):
    known = dims(spark, base)
    facts = write_through(
        fact(spark, base, known).select(*[f"{e}_sk" for e in known]), "fact-keys"
    )
    return union_all(
        [
            constraints.members_in_use(facts, dim.select(f"{e}_sk", f"{e}_id"), f"{e}_sk").select(
                F.lit(e).alias("dimension"), F.col(f"{e}_id").alias("natural_key")
            )
            for e, dim in known.items()
        ]
    )


@query
def dim_feed_dedupe(spark, base):
    return scd.latest_per_key(retail.versioned_master(spark, base, "product"), "product_id", ["version"])


@query
def assign_surrogate_keys(spark, base):
    known = retail.existing_dimension(spark, base, "customer")
    new = scd.insert_if_absent(retail.incoming_master(spark, base, "customer"), known, "customer_id")
    keyed = keys.assign_keys(new, "customer_id", "customer_sk", keys.highest_key(known, "customer_sk"))
    return keyed.select("customer_sk", "customer_id")


@query
def dim_date(spark, base):
    return retail.dim_date(spark, base)


# --- load and run figures --------------------------------------------------------------


@query
def reconciliation(spark, base):
    stored = judged(spark, base)
    facts = fact(spark, base, rows=validate.passed_rows(stored))
    return load.reconciliation(stored, facts, _stored_fact(spark, base, facts), RUN_ID)


@query
def load_report(spark, base):
    deltas = [_delta(spark, base, e) for e in ("store", "product")]
    stored = judged(spark, base)
    return load.load_report(deltas, stored, fact(spark, base, rows=validate.passed_rows(stored)), RUN_ID)


@query
def transformation_report(spark, base):
    rows = validate.passed_rows(judged(spark, base))
    return load.transformation_report(rows, resolved(spark, base, rows=rows), RUN_ID)


@query
def stage_durations(spark, base):
    names = ["click", "error", "purchase", "signup", "view"]
    return audit.stage_durations(retail.audit_events(spark, base), names)


@query
def execution_summary(spark, base):
    return audit.execution_summary(retail.audit_events(spark, base))


@query
def execution_timeline(spark, base):
    return audit.execution_timeline(retail.audit_events(spark, base))


@query
def latest_watermark(spark, base):
    return incremental.latest_watermark(retail.file_registry(spark, base))


@query
def store_watermark(spark, base):
    # Few columns are asked for: the feed is judged as it is read, without a copy of all.
    rows = validate.passed_rows(validate.flag_feed(feed(spark, base), FEED_ORDER, AS_OF))
    return incremental.store_watermark(rows, parse_timestamp(F.col("transaction_time")))


# --- sales reports -----------------------------------------------------------------------

_loaded: dict[tuple[str, str], tuple[str, str, Dims]] = {}


def gold(spark: SparkSession, base: str) -> tuple[str, str, Dims]:
    """Paths of the loaded fact table and of its aggregates, and the dimensions. The feed is
    loaded once per Spark application; reports read what the load left behind."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _loaded:
        known = dims(spark, base)
        path = work_dir(spark, "gold")
        lines = load.with_month(fact(spark, base, known)).withColumns(
            {
                load.LINE: F.lit(None).cast("binary"),
                load.SOURCE: F.lit(None).cast("string"),
                "change": F.lit("ADDED"),
                "old_months": F.array().cast("array<string>"),
            }
        )
        load.commit_changes(spark, lines, f"{path}/fact_sales")
        aggregates.refresh(spark, f"{path}/fact_sales", f"{path}/aggregates")
        _loaded[key] = (f"{path}/fact_sales", f"{path}/aggregates", known)
    return _loaded[key]


def _sums(spark, base, key):
    _, path, known = gold(spark, base)
    return aggregates.sums(spark, path, key), known


@query
def report_region_store(spark, base):
    _, path, known = gold(spark, base)
    return aggregates.region_store(spark, path, known["store"])


@query
def report_top5_products(spark, base):
    sums, known = _sums(spark, base, "product_sk")
    return reports.top_categories_products(sums, known["product"], 5)


@query
def report_audit_by_status(spark, base):
    return reports.audit_by_status(audit.run_log(retail.audit_events(spark, base)))


@query
def report_daily_store(spark, base):
    """The day before ``REPORT_DAY``; only the folders of its month are opened."""
    facts, _, known = gold(spark, base)
    month = (date.fromisoformat(REPORT_DAY) - timedelta(days=1)).isoformat()[:7]
    rows = load.read_table(spark, facts, [month])
    return reports.daily_store(rows, retail.dim_date(spark, base), known["store"], REPORT_DAY)


@query
def report_top10_products(spark, base):
    sums, known = _sums(spark, base, "product_sk")
    return reports.top_products(sums, known["product"], 10)


@query
def report_monthly(spark, base):
    return aggregates.monthly(spark, gold(spark, base)[1], retail.dim_date(spark, base))


@query
def report_monthly_growth(spark, base):
    return reports.monthly_growth(aggregates.monthly(spark, gold(spark, base)[1], retail.dim_date(spark, base)))


@query
def report_monthly_refreshed(spark, base):
    """The lines of 1997 are delivered again, a third of them 31 days later; only the months
    that this load touches are aggregated again."""
    path = work_dir(spark, "refreshed")
    facts, partial = f"{path}/fact_sales", f"{path}/aggregates"
    _loaded_lines(spark, base, facts)
    aggregates.refresh(spark, facts, partial)
    stored = load.read_table(spark, facts)
    later = F.col("transaction_time") + F.expr("INTERVAL 31 DAY")
    time = F.when(F.dayofmonth("transaction_time") % 3 == 1, later).otherwise(F.col("transaction_time"))
    sent = stored.filter(F.year("transaction_time") == 1997).withColumn("transaction_time", time)
    sent = load.with_month(sent.withColumn("date_sk", keys.date_key(F.col("transaction_time"))))
    aggregates.refresh(spark, facts, partial, _load_changes(spark, sent, stored, facts))
    return aggregates.monthly(spark, partial, retail.dim_date(spark, base))


@query
def report_employee(spark, base):
    _, path, known = gold(spark, base)
    return aggregates.employee_sales(spark, path, known["employee"])


@query
def report_repeat_customers(spark, base):
    _, path, known = gold(spark, base)
    return aggregates.repeat_customers(spark, path, known["customer"])


@query
def report_weekend(spark, base):
    return aggregates.weekend(spark, gold(spark, base)[1], retail.dim_date(spark, base))


@query
def report_region(spark, base):
    sums, known = _sums(spark, base, "store_sk")
    return reports.region(sums, known["store"])


@query
def report_category(spark, base):
    sums, known = _sums(spark, base, "product_sk")
    return reports.category(sums, known["product"])


@query
def report_store_aov(spark, base):
    _, path, known = gold(spark, base)
    return aggregates.store_line_value(spark, path, known["store"])


@query
def report_top10_stores(spark, base):
    sums, known = _sums(spark, base, "store_sk")
    return reports.top_stores(sums, known["store"], 10)


# --- audit runs --------------------------------------------------------------------------


def _runs(spark, base):
    return audit.run_log(retail.audit_events(spark, base))


@query
def audit_recent_runs(spark, base):
    return audit.recent_runs(_runs(spark, base), 10)


@query
def audit_failed_runs(spark, base):
    return audit.failed_runs(_runs(spark, base))


@query
def audit_get_run(spark, base):
    return audit.get_run(_runs(spark, base), "RUN-7-20240110")


@query
def audit_event_counts(spark, base):
    return audit.event_counts(retail.audit_events(spark, base))


@query
def audit_alerts(spark, base):
    return audit.alerts(retail.audit_events(spark, base)).select("event_id", "run_id", "event_name", "severity", "event_time")


# --- incremental --------------------------------------------------------------------------


def _classified(spark, base):
    stale = F.lit("2026-01-01 02:00:00").cast("timestamp_ntz")
    return incremental.classify_files(
        retail.incoming_files(spark, base), retail.file_registry(spark, base), stale
    )


@query
def files_already_processed(spark, base):
    return incremental.files_already_processed(
        retail.incoming_files(spark, base), retail.file_registry(spark, base)
    ).select("doc_id", "file_name", "file_hash")


@query
def classify_files(spark, base):
    return _classified(spark, base).select("doc_id", "file_name", "file_hash", "classification")


def _strategy(name: str) -> Query:
    def run(spark, base):
        chosen = incremental.select_incremental(
            retail.incoming_files(spark, base), retail.file_registry(spark, base), name
        )
        return chosen.select("doc_id", "file_name", "file_hash", "batch_id", "file_time")

    return run


for _name in incremental.STRATEGIES:
    QUERIES[f"incr_{_name.lower()}"] = _strategy(_name)


@query
def watermark_upsert(spark, base):
    loaded = _classified(spark, base).filter(F.col("classification").isin("NEW", "MODIFIED", "REPROCESS")).select(
        "file_name",
        "file_hash",
        F.lit("SUCCESS").alias("status"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("processed_at"),
        "batch_id",
        F.lit(RUN_ID).alias("run_id"),
    )
    return incremental.registry_state(retail.file_registry(spark, base).unionByName(loaded))


@query
def incremental_report(spark, base):
    return incremental.incremental_report(_classified(spark, base), retail.file_registry(spark, base), AS_OF)


@query
def rows_after_store_watermark(spark, base):
    time = parse_timestamp(F.col("transaction_time"))
    sales = transform.clean(passed(spark, base))
    stored = sales.filter(time < F.lit(STORED_UNTIL).cast("timestamp_ntz"))
    marks = incremental.store_watermark(stored, time)
    return incremental.rows_after_watermark(sales, time, marks).select(
        "transaction_id", "store_id", "product_id", "transaction_time"
    )


@query
def replay_selection(spark, base):
    chosen = incremental.replay_selection(
        retail.incoming_files(spark, base), retail.file_registry(spark, base), run_id="RUN-4"
    )
    return incremental.classify_files(chosen, retail.file_registry(spark, base)).select(
        "doc_id", "file_name", "file_hash", "classification"
    )


def _lines(spark, base):
    """Facts with their line keys. Lines are told apart by the keys as delivered, by which
    this feed's duplicates are found."""
    as_sent = F.concat_ws("|", *(F.coalesce(c, F.lit("\x00")) for c in C.DUPLICATE_KEY))
    rows = passed(spark, base).withColumn(load.LINE, F.unhex(F.md5(as_sent)))
    lines = fact_of(normalized(spark, base, rows), dims(spark, base), extra=[load.LINE])
    one_file = F.concat(F.lit("store_"), F.pmod("store_sk", F.lit(10)).cast("string"))
    return load.with_month(lines).withColumn(load.SOURCE, one_file)


def _loaded_lines(spark, base, path, sent=None):
    """The feed, or its lines as ``sent``, loaded into a table that is not there yet. Nothing
    is replaced, so the changes are read once and go to the table without a copy."""
    with scratch(spark):
        sent = _lines(spark, base) if sent is None else sent
        load.commit_changes(spark, load.line_changes(sent, load.read_table(spark, path)), path)


def _load_changes(spark, sent, stored, path, corrected=None):
    """Bring the table at ``path`` to ``sent``; the months in which a line came or went."""
    with scratch(spark):
        changes = load.line_changes(sent, stored, corrected).filter(F.col("change") != "UNCHANGED")
        changes = write_through(changes, "changes")
        load.commit_changes(spark, changes, path)
        months = changes.select(F.explode(F.concat("old_months", F.array(load.MONTH)))).distinct()
        return [r[0] for r in months.collect()]  # calendar months: few


@query
def idempotent_reload(spark, base):
    """What a second load of the same lines would add: nothing, or a month that was lost."""
    path = work_dir(spark, "reloaded")
    with scratch(spark) as copies:
        sent = write_through(_lines(spark, base), "sent")
        copies.pop()  # the lines themselves are read below
    _loaded_lines(spark, base, path, sent)
    stored = load.read_table(spark, path)
    states = {"complete": stored, "month_lost": stored.filter(F.col(load.MONTH) != LOST_MONTH)}
    return union_all(
        [
            load.line_changes(sent, held)
            .agg(F.count_if(F.col("change") == "ADDED").alias("rows_added"))
            .select(F.lit(name).alias("table_state"), "rows_added")
            for name, held in states.items()
        ]
    )


@query
def reload_corrected(spark, base):
    """The whole fact table is delivered again: a third of its lines with another quantity,
    a third in another month. Rows and quantity per month afterwards."""
    path = work_dir(spark, "corrected")
    _loaded_lines(spark, base, path)
    stored = load.read_table(spark, path)
    kind = F.pmod(F.dayofmonth("transaction_time"), F.lit(3))
    sent = stored.withColumns(
        {
            "quantity": F.when(kind == 0, F.col("quantity") + 1).otherwise(F.col("quantity")),
            "transaction_time": F.when(kind == 1, F.col("transaction_time") + F.expr("INTERVAL 31 DAY")).otherwise(F.col("transaction_time")),
            "audit_run_id": F.lit(AUDIT_RUN_ID + 1).cast("bigint"),
        }
    )
    _load_changes(spark, load.with_month(sent), stored, path)
    after = load.read_table(spark, path)
    return after.groupBy(load.MONTH, "audit_run_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("quantity"))


@query
def reload_with_lines_left_out(spark, base):
    """Half of the files are delivered again without the lines of odd days: these leave the
    table, all others stay. Rows and quantity per month afterwards."""
    path = work_dir(spark, "left-out")
    _loaded_lines(spark, base, path)
    stored = load.read_table(spark, path)
    sent = stored.filter(F.col("store_sk") % 2 == 0)
    fewer = sent.filter(F.dayofmonth("transaction_time") % 2 == 0)
    _load_changes(spark, fewer, stored, path, sent.select(load.SOURCE).distinct())
    after = load.read_table(spark, path)
    return after.groupBy(load.MONTH).agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("quantity"))


# --- streaming ----------------------------------------------------------------------------


def _landed_parquet(spark, base, arrivals=4):
    """The feed as files that arrive in feed order, in several lots; copies of a key fall
    into different lots. Returns the number of files in a lot as well."""
    path, files = work_dir(spark, "landed"), spark.sparkContext.defaultParallelism
    with scratch(spark), shuffles_dropped(spark):
        for lot in _lots(stored_feed(spark, base), arrivals):
            lot.repartition(files).write.mode("append").options(**COMPACT).parquet(path)
    return path, spark.read.parquet(path).schema, files


def _lots(rows, arrivals):
    by = F.col(FEED_ORDER[0])
    shares = [k / arrivals for k in range(1, arrivals)]
    # An empty lot would leave fewer files, and triggers would no longer end where lots do.
    cuts = sorted(set(rows.approxQuantile(FEED_ORDER[0], shares, 0.01))) if shares else []
    for low, high in zip([None, *cuts], [*cuts, None]):
        lot = rows if low is None else rows.filter(by > low)
        yield lot if high is None else lot.filter(by <= high)


@query
def stream_validate_feed(spark, base):
    path, schema, files = _landed_parquet(spark, base)
    out = work_dir(spark, "stream")
    ingest.validate_stream(
        ingest.feed_stream(spark, path, schema, files), FEED_ORDER, AS_OF, f"{out}/clean", f"{out}/bad", f"{out}/checkpoint"
    ).awaitTermination()
    columns = C.FEED_COLUMNS
    clean = spark.read.parquet(f"{out}/clean/rows").select(*columns, F.lit("").alias("error_codes"))
    bad = spark.read.parquet(f"{out}/bad").select(*columns, "error_codes")
    return clean.unionByName(bad)


@query
def stream_validate_csv(spark, base):
    """CSV files arrive in several lots, each lot with a header of its own; a stream is
    started after each lot and goes on where the last one ended."""
    landed, out = work_dir(spark, "landed-csv"), work_dir(spark, "stream-csv")
    with scratch(spark):
        for lot, rows in enumerate(_lots(stored_feed(spark, base), 3)):
            in_order = rows.repartitionByRange(*FEED_ORDER).sortWithinPartitions(*FEED_ORDER)
            with shuffles_dropped(spark):
                _turned(in_order, lot).write.options(**feed_files.CSV_OPTIONS).csv(f"{landed}/lot={lot}")
            ingest.validate_csv_stream(
                ingest.file_stream(spark, landed), AS_OF, f"{out}/clean", f"{out}/bad", f"{out}/checkpoint"
            ).awaitTermination()
    clean = spark.read.parquet(f"{out}/clean/rows").select(*C.FEED_COLUMNS, F.lit("").alias("error_codes"))
    bad = spark.read.parquet(f"{out}/bad").select(*C.FEED_COLUMNS, "error_codes")
    return clean.unionByName(bad)


@query
def stream_dedupe(spark, base):
    """Keys of the lines that are left; which copy of a line stays depends on arrival."""
    path, schema, files = _landed_parquet(spark, base)
    out = work_dir(spark, "stream-dedupe")
    lines = ingest.feed_stream(spark, path, schema, files)
    (
        ingest.dedupe_stream(lines)
        .writeStream.format("parquet")
        .options(**COMPACT)
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows").select(*C.DUPLICATE_KEY)
