"""Row rules: named boolean columns, evaluated together in one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.money import AMOUNT, MONEY
from tillforge.functions.text import BLANK, NUMBER, clean_text, parse_number, parse_timestamp, strip_blank

DATA_TYPE = "DataTypeValidator"
BUSINESS = "BusinessRuleValidator"
DUPLICATES = "DuplicateValidator"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true on rows that break the rule; it must never be NULL."""

    code: str
    validator: str
    severity: str
    message: str
    fails: Column


def parse_feed(feed: DataFrame) -> DataFrame:
    """Add the typed readings that several rules share."""
    return feed.withColumns(
        {
            "_quantity": parse_number(F.col("quantity")),
            "_price": parse_number(F.col("unit_price")),
            "_time": parse_timestamp(F.col("transaction_time")),
        }
    )


def feed_rules(as_of: str) -> list[Rule]:
    """Data type and business rules over a parsed feed, in reporting order.

    ``as_of`` stands for "now", so that a re-run gives the same answer.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    never = F.lit(False)
    return [
        Rule(C.BAD_QUANTITY, DATA_TYPE, "ERROR", "quantity is not a number", F.col("_quantity").isNull()),
        Rule(C.BAD_PRICE, DATA_TYPE, "ERROR", "unit_price is not a number", F.col("_price").isNull()),
        Rule(C.BAD_TIME, DATA_TYPE, "ERROR", "transaction_time is not a timestamp", F.col("_time").isNull()),
        Rule(
            C.NEGATIVE_QUANTITY,
            BUSINESS,
            "ERROR",
            "quantity must be greater than 0",
            F.coalesce(F.col("_quantity") <= 0, never),
        ),
        Rule(
            C.NEGATIVE_PRICE,
            BUSINESS,
            "ERROR",
            "unit_price must not be negative",
            F.coalesce(F.col("_price") < 0, never),
        ),
        Rule(
            C.FUTURE_TIME,
            BUSINESS,
            "ERROR",
            "transaction_time lies in the future",
            F.coalesce(F.col("_time") > now, never),
        ),
    ]


def duplicate_rule() -> Rule:
    """Needs the ``_repeated`` column of :func:`tillforge.operators.validate.mark_repeats`."""
    return Rule(
        C.DUPLICATE,
        DUPLICATES,
        "WARNING",
        "transaction_id and product_id were seen before",
        F.col("_repeated"),
    )


def discount_rule() -> Rule:
    """Optional feed rule: a discount must not be negative."""
    discount = parse_number(F.col("discount_amount"))
    return Rule(
        "VAL_NEG_DISCOUNT", BUSINESS, "ERROR", "discount_amount must not be negative",
        F.coalesce(discount < 0, F.lit(False)),
    )


def _fits_not(text: Column, kind: str) -> Column:
    """A number in plain form that the type cannot hold."""
    number = text.rlike(NUMBER)
    return F.coalesce(number & F.trim(text).try_cast(kind).isNull(), F.lit(False))


def range_rules() -> list[Rule]:
    """Quantities and amounts that the fact columns cannot hold, of a parsed feed."""
    price, discount = F.col("unit_price"), clean_text(F.col("discount_amount"))
    quantity = F.coalesce(F.col("_quantity").try_cast("int"), F.lit(1))

    def money(text: Column) -> Column:
        return F.coalesce(F.when(text.rlike(NUMBER), F.trim(text).try_cast(MONEY)), F.lit(0).cast(MONEY))

    net = quantity * money(price) - money(discount)
    return [
        Rule(
            C.QUANTITY_RANGE,
            BUSINESS,
            "ERROR",
            "quantity is too large",
            F.coalesce(F.col("_quantity").isNotNull() & F.col("_quantity").try_cast("int").isNull(), F.lit(False)),
        ),
        Rule(
            C.AMOUNT_RANGE,
            BUSINESS,
            "ERROR",
            "an amount of the line is too large",
            _fits_not(price, MONEY) | _fits_not(discount, MONEY) | net.try_cast(AMOUNT).isNull(),
        ),
    ]


def malformed_rule() -> Rule:
    """Needs the ``_corrupt`` column of :func:`tillforge.sources.feed_files.scan_feed`."""
    return Rule(C.MALFORMED_LINE, DATA_TYPE, "ERROR", "line has another number of fields than its header", F.col("_corrupt").isNotNull())


def null_key_rule() -> Rule:
    """Optional feed rule: a line needs its transaction and its product."""
    return Rule(
        C.NULL_KEY, DATA_TYPE, "ERROR", "transaction_id and product_id must not be empty",
        null_key(F.col("transaction_id")) | null_key(F.col("product_id")),
    )


# --- entity contracts -------------------------------------------------------

# Longest text each column may hold.
MAX_LENGTH = {
    "sale": {"transaction_id": 100, "store_id": 20, "product_id": 50, "employee_id": 50, "customer_id": 50},
    "customer": {"customer_id": 50, "first_name": 100, "last_name": 100, "email": 255, "phone": 30},
    "product": {"product_id": 50, "product_name": 255, "category": 100, "brand": 100},
    "store": {"store_id": 20, "store_name": 150, "region": 50, "city": 100},
    "employee": {"employee_id": 50, "first_name": 100, "last_name": 100, "role": 50, "store_id": 20},
}
# Texts that must hold something besides white space.
NOT_EMPTY = {
    "sale": ["transaction_id", "store_id", "product_id", "employee_id"],
    "customer": ["customer_id", "first_name", "last_name"],
    "product": ["product_id", "product_name", "category", "brand"],
    "store": ["store_id", "store_name", "region", "city"],
    "employee": ["employee_id", "first_name", "last_name", "role", "store_id"],
}


def _stripped(column: str) -> Column:
    return strip_blank(F.col(column))


def contract_rules(entity: str) -> dict[str, Column]:
    """Violations of one entity's contract, by rule name."""
    rules = {
        f"{c}_empty": F.coalesce(_stripped(c) == "", F.lit(True)) for c in NOT_EMPTY[entity]
    }
    for c, longest in MAX_LENGTH[entity].items():
        rules[f"{c}_too_long"] = F.coalesce(F.length(_stripped(c)) > longest, F.lit(False))
    if entity == "store":
        rules["state_not_two_letters"] = F.coalesce(F.length(_stripped("state")) != 2, F.lit(True))
    if entity == "product":
        rules["unit_price_negative"] = F.coalesce(F.col("unit_price") < 0, F.lit(True))
    if entity == "sale":
        quantity = parse_number(F.col("quantity"))
        discount = F.col("discount_amount")
        rules["quantity_not_positive_integer"] = F.coalesce(
            (quantity <= 0) | (quantity != F.floor(quantity)), F.lit(True)
        )
        rules["unit_price_negative"] = F.coalesce(parse_number(F.col("unit_price")) < 0, F.lit(True))
        rules["discount_amount_negative"] = F.when(
            discount.isNull() | (discount == ""), F.lit(False)
        ).otherwise(F.coalesce(parse_number(discount) < 0, F.lit(True)))
        rules["transaction_time_invalid"] = parse_timestamp(F.col("transaction_time")).isNull()
    return rules


def contract_violations(df: DataFrame, entity: str) -> DataFrame:
    """Number of violating rows per contract rule, all rules in one pass."""
    return count_violations(df, contract_rules(entity))


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(rule, rows_checked, violations)`` for named boolean columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(fails).alias(name) for name, fails in rules.items()],
    )
    return counts.unpivot("rows_checked", list(rules), "rule", "violations").select(
        "rule", "rows_checked", "violations"
    )


def invalid_email(email: Column) -> Column:
    return ~email.rlike(C.EMAIL_PATTERN)


def invalid_store_id(store_id: Column) -> Column:
    return F.coalesce(~store_id.rlike(C.STORE_ID_PATTERN), F.lit(True))


def null_key(key: Column) -> Column:
    """Missing, or nothing but white space."""
    return F.coalesce(key.rlike(f"^{BLANK}*$"), F.lit(True))
