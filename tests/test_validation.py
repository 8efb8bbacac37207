import json

import pytest
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.operators import rules, validate
from tillforge.operators.scorecard import scorecard

AS_OF = "2026-12-01 00:00:00"
RULES = [C.BAD_QUANTITY, C.BAD_PRICE, C.BAD_TIME, C.NEGATIVE_QUANTITY, C.NEGATIVE_PRICE, C.FUTURE_TIME]


def flag(feed, **kw):
    return validate.flag_feed(feed, ["line"], AS_OF, **kw)


def codes(feed):
    checks = validate.default_rules(AS_OF)
    rows = flag(feed).select("line", validate.error_codes(checks).alias("codes")).collect()
    return {r.line: r.codes for r in rows}


@pytest.mark.parametrize(
    "override, code",
    [
        ({"quantity": "abc"}, C.BAD_QUANTITY),
        ({"quantity": None}, C.BAD_QUANTITY),
        ({"quantity": "NaN"}, C.BAD_QUANTITY),
        ({"quantity": "5d"}, C.BAD_QUANTITY),
        ({"quantity": "1_000"}, C.BAD_QUANTITY),
        ({"quantity": "-5"}, C.NEGATIVE_QUANTITY),
        ({"quantity": "0"}, C.NEGATIVE_QUANTITY),
        ({"unit_price": "ten"}, C.BAD_PRICE),
        ({"unit_price": "-149.99"}, C.NEGATIVE_PRICE),
        ({"unit_price": "-0.001"}, C.NEGATIVE_PRICE),
        ({"transaction_time": "not-a-date"}, C.BAD_TIME),
        ({"transaction_time": "2026"}, C.BAD_TIME),
        ({"transaction_time": "2026-02-30 10:00:00"}, C.BAD_TIME),
        ({"transaction_time": "2099-01-15 10:10:00"}, C.FUTURE_TIME),
        ({"quantity": " 1e1 ", "unit_price": ".5"}, ""),
        ({"transaction_time": "2026-12-01 00:00:00"}, ""),
    ],
)
def test_single_rule(make_feed, override, code):
    assert codes(make_feed(override)) == {0: code}


def test_row_may_break_several_rules(make_feed):
    feed = make_feed({"quantity": "-1", "unit_price": "x", "transaction_time": "2099-01-01 00:00:00"})
    assert codes(feed)[0] == f"{C.BAD_PRICE},{C.NEGATIVE_QUANTITY},{C.FUTURE_TIME}"


def test_only_later_copies_are_duplicates(make_feed):
    feed = make_feed({}, {}, {"product_id": "PROD-2"}, {"unit_price": "7"})
    assert codes(feed) == {0: "", 1: C.DUPLICATE, 2: "", 3: C.DUPLICATE}


def test_missing_keys_are_one_key(make_feed):
    none = {"transaction_id": None, "product_id": None}
    assert [c for _, c in sorted(codes(make_feed(none, none, {"transaction_id": None})).items())] == ["", C.DUPLICATE, ""]


def test_duplicates_are_found_on_raw_text(make_feed):
    assert set(codes(make_feed({}, {"transaction_id": " tx-1 "})).values()) == {""}


def test_hot_key_keeps_exactly_its_first_row(spark):
    """A third of all rows share one key; compared with a brute-force pass."""
    n = 30000
    feed = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "TX-HOT").otherwise(F.concat(F.lit("TX-"), (F.col("id") % 14000).cast("string"))).alias("transaction_id"),
        F.lit("P").alias("product_id"),
        ((F.col("id") * 7919) % n).alias("line"),
    )
    marked = validate.mark_repeats(feed, ["transaction_id", "product_id"], ["line"])
    rows = marked.select("transaction_id", "line", "_repeated").collect()
    first = {}
    for r in rows:
        first[r.transaction_id] = min(first.get(r.transaction_id, n), r.line)
    assert len(rows) == n
    assert all(r._repeated == (r.line > first[r.transaction_id]) for r in rows)


def test_split_loses_no_row(make_feed):
    flagged = flag(make_feed({}, {"quantity": "-5", "transaction_id": "TX-2"}, {"transaction_id": "TX-3"}))
    assert validate.passed_rows(flagged).count() == 2
    assert validate.failed_rows(flagged, validate.default_rules(AS_OF)).count() == 1


def test_quarantine_holds_raw_values_and_reasons(spark, make_feed, tmp_path):
    path = str(tmp_path / "bad")
    flagged = flag(make_feed({}, {"quantity": " -5 ", "transaction_id": "TX-2"}))
    checks = validate.default_rules(AS_OF)
    for run in ("run-1", "run-2"):
        validate.write_quarantine(flagged, checks, path, run, F.lit("store_1.csv"), AS_OF)
    row = validate.read_quarantine(spark, path).filter("run_id = 'run-1'").first()
    assert (row.raw_record.quantity, row.error_codes) == (" -5 ", [C.NEGATIVE_QUANTITY])
    assert validate.read_quarantine(spark, path).count() == 2
    files = list((tmp_path / "bad" / "run_id=run-1").glob("*.json"))
    assert "raw_record" in json.loads(files[0].read_text().splitlines()[0])


def test_missing_column_aborts(make_feed):
    with pytest.raises(validate.SchemaError, match="quantity"):
        flag(make_feed({}).drop("quantity"))


def test_customer_and_discount_are_optional(make_feed):
    feed = make_feed({"customer_id": None, "discount_amount": None})
    assert validate.missing_columns(feed.drop("customer_id", "discount_amount")) == []


def test_rule_list_can_be_replaced(make_feed):
    only = [rules.Rule("CHEAP", "Custom", "INFO", "too cheap", F.coalesce(F.col("_price") < 5, F.lit(False)))]
    flagged = flag(make_feed({"unit_price": "4"}, {"unit_price": "6"}), rules=only)
    assert [r.CHEAP for r in flagged.orderBy("line").collect()] == [True, False]


@pytest.mark.parametrize("bad, limit, valid", [(0, 0, True), (1, 5, False), (1, 50, True), (1, 33.33, False), (1, 33.34, True)])
def test_validity_gate(make_feed, bad, limit, valid):
    feed = make_feed(*[{"transaction_id": f"T{i}", "quantity": "-1" if i < bad else "1"} for i in range(3)])
    report = validate.validation_report(flag(feed), {"is_valid": limit}).first()
    assert (report.failed_rows, report.is_valid) == (bad, valid)


def test_empty_feed_is_valid_and_scores_full(make_feed):
    flagged = flag(make_feed({}).limit(0))
    report = validate.validation_report(flagged).first()
    score = scorecard(flagged).first()
    assert (report.total_rows, report.is_valid, float(report.failure_rate_pct)) == (0, True, 0.0)
    assert (float(score.completeness_pct), float(score.overall_quality_score)) == (100.0, 100.0)


def test_scorecard_weights(make_feed):
    feed = make_feed({}, {"customer_id": None}, {"transaction_id": "TX-2"}, {"transaction_id": "TX-3", "quantity": "-1"})
    got = scorecard(flag(feed)).first()
    completeness, validity, uniqueness = 35 / 36 * 100, 50, 75  # second row repeats the first
    want = completeness * 0.25 + validity * 0.30 + uniqueness * 0.20 + 10 + 8 + 5
    assert float(got.overall_quality_score) == pytest.approx(want, abs=0.006)
    assert float(got.conformity_pct) == 80


def test_contract_of_a_sale(make_feed):
    feed = make_feed({"transaction_id": " \t", "quantity": "1.5", "discount_amount": ""}, {"discount_amount": "-1"})
    got = {r.rule: r.violations for r in rules.contract_violations(feed, "sale").collect() if r.violations}
    assert got == {"transaction_id_empty": 1, "quantity_not_positive_integer": 1, "discount_amount_negative": 1}


def test_contract_of_a_store(spark):
    stores = spark.createDataFrame(
        [("STR-1", "A", "East", "Rome", "ITA"), ("STR-2", " ", "East", "Rome", " NY ")],
        "store_id string, store_name string, region string, city string, state string",
    )
    got = {r.rule: r.violations for r in rules.contract_violations(stores, "store").collect() if r.violations}
    assert got == {"store_name_empty": 1, "state_not_two_letters": 1}


@pytest.mark.parametrize("mail, bad", [("a.b@c.de", False), ("a.b.de", True), ("@c.de", True), ("a@c", True)])
def test_email_pattern(spark, mail, bad):
    assert spark.createDataFrame([(mail,)], "m string").select(rules.invalid_email(F.col("m"))).first()[0] is bad
