import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillforge.session import create_session

    session = create_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base():
    return BASE


FEED = (
    "transaction_id string, store_id string, product_id string, employee_id string, customer_id string, "
    "quantity string, unit_price string, discount_amount string, transaction_time string, line int"
)


@pytest.fixture
def make_feed(spark):
    """Feed rows from overrides of one good row; ``line`` numbers them."""
    good = {
        "transaction_id": "TX-1",
        "store_id": "STR-001",
        "product_id": "PROD-001",
        "employee_id": "EMP-001",
        "customer_id": "CUST-0001",
        "quantity": "2",
        "unit_price": "10.00",
        "discount_amount": "0.00",
        "transaction_time": "2026-01-15 10:00:00",
    }

    def make(*overrides):
        rows = [tuple({**good, **o}.values()) + (i,) for i, o in enumerate(overrides)]
        return spark.createDataFrame(rows, FEED)

    return make
