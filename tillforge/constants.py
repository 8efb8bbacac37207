"""Fixed values that results depend on. Plain text, one list per purpose."""

from __future__ import annotations

# --- fixed values: sales feed layout ---------------------------------------
FEED_COLUMNS = [
    "transaction_id",
    "store_id",
    "product_id",
    "employee_id",
    "customer_id",
    "quantity",
    "unit_price",
    "discount_amount",
    "transaction_time",
]
REQUIRED_COLUMNS = [
    "transaction_id",
    "store_id",
    "product_id",
    "employee_id",
    "quantity",
    "unit_price",
    "transaction_time",
]
DUPLICATE_KEY = ["transaction_id", "product_id"]

# --- fixed values: fact layout ---------------------------------------------
FACT_COLUMNS = [
    "transaction_id",
    "date_sk",
    "customer_sk",
    "product_sk",
    "store_sk",
    "employee_sk",
    "transaction_time",
    "quantity",
    "unit_price",
    "discount_amount",
    "net_sales_amount",
    "audit_run_id",
]
UNKNOWN_KEY = -1
UNKNOWN_DATE_KEY = 19700101

# --- fixed values: reason codes --------------------------------------------
FILE_NOT_FOUND = "ERR_FILE_NOT_FOUND"
HEADER_MISMATCH = "ERR_HEADER_MISMATCH"
MISSING_COLUMN = "VAL001_MISSING_COLUMN"
BAD_QUANTITY = "VAL002_INVALID_DATATYPE_QTY"
BAD_PRICE = "VAL002_INVALID_DATATYPE_PRICE"
BAD_TIME = "VAL002_INVALID_DATATYPE_TIME"
NEGATIVE_PRICE = "VAL002_NEGATIVE_PRICE"
DUPLICATE = "VAL003_DUPLICATE_PRIMARY_KEY"
NEGATIVE_QUANTITY = "VAL005_NEGATIVE_QUANTITY"
FUTURE_TIME = "VAL006_FUTURE_TRANSACTION_DATE"
MALFORMED_LINE = "VAL_MALFORMED_LINE"
QUANTITY_RANGE = "VAL_QUANTITY_OUT_OF_RANGE"
AMOUNT_RANGE = "VAL_AMOUNT_OUT_OF_RANGE"
NULL_KEY = "VAL_NULL_PRIMARY_KEY"
INVALID_EMAIL = "VAL_INVALID_EMAIL"
FK_NOT_FOUND = "VAL_FK_NOT_FOUND"

# --- fixed values: text rules ----------------------------------------------
NULL_WORDS = ["", "null", "none", "n/a", "na", "nan", "undefined", "<null>", "nil"]
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
STORE_ID_PATTERN = r"^STR-[0-9]{3,}$"
MASK = "********"

# --- fixed values: run control ---------------------------------------------
MAX_ERROR_PERCENTAGE = 5
BATCH_SIZE = 10000
EPOCH = "1970-01-01 00:00:00"
APPLICATION_VERSION = "0.1.0"
RUN_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "PARTIAL_SUCCESS"]
SEVERITIES = ["INFO", "WARNING", "ERROR", "CRITICAL"]
ALERT_SEVERITIES = ["ERROR", "CRITICAL"]
LIFECYCLE_EVENTS = [
    "PIPELINE_STARTED",
    "HEALTH_CHECK_COMPLETED",
    "VALIDATION_STARTED",
    "VALIDATION_COMPLETED",
    "TRANSFORMATION_STARTED",
    "TRANSFORMATION_COMPLETED",
    "LOADING_STARTED",
    "LOADING_COMPLETED",
    "WATERMARK_UPDATED",
    "RECONCILIATION_COMPLETED",
    "PIPELINE_COMPLETED",
    "PIPELINE_FAILED",
]
FAILURE_CATEGORIES = [
    "CONFIGURATION",
    "VALIDATION",
    "TRANSFORMATION",
    "DATABASE",
    "NETWORK",
    "INCREMENTAL",
    "AUDIT",
    "UNKNOWN",
]
