-- name: schema_check
SELECT feed, 'SchemaValidator' AS validator_name, status, severity, (SELECT count(*) FROM lineitem) AS records_checked,
  CAST(n AS BIGINT) AS records_failed, missing_columns
FROM (VALUES ('whole', 'PASSED', 'INFO', 0, ''), ('lacking', 'FAILED', 'CRITICAL', 2, 'employee_id,unit_price'))
  AS t(feed, status, severity, n, missing_columns)

-- name: rule_hits
-- uses: flagged
SELECT code, validator, 'ERROR' AS severity, hits FROM (
  SELECT 'VAL002_INVALID_DATATYPE_QTY' AS code, 'DataTypeValidator' AS validator, count(*) FILTER (bad_quantity) AS hits FROM flagged
  UNION ALL SELECT 'VAL002_INVALID_DATATYPE_PRICE', 'DataTypeValidator', count(*) FILTER (bad_price) FROM flagged
  UNION ALL SELECT 'VAL002_INVALID_DATATYPE_TIME', 'DataTypeValidator', count(*) FILTER (bad_time) FROM flagged
  UNION ALL SELECT 'VAL005_NEGATIVE_QUANTITY', 'BusinessRuleValidator', count(*) FILTER (negative_quantity) FROM flagged
  UNION ALL SELECT 'VAL002_NEGATIVE_PRICE', 'BusinessRuleValidator', count(*) FILTER (negative_price) FROM flagged
  UNION ALL SELECT 'VAL006_FUTURE_TRANSACTION_DATE', 'BusinessRuleValidator', count(*) FILTER (future_time) FROM flagged
)

-- name: range_rule_hits
-- uses: feed
SELECT code, 'BusinessRuleValidator' AS validator, 'ERROR' AS severity, hits FROM (
  WITH large AS (
    SELECT *, TRY_CAST(TRY_CAST(trim(q) AS DOUBLE) AS INTEGER) AS whole, trunc(TRY_CAST(trim(q) AS DOUBLE)) AS units,
      TRY_CAST(trim(p) AS DECIMAL(20,2)) AS price, TRY_CAST(trim(discount_amount) AS DECIMAL(20,2)) AS discount
    FROM (SELECT *, CASE right(transaction_id, 1) WHEN '3' THEN quantity || '00000000' WHEN '5' THEN quantity || '000000' ELSE quantity END AS q,
      CASE WHEN right(transaction_id, 1) = '7' THEN '9000' || unit_price ELSE unit_price END AS p FROM feed))
  SELECT 'VAL_QUANTITY_OUT_OF_RANGE' AS code, count(*) FILTER (units > 2147483647 OR units < -2147483648) AS hits FROM large
  UNION ALL SELECT 'VAL_AMOUNT_OUT_OF_RANGE', count(*) FILTER (coalesce(abs(price) > 99999999.99, FALSE) OR coalesce(abs(discount) > 99999999.99, FALSE)
    OR abs(CASE WHEN coalesce(abs(units) > 2147483647, TRUE) THEN 1 ELSE CAST(units AS BIGINT) END::DECIMAL(12,0)
      * CASE WHEN abs(price) > 99999999.99 THEN 0 ELSE coalesce(price, 0) END
      - CASE WHEN abs(discount) > 99999999.99 THEN 0 ELSE coalesce(discount, 0) END) > 9999999999.99) FROM large
)

-- name: contract_violations_sale
-- uses: parsed
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(transaction_id) = '', TRUE)) AS transaction_id_empty,
    count(*) FILTER (coalesce(trim(store_id) = '', TRUE)) AS store_id_empty,
    count(*) FILTER (coalesce(trim(product_id) = '', TRUE)) AS product_id_empty,
    count(*) FILTER (coalesce(trim(employee_id) = '', TRUE)) AS employee_id_empty,
    count(*) FILTER (length(trim(transaction_id)) > 100) AS transaction_id_too_long,
    count(*) FILTER (length(trim(store_id)) > 20) AS store_id_too_long,
    count(*) FILTER (length(trim(product_id)) > 50) AS product_id_too_long,
    count(*) FILTER (length(trim(employee_id)) > 50) AS employee_id_too_long,
    count(*) FILTER (length(trim(customer_id)) > 50) AS customer_id_too_long,
    count(*) FILTER (coalesce(q_num <= 0 OR q_num <> floor(q_num), TRUE)) AS quantity_not_positive_integer,
    count(*) FILTER (coalesce(p_num < 0, TRUE)) AS unit_price_negative,
    count(*) FILTER (CASE WHEN discount_amount IS NULL OR discount_amount = '' THEN FALSE ELSE coalesce(TRY_CAST(discount_amount AS DOUBLE) < 0, TRUE) END) AS discount_amount_negative,
    count(*) FILTER (t_ts IS NULL) AS transaction_time_invalid
  FROM parsed
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: contract_violations_customer
-- uses: dim_customer
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(customer_id) = '', TRUE)) AS customer_id_empty,
    count(*) FILTER (coalesce(trim(first_name) = '', TRUE)) AS first_name_empty,
    count(*) FILTER (coalesce(trim(last_name) = '', TRUE)) AS last_name_empty,
    count(*) FILTER (length(trim(customer_id)) > 50) AS customer_id_too_long,
    count(*) FILTER (length(trim(first_name)) > 100) AS first_name_too_long,
    count(*) FILTER (length(trim(last_name)) > 100) AS last_name_too_long,
    count(*) FILTER (length(trim(email)) > 255) AS email_too_long,
    count(*) FILTER (length(trim(phone)) > 30) AS phone_too_long
  FROM dim_customer
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: contract_violations_product
-- uses: dim_product
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(product_id) = '', TRUE)) AS product_id_empty,
    count(*) FILTER (coalesce(trim(product_name) = '', TRUE)) AS product_name_empty,
    count(*) FILTER (coalesce(trim(category) = '', TRUE)) AS category_empty,
    count(*) FILTER (coalesce(trim(brand) = '', TRUE)) AS brand_empty,
    count(*) FILTER (length(trim(product_id)) > 50) AS product_id_too_long,
    count(*) FILTER (length(trim(product_name)) > 255) AS product_name_too_long,
    count(*) FILTER (length(trim(category)) > 100) AS category_too_long,
    count(*) FILTER (length(trim(brand)) > 100) AS brand_too_long,
    count(*) FILTER (coalesce(unit_price < 0, TRUE)) AS unit_price_negative
  FROM dim_product
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: contract_violations_store
-- uses: dim_store
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(store_id) = '', TRUE)) AS store_id_empty,
    count(*) FILTER (coalesce(trim(store_name) = '', TRUE)) AS store_name_empty,
    count(*) FILTER (coalesce(trim(region) = '', TRUE)) AS region_empty,
    count(*) FILTER (coalesce(trim(city) = '', TRUE)) AS city_empty,
    count(*) FILTER (length(trim(store_id)) > 20) AS store_id_too_long,
    count(*) FILTER (length(trim(store_name)) > 150) AS store_name_too_long,
    count(*) FILTER (length(trim(region)) > 50) AS region_too_long,
    count(*) FILTER (length(trim(city)) > 100) AS city_too_long,
    count(*) FILTER (coalesce(length(trim(state)) <> 2, TRUE)) AS state_not_two_letters
  FROM dim_store
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: contract_violations_employee
-- uses: dim_employee
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(employee_id) = '', TRUE)) AS employee_id_empty,
    count(*) FILTER (coalesce(trim(first_name) = '', TRUE)) AS first_name_empty,
    count(*) FILTER (coalesce(trim(last_name) = '', TRUE)) AS last_name_empty,
    count(*) FILTER (coalesce(trim(role) = '', TRUE)) AS role_empty,
    count(*) FILTER (coalesce(trim(store_id) = '', TRUE)) AS store_id_empty,
    count(*) FILTER (length(trim(employee_id)) > 50) AS employee_id_too_long,
    count(*) FILTER (length(trim(first_name)) > 100) AS first_name_too_long,
    count(*) FILTER (length(trim(last_name)) > 100) AS last_name_too_long,
    count(*) FILTER (length(trim(role)) > 50) AS role_too_long,
    count(*) FILTER (length(trim(store_id)) > 20) AS store_id_too_long
  FROM dim_employee
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: email_rule
-- uses: dim_customer
SELECT customer_id, email, 'VAL_INVALID_EMAIL' AS error_code FROM dim_customer
WHERE NOT regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$')

-- name: store_id_rule
-- uses: feed
SELECT rule, rows_checked, violations FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (NOT regexp_matches(store_id, '^STR-[0-9]{3,}$')) AS store_id,
    count(*) FILTER (NOT regexp_matches(employee_id, '^STR-[0-9]{3,}$')) AS employee_id
  FROM feed
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: null_key_rule
-- uses: feed
SELECT rule, rows_checked, violations, 'VAL_NULL_PRIMARY_KEY' AS error_code FROM (
  SELECT count(*) AS rows_checked,
    count(*) FILTER (coalesce(trim(transaction_id), '') = '') AS transaction_id,
    count(*) FILTER (coalesce(trim(store_id), '') = '') AS store_id,
    count(*) FILTER (coalesce(trim(product_id), '') = '') AS product_id,
    count(*) FILTER (coalesce(trim(employee_id), '') = '') AS employee_id,
    count(*) FILTER (coalesce(trim(customer_id), '') = '') AS customer_id
  FROM feed
) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))

-- name: fk_orphans
-- uses: enriched, masters
SELECT dimension, natural_key, count(*) AS rows FROM (
  SELECT 'store' AS dimension, store_id AS natural_key FROM enriched WHERE NOT failed
  UNION ALL SELECT 'product', product_id FROM enriched WHERE NOT failed
  UNION ALL SELECT 'employee', employee_id FROM enriched WHERE NOT failed
  UNION ALL SELECT 'customer', customer_id FROM enriched WHERE NOT failed
) u
WHERE natural_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM masters m WHERE m.entity = u.dimension AND m.nk = u.natural_key AND (m.entity <> 'customer' OR m.sk % 11 <> 0))
GROUP BY ALL

-- name: check_constraint_audit
-- uses: dim_date, dim_product, unchecked_fact, runs, registry
SELECT 'dim_date' AS table_name, 'quarter_range' AS rule, count(*) AS rows_checked, count(*) FILTER (quarter NOT BETWEEN 1 AND 4) AS violations FROM dim_date
UNION ALL SELECT 'dim_date', 'month_range', count(*), count(*) FILTER (month NOT BETWEEN 1 AND 12) FROM dim_date
UNION ALL SELECT 'dim_date', 'week_range', count(*), count(*) FILTER (week NOT BETWEEN 1 AND 53) FROM dim_date
UNION ALL SELECT 'dim_date', 'day_range', count(*), count(*) FILTER (day NOT BETWEEN 1 AND 31) FROM dim_date
UNION ALL SELECT 'dim_product', 'unit_price_not_negative', count(*), count(*) FILTER (unit_price < 0) FROM dim_product
UNION ALL SELECT 'fact_sales', 'quantity_positive', count(*), count(*) FILTER (quantity <= 0) FROM unchecked_fact
UNION ALL SELECT 'fact_sales', 'unit_price_not_negative', count(*), count(*) FILTER (unit_price < 0) FROM unchecked_fact
UNION ALL SELECT 'fact_sales', 'discount_not_negative', count(*), count(*) FILTER (discount_amount < 0) FROM unchecked_fact
UNION ALL SELECT 'etl_audit_log', 'status_declared', count(*), count(*) FILTER (execution_status NOT IN ('RUNNING', 'SUCCESS', 'FAILED', 'PARTIAL_SUCCESS')) FROM runs
UNION ALL SELECT 'file_registry', 'status_declared', count(*), count(*) FILTER (status NOT IN ('SUCCESS', 'FAILED', 'REPROCESSED')) FROM registry

-- name: unique_constraint_audit
-- uses: masters, dim_date, flagged, registry
SELECT table_name, key_columns, count(*) FILTER (n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (
  SELECT 'dim_' || entity AS table_name, entity || '_id' AS key_columns, nk AS k, count(*) AS n FROM masters GROUP BY ALL
  UNION ALL SELECT 'dim_date', 'calendar_date', CAST(calendar_date AS VARCHAR), count(*) FROM dim_date GROUP BY ALL
  UNION ALL SELECT 'etl_watermark', 'entity_name,store_id', store_id, 1 FROM (SELECT DISTINCT store_id FROM flagged WHERE NOT failed)
  UNION ALL SELECT 'file_registry', 'file_hash', file_hash, count(*) FROM registry GROUP BY ALL
) GROUP BY ALL

-- name: not_null_audit
-- uses: unchecked_fact, dim_customer
SELECT table_name, rule, rows_checked, violations FROM (
  SELECT 'fact_sales' AS table_name, rule, rows_checked, violations FROM (
    SELECT count(*) AS rows_checked,
      count(*) FILTER (transaction_id IS NULL) AS transaction_id, count(*) FILTER (date_sk IS NULL) AS date_sk,
      count(*) FILTER (product_sk IS NULL) AS product_sk, count(*) FILTER (store_sk IS NULL) AS store_sk,
      count(*) FILTER (employee_sk IS NULL) AS employee_sk, count(*) FILTER (transaction_time IS NULL) AS transaction_time,
      count(*) FILTER (quantity IS NULL) AS quantity, count(*) FILTER (unit_price IS NULL) AS unit_price,
      count(*) FILTER (discount_amount IS NULL) AS discount_amount, count(*) FILTER (net_sales_amount IS NULL) AS net_sales_amount
    FROM unchecked_fact
  ) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))
  UNION ALL
  SELECT 'dim_customer' AS table_name, rule, rows_checked, violations FROM (
    SELECT count(*) AS rows_checked,
      count(*) FILTER (customer_sk IS NULL) AS customer_sk, count(*) FILTER (customer_id IS NULL) AS customer_id,
      count(*) FILTER (first_name IS NULL) AS first_name, count(*) FILTER (last_name IS NULL) AS last_name,
      count(*) FILTER (phone IS NULL) AS phone
    FROM dim_customer
  ) UNPIVOT (violations FOR rule IN (COLUMNS(* EXCLUDE (rows_checked))))
)

-- name: duplicate_rows
-- uses: flagged
SELECT transaction_id, store_id, product_id, employee_id, customer_id, quantity, unit_price, discount_amount, transaction_time,
  l_linenumber, l_suppkey, l_shipdate, l_quantity
FROM flagged WHERE repeated

-- name: duplicates_after_cleaning
-- uses: cleaned
SELECT count(*) AS repeated_lines, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (
  SELECT upper(transaction_id), upper(product_id), count(*) AS n FROM cleaned GROUP BY ALL HAVING count(*) > 1
)

-- name: rows_with_errors
-- uses: flagged
SELECT error_codes, count(*) AS rows FROM flagged WHERE failed GROUP BY error_codes

-- name: clean_rows
-- uses: flagged
SELECT transaction_id, store_id, product_id, employee_id, customer_id, quantity, unit_price, discount_amount, transaction_time
FROM flagged WHERE NOT failed

-- name: failure_reasons
-- uses: flagged
SELECT code, count(*) AS hits FROM (SELECT unnest(string_split(error_codes, ',')) AS code FROM flagged WHERE failed) GROUP BY code

-- name: validator_results
-- uses: flagged
SELECT validator_name, CASE WHEN records_failed > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, severity, records_checked, records_failed, error_summary
FROM (
  SELECT 'FileValidator' AS validator_name, 'CRITICAL' AS severity, count(*) AS records_checked, CAST(0 AS BIGINT) AS records_failed, '' AS error_summary FROM flagged
  UNION ALL SELECT 'SchemaValidator', 'INFO', count(*), 0, '' FROM flagged
  UNION ALL SELECT 'DataTypeValidator', 'ERROR', count(*), count(*) FILTER (bad_quantity OR bad_price OR bad_time),
    concat_ws(',',
      CASE WHEN count(*) FILTER (bad_quantity) > 0 THEN 'VAL002_INVALID_DATATYPE_QTY=' || count(*) FILTER (bad_quantity) END,
      CASE WHEN count(*) FILTER (bad_price) > 0 THEN 'VAL002_INVALID_DATATYPE_PRICE=' || count(*) FILTER (bad_price) END,
      CASE WHEN count(*) FILTER (bad_time) > 0 THEN 'VAL002_INVALID_DATATYPE_TIME=' || count(*) FILTER (bad_time) END) FROM flagged
  UNION ALL SELECT 'BusinessRuleValidator', 'ERROR', count(*), count(*) FILTER (negative_quantity OR negative_price OR future_time),
    concat_ws(',',
      CASE WHEN count(*) FILTER (negative_quantity) > 0 THEN 'VAL005_NEGATIVE_QUANTITY=' || count(*) FILTER (negative_quantity) END,
      CASE WHEN count(*) FILTER (negative_price) > 0 THEN 'VAL002_NEGATIVE_PRICE=' || count(*) FILTER (negative_price) END,
      CASE WHEN count(*) FILTER (future_time) > 0 THEN 'VAL006_FUTURE_TRANSACTION_DATE=' || count(*) FILTER (future_time) END) FROM flagged
  UNION ALL SELECT 'DuplicateValidator', 'WARNING', count(*), count(*) FILTER (repeated),
    concat_ws(',', CASE WHEN count(*) FILTER (repeated) > 0 THEN 'VAL003_DUPLICATE_PRIMARY_KEY=' || count(*) FILTER (repeated) END) FROM flagged
)

-- name: validation_report
-- uses: flagged
SELECT n AS total_rows, n - f AS passed_rows, f AS failed_rows,
  CAST(CAST((2 * f * 10000 + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS failure_rate_pct,
  f = 0 OR f * 100 <= n * 5 AS is_valid, f = 0 OR f * 100 <= n * 2 AS is_valid_production, f = 0 AS is_valid_testing
FROM (SELECT count(*) AS n, count(*) FILTER (failed) AS f FROM flagged)

-- name: store_failure_rate
-- uses: flagged
SELECT store_id, n AS total_rows, f AS failed_rows,
  CAST(CAST((2 * f * 10000 + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS failure_rate_pct,
  f = 0 OR f * 100 <= n * 5 AS is_valid
FROM (SELECT store_id, count(*) AS n, count(*) FILTER (failed) AS f FROM flagged GROUP BY store_id)

-- name: scorecard
-- uses: flagged
SELECT n AS total_records,
  CAST(CAST((20000 * (9 * n - empty) + 9 * n) // (18 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS completeness_pct,
  CAST(CAST((20000 * passed + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS validity_pct,
  CAST(CAST((20000 * ids + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS uniqueness_pct,
  CAST(CAST((20000 * lines + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS uniqueness_line_pct,
  CAST(100 AS DECIMAL(9,2)) AS consistency_pct,
  CAST(conformity AS DECIMAL(9,2)) AS conformity_pct,
  CAST(100 AS DECIMAL(9,2)) AS freshness_pct,
  CAST(CAST((200 * (25 * (9 * n - empty) + 270 * passed + 180 * ids + 9 * n * (15 + conformity // 10)) + 9 * n) // (18 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(9,2)) AS overall_quality_score
FROM (
  SELECT *, CASE WHEN (n - passed) * 100 <= n * 5 THEN 100 ELSE 80 END AS conformity FROM (
    SELECT count(*) AS n,
      CAST(sum((transaction_id IS NULL)::INT + (store_id IS NULL)::INT + (product_id IS NULL)::INT + (employee_id IS NULL)::INT + (customer_id IS NULL)::INT
        + (quantity IS NULL)::INT + (unit_price IS NULL)::INT + (discount_amount IS NULL)::INT + (transaction_time IS NULL)::INT) AS BIGINT) AS empty,
      count(*) FILTER (NOT failed) AS passed, count(DISTINCT transaction_id) AS ids, count(*) FILTER (NOT repeated) AS lines
    FROM flagged
  )
)
