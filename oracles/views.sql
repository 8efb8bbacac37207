-- name: feed
SELECT
  CASE WHEN h % 11 = 0 THEN '  tx-' || tx || ' ' ELSE 'TX-' || tx END AS transaction_id,
  CASE WHEN h % 71 = 0 THEN 'STR-999999' ELSE 'STR-' || lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(l_suppkey AS VARCHAR))) AS INTEGER), '0') END AS store_id,
  'prod-' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(6, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') AS product_id,
  'EMP-' || lpad(CAST(l_orderkey % 50 AS VARCHAR), 3, '0') AS employee_id,
  CASE WHEN h % 4 = 0 THEN NULL WHEN h % 23 = 0 THEN 'N/A'
       ELSE 'CUST-' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') END AS customer_id,
  CASE WHEN h % 397 = 0 THEN 'abc' WHEN h % 50 = 0 THEN '-' || q ELSE q END AS quantity,
  CASE WHEN h % 100 = 1 THEN '-10.00' ELSE CAST(price AS VARCHAR) END AS unit_price,
  CASE WHEN h % 3 = 0 THEN CAST(CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS VARCHAR) END AS discount_amount,
  CASE WHEN h % 401 = 0 THEN 'not-a-date' WHEN h % 100 = 2 THEN '2099-01-15 10:10:00'
       ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_time,
  l_linenumber, l_suppkey, l_shipdate, l_quantity
FROM (
  SELECT *,
    l_orderkey * 7 + l_partkey * 13 + l_suppkey * 17 + l_linenumber AS h,
    lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(9, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0') AS tx,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
    CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)

-- name: parsed
-- uses: feed
SELECT *,
  CASE WHEN regexp_matches(quantity, '^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') THEN TRY_CAST(trim(quantity) AS DOUBLE) END AS q_num,
  CASE WHEN regexp_matches(unit_price, '^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') THEN TRY_CAST(trim(unit_price) AS DOUBLE) END AS p_num,
  CASE WHEN regexp_matches(transaction_time, '^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$') THEN TRY_CAST(transaction_time AS TIMESTAMP) END AS t_ts,
  row_number() OVER (PARTITION BY transaction_id, product_id ORDER BY l_linenumber, l_suppkey, l_shipdate, l_quantity) AS copy_no
FROM feed

-- name: flags
-- uses: parsed
SELECT *,
  q_num IS NULL AS bad_quantity,
  p_num IS NULL AS bad_price,
  t_ts IS NULL AS bad_time,
  coalesce(q_num <= 0, FALSE) AS negative_quantity,
  coalesce(p_num < 0, FALSE) AS negative_price,
  coalesce(t_ts > TIMESTAMP '2026-12-01 00:00:00', FALSE) AS future_time,
  copy_no > 1 AS repeated
FROM parsed

-- name: flagged
-- uses: flags
SELECT *,
  bad_quantity OR bad_price OR bad_time OR negative_quantity OR negative_price OR future_time OR repeated AS failed,
  concat_ws(',',
    CASE WHEN bad_quantity THEN 'VAL002_INVALID_DATATYPE_QTY' END,
    CASE WHEN bad_price THEN 'VAL002_INVALID_DATATYPE_PRICE' END,
    CASE WHEN bad_time THEN 'VAL002_INVALID_DATATYPE_TIME' END,
    CASE WHEN negative_quantity THEN 'VAL005_NEGATIVE_QUANTITY' END,
    CASE WHEN negative_price THEN 'VAL002_NEGATIVE_PRICE' END,
    CASE WHEN future_time THEN 'VAL006_FUTURE_TRANSACTION_DATE' END,
    CASE WHEN repeated THEN 'VAL003_DUPLICATE_PRIMARY_KEY' END) AS error_codes,
  concat_ws('; ',
    CASE WHEN bad_quantity THEN 'quantity is not a number' END,
    CASE WHEN bad_price THEN 'unit_price is not a number' END,
    CASE WHEN bad_time THEN 'transaction_time is not a timestamp' END,
    CASE WHEN negative_quantity THEN 'quantity must be greater than 0' END,
    CASE WHEN negative_price THEN 'unit_price must not be negative' END,
    CASE WHEN future_time THEN 'transaction_time lies in the future' END,
    CASE WHEN repeated THEN 'transaction_id and product_id were seen before' END) AS error_messages
FROM flags

-- name: stripped
-- uses: flagged
SELECT
  regexp_replace(regexp_replace(
    COLUMNS(['transaction_id', 'store_id', 'product_id', 'employee_id', 'customer_id', 'quantity', 'unit_price', 'discount_amount', 'transaction_time']),
    '^[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+|[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+$', '', 'g'),
    '[\x00-\x1F\x7F-\x{9F}]', '', 'g'),
  failed
FROM flagged

-- name: cleaned
-- uses: stripped
SELECT
  CASE WHEN lower(COLUMNS(['transaction_id', 'store_id', 'product_id', 'employee_id', 'customer_id', 'quantity', 'unit_price', 'discount_amount', 'transaction_time']))
         IN ('', 'null', 'none', 'n/a', 'na', 'nan', 'undefined', '<null>', 'nil') THEN NULL
       ELSE COLUMNS(['transaction_id', 'store_id', 'product_id', 'employee_id', 'customer_id', 'quantity', 'unit_price', 'discount_amount', 'transaction_time']) END,
  failed
FROM stripped

-- name: normalized
-- uses: cleaned
SELECT
  upper(transaction_id) AS transaction_id,
  upper(store_id) AS store_id,
  upper(product_id) AS product_id,
  upper(employee_id) AS employee_id,
  upper(customer_id) AS customer_id,
  coalesce(TRY_CAST(trunc(CASE WHEN regexp_matches(quantity, '^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') THEN TRY_CAST(trim(quantity) AS DOUBLE) END) AS INTEGER), 1) AS quantity,
  coalesce(CASE WHEN regexp_matches(unit_price, '^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') THEN TRY_CAST(trim(unit_price) AS DECIMAL(10,2)) END, CAST(0 AS DECIMAL(10,2))) AS unit_price,
  coalesce(CASE WHEN regexp_matches(discount_amount, '^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') THEN TRY_CAST(trim(discount_amount) AS DECIMAL(10,2)) END, CAST(0 AS DECIMAL(10,2))) AS discount_amount,
  transaction_time,
  failed
FROM cleaned

-- name: amounts
-- uses: normalized
SELECT *,
  CAST(quantity * unit_price AS DECIMAL(20,2)) AS gross_sales_amount,
  CAST(CAST(quantity * unit_price AS DECIMAL(20,2)) - discount_amount AS DECIMAL(20,2)) AS net_sales_amount
FROM normalized

-- name: enriched
-- uses: amounts
SELECT * EXCLUDE (failed, n, d, gross_cents, disc),
  CASE WHEN gross_cents > 0 THEN
    CAST(CAST(CASE WHEN disc < 0 THEN -((2 * -disc + gross_cents) // (2 * gross_cents)) ELSE (2 * disc + gross_cents) // (2 * gross_cents) END AS DECIMAL(26,0)) * 0.01 AS DECIMAL(16,2))
  ELSE CAST(0 AS DECIMAL(16,2)) END AS discount_percentage,
  CAST(CAST(CASE WHEN (n < 0) <> (d < 0) THEN -((2 * abs(n) + abs(d)) // (2 * abs(d))) ELSE (2 * abs(n) + abs(d)) // (2 * abs(d)) END AS DECIMAL(26,0)) * 0.01 AS DECIMAL(20,2)) AS effective_unit_price,
  net_sales_amount AS transaction_line_total,
  failed
FROM (
  SELECT *,
    CAST(net_sales_amount * 100 AS HUGEINT) AS n,
    CAST(CASE WHEN quantity = 0 THEN 1 ELSE quantity END AS HUGEINT) AS d,
    CAST(gross_sales_amount * 100 AS HUGEINT) AS gross_cents,
    CAST(discount_amount * 100 AS HUGEINT) * 10000 AS disc
  FROM amounts
)

-- name: dim_store
SELECT s_suppkey + 1 AS store_sk, 'STR-' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS store_id,
  s_name AS store_name, r_name AS region, n_name AS city, upper(substring(n_name, 1, 2)) AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey

-- name: dim_product
SELECT p_partkey + 1 AS product_sk, 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(6, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS product_id,
  p_name AS product_name, p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
FROM part

-- name: dim_customer
SELECT c_custkey + 1 AS customer_sk, 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_id,
  c_mktsegment AS first_name, split_part(c_name, '#', 2) AS last_name,
  CASE WHEN c_custkey % 13 = 0 THEN replace(c_name, '#', '.') || 'Example.COM' ELSE replace(c_name, '#', '.') || '@Example.COM' END AS email,
  CAST(NULL AS VARCHAR) AS phone
FROM customer

-- name: dim_employee
SELECT n + 1 AS employee_sk, 'EMP-' || lpad(CAST(n AS VARCHAR), 3, '0') AS employee_id,
  'First' || n AS first_name, 'Last' || n AS last_name,
  CASE n % 3 WHEN 0 THEN 'Shift Lead' WHEN 1 THEN 'Cashier' ELSE 'Manager' END AS role,
  'STR-' || lpad(CAST(n AS VARCHAR), 6, '0') AS store_id
FROM (SELECT DISTINCT o_orderkey % 50 AS n FROM orders)

-- name: dim_date
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS calendar_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(week(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
  CAST(year(d) AS INTEGER) AS fiscal_year
FROM (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT date_trunc('day', o_orderdate) AS o_orderdate FROM orders)
)

-- name: resolved
-- uses: enriched, dim_store, dim_product, dim_customer, dim_employee
SELECT e.*,
  coalesce(store_sk, -1) AS store_sk,
  coalesce(product_sk, -1) AS product_sk,
  coalesce(employee_sk, -1) AS employee_sk,
  CASE WHEN e.customer_id IS NOT NULL THEN coalesce(customer_sk, -1) END AS customer_sk,
  CASE WHEN ts IS NULL THEN 19700101 ELSE CAST(strftime(ts, '%Y%m%d') AS INTEGER) END AS date_sk,
  ts
FROM (
  SELECT *, CASE WHEN regexp_matches(transaction_time, '^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$') THEN TRY_CAST(transaction_time AS TIMESTAMP) END AS ts
  FROM enriched
) e
LEFT JOIN (SELECT store_id, store_sk FROM dim_store) s ON e.store_id = s.store_id
LEFT JOIN (SELECT product_id, product_sk FROM dim_product) p ON e.product_id = p.product_id
LEFT JOIN (SELECT employee_id, employee_sk FROM dim_employee) m ON e.employee_id = m.employee_id
LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customer) c ON e.customer_id = c.customer_id

-- name: unchecked_fact
-- uses: resolved
SELECT transaction_id, date_sk, customer_sk, product_sk, store_sk, employee_sk, ts AS transaction_time, quantity,
  unit_price, discount_amount, CAST(net_sales_amount AS DECIMAL(12,2)) AS net_sales_amount, CAST(1 AS BIGINT) AS audit_run_id, failed
FROM resolved

-- name: fact
-- uses: unchecked_fact
SELECT * EXCLUDE (failed) FROM unchecked_fact WHERE NOT failed

-- name: fact_month
-- uses: fact
SELECT *, strftime(transaction_time, '%Y-%m') AS tx_month FROM fact

-- name: masters
-- uses: dim_store, dim_product, dim_customer, dim_employee
SELECT 'store' AS entity, store_sk AS sk, store_id AS nk, store_name AS a1, region AS a2, city AS a3, state AS a4 FROM dim_store
UNION ALL SELECT 'product', product_sk, product_id, product_name, category, brand, CAST(unit_price AS VARCHAR) FROM dim_product
UNION ALL SELECT 'customer', customer_sk, customer_id, first_name, last_name, email, phone FROM dim_customer
UNION ALL SELECT 'employee', employee_sk, employee_id, first_name, last_name, role, store_id FROM dim_employee

-- name: applied
-- uses: masters
SELECT entity,
  CASE WHEN sk % 11 <> 0 THEN sk ELSE max(CASE WHEN sk % 11 <> 0 THEN sk END) OVER (PARTITION BY entity)
    + row_number() OVER (PARTITION BY entity, sk % 11 = 0 ORDER BY nk) END AS sk,
  nk, CASE WHEN sk % 7 = 0 THEN a1 || ' (renamed)' ELSE a1 END AS a1, a2, a3, a4,
  CASE WHEN sk % 11 = 0 THEN TIMESTAMP '2026-12-01 00:00:00' ELSE TIMESTAMP '2026-11-30 00:00:00' END AS created_at,
  CASE WHEN sk % 11 = 0 OR sk % 7 = 0 THEN TIMESTAMP '2026-12-01 00:00:00' ELSE TIMESTAMP '2026-11-30 00:00:00' END AS updated_at,
  CASE WHEN sk % 11 = 0 THEN 'INSERT' WHEN sk % 7 = 0 THEN 'UPDATE' ELSE 'UNCHANGED' END AS change
FROM masters

-- name: doc_files
SELECT doc_id, source || '_' || (doc_id % 31) AS file_name, sha256(text) AS file_hash,
  CAST(octet_length(encode(text)) AS BIGINT) AS length,
  CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS rows_in_file,
  'BATCH-' || (doc_id % 71) AS batch_id
FROM documents

-- name: registry
-- uses: doc_files
SELECT file_name, file_hash,
  CASE WHEN doc_id % 20 = 0 THEN 'FAILED' WHEN doc_id % 20 = 10 THEN 'REPROCESSED' ELSE 'SUCCESS' END AS status,
  TIMESTAMP '2026-01-01 00:00:00' + to_minutes(doc_id % 40000) AS processed_at,
  batch_id, 'RUN-' || (doc_id % 10) AS run_id
FROM doc_files WHERE doc_id % 2 = 0

-- name: done
-- uses: registry
SELECT * FROM registry WHERE status IN ('SUCCESS', 'REPROCESSED')

-- name: incoming
-- uses: doc_files
SELECT doc_id, file_name, file_hash, rows_in_file, batch_id,
  TIMESTAMP '2026-01-01 00:00:00' + to_minutes(doc_id * 2 % 40000) AS file_time,
  doc_id % 97 = 0 AS is_replay, doc_id % 89 <> 1 AS is_present
FROM doc_files WHERE doc_id % 2 = 1

-- name: classified
-- uses: incoming, done
SELECT *, CASE
  WHEN NOT is_present THEN 'STALE'
  WHEN is_replay THEN 'REPROCESS'
  WHEN file_hash IN (SELECT file_hash FROM done) THEN 'DUPLICATE'
  WHEN file_time < TIMESTAMP '2026-01-01 02:00:00' THEN 'STALE'
  WHEN file_name IN (SELECT file_name FROM done) THEN 'MODIFIED'
  ELSE 'NEW' END AS classification
FROM incoming

-- name: audit_events
SELECT event_id, user_id AS run_id, event_type AS event_name,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS severity,
  ts AS event_time, event_type AS stage, CAST(value AS DECIMAL(18,2)) AS duration_ms
FROM events

-- name: runs
-- uses: audit_events
SELECT 'RUN-' || run_id || '-' || strftime(run_date, '%Y%m%d') AS pipeline_run_id,
  'store-feed-' || (run_id % 4) AS pipeline_name,
  started_at, completed_at,
  CAST((epoch_us(completed_at) - epoch_us(started_at)) // 1000 AS BIGINT) AS duration_ms,
  records_read, records_rejected, records_read - records_rejected AS records_loaded,
  CASE WHEN 2 * records_rejected > records_read THEN 'FAILED' WHEN records_rejected > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS execution_status
FROM (
  SELECT run_id, CAST(event_time AS DATE) AS run_date, min(event_time) AS started_at, max(event_time) AS completed_at,
    count(*) AS records_read, count(*) FILTER (severity = 'ERROR') AS records_rejected
  FROM audit_events GROUP BY ALL
)
