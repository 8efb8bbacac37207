-- name: feed_scan
-- uses: feed
SELECT * EXCLUDE (l_linenumber, l_suppkey, l_shipdate, l_quantity) FROM feed

-- name: feed_scan_headers
-- uses: feed
SELECT * EXCLUDE (l_linenumber, l_suppkey, l_shipdate, l_quantity), CAST(NULL AS VARCHAR) AS _corrupt FROM feed

-- name: changed_files
-- uses: feed
SELECT split_part(store_id, '-', 2) AS store, count(*) AS rows, CAST(split_part(store_id, '-', 2) AS BIGINT) % 3 = 0 AS changed FROM feed GROUP BY ALL

-- name: file_fingerprint
-- uses: doc_files
SELECT doc_id, file_name, length, file_hash FROM doc_files

-- name: feed_files_by_store
-- uses: feed
SELECT split_part(store_id, '-', 2) AS store, '20010801' AS business_date, count(*) AS rows FROM feed GROUP BY ALL

-- name: feed_file_checks
-- uses: feed, dim_store
SELECT store,
  CASE WHEN store IN (SELECT split_part(store_id, '-', 2) FROM feed) THEN 'PASSED' ELSE 'FAILED' END AS status,
  CASE WHEN store IN (SELECT split_part(store_id, '-', 2) FROM feed) THEN '' ELSE 'ERR_FILE_NOT_FOUND' END AS error_code
FROM (
  SELECT split_part(store_id, '-', 2) AS store FROM dim_store
  UNION ALL SELECT CAST(store_sk + 900000 AS VARCHAR) FROM dim_store
)

-- name: quarantine_rows
-- uses: flagged
SELECT 'run-0001' AS run_id, 'store_' || store_id || '_sales_20010801.csv' AS source_file,
  transaction_id, store_id, product_id, employee_id, customer_id, quantity, unit_price, discount_amount, transaction_time,
  error_codes, error_messages
FROM flagged WHERE failed

-- name: fact_load
-- uses: fact_month
SELECT * FROM fact_month

-- name: load_batch_stats
-- uses: fact_month
SELECT tx_month, n AS rows, (n + 9999) // 10000 AS batches, n - ((n + 9999) // 10000 - 1) * 10000 AS last_batch_rows
FROM (SELECT tx_month, count(*) AS n FROM fact_month GROUP BY tx_month)

-- name: fact_partition_counts
-- uses: fact_month
SELECT CASE WHEN tx_month IN ('1998-07', '1998-08') THEN tx_month ELSE 'default' END AS partition_name, count(*) AS rows
FROM fact_month GROUP BY ALL

-- name: fact_pruned_month
-- uses: fact
SELECT date_sk, count(*) AS rows, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS net
FROM fact WHERE transaction_time >= TIMESTAMP '1998-07-01' AND transaction_time < TIMESTAMP '1998-08-01' GROUP BY date_sk

-- name: seed_dim_insert_only
-- uses: masters
SELECT entity, nk AS natural_key, CASE WHEN sk % 11 <> 0 THEN 'existing' ELSE 'seeded' END AS origin FROM masters

-- name: run_manifest
-- uses: classified
SELECT 'run-0001' AS run_id, batch_id, file_name AS filename, file_hash, rows_in_file AS rows_read,
  CASE WHEN classification IN ('NEW', 'MODIFIED', 'REPROCESS') THEN rows_in_file ELSE 0 END AS rows_loaded,
  'FILE_HASH' AS processing_strategy, classification, '0.1.0' AS pipeline_version,
  CASE WHEN classification IN ('NEW', 'MODIFIED', 'REPROCESS') THEN 'SUCCESS' ELSE 'SKIPPED' END AS status
FROM classified

-- name: last_successful_stage
-- uses: audit_events
SELECT run_id, stage AS last_successful_stage FROM (
  SELECT run_id, stage, row_number() OVER (PARTITION BY run_id ORDER BY event_time DESC, event_id DESC) AS rn FROM audit_events
) WHERE rn = 1

-- name: synthetic_feed_profile
SELECT count(*) AS rows, count(DISTINCT i) AS transactions, count(*) FILTER (i % 4 = 0) AS no_customer,
  count(*) FILTER (i % 50 = 7) AS bad_quantity, count(*) FILTER (i % 100 = 11) AS bad_price,
  count(*) FILTER (i % 100 = 13) AS future_time, count(*) FILTER (copy = 1) AS duplicates,
  count(*) FILTER (i % 50 = 7 OR i % 100 = 11 OR i % 100 = 13 OR copy = 1) AS failed,
  CAST(sum(CASE WHEN i % 100 = 11 THEN CAST(-10 AS DECIMAL(10,2)) ELSE CAST(CAST(500 + i * 37 % 24501 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) END) AS DECIMAL(28,2)) AS price_total,
  CAST(sum(CASE WHEN i % 3 = 0 THEN CAST(CAST(i % 1500 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) ELSE 0 END) AS DECIMAL(28,2)) AS discount_total,
  CAST(sum(CASE WHEN i % 50 = 7 THEN -(i % 5 + 1) ELSE i * 7 % 10 + 1 END) AS BIGINT) AS quantity_total
FROM (
  SELECT o_orderkey + 1 AS i, 0 AS copy FROM orders
  UNION ALL SELECT o_orderkey + 1, 1 FROM orders WHERE (o_orderkey + 1) % 20 = 0
)
