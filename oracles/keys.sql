-- name: resolve_keys
-- uses: resolved
SELECT transaction_id, product_id, transaction_time, store_sk, product_sk, employee_sk, customer_sk, date_sk FROM resolved WHERE NOT failed

-- name: lookup_failures
-- uses: resolved
SELECT 'store' AS dimension, count(*) FILTER (store_sk <> -1) AS hits, count(*) FILTER (store_sk = -1) AS misses, count(*) FILTER (store_sk = -1) AS failures FROM resolved WHERE NOT failed
UNION ALL SELECT 'product', count(*) FILTER (product_sk <> -1), count(*) FILTER (product_sk = -1), count(*) FILTER (product_sk = -1) FROM resolved WHERE NOT failed
UNION ALL SELECT 'employee', count(*) FILTER (employee_sk <> -1), count(*) FILTER (employee_sk = -1), count(*) FILTER (employee_sk = -1) FROM resolved WHERE NOT failed
UNION ALL SELECT 'customer', count(*) FILTER (customer_sk <> -1), count(*) FILTER (customer_sk = -1), 0 FROM resolved WHERE NOT failed
UNION ALL SELECT 'date', count(*) FILTER (date_sk <> 19700101), 0, count(*) FILTER (date_sk = 19700101) FROM resolved WHERE NOT failed

-- name: unknown_use_key
-- uses: resolved
SELECT store_id, store_sk, count(*) AS rows FROM resolved WHERE NOT failed AND store_sk = -1 GROUP BY ALL

-- name: unknown_auto_create
-- uses: enriched, dim_store
SELECT store_id, (SELECT max(store_sk) FROM dim_store WHERE store_sk % 11 <> 0) + row_number() OVER (ORDER BY store_id) AS store_sk
FROM (
  SELECT DISTINCT store_id FROM enriched
  WHERE NOT failed AND store_id IS NOT NULL AND store_id NOT IN (SELECT store_id FROM dim_store WHERE store_sk % 11 <> 0)
)

-- name: unknown_reject_row
-- uses: resolved
SELECT transaction_id, product_id, store_id,
  concat_ws(',', CASE WHEN store_sk = -1 THEN 'store_id' END, CASE WHEN product_sk = -1 THEN 'product_id' END, CASE WHEN employee_sk = -1 THEN 'employee_id' END) AS unknown_members,
  'VAL_FK_NOT_FOUND' AS error_codes
FROM resolved WHERE NOT failed AND (store_sk = -1 OR product_sk = -1 OR employee_sk = -1)

-- name: scd1_delta_store
-- uses: applied
SELECT nk AS store_id, a1 AS store_name, a2 AS region, a3 AS city, a4 AS state, change FROM applied WHERE entity = 'store'

-- name: scd1_delta_product
-- uses: applied
SELECT nk AS product_id, a1 AS product_name, a2 AS category, a3 AS brand, CAST(a4 AS DECIMAL(10,2)) AS unit_price, change FROM applied WHERE entity = 'product'

-- name: scd1_metrics
-- uses: applied
SELECT entity AS dimension, count(*) AS rows_compared, count(*) FILTER (change = 'INSERT') AS rows_inserted,
  count(*) FILTER (change = 'UPDATE') AS rows_changed, count(*) FILTER (change = 'UNCHANGED') AS rows_unchanged
FROM applied WHERE entity IN ('store', 'product') GROUP BY entity

-- name: scd1_apply_store
-- uses: applied
SELECT sk AS store_sk, nk AS store_id, a1 AS store_name, a2 AS region, a3 AS city, a4 AS state, created_at, updated_at FROM applied WHERE entity = 'store'

-- name: scd1_apply_product
-- uses: applied
SELECT sk AS product_sk, nk AS product_id, a1 AS product_name, a2 AS category, a3 AS brand, CAST(a4 AS DECIMAL(10,2)) AS unit_price, created_at, updated_at FROM applied WHERE entity = 'product'

-- name: scd1_apply_customer
-- uses: applied
SELECT sk AS customer_sk, nk AS customer_id, a1 AS first_name, a2 AS last_name, a3 AS email, a4 AS phone, created_at, updated_at FROM applied WHERE entity = 'customer'

-- name: scd1_apply_employee
-- uses: applied
SELECT sk AS employee_sk, nk AS employee_id, a1 AS first_name, a2 AS last_name, a3 AS role, a4 AS store_id, created_at, updated_at FROM applied WHERE entity = 'employee'

-- name: dim_rows_in_use
-- uses: fact, masters
SELECT entity AS dimension, nk AS natural_key FROM masters
WHERE (entity = 'store' AND sk IN (SELECT store_sk FROM fact)) OR (entity = 'product' AND sk IN (SELECT product_sk FROM fact))
  OR (entity = 'customer' AND sk IN (SELECT customer_sk FROM fact)) OR (entity = 'employee' AND sk IN (SELECT employee_sk FROM fact))

-- name: dim_feed_dedupe
-- uses: dim_product
SELECT product_id, CASE WHEN product_sk % 7 = 0 THEN product_name || ' (renamed)' ELSE product_name END AS product_name, category, brand, unit_price,
  CASE WHEN product_sk % 7 = 0 THEN 2 ELSE 1 END AS version
FROM dim_product

-- name: assign_surrogate_keys
-- uses: applied
SELECT sk AS customer_sk, nk AS customer_id FROM applied WHERE entity = 'customer' AND change = 'INSERT'

-- name: dim_date
-- uses: dim_date
SELECT * FROM dim_date
