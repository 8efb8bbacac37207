-- name: report_region_store
-- uses: fact, dim_store
SELECT region, store_name, total_transactions, total_units_sold, total_net_revenue,
  CAST(CAST(CASE WHEN c < 0 THEN -((2 * -c + n) // (2 * n)) ELSE (2 * c + n) // (2 * n) END AS DECIMAL(26,0)) * 0.01 AS DECIMAL(28,2)) AS avg_transaction_line_value
FROM (
  SELECT region, store_name, count(DISTINCT transaction_id) AS total_transactions, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS total_net_revenue, CAST(sum(net_sales_amount) * 100 AS HUGEINT) AS c, count(*) AS n
  FROM fact JOIN dim_store USING (store_sk) GROUP BY region, store_name
)

-- name: report_top5_products
-- uses: fact, dim_product
SELECT category, product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS category_revenue
FROM fact JOIN (SELECT product_sk, category, product_name FROM dim_product) USING (product_sk)
GROUP BY category, product_name ORDER BY category_revenue DESC, category, product_name LIMIT 5

-- name: report_audit_by_status
-- uses: runs
SELECT pipeline_name, execution_status AS status, count(*) AS total_runs, CAST(sum(records_read) AS BIGINT) AS aggregate_rows_read,
  CAST(sum(records_loaded) AS BIGINT) AS aggregate_rows_loaded, CAST(sum(records_rejected) AS BIGINT) AS aggregate_rows_rejected,
  CAST(CAST((2 * sum(duration_ms) + count(*)) // (2 * count(*)) AS DECIMAL(26,0)) * 0.001 AS DECIMAL(18,3)) AS avg_run_duration_sec
FROM runs GROUP BY pipeline_name, execution_status

-- name: report_daily_store
-- uses: fact, dim_date, dim_store
SELECT calendar_date, store_id, store_name, count(DISTINCT transaction_id) AS total_orders, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS daily_revenue
FROM fact JOIN dim_date USING (date_sk) JOIN dim_store USING (store_sk)
WHERE calendar_date = DATE '1998-07-16' - INTERVAL 1 DAY GROUP BY ALL

-- name: report_top10_products
-- uses: fact, dim_product
SELECT product_id, product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS total_revenue
FROM fact JOIN (SELECT product_sk, product_id, product_name, category FROM dim_product) USING (product_sk)
GROUP BY product_id, product_name, category ORDER BY total_revenue DESC, product_id LIMIT 10

-- name: report_monthly
-- uses: fact, dim_date
SELECT year, month, month_name, count(DISTINCT transaction_id) AS order_volume, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS monthly_revenue
FROM fact JOIN dim_date USING (date_sk) GROUP BY year, month, month_name

-- name: report_monthly_growth
-- uses: fact, dim_date
SELECT year, month, monthly_revenue, previous_revenue, CAST(monthly_revenue - previous_revenue AS DECIMAL(28,2)) AS growth,
  CASE WHEN previous_revenue > 0 THEN CAST(CAST(CASE WHEN n < 0 THEN -((2 * -n + p) // (2 * p)) ELSE (2 * n + p) // (2 * p) END AS DECIMAL(26,0)) * 0.01 AS DECIMAL(18,2)) END AS growth_percent
FROM (
  SELECT *, CAST(previous_revenue * 100 AS HUGEINT) AS p, CAST((monthly_revenue - previous_revenue) * 100 AS HUGEINT) * 10000 AS n
  FROM (
    SELECT year, month, monthly_revenue, CASE WHEN lag(year * 12 + month) OVER w = year * 12 + month - 1 THEN lag(monthly_revenue) OVER w END AS previous_revenue
    FROM (SELECT year, month, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS monthly_revenue FROM fact JOIN dim_date USING (date_sk) GROUP BY year, month)
    WINDOW w AS (ORDER BY year * 12 + month)
  )
)

-- name: report_monthly_refreshed
-- uses: fact, dim_date
SELECT d.year, d.month, d.month_name, count(DISTINCT transaction_id) AS order_volume, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS monthly_revenue
FROM (SELECT *, CAST(transaction_time + CASE WHEN year(transaction_time) = 1997 AND day(transaction_time) % 3 = 1 THEN INTERVAL 31 DAY ELSE INTERVAL 0 DAY END AS DATE) AS t FROM fact)
JOIN dim_date d ON d.calendar_date = t GROUP BY d.year, d.month, d.month_name

-- name: report_employee
-- uses: fact, dim_employee
SELECT store_id, employee_id, first_name || ' ' || last_name AS employee_name, count(DISTINCT transaction_id) AS transactions_processed,
  CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS total_sales_generated
FROM fact JOIN dim_employee USING (employee_sk) GROUP BY ALL

-- name: report_repeat_customers
-- uses: fact, dim_customer
SELECT customer_id, first_name || ' ' || last_name AS customer_name, count(DISTINCT transaction_id) AS lifetime_orders,
  CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS lifetime_spend
FROM fact JOIN dim_customer USING (customer_sk) GROUP BY ALL HAVING count(DISTINCT transaction_id) > 1

-- name: report_weekend
-- uses: fact, dim_date
SELECT is_weekend, total_orders, total_revenue,
  CAST(CAST((2 * c + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(28,2)) AS avg_order_value
FROM (
  SELECT is_weekend, count(DISTINCT transaction_id) AS total_orders, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(net_sales_amount) * 100 AS HUGEINT) AS c, count(*) AS n
  FROM fact JOIN dim_date USING (date_sk) GROUP BY is_weekend
)

-- name: report_region
-- uses: fact, dim_store
SELECT region, store_count, regional_revenue,
  CAST(CAST((2 * CAST(regional_revenue * 100 AS HUGEINT) + store_count) // (2 * store_count) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(28,2)) AS avg_revenue_per_store
FROM (
  SELECT region, count(DISTINCT store_id) AS store_count, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS regional_revenue
  FROM fact JOIN dim_store USING (store_sk) GROUP BY region
)

-- name: report_category
-- uses: fact, dim_product
SELECT category, count(DISTINCT product_sk) AS distinct_products, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS total_category_revenue
FROM fact JOIN (SELECT product_sk, category FROM dim_product) USING (product_sk) GROUP BY category

-- name: report_store_aov
-- uses: fact, dim_store
SELECT store_name, CAST(CAST((2 * c + n) // (2 * n) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(28,2)) AS avg_line_item_value, total_discounts_given
FROM (
  SELECT store_name, CAST(sum(net_sales_amount) * 100 AS HUGEINT) AS c, count(*) AS n, CAST(sum(discount_amount) AS DECIMAL(28,2)) AS total_discounts_given
  FROM fact JOIN dim_store USING (store_sk) GROUP BY store_name
)

-- name: report_top10_stores
-- uses: fact, dim_store
SELECT store_id, store_name, city, state, CAST(sum(net_sales_amount) AS DECIMAL(28,2)) AS annual_store_revenue
FROM fact JOIN dim_store USING (store_sk) GROUP BY ALL ORDER BY annual_store_revenue DESC, store_id LIMIT 10
