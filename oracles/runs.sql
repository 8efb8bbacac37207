-- name: reconciliation
-- uses: flagged, fact
SELECT 'run-0001' AS run_id, n AS source_rows, n - f AS validated_rows, l AS transformed_rows, l AS loaded_rows, f AS rejected_rows, r AS duplicate_rows, n - f = l AS is_reconciled
FROM (SELECT count(*) AS n, count(*) FILTER (failed) AS f, count(*) FILTER (repeated) AS r FROM flagged), (SELECT count(*) AS l FROM fact)

-- name: load_report
-- uses: applied, flagged, fact
SELECT 'run-0001' AS run_id,
  (SELECT count(*) FROM applied WHERE entity IN ('store', 'product') AND change = 'INSERT') AS dimensions_inserted,
  (SELECT count(*) FROM applied WHERE entity IN ('store', 'product') AND change = 'UPDATE') AS dimensions_updated,
  (SELECT count(*) FROM applied WHERE entity IN ('store', 'product') AND change = 'UNCHANGED') AS dimensions_unchanged,
  n AS facts_loaded,
  (SELECT count(*) FROM flagged WHERE failed) AS facts_rejected,
  (n + 9999) // 10000 AS batches_processed
FROM (SELECT count(*) AS n FROM fact)

-- name: transformation_report
-- uses: resolved
SELECT 'run-0001' AS run_id, count(*) AS rows_received, count(*) AS rows_transformed, CAST(0 AS BIGINT) AS rows_skipped, count(*) AS facts_generated,
  count(*) FILTER (store_sk = -1) + count(*) FILTER (product_sk = -1) + count(*) FILTER (employee_sk = -1) + count(*) FILTER (date_sk = 19700101) AS lookup_failures
FROM resolved WHERE NOT failed

-- name: stage_durations
-- uses: audit_events
SELECT run_id,
  CAST(coalesce(sum(duration_ms) FILTER (stage = 'click'), 0) AS DECIMAL(18,2)) AS click_ms,
  CAST(coalesce(sum(duration_ms) FILTER (stage = 'error'), 0) AS DECIMAL(18,2)) AS error_ms,
  CAST(coalesce(sum(duration_ms) FILTER (stage = 'purchase'), 0) AS DECIMAL(18,2)) AS purchase_ms,
  CAST(coalesce(sum(duration_ms) FILTER (stage = 'signup'), 0) AS DECIMAL(18,2)) AS signup_ms,
  CAST(coalesce(sum(duration_ms) FILTER (stage = 'view'), 0) AS DECIMAL(18,2)) AS view_ms,
  CAST(sum(duration_ms) AS DECIMAL(18,2)) AS total_ms
FROM audit_events GROUP BY run_id

-- name: execution_summary
-- uses: audit_events
SELECT run_id, start_time, end_time, rows_processed, rows_loaded, rows_rejected, warnings_count, rows_rejected AS errors_count, duration_ms,
  CASE WHEN duration_ms > 0 THEN CAST(CAST((200000 * rows_loaded + duration_ms) // (2 * duration_ms) AS DECIMAL(26,0)) * 0.01 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS throughput_rows_per_sec,
  CASE WHEN 2 * rows_rejected > rows_processed THEN 'FAILED' ELSE 'SUCCESS' END AS final_status,
  'RECONCILED' AS reconciliation_status
FROM (
  SELECT run_id, min(event_time) AS start_time, max(event_time) AS end_time, count(*) AS rows_processed,
    count(*) FILTER (severity <> 'ERROR') AS rows_loaded, count(*) FILTER (severity = 'ERROR') AS rows_rejected,
    count(*) FILTER (severity = 'WARNING') AS warnings_count,
    CAST((epoch_us(max(event_time)) - epoch_us(min(event_time))) // 1000 AS BIGINT) AS duration_ms
  FROM audit_events GROUP BY run_id
)

-- name: execution_timeline
-- uses: audit_events
SELECT run_id, event_time, event_id, event_name, severity, duration_ms FROM audit_events

-- name: latest_watermark
-- uses: done
SELECT coalesce(max(processed_at), TIMESTAMP '1970-01-01') AS watermark FROM done

-- name: store_watermark
-- uses: flagged
SELECT 'sales' AS entity_name, store_id, max(t_ts) AS last_processed_timestamp FROM flagged WHERE NOT failed GROUP BY store_id

-- name: audit_recent_runs
-- uses: runs
SELECT pipeline_run_id, execution_status, records_loaded, started_at FROM runs ORDER BY started_at DESC, pipeline_run_id LIMIT 10

-- name: audit_failed_runs
-- uses: runs
SELECT pipeline_run_id, execution_status, records_rejected AS error_count, started_at FROM runs WHERE execution_status = 'FAILED'

-- name: audit_get_run
-- uses: runs
SELECT * FROM runs WHERE pipeline_run_id = 'RUN-7-20240110'

-- name: audit_event_counts
-- uses: audit_events
SELECT event_name, severity, count(*) AS events, CAST(sum(duration_ms) AS DECIMAL(18,2)) AS duration_ms,
  event_name IN ('PIPELINE_STARTED', 'HEALTH_CHECK_COMPLETED', 'VALIDATION_STARTED', 'VALIDATION_COMPLETED', 'TRANSFORMATION_STARTED', 'TRANSFORMATION_COMPLETED',
    'LOADING_STARTED', 'LOADING_COMPLETED', 'WATERMARK_UPDATED', 'RECONCILIATION_COMPLETED', 'PIPELINE_COMPLETED', 'PIPELINE_FAILED') AS is_declared
FROM audit_events GROUP BY event_name, severity

-- name: audit_alerts
-- uses: audit_events
SELECT event_id, run_id, event_name, severity, event_time FROM audit_events WHERE severity IN ('ERROR', 'CRITICAL')

-- name: audit_events_json
-- uses: audit_events
SELECT event_id, CAST(to_json({
  'timestamp': CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN strftime(event_time, '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), '0') END,
  'level': severity, 'module': 'audit', 'function': 'record_event', 'line': event_id, 'message': event_name,
  'pipeline_run_id': CAST(run_id AS VARCHAR), 'batch_id': 'BATCH-1', 'source_filename': 'events', 'execution_stage': event_name,
  'environment': 'testing', 'application_version': '0.1.0'}) AS VARCHAR) AS log_line
FROM audit_events

-- name: files_already_processed
-- uses: incoming, done
SELECT doc_id, file_name, file_hash FROM incoming WHERE file_hash IN (SELECT file_hash FROM done)

-- name: classify_files
-- uses: classified
SELECT doc_id, file_name, file_hash, classification FROM classified

-- name: incr_timestamp
-- uses: incoming, done
SELECT doc_id, file_name, file_hash, batch_id, file_time FROM incoming WHERE file_time > (SELECT max(processed_at) FROM done)

-- name: incr_file_hash
-- uses: incoming, done
SELECT doc_id, file_name, file_hash, batch_id, file_time FROM incoming WHERE file_hash NOT IN (SELECT file_hash FROM done)

-- name: incr_batch_id
-- uses: incoming, done
SELECT doc_id, file_name, file_hash, batch_id, file_time FROM incoming WHERE batch_id NOT IN (SELECT batch_id FROM done)

-- name: incr_composite
-- uses: incoming, done
SELECT doc_id, file_name, file_hash, batch_id, file_time FROM incoming
WHERE file_time > (SELECT max(processed_at) FROM done) AND file_hash NOT IN (SELECT file_hash FROM done)

-- name: incr_full_reload
-- uses: incoming
SELECT doc_id, file_name, file_hash, batch_id, file_time FROM incoming

-- name: watermark_upsert
-- uses: classified, done
SELECT file_hash, file_name, processed_at, loads, CASE WHEN loads > 1 THEN 'REPROCESSED' ELSE 'SUCCESS' END AS status FROM (
  SELECT file_hash, file_name, max(processed_at) OVER w AS processed_at, count(*) OVER w AS loads,
    row_number() OVER (PARTITION BY file_hash ORDER BY processed_at, file_name) AS rn
  FROM (
    SELECT file_hash, file_name, processed_at FROM done
    UNION ALL SELECT file_hash, file_name, TIMESTAMP '2026-12-01 00:00:00' FROM classified WHERE classification IN ('NEW', 'MODIFIED', 'REPROCESS')
  ) WINDOW w AS (PARTITION BY file_hash)
) WHERE rn = 1

-- name: incremental_report
-- uses: classified, done
SELECT 'FILE_HASH' AS strategy_used, (SELECT max(processed_at) FROM done) AS watermark_before, TIMESTAMP '2026-12-01 00:00:00' AS watermark_after,
  count(*) FILTER (classification IN ('NEW', 'MODIFIED', 'REPROCESS')) AS files_processed,
  count(*) FILTER (classification = 'DUPLICATE') AS files_skipped,
  count(*) FILTER (classification = 'DUPLICATE') AS duplicate_count,
  count(*) FILTER (classification = 'REPROCESS') AS replay_count,
  count(*) FILTER (classification = 'STALE') AS stale_count,
  count(*) FILTER (classification = 'MODIFIED') AS modified_count
FROM classified

-- name: rows_after_store_watermark
-- uses: cleaned
SELECT transaction_id, store_id, product_id, transaction_time FROM (
  SELECT *, max(CASE WHEN ts < TIMESTAMP '2000-01-01' THEN ts END) OVER (PARTITION BY store_id) AS mark
  FROM (SELECT *, CAST(transaction_time AS TIMESTAMP) AS ts FROM cleaned WHERE NOT failed)
) WHERE mark IS NULL OR ts > mark

-- name: replay_selection
-- uses: incoming, registry
SELECT doc_id, file_name, file_hash, CASE WHEN is_present THEN 'REPROCESS' ELSE 'STALE' END AS classification
FROM incoming WHERE file_hash IN (SELECT file_hash FROM registry WHERE run_id = 'RUN-4')

-- name: idempotent_reload
-- uses: fact_month
SELECT 'complete' AS table_state, CAST(0 AS BIGINT) AS rows_added
UNION ALL
SELECT 'month_lost', count(*) FROM fact_month n WHERE NOT EXISTS (
  SELECT 1 FROM fact_month o WHERE o.tx_month <> '1998-07' AND o.transaction_id = n.transaction_id AND o.product_sk = n.product_sk)

-- name: reload_corrected
-- uses: fact_month
SELECT strftime(t, '%Y-%m') AS tx_month, CAST(CASE kind WHEN 2 THEN 1 ELSE 2 END AS BIGINT) AS audit_run_id, count(*) AS rows,
  CAST(sum(quantity + CASE kind WHEN 0 THEN 1 ELSE 0 END) AS BIGINT) AS quantity
FROM (SELECT *, day(transaction_time) % 3 AS kind,
  transaction_time + CASE day(transaction_time) % 3 WHEN 1 THEN INTERVAL 31 DAY ELSE INTERVAL 0 DAY END AS t FROM fact_month)
GROUP BY 1, 2

-- name: reload_with_lines_left_out
-- uses: fact_month
SELECT tx_month, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS quantity
FROM fact_month WHERE store_sk % 2 <> 0 OR day(transaction_time) % 2 = 0 GROUP BY tx_month

-- name: stream_validate_feed
-- uses: flagged
SELECT transaction_id, store_id, product_id, employee_id, customer_id, quantity, unit_price, discount_amount, transaction_time, error_codes FROM flagged

-- name: stream_validate_csv
-- uses: flagged
SELECT transaction_id, store_id, product_id, employee_id, customer_id, quantity, unit_price, discount_amount, transaction_time, error_codes FROM flagged

-- name: stream_dedupe
-- uses: feed
SELECT DISTINCT transaction_id, product_id FROM feed
