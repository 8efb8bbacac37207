-- name: clean_feed
-- uses: cleaned
SELECT * EXCLUDE (failed) FROM cleaned

-- name: clean_documents
SELECT doc_id, CASE WHEN lower(t) IN ('', 'null', 'none', 'n/a', 'na', 'nan', 'undefined', '<null>', 'nil') THEN NULL ELSE t END AS text
FROM (
  SELECT doc_id, regexp_replace(regexp_replace(text, '^[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+|[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+$', '', 'g'), '[\x00-\x1F\x7F-\x{9F}]', '', 'g') AS t
  FROM documents
)

-- name: normalize_customers
-- uses: dim_customer
SELECT upper(trim(customer_id)) AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email, phone FROM dim_customer

-- name: normalize_feed
-- uses: normalized
SELECT * EXCLUDE (failed) FROM normalized

-- name: enrich_feed
-- uses: enriched
SELECT * EXCLUDE (failed) FROM enriched WHERE NOT failed

-- name: fact_sales
-- uses: fact
SELECT * FROM fact

-- name: redact_documents
SELECT doc_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '(password[''"]?[\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[:=][\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[''"]?)([^''"&\x09-\x0D\x1C-\x20\x{85}\p{Z}]+)', '\1********', 'gi'),
    '(postgres(?:ql)?://[^:]+:)([^@]+)(@)', '\1********\3', 'gi'),
    '(token[''"]?[\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[:=][\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[''"]?)([^''"&\x09-\x0D\x1C-\x20\x{85}\p{Z}]+)', '\1********', 'gi'),
    '(api_key[''"]?[\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[:=][\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[''"]?)([^''"&\x09-\x0D\x1C-\x20\x{85}\p{Z}]+)', '\1********', 'gi'),
    '(secret[''"]?[\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[:=][\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[''"]?)([^''"&\x09-\x0D\x1C-\x20\x{85}\p{Z}]+)', '\1********', 'gi') AS text
FROM documents

-- name: redaction_counts
SELECT source_table, count(*) AS texts, count(*) FILTER (
  regexp_matches(text, '((password|token|api_key|secret)[''"]?[\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[:=][\x09-\x0D\x1C-\x20\x{85}\p{Z}]*[''"]?)([^''"&\x09-\x0D\x1C-\x20\x{85}\p{Z}]+)', 'i')
  OR regexp_matches(text, 'postgres(?:ql)?://[^:]+:[^@]+@', 'i')) AS redacted
FROM (SELECT 'documents' AS source_table, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations)
GROUP BY source_table
