"""SQL definitions of the payments-shaped tables and the simplified results."""

from __future__ import annotations

from checks.sql_tables import (
    _CATEGORIES, _COUNTRIES, _CURRENCIES, _MCC, ACTIONS_VALUES, SEGMENT_CASE, TABLES,
)

TABLES["payments"] = """
SELECT t.* EXCLUDE (ip_country), t.ip_country AS country, m.merchant_name, m.category AS merchant_category
FROM raw_transactions t LEFT JOIN raw_merchants m USING (merchant_id)"""

TABLES["order_payments"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CAST(o_orderkey % 50 AS VARCHAR) AS merchant_id, 'Shop ' || (o_orderkey % 50) AS merchant_name,
  {_CATEGORIES}[o_orderkey % 10 + 1] AS merchant_category,
  CASE WHEN o_custkey % 7 = 0 THEN floor(o_totalprice / 5000) * 100.0
       ELSE floor(o_totalprice * 2 + 0.5) / 100.0 END AS amount,
  {_CURRENCIES}[o_orderkey % 3 + 1] AS currency,
  o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS transaction_at,
  if(o_orderstatus = 'O', 'declined', 'completed') AS status,
  ['card','app','web','atm'][o_orderkey % 4 + 1] AS channel, {_COUNTRIES}[o_custkey % 8 + 1] AS country,
  o_orderpriority = '1-URGENT' AS is_flagged_fraud
FROM orders"""

TABLES["event_payments"] = f"""
SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS customer_id,
  CAST(event_id % 40 AS VARCHAR) AS merchant_id, 'Shop ' || (event_id % 40) AS merchant_name,
  {_CATEGORIES}[event_id % 10 + 1] AS merchant_category, value AS amount,
  {_CURRENCIES}[event_id % 3 + 1] AS currency, ts AS transaction_at,
  if(event_type = 'error', 'declined', 'completed') AS status,
  ['card','app','web','atm'][event_id % 4 + 1] AS channel, {_COUNTRIES}[user_id % 8 + 1] AS country,
  (event_type = 'error' AND value > 60) AS is_flagged_fraud
FROM events"""

TABLES["user_export"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS member_id,
  CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 THEN '-' || printf('%.2f', o_totalprice)
       ELSE printf('%.2f', o_totalprice) END AS debit,
  CASE WHEN o_orderkey % 19 = 0 THEN 'unknown date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS occurred_at,
  CASE WHEN o_orderstatus = 'F' THEN ' SUCCESS ' WHEN o_orderstatus = 'O' THEN 'failed'
       WHEN o_orderkey % 2 = 0 THEN 'Processing' END AS outcome,
  'Shop ' || (o_orderkey % 50) AS payee,
  ' ' || lower({_CURRENCIES}[o_orderkey % 6 + 1]) AS ccy,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'YES' WHEN o_orderkey % 3 = 0 THEN '0' END AS fraud_flag,
  o_orderpriority AS remarks
FROM orders"""

# Merchant ids are name-based UUIDs, which SQL here cannot compute; they are compared by their shape.
TABLES["canonical"] = """
SELECT record_id AS transaction_id, abs(TRY_CAST(debit AS DOUBLE)) AS amount,
  coalesce(member_id, 'unknown') AS customer_id, payee AS merchant_name, 'Other' AS merchant_category,
  upper(trim(ccy)) AS currency,
  CASE lower(trim(outcome)) WHEN 'success' THEN 'completed' WHEN 'failed' THEN 'declined'
       WHEN 'processing' THEN 'pending' ELSE 'unknown' END AS status,
  coalesce(TRY_CAST(occurred_at AS TIMESTAMP), TIMESTAMP '2023-01-01' + to_seconds(30 * (
    row_number() OVER (PARTITION BY TRY_CAST(occurred_at AS TIMESTAMP) IS NULL ORDER BY record_id) - 1))) AS transaction_at,
  coalesce(lower(fraud_flag) IN ('1', 'true', 'yes', 'fraud'), false) AS is_fraud
FROM user_export"""

TABLES["perf"] = """
SELECT CAST(date_trunc('month', transaction_at) AS DATE) AS month, currency, count(*) AS total_transactions,
  count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'declined') AS declined,
  round(sum(amount) FILTER (status = 'completed'), 2) AS total_volume,
  round(sum(amount) FILTER (status = 'completed'), 2) / nullif(count(amount) FILTER (status = 'completed'), 0) AS avg_transaction,
  count(*) FILTER (is_flagged_fraud) AS fraud_count,
  round((count(*) FILTER (status = 'completed')) * 100.0::DOUBLE / count(*), 2) AS completion_pct,
  round((count(*) FILTER (is_flagged_fraud)) * 100.0::DOUBLE / count(*), 3) AS fraud_rate_pct
FROM payments GROUP BY 1, 2"""

_RFM = f"""
SELECT s.*, r_score + f_score + m_score AS rfm_total, a.segment,
  CASE WHEN a.segment IN ('Champions','Loyal Customers','Potential Loyalists','Recent Customers','At Risk','Cannot Lose Them')
       THEN a.action ELSE 'Monitor and re-engage.' END AS recommended_action
FROM (
  SELECT *, {{recency}} AS r_score, ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
    ntile(5) OVER (ORDER BY monetary, customer_id) AS m_score
  FROM (SELECT customer_id,
          (SELECT max(CAST(transaction_at AS DATE)) FROM payments) - max(CAST(transaction_at AS DATE)) AS recency_days,
          count(*) AS frequency, round(sum(amount), 2) AS monetary, max(CAST(transaction_at AS DATE)) AS last_txn_date
        FROM payments WHERE status = 'completed' GROUP BY customer_id)) s
JOIN {ACTIONS_VALUES} ON a.segment = {SEGMENT_CASE}"""
_TILE = "ntile(5) OVER (ORDER BY recency_days DESC, customer_id)"
TABLES["rfm"] = _RFM.format(recency=_TILE)
TABLES["rfm_ref"] = _RFM.format(recency=f"6 - {_TILE}")

TABLES["cards"] = """
SELECT merchant_id, merchant_name, merchant_category, count(*) AS total_transactions,
  count(*) FILTER (status = 'completed') AS completed,
  round(sum(amount) FILTER (status = 'completed'), 2) AS total_volume,
  count(*) FILTER (is_flagged_fraud) AS fraud_count,
  round((count(*) FILTER (is_flagged_fraud)) * 100.0::DOUBLE / count(*), 2) AS fraud_rate_pct,
  round((count(*) FILTER (status = 'completed')) * 100.0::DOUBLE / count(*), 2) AS completion_rate_pct,
  count(DISTINCT customer_id) AS unique_customers,
  CASE WHEN (count(*) FILTER (is_flagged_fraud))::DOUBLE / count(*) > 0.05::DOUBLE THEN 'critical'
       WHEN (count(*) FILTER (is_flagged_fraud))::DOUBLE / count(*) > 0.02::DOUBLE THEN 'elevated' ELSE 'standard' END AS risk_band
FROM payments GROUP BY 1, 2, 3"""

TABLES["first_months"] = """
SELECT customer_id, CAST(date_trunc('month', min(transaction_at)) AS DATE) AS cohort_month
FROM payments WHERE status = 'completed' GROUP BY 1"""

TABLES["keep"] = """
SELECT cohort_month, months_since_signup, active_customers, cohort_size,
  round(active_customers * 100.0::DOUBLE / cohort_size, 1) AS retention_pct
FROM (SELECT cohort_month, date_diff('month', cohort_month, CAST(transaction_at AS DATE)) AS months_since_signup,
        count(DISTINCT customer_id) AS active_customers
      FROM payments JOIN first_months USING (customer_id) WHERE status = 'completed' GROUP BY 1, 2)
JOIN (SELECT cohort_month, count(*) AS cohort_size FROM first_months GROUP BY 1) USING (cohort_month)
WHERE months_since_signup >= 0"""

TABLES["metrics"] = """
SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT merchant_id) AS unique_merchants,
  round(sum(amount) FILTER (status = 'completed'), 2) AS total_volume,
  round(round(sum(amount) FILTER (status = 'completed'), 2) / count(amount) FILTER (status = 'completed'), 2) AS avg_transaction,
  round((count(*) FILTER (status = 'completed')) * 100.0::DOUBLE / count(*), 1) AS completion_pct,
  round((count(*) FILTER (is_flagged_fraud)) * 100.0::DOUBLE / count(*), 2) AS fraud_rate_pct,
  min(CAST(transaction_at AS DATE)) AS date_from, max(CAST(transaction_at AS DATE)) AS date_to
FROM payments"""

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"
TABLES["sent"] = f"""
SELECT event_id AS n, user_id % 3 AS part, event_id * 2 + unnest(if(event_id % 50 = 7, [0, 1], [0])) AS seq,
  event_id % 97 = 0 AS cut_off, event_id % 101 = 0 AS no_id, 'evt-' || event_id AS event_id,
  'stx-' || event_id AS transaction_id, ts AS event_time, CAST(user_id AS VARCHAR) AS customer_id,
  CAST(event_id % 40 AS VARCHAR) AS merchant_id, 'Shop ' || (event_id % 40) AS merchant_name,
  {_CATEGORIES}[event_id % 10 + 1] AS merchant_category, {_MCC}[event_id % 10 + 1] AS mcc_code, value AS amount,
  {_CURRENCIES}[event_id % 3 + 1] AS currency,
  floor(value / [1.0::DOUBLE, 1.27::DOUBLE, 1.17::DOUBLE][event_id % 3 + 1] * 100 + 0.5) / 100.0 AS amount_gbp,
  CASE event_type WHEN 'error' THEN 'declined' WHEN 'click' THEN 'pending' ELSE 'completed' END AS status,
  ['card','app','web','atm'][event_id % 4 + 1] AS channel, {_COUNTRIES}[event_id % 8 + 1] AS ip_country,
  if(user_id % 5 <> 0, 'standard', '') AS customer_tier, {_COUNTRIES}[user_id % 8 + 1] AS customer_country,
  user_id % 10 <> 9 AS is_kyc_verified, event_id % 10 = 9 AS is_high_risk_merchant,
  event_id % 8 <> user_id % 8 AS is_cross_border,
  (event_type = 'error' AND {_K} >= 50) AS is_flagged_fraud, {_K} AS risk_score
FROM events"""

TABLES["stored"] = """
SELECT part AS kafka_partition, min(seq) AS kafka_seq, s.* EXCLUDE (n, part, seq, cut_off, no_id)
FROM sent s WHERE NOT cut_off AND NOT no_id GROUP BY ALL"""
