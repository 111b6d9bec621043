"""SQL definitions of the raw, staged and mart tables, written for the check engine.

``select(body)`` prepends the common table expressions a query mentions. Nothing here is
used by the library.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-12-01'"

_COUNTRIES = "['GB','US','FR','JP','BR','CA','KE','PL']"
_CURRENCIES = "['GBP','USD','EUR','SGD','AED','CAD']"
_CATEGORIES = (
    "['Books','ATM','Bakery','Cinema','Clothing','Transfer','Dentist','Garden','Hotel','Petrol']"
)
_MCC = "['5942','6011','5462','7922','5691','4829','8021','5261','7011','5542']"

TABLES: dict[str, str] = {}

TABLES["raw_lines"] = """
SELECT l.*, o.o_custkey, o.o_orderstatus,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'),
            CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS transaction_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

TABLES["raw_transactions"] = f"""
SELECT transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_suppkey AS VARCHAR) AS merchant_id,
  floor(l_extendedprice / 10 + 0.5) / 100.0 AS amount,
  {_CURRENCIES}[l_partkey % 6 + 1] AS currency,
  l_shipdate + to_seconds((l_partkey * 7919 + l_linenumber * 104729) % 86400) AS transaction_at,
  CASE WHEN o_orderstatus = 'O' AND l_linestatus = 'O' THEN 'declined'
       WHEN o_orderstatus = 'P' AND l_discount >= 0.09 THEN 'pending'
       WHEN o_orderstatus = 'F' AND l_tax >= 0.08 THEN 'failed' ELSE 'completed' END AS status,
  (l_returnflag = 'R' AND l_discount >= 0.09) AS is_flagged_fraud,
  ['card','app','web','atm'][l_linenumber % 4 + 1] AS channel,
  {_COUNTRIES}[(CASE WHEN l_partkey % 5 = 0 THEN l_partkey ELSE o_custkey END) % 8 + 1] AS ip_country
FROM raw_lines"""

TABLES["raw_customers"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name,
  '  ' || c_name || '@Example.COM ' AS email, printf('000-%07d', c_custkey) AS phone,
  {_COUNTRIES}[c_custkey % 8 + 1] AS country, c_mktsegment AS account_tier,
  DATE '1995-01-01' + CAST((c_custkey * 37) % 1400 AS INTEGER) AS signup_date,
  CASE c_custkey % 10 WHEN 8 THEN 'pending' WHEN 9 THEN 'failed' ELSE 'verified' END AS kyc_status,
  DATE '1930-01-01' + CAST((c_custkey * 101) % 18000 AS INTEGER) AS date_of_birth,
  {_CURRENCIES}[n_regionkey + 1] AS currency
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

TABLES["raw_merchants"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
  {_CATEGORIES}[s_suppkey % 10 + 1] AS category, {_MCC}[s_suppkey % 10 + 1] AS mcc_code,
  {_COUNTRIES}[s_nationkey % 8 + 1] AS country, s_acctbal < 0 AS is_high_risk,
  DATE '1992-01-01' + CAST((s_suppkey * 53) % 1000 AS INTEGER) AS onboarded_date
FROM supplier"""

TABLES["raw_fx_rates"] = """
SELECT CAST(d.first + CAST(d.n AS INTEGER) AS DATE) AS rate_date, r.currency,
  r.base * (1.0::DOUBLE + ((d.n * 37 + r.i * 11) % 101 - 50)::DOUBLE / 10000.0::DOUBLE) AS rate_to_gbp
FROM (SELECT first, unnest(range(0, last - first + 1)) AS n
      FROM (SELECT min(l_shipdate)::DATE AS first, max(l_shipdate)::DATE AS last FROM lineitem)) d
CROSS JOIN (VALUES ('GBP',0,1.0::DOUBLE),('USD',1,1.27::DOUBLE),('EUR',2,1.17::DOUBLE),
                   ('SGD',3,1.70::DOUBLE),('AED',4,4.66::DOUBLE),('CAD',5,1.73::DOUBLE)) r(currency, i, base)
WHERE d.n % 17 <> 16"""

TABLES["raw_disputes"] = f"""
SELECT 'd' || n || '-' || transaction_id AS dispute_id, transaction_id,
  CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_shipdate AS DATE) + n * 10 AS opened_at,
  ['stolen_card','charged_twice','never_arrived','wrong_price'][l_linenumber % 4 + 1] AS reason,
  ['won','lost','pending'][l_partkey % 3 + 1] AS status,
  floor(l_extendedprice / 10 + 0.5) / 100.0 AS amount, {_CURRENCIES}[l_partkey % 6 + 1] AS currency
FROM (SELECT *, unnest(CASE WHEN l_linenumber % 2 = 1 THEN [1, 2] ELSE [1] END) AS n FROM raw_lines
      WHERE l_returnflag = 'R' AND l_tax >= 0.06 AND l_tax < 0.07)"""

TABLES["customers"] = f"""
SELECT customer_id, full_name, lower(trim(email)) AS email, phone, country AS country_code, account_tier,
  signup_date, kyc_status, date_of_birth, currency AS account_currency,
  year({AS_OF}) - year(date_of_birth) AS age_years,
  kyc_status IS NOT DISTINCT FROM 'verified' AS is_kyc_verified
FROM raw_customers"""

TABLES["merchants"] = f"""
SELECT merchant_id, merchant_name, category AS merchant_category, mcc_code, country AS merchant_country,
  is_high_risk, onboarded_date, {AS_OF} - onboarded_date AS days_since_onboarding
FROM raw_merchants"""

TABLES["transactions"] = """
SELECT transaction_id, customer_id, merchant_id, amount, currency, transaction_at, status, is_flagged_fraud,
  channel, ip_country, CAST(transaction_at AS DATE) AS transaction_date,
  CAST(date_trunc('month', transaction_at) AS DATE) AS transaction_month,
  CAST(date_trunc('week', transaction_at) AS DATE) AS transaction_week,
  hour(transaction_at) AS transaction_hour, dayofweek(transaction_at) AS day_of_week,
  status = 'completed' AS is_completed, status = 'declined' AS is_declined,
  ip_country <> currency AS is_cross_border
FROM raw_transactions"""

TABLES["fx"] = """
SELECT rate_date, currency, rate_to_gbp, 1.0 / nullif(rate_to_gbp, 0) AS gbp_to_currency FROM raw_fx_rates"""

TABLES["disputes"] = """
SELECT dispute_id, transaction_id, customer_id, CAST(opened_at AS TIMESTAMP) AS opened_at,
  CAST(opened_at AS DATE) AS opened_date, reason, status, amount, currency,
  status = 'won' AS is_won, status = 'pending' AS is_pending
FROM raw_disputes"""

_ENRICHED = """
SELECT * EXCLUDE (cross_border), cross_border AS is_cross_border,
  CASE WHEN is_flagged_fraud THEN 'fraud_flagged'
       WHEN is_high_risk_merchant THEN if(cross_border, 'high_risk_cross_border', 'high_risk_merchant')
       ELSE if(cross_border, 'cross_border', 'standard') END AS risk_tier
FROM (
  SELECT t.* EXCLUDE (is_cross_border), {flag} AS cross_border,
    round(t.amount / nullif(coalesce(f.rate_to_gbp, 1.0), 0), 2) AS amount_gbp,
    m.merchant_name, m.merchant_category, m.mcc_code, m.merchant_country, m.is_high_risk AS is_high_risk_merchant,
    c.country_code AS customer_country, c.account_tier, c.is_kyc_verified, c.account_currency
  FROM transactions t
  LEFT JOIN fx f ON (f.rate_date, f.currency) = (t.transaction_date, t.currency)
  LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
  LEFT JOIN customers c ON c.customer_id = t.customer_id)"""
TABLES["enriched"] = _ENRICHED.format(flag="(t.ip_country <> c.country_code)")
TABLES["enriched_ref"] = _ENRICHED.format(flag="t.is_cross_border")

TABLES["summary"] = """
SELECT customer_id, account_tier, customer_country, is_kyc_verified,
  count(*) AS total_transactions, count(DISTINCT transaction_month) AS active_months,
  count(DISTINCT merchant_id) AS distinct_merchants, count(DISTINCT merchant_category) AS distinct_categories,
  round(sum(amount_gbp), 2) AS total_spend_gbp, round(sum(amount_gbp), 2) / count(amount_gbp) AS avg_transaction_gbp,
  max(amount_gbp) AS max_transaction_gbp, round(median(amount_gbp), 3) AS median_transaction_gbp,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
  max(transaction_date) - min(transaction_date) AS customer_tenure_days,
  count(*) FILTER (is_flagged_fraud) AS fraud_flagged_count, count(*) FILTER (is_cross_border) AS cross_border_count,
  count(*) FILTER (channel = 'app') AS app_txn_count, count(*) FILTER (channel = 'card') AS card_txn_count,
  count(*) FILTER (channel = 'web') AS web_txn_count,
  round(3.0::DOUBLE * count(DISTINCT transaction_month) + 2.0::DOUBLE * count(DISTINCT merchant_category)
        + 0.5::DOUBLE * least(count(*), 100), 1) AS engagement_score
FROM enriched WHERE is_completed
GROUP BY ALL"""

TABLES["performance"] = """
SELECT *, round(100.0::DOUBLE * total_volume_gbp / nullif(sum(total_volume_gbp) OVER (PARTITION BY month), 0), 2)
  AS pct_of_monthly_volume
FROM (
  SELECT transaction_month AS month, currency, channel, merchant_category, count(*) AS total_transactions,
    count(*) FILTER (is_completed) AS completed_transactions, count(*) FILTER (is_declined) AS declined_transactions,
    count(*) FILTER (status = 'pending') AS pending_transactions,
    round(sum(amount_gbp) FILTER (is_completed), 2) AS total_volume_gbp,
    round(sum(amount_gbp) FILTER (is_completed), 2) / nullif(count(amount_gbp) FILTER (is_completed), 0) AS avg_transaction_gbp,
    (count(*) FILTER (is_completed))::DOUBLE / count(*) AS completion_rate,
    count(*) FILTER (is_flagged_fraud) AS fraud_flagged_count,
    (count(*) FILTER (is_flagged_fraud))::DOUBLE / count(*) AS fraud_rate,
    count(*) FILTER (is_cross_border) AS cross_border_count
  FROM enriched GROUP BY 1, 2, 3, 4)"""

TABLES["disputes_by_customer"] = """
SELECT customer_id, count(*) AS total_disputes, count(*) FILTER (is_won) AS disputes_won,
  round(sum(amount), 2) AS total_disputed_amount
FROM disputes GROUP BY customer_id"""

_ZERO_WHEN_ABSENT = ", ".join(f"coalesce({c}, 0) AS {c}" for c in (
    "total_transactions", "active_months", "distinct_merchants", "distinct_categories", "customer_tenure_days",
    "fraud_flagged_count", "cross_border_count", "total_spend_gbp", "avg_transaction_gbp",
    "median_transaction_gbp", "engagement_score", "total_disputes", "disputes_won", "total_disputed_amount"))

TABLES["c360"] = f"""
SELECT c.customer_id, c.full_name, c.email, c.country_code, c.account_tier, c.signup_date, c.kyc_status,
  c.is_kyc_verified, c.account_currency, c.age_years, s.first_transaction_date, s.last_transaction_date,
  {_ZERO_WHEN_ABSENT},
  CAST(date_trunc('month', c.signup_date) AS DATE) AS signup_cohort,
  CASE WHEN s.total_spend_gbp >= 10000 THEN 'platinum' WHEN s.total_spend_gbp >= 3000 THEN 'gold'
       WHEN s.total_spend_gbp >= 500 THEN 'silver' ELSE 'bronze' END AS ltv_tier,
  CASE WHEN s.last_transaction_date IS NULL THEN 'churned'
       WHEN {AS_OF} - s.last_transaction_date > 60 THEN 'at_risk'
       WHEN {AS_OF} - s.last_transaction_date > 30 THEN 'cooling' ELSE 'active' END AS churn_risk_segment,
  {AS_OF} - c.signup_date AS days_since_signup
FROM customers c
LEFT JOIN (SELECT * EXCLUDE (account_tier, customer_country, is_kyc_verified) FROM summary) s USING (customer_id)
LEFT JOIN disputes_by_customer d USING (customer_id)"""

TABLES["retention"] = """
SELECT cohort_month, months_since_signup, active_customers, cohort_size,
  active_customers::DOUBLE / nullif(cohort_size, 0) AS retention_rate
FROM (
  SELECT cohort_month, date_diff('month', cohort_month, transaction_month) AS months_since_signup,
    count(DISTINCT customer_id) AS active_customers
  FROM (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month FROM customers)
  JOIN (SELECT customer_id, transaction_month FROM enriched WHERE is_completed) USING (customer_id)
  GROUP BY 1, 2)
JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month,
        count(DISTINCT customer_id) AS cohort_size FROM customers GROUP BY 1) USING (cohort_month)
WHERE months_since_signup >= 0"""

# fixed values: the rungs of the segment ladder, in order
SEGMENT_CASE = """
CASE WHEN r_score = 5 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
     WHEN f_score >= 4 AND m_score >= 3 THEN 'Loyal Customers'
     WHEN r_score >= 4 AND f_score >= 2 AND f_score <= 3 THEN 'Potential Loyalists'
     WHEN r_score >= 4 AND f_score = 1 THEN 'Recent Customers'
     WHEN r_score = 3 AND f_score >= 2 THEN 'Promising'
     WHEN r_score = 3 AND f_score = 1 AND m_score >= 3 THEN 'Need Attention'
     WHEN r_score = 2 AND f_score <= 2 THEN 'About to Sleep'
     WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
     WHEN r_score = 1 AND f_score >= 4 THEN 'Cannot Lose Them'
     WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Hibernating'
     WHEN r_score = 1 AND f_score = 1 THEN 'Lost' ELSE 'Others' END"""

# fixed values: group and wording per segment
ACTIONS_VALUES = """(VALUES
  ('Champions','High Value','Reward them. Ask for reviews. Upsell premium.'),
  ('Loyal Customers','High Value','Offer loyalty programme. Upsell higher tier.'),
  ('Potential Loyalists','Growth','Offer membership. Personalised recommendations.'),
  ('Recent Customers','Growth','Onboarding support. Build the habit.'),
  ('Promising','Growth','Create brand awareness. Free trials.'),
  ('Need Attention','Slipping','Reactivation campaign. Limited time offer.'),
  ('About to Sleep','Slipping','Reconnect. Share relevant products.'),
  ('At Risk','At Risk','Send personalised email. Win-back campaign.'),
  ('Cannot Lose Them','At Risk','Win back with renewals. Talk to them.'),
  ('Hibernating','Lost','Offer relevant products. Discounts.'),
  ('Lost','Lost','Revive interest with new offering or ignore.'),
  ('Others','Others','Monitor')) a(segment, segment_group, action)"""

_RFM_MART = """
SELECT s.customer_id, c.full_name, c.email, c.country_code, c.account_tier, c.account_currency, c.signup_date,
  c.is_kyc_verified, recency_days, frequency, monetary_gbp, last_transaction_date, r_score, f_score, m_score,
  r_score + f_score + m_score AS rfm_total, a.segment AS rfm_segment, a.segment_group, a.action AS recommended_action
FROM (
  SELECT *, {recency} AS r_score,
    ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
    ntile(5) OVER (ORDER BY monetary_gbp, customer_id) AS m_score
  FROM (SELECT customer_id, (SELECT max(transaction_date) FROM transactions) - max(transaction_date) AS recency_days,
          count(*) AS frequency, round(sum(amount_gbp), 2) AS monetary_gbp,
          max(transaction_date) AS last_transaction_date
        FROM enriched WHERE is_completed GROUP BY customer_id)) s
JOIN customers c USING (customer_id)
JOIN {actions} ON a.segment = {segment}"""
_TILE = "ntile(5) OVER (ORDER BY recency_days DESC, customer_id)"
TABLES["rfm_mart"] = _RFM_MART.format(recency=_TILE, actions=ACTIONS_VALUES, segment=SEGMENT_CASE)
TABLES["rfm_mart_ref"] = _RFM_MART.format(recency=f"6 - {_TILE}", actions=ACTIONS_VALUES, segment=SEGMENT_CASE)

_FRAUD_EVENTS = """
SELECT f.transaction_id, f.customer_id, f.merchant_id, f.amount_gbp, f.currency, f.transaction_at, f.transaction_date,
  f.channel, f.ip_country, f.customer_country, f.account_tier, f.is_kyc_verified, f.merchant_category, f.mcc_code,
  f.is_high_risk_merchant, f.is_cross_border, f.risk_tier, f.status,
  d.dispute_id IS NOT NULL AS has_dispute, d.dispute_id, d.reason AS dispute_reason, d.status AS dispute_status,
  count(*) OVER (PARTITION BY f.customer_id ORDER BY f.transaction_at
                 RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS customer_fraud_velocity_30d
FROM enriched f LEFT JOIN disputes d USING (transaction_id)
WHERE f.is_flagged_fraud"""
TABLES["fraud_events"] = _FRAUD_EVENTS

TABLES["scorecard"] = """
SELECT m.merchant_id, m.merchant_name, m.merchant_category, m.mcc_code, m.merchant_country, m.is_high_risk,
  m.onboarded_date, coalesce(n, 0) AS total_transactions, coalesce(done, 0) AS completed_transactions,
  coalesce(fraud, 0) AS fraud_flagged_count, coalesce(people, 0) AS unique_customers,
  coalesce(disputed, 0) AS total_disputes, coalesce(volume, 0) AS total_volume_gbp,
  coalesce(volume / nullif(priced, 0), 0) AS avg_transaction_gbp, coalesce(disputed_amount, 0) AS total_disputed_amount,
  fraud::DOUBLE / nullif(n, 0) AS fraud_rate, disputed::DOUBLE / nullif(done, 0) AS dispute_rate,
  done::DOUBLE / nullif(n, 0) AS completion_rate,
  round(least(100.0::DOUBLE, coalesce(fraud::DOUBLE / nullif(n, 0), 0) * 4000.0::DOUBLE
    + coalesce(disputed::DOUBLE / nullif(done, 0), 0) * 3000.0::DOUBLE + if(m.is_high_risk, 20.0, 0.0)::DOUBLE), 1) AS risk_score,
  CASE WHEN m.is_high_risk OR coalesce(fraud::DOUBLE / nullif(n, 0), 0) > 0.05::DOUBLE THEN 'critical'
       WHEN coalesce(fraud::DOUBLE / nullif(n, 0), 0) > 0.02::DOUBLE THEN 'elevated' ELSE 'standard' END AS risk_band
FROM merchants m
LEFT JOIN (SELECT merchant_id, count(*) AS n, count(*) FILTER (is_completed) AS done,
    count(*) FILTER (is_flagged_fraud) AS fraud, count(DISTINCT customer_id) AS people,
    round(sum(amount_gbp) FILTER (is_completed), 2) AS volume, count(amount_gbp) FILTER (is_completed) AS priced
  FROM enriched GROUP BY 1) s ON s.merchant_id = m.merchant_id
LEFT JOIN (SELECT t.merchant_id, count(DISTINCT dispute_id) AS disputed, round(sum(d.amount), 2) AS disputed_amount
  FROM disputes d JOIN transactions t USING (transaction_id) GROUP BY 1) d ON d.merchant_id = m.merchant_id"""


def select(body: str, **extra: str) -> str:
    """``body`` preceded by the definitions of all tables it mentions, in order."""
    known = TABLES | extra
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "", sql)):
                if known[name] is sql:
                    continue
                visit(known[name])
                needed[name] = None

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({known[name].strip()})" for name in needed)
    return f"WITH {parts}\n{body.strip()}"
