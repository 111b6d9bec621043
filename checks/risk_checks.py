"""Fraud features, reasons, drift, compliance and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_payments  # noqa: F401 - adds its tables
from checks.registry import Context, register
from checks.sql_tables import select
from ledgerlens.operators import compliance, drift, fraud, quality

# ---- features and rules ----------------------------------------------------------

register(
    "fraud_features",
    lambda c: fraud.fraud_features(c.tables.payments).withColumn("amount_log", F.round("amount_log", 9)),
    select("""SELECT transaction_id, amount, round(ln(1 + amount), 9) AS amount_log, hour(transaction_at) AS hour,
  isodow(transaction_at) - 1 AS day_of_week, if(isodow(transaction_at) > 5, 1, 0) AS is_weekend,
  if(hour(transaction_at) < 6 OR hour(transaction_at) > 22, 1, 0) AS is_night,
  row_number() OVER (PARTITION BY customer_id ORDER BY transaction_at, transaction_id) AS customer_txn_count,
  dense_rank() OVER (ORDER BY merchant_category) - 1 AS merchant_category_enc,
  dense_rank() OVER (ORDER BY channel) - 1 AS channel_enc, CAST(is_flagged_fraud AS INTEGER) AS label FROM payments"""),
)
register(
    "fraud_features_one_customer",
    lambda c: fraud.fraud_features(
        c.tables.payments.withColumns({"customer_id": F.lit("c"), "transaction_at": F.lit(None).cast("timestamp")}), hot_limit=100
    ).select("transaction_id", "customer_txn_count"),
    select("SELECT transaction_id, row_number() OVER (ORDER BY transaction_id) AS customer_txn_count FROM payments"),
)
register(
    "fraud_detection_mode", lambda c: fraud.detection_mode(c.tables.payments),
    select("SELECT if(bool_or(is_flagged_fraud), 'supervised', 'unsupervised') AS mode FROM payments"),
)

REASONS = """
SELECT transaction_id, customer_id, amount,
  concat_ws('|', if(amount > 3 * mid, 'HIGH_AMOUNT', NULL), if(hour(transaction_at) < 4, 'ODD_HOURS', NULL),
    if(regexp_matches(merchant_category, '(?i)transfer|atm|crypto'), 'HIGH_RISK_MERCHANT_CATEGORY', NULL),
    if(country <> home AND length(country) = 2, 'CROSS_BORDER_MISMATCH', NULL), if(same_day > 5, 'HIGH_VELOCITY', NULL)) AS risk_signals,
  concat_ws('|',
    if(amount > 3 * mid, format('Amount ${:.2f} is {}% above median transaction', amount, CAST(floor((amount / mid - 1) * 100) AS BIGINT)), NULL),
    if(hour(transaction_at) < 4, format('Transaction at {:02d}:xx — unusual hour (high fraud window)', hour(transaction_at)), NULL),
    if(regexp_matches(merchant_category, '(?i)transfer|atm|crypto'), format('Merchant category ''{}'' has elevated fraud rate', merchant_category), NULL),
    if(country <> home AND length(country) = 2, format('Transaction origin ''{}'' doesn''t match account currency ''{}'' (expected {})', country, currency, home), NULL),
    if(same_day > 5, format('Customer had {} transactions on this date — velocity flag', same_day), NULL)) AS reasons
FROM (SELECT *, (SELECT median(amount) FROM event_payments) AS mid,
        count(*) OVER (PARTITION BY customer_id, CAST(transaction_at AS DATE)) AS same_day,
        CASE currency WHEN 'GBP' THEN 'GB' WHEN 'USD' THEN 'US' WHEN 'EUR' THEN 'EU' END AS home
      FROM event_payments)"""
register(
    "fraud_reason_codes",
    lambda c: fraud.reason_codes(c.tables.event_payments)
    .withColumn("risk_signals", F.array_join("risk_signals", "|"))
    .withColumn("reasons", F.array_join("reasons", "|")),
    select("""SELECT * REPLACE (if(reasons = '', 'No specific risk signals detected — flagged by anomaly model', reasons) AS reasons)
FROM reasoned""", reasoned=REASONS),
)
register(
    "fraud_reason_counts",
    lambda c: fraud.reason_codes(c.tables.payments).select(F.explode("risk_signals").alias("signal"))
    .groupBy("signal").agg(F.count("*").alias("transactions")),
    select("""SELECT signal, count(*) AS transactions FROM (
  SELECT unnest(string_split(risk_signals, '|')) AS signal FROM reasoned WHERE risk_signals <> '') GROUP BY 1""",
           reasoned=REASONS.replace("event_payments", "payments")),
)


def _levels(c: Context):
    """Levels and actions for a probability that every row has: its place within 0..1."""
    p = (F.col("l_linenumber") * 13 + F.col("l_partkey")) % 101 / 100.0
    rows = c.tables.table("lineitem").select(p.alias("fraud_probability"))
    level = fraud.risk_level(F.col("fraud_probability"))
    return rows.groupBy(level.alias("risk_level")).agg(F.count("*").alias("transactions")).withColumn(
        "recommended_action", fraud.action_for(F.col("risk_level"))
    )


register(
    "fraud_risk_levels", _levels,
    """SELECT risk_level, count(*) AS transactions, CASE risk_level
  WHEN 'CRITICAL' THEN 'Block immediately and request manual review'
  WHEN 'HIGH' THEN 'Block and send SCA re-authentication challenge'
  WHEN 'MEDIUM' THEN 'Flag for review — allow with monitoring' ELSE 'Allow — no action required' END AS recommended_action
FROM (SELECT CASE WHEN p <= 30 THEN 'LOW' WHEN p <= 60 THEN 'MEDIUM' WHEN p <= 80 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level
      FROM (SELECT (l_linenumber * 13 + l_partkey) % 101 AS p FROM lineitem)) GROUP BY 1""",
)

# ---- models: no SQL form, checked by invariants in the tests -------------------------

register("fraud_scores_supervised", lambda c: fraud.supervised_scores(c.tables.event_payments))
register("fraud_scores_unsupervised", lambda c: fraud.unsupervised_scores(c.tables.payments))
register("fraud_summary", lambda c: fraud.fraud_summary(fraud.unsupervised_scores(c.tables.payments)))
register(
    "fraud_explanations",
    lambda c: fraud.explain_transactions(
        c.tables.event_payments, fraud.unsupervised_scores(c.tables.event_payments), "unsupervised"),
)

# ---- drift -----------------------------------------------------------------------------

CUT = "1998-06-01"


def _periods(c: Context):
    rows = c.tables.payments
    at = F.col("transaction_at")
    return drift.feature_tables(rows.filter(at < CUT), rows.filter(at >= CUT))


def _psi(c: Context):
    return drift.feature_psi(*_periods(c))


def _report(c: Context):
    reference, current = _periods(c)
    report = drift.drift_report(reference, current, drift.feature_psi(reference, current))
    return report.withColumns({
        "top_drifted_features": F.array_join("top_drifted_features", "|"),
        "recommendations": F.array_join("recommendations", "|"),
    })


_DRIFT = {
    "feats": f"""
SELECT transaction_at >= TIMESTAMP '{CUT}' AS is_cur, amount, ln(1 + amount) AS amount_log,
  hour(transaction_at)::DOUBLE AS hour, (isodow(transaction_at) - 1)::DOUBLE AS day_of_week,
  if(isodow(transaction_at) > 5, 1, 0)::DOUBLE AS is_weekend,
  if(hour(transaction_at) < 6 OR hour(transaction_at) > 22, 1, 0)::DOUBLE AS is_night,
  (row_number() OVER (PARTITION BY customer_id, transaction_at >= TIMESTAMP '{CUT}' ORDER BY transaction_at, transaction_id))::DOUBLE
    AS customer_txn_count,
  (dense_rank() OVER (ORDER BY merchant_category) - 1)::DOUBLE AS merchant_category_enc
FROM payments""",
    "vals": """
UNPIVOT feats ON amount, amount_log, hour, day_of_week, is_weekend, is_night, customer_txn_count, merchant_category_enc
INTO NAME feature VALUE x""",
    "edges": """
SELECT feature, list_sort(list_distinct(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
FROM vals WHERE NOT is_cur GROUP BY 1""",
    "bins": """
SELECT feature, unnest(range(0, len(e) - 1)) AS bin FROM edges WHERE len(e) >= 2""",
    "hits": """
SELECT feature, is_cur, len(list_filter(e[:len(e) - 1], lambda b: b <= x)) - 1 AS bin, count(*) AS n
FROM vals JOIN edges USING (feature) WHERE x BETWEEN e[1] AND e[len(e)] GROUP BY ALL""",
    "shares": """
SELECT feature, bin, (coalesce(r.n, 0) + 1e-6) / ((SELECT count(*) FROM feats WHERE NOT is_cur) + 1e-5) AS p,
  (coalesce(u.n, 0) + 1e-6) / ((SELECT count(*) FROM feats WHERE is_cur) + 1e-5) AS q
FROM bins LEFT JOIN (FROM hits WHERE NOT is_cur) r USING (feature, bin) LEFT JOIN (FROM hits WHERE is_cur) u USING (feature, bin)""",
    "psis": """
SELECT feature, coalesce(psi, 0) AS psi, CASE WHEN psi >= 0.20 THEN 'retrain' WHEN psi >= 0.10 THEN 'monitor' ELSE 'stable' END AS status
FROM edges LEFT JOIN (SELECT feature, round(sum((q - p) * ln(q / p)), 4) AS psi FROM shares GROUP BY 1) USING (feature)""",
    "overall": f"""
SELECT *, (SELECT round(sum(psi), 4) / count(*) FROM psis) AS o, 100.0 * (volume_cur - volume_ref) / volume_ref AS grown
FROM (SELECT count(*) FILTER (NOT c) AS volume_ref, count(*) FILTER (c) AS volume_cur,
        (count(*) FILTER (f AND NOT c)) * 100.0::DOUBLE / count(*) FILTER (NOT c) AS rate_ref,
        (count(*) FILTER (f AND c)) * 100.0::DOUBLE / count(*) FILTER (c) AS rate_cur
      FROM (SELECT is_flagged_fraud AS f, transaction_at >= TIMESTAMP '{CUT}' AS c FROM payments))""",
}
register("drift_feature_psi", _psi, select("SELECT * FROM psis", **_DRIFT))
register(
    "drift_report", _report,
    select("""SELECT round(o, 4) AS overall_psi,
  CASE WHEN o >= 0.20 THEN 'retrain' WHEN o >= 0.10 THEN 'monitor' ELSE 'stable' END AS status,
  (o >= 0.20 OR abs(rate_cur - rate_ref) > 1) AS should_retrain, round(rate_ref, 3) AS fraud_rate_ref,
  round(rate_cur, 3) AS fraud_rate_cur, volume_ref, volume_cur, round(grown, 1) AS volume_change_pct,
  (SELECT string_agg(feature, '|' ORDER BY psi DESC, feature) FROM (FROM psis ORDER BY psi DESC, feature LIMIT 5)) AS top_drifted_features,
  concat_ws('|',
    CASE WHEN o >= 0.20 THEN format('PSI {:.3f} exceeds 0.20 threshold — retrain model immediately.', o)
         WHEN o >= 0.10 THEN format('PSI {:.3f} in warning zone (0.10–0.20) — schedule retraining soon.', o)
         ELSE format('PSI {:.3f} is stable — no retraining needed.', o) END,
    (SELECT string_agg(format('Feature ''{}'' has high drift (PSI={:.3f}) — investigate distribution change.', feature, psi), '|'
       ORDER BY psi DESC, feature) FROM (FROM psis ORDER BY psi DESC, feature LIMIT 3) WHERE psi >= 0.20),
    CASE WHEN rate_cur - rate_ref > 1 THEN format('Fraud rate increased {:+.2f}% — potential new attack pattern. Review recent flagged transactions immediately.', rate_cur - rate_ref)
         WHEN rate_cur - rate_ref < -1 THEN format('Fraud rate dropped {:+.2f}% — possible model under-detecting. Verify false negative rate hasn''t increased.', rate_cur - rate_ref) END,
    CASE WHEN abs(grown) > 30 THEN format('Transaction volume changed {:+.0f}% — significant volume shift can distort PSI scores.', grown::DOUBLE) END) AS recommendations
FROM overall""", **_DRIFT),
)

# ---- compliance --------------------------------------------------------------------------

WIDE = {"structuring_window_days": 30}
BUSY = {"velocity_max_txns": 4}


def _structuring_sql(days: int) -> str:
    return f"""
SELECT customer_id, max(n) AS txn_count, max(round(total, 2)) AS total_amount
FROM (SELECT a.customer_id, a.d, count(*) AS n, sum(b.amount) AS total
      FROM banded a JOIN banded b ON a.customer_id = b.customer_id AND b.d BETWEEN a.d - {days} AND a.d
      GROUP BY 1, 2 HAVING count(*) >= 3) GROUP BY 1"""


_AML = {
    "banded": """
SELECT customer_id, CAST(transaction_at AS DATE) AS d, amount FROM order_payments
WHERE status = 'completed' AND amount >= 7000 AND amount < 10000""",
    "smurfs": _structuring_sql(5),
    "smurfs_wide": _structuring_sql(30),
    "bursts": """
SELECT customer_id, count(*) AS txn_count, round(sum(amount), 2) AS total_amount, min(transaction_at) AS window_start,
  max(transaction_at) AS window_end
FROM event_payments WHERE status = 'completed'
GROUP BY customer_id, epoch_us(transaction_at) // 86400000000 HAVING count(*) > 4""",
    "rounders": """
SELECT customer_id, count(*) AS total_txns, count(*) FILTER (amount % 100 = 0) AS round_txns,
  round((count(*) FILTER (amount % 100 = 0)) * 100.0::DOUBLE / count(*), 1) AS round_pct, round(sum(amount), 2) AS total_amount
FROM order_payments WHERE status = 'completed' GROUP BY 1 HAVING total_txns >= 5 AND round_pct > 40""",
    "sleepers": """
SELECT customer_id, max(gap) AS max_gap_days, round(sum(amount), 2) AS recent_amount, count(*) AS recent_txns
FROM (SELECT customer_id, amount, CAST(transaction_at AS DATE) - lag(CAST(transaction_at AS DATE)) OVER (
        PARTITION BY customer_id ORDER BY transaction_at, transaction_id) AS gap
      FROM order_payments WHERE status = 'completed') WHERE gap > 90 GROUP BY 1""",
    "cash": """
SELECT customer_id, transaction_id, amount, merchant_category FROM order_payments
WHERE status = 'completed' AND amount > 5000 AND regexp_matches(lower(merchant_category), 'atm|cash|transfer')""",
}
register("aml_structuring", lambda c: compliance.structuring(c.tables.order_payments), select("SELECT * FROM smurfs", **_AML))
register(
    "aml_structuring_30_days", lambda c: compliance.structuring(c.tables.order_payments, WIDE),
    select("SELECT * FROM smurfs_wide", **_AML),
)
register("aml_velocity", lambda c: compliance.velocity(c.tables.event_payments, BUSY), select("SELECT * FROM bursts", **_AML))
register(
    "aml_velocity_as_written",
    lambda c: compliance.velocity(
        c.tables.event_payments.withColumn("transaction_at", F.date_trunc("hour", "transaction_at")),
        {"velocity_max_txns": 2}, "reference"),
    select("""SELECT customer_id, count(*) AS txn_count, round(sum(amount), 2) AS total_amount, min(t) AS window_start, max(t) AS window_end
FROM (SELECT *, date_trunc('hour', transaction_at) AS t FROM event_payments WHERE status = 'completed')
GROUP BY customer_id, epoch(t) / 86400 HAVING count(*) > 2"""),
)
register("aml_round_numbers", lambda c: compliance.round_numbers(c.tables.order_payments), select("SELECT * FROM rounders", **_AML))
register("aml_dormant_activity", lambda c: compliance.dormant_activity(c.tables.order_payments), select("SELECT * FROM sleepers", **_AML))
register("aml_large_cash", lambda c: compliance.large_cash(c.tables.order_payments), select("SELECT * FROM cash", **_AML))

FLAGS = """
SELECT 'STRUCTURING' AS flag_type, 'HIGH' AS severity, customer_id,
  format('Possible structuring: {} transactions totalling ${:,.2f} — all below $10,000 threshold within 5 days', txn_count, total_amount) AS description,
  0 AS transaction_count, total_amount AS amount_total,
  'File Suspicious Activity Report (SAR). Escalate to MLRO for review.' AS recommended_action FROM smurfs
UNION ALL
SELECT 'VELOCITY_ANOMALY', 'MEDIUM', customer_id,
  format('Velocity flag: {} transactions in 24h window — exceeds 1 threshold. Total: ${:,.2f}', count(*), round(sum(amount), 2)),
  0, round(sum(amount), 2), 'Enhanced due diligence. Review account activity pattern.'
FROM order_payments WHERE status = 'completed' GROUP BY customer_id, epoch_us(transaction_at) // 86400000000 HAVING count(*) > 1
UNION ALL
SELECT 'ROUND_NUMBER_BIAS', 'LOW', customer_id,
  format('{}% of transactions are round numbers (threshold: 40.0%) — possible manual fraud', CAST(round_pct AS VARCHAR)),
  0, total_amount, 'Monitor account. Consider enhanced verification.' FROM rounders
UNION ALL
SELECT 'DORMANT_ACCOUNT_ACTIVITY', 'MEDIUM', customer_id,
  format('Account was dormant for {} days, then made {} transaction(s) totalling ${:,.2f}', max_gap_days, recent_txns, recent_amount),
  0, recent_amount, 'Verify customer identity. Review recent transactions for legitimacy.' FROM sleepers
UNION ALL
SELECT 'LARGE_CASH_TRANSACTION', 'HIGH', customer_id,
  format('Large {} transaction: ${:,.2f} — exceeds $5,000 threshold', merchant_category, amount), 1, amount,
  'Mandatory reporting review. Consider filing CTR (Currency Transaction Report).' FROM cash"""
PAIRS = {"velocity_max_txns": 1}
register("aml_flags", lambda c: compliance.aml_flags(c.tables.order_payments, PAIRS), select("SELECT * FROM flags", flags=FLAGS, **_AML))
register(
    "aml_flag_counts", lambda c: compliance.flag_counts(compliance.aml_flags(c.tables.order_payments, PAIRS)),
    select("SELECT severity, count(*) AS flags FROM flagged GROUP BY 1", flagged=FLAGS, **_AML),
)

# ---- quality -------------------------------------------------------------------------------


def _raw(c: Context):
    t = c.tables
    return {
        "customers": t.customers, "merchants": t.merchants, "transactions": t.transactions,
        "fx_rates": t.fx_rates, "disputes": t.disputes,
    }


def _marts(c: Context):
    w = c.warehouse
    return {name: getattr(w, name) for name in quality.MART_EXPECTATIONS}


_TABLE_OF = {
    "customers_360": "c360", "monthly_payment_performance": "performance", "cohort_retention": "retention",
    "merchant_risk_scorecard": "scorecard", "fraud_events": "fraud_events",
}


def _tests_sql(expectations: dict, table_of) -> str:
    lines = []
    for table, expects in expectations.items():
        for e in expects:
            source, col = table_of(table), e.column
            head = f"SELECT '{table}' AS table_name, '{col}' AS column_name"
            if e.not_null:
                lines.append(f"{head}, 'not_null' AS test, count(*) FILTER ({col} IS NULL) AS failures FROM {source}")
            if e.accepted:
                values = ", ".join(f"'{v}'" for v in e.accepted)
                lines.append(
                    f"{head}, 'accepted_values' AS test, count(DISTINCT {col}) FILTER ({col} NOT IN ({values})) AS failures FROM {source}")
            if e.unique:
                lines.append(
                    f"{head}, 'unique' AS test, count(*) AS failures FROM "
                    f"(SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(lines) + ")"


_RAW_TESTS = _tests_sql(quality.RAW_EXPECTATIONS, lambda t: f"raw_{t}")
_MART_TESTS = _tests_sql(quality.MART_EXPECTATIONS, _TABLE_OF.get)
register("quality_raw_tables", lambda c: quality.check_tables(_raw(c), quality.RAW_EXPECTATIONS), select(_RAW_TESTS))
register("quality_marts", lambda c: quality.check_tables(_marts(c), quality.MART_EXPECTATIONS), select(_MART_TESTS))
register(
    "quality_summary",
    lambda c: quality.check_summary(quality.check_tables(_raw(c), quality.RAW_EXPECTATIONS)),
    select(f"""SELECT count(*) FILTER (passed) AS tests_passed, count(*) FILTER (NOT passed) AS tests_failed,
  bool_and(passed) AS export_allowed FROM ({_RAW_TESTS})"""),
)
register(
    "quality_row_counts", lambda c: quality.row_counts(_raw(c)),
    select(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) = 0 AS is_empty FROM raw_{t}"
        for t in ("customers", "merchants", "transactions", "fx_rates", "disputes"))),
)
register(
    "quality_raw_issues",
    lambda c: quality.raw_issues(
        c.tables.user_export.selectExpr(
            "record_id AS transaction_id", "try_cast(debit AS double) AS amount",
            "lower(trim(outcome)) AS status", "member_id AS customer_id")),
    select("""SELECT 'NULL transaction_ids' AS issue, count(*) FILTER (record_id IS NULL) AS rows FROM typed
UNION ALL SELECT 'amount <= 0', count(*) FILTER (amount <= 0) FROM typed
UNION ALL SELECT 'unknown status', count(*) FILTER (status NOT IN ('completed', 'declined', 'pending', 'failed')) FROM typed
UNION ALL SELECT 'NULL customer_id', count(*) FILTER (member_id IS NULL) FROM typed""",
        typed="SELECT record_id, TRY_CAST(debit AS DOUBLE) AS amount, lower(trim(outcome)) AS status, member_id FROM user_export"),
)
