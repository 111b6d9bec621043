"""Simplified results over a payments table, their views, explanations and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_payments  # noqa: F401 - adds its tables
from checks.registry import Context, register
from checks.sql_tables import select
from ledgerlens.operators import customers, explain, forecast, payments, risk, segments
from ledgerlens.plans import reports


def performance(c: Context):
    return payments.payment_performance(c.tables.payments)


def rfm(c: Context):
    return customers.rfm(c.tables.payments)


def scorecard(c: Context):
    return risk.merchant_scorecard(c.tables.payments)


def retention(c: Context):
    return customers.first_purchase_retention(c.tables.payments)


# ---- results -------------------------------------------------------------------

register("payment_performance", performance, select("SELECT * FROM perf"))
register("rfm", rfm, select("SELECT * FROM rfm"))
register(
    "rfm_as_written",
    lambda c: customers.rfm(c.tables.payments, "reference"),
    select("SELECT * FROM rfm_ref"),
)
register("merchant_scorecard", scorecard, select("SELECT * FROM cards"))
register("first_purchase_retention", retention, select("SELECT * FROM keep"))
register(
    "headline_metrics",
    lambda c: payments.headline_metrics(c.tables.payments),
    select("SELECT * FROM metrics"),
)

# ---- marts in the shape of the simplified results --------------------------------

register(
    "rfm_from_mart",
    lambda c: segments.rfm_from_mart(c.warehouse.rfm_segmentation),
    select("""SELECT customer_id, recency_days, frequency, monetary_gbp AS monetary,
  last_transaction_date AS last_txn_date, r_score, f_score, m_score, rfm_total, rfm_segment AS segment,
  recommended_action FROM rfm_mart"""),
)
register(
    "retention_from_mart",
    lambda c: segments.retention_from_mart(c.warehouse.cohort_retention),
    select("""SELECT * EXCLUDE (retention_rate), round(active_customers * 100.0::DOUBLE / cohort_size, 1) AS retention_pct
FROM retention"""),
)
register(
    "performance_from_mart",
    lambda c: segments.performance_from_mart(c.warehouse.monthly_payment_performance),
    select("""SELECT month, currency, total_transactions, completed_transactions AS completed,
  declined_transactions AS declined, total_volume_gbp AS total_volume, avg_transaction_gbp AS avg_transaction,
  fraud_flagged_count AS fraud_count, round(completion_rate * 100, 2) AS completion_pct,
  round(fraud_rate * 100, 3) AS fraud_rate_pct FROM performance"""),
)
register(
    "scorecard_from_mart",
    lambda c: segments.scorecard_from_mart(c.warehouse.merchant_risk_scorecard),
    select("""SELECT merchant_id, merchant_name, merchant_category, total_transactions,
  completed_transactions AS completed, total_volume_gbp AS total_volume, fraud_flagged_count AS fraud_count,
  round(fraud_rate * 100, 2) AS fraud_rate_pct, round(completion_rate * 100, 2) AS completion_rate_pct,
  unique_customers, risk_band FROM scorecard"""),
)

# ---- views -----------------------------------------------------------------------

register("segment_rfm_by_spend", lambda c: segments.by_spend(rfm(c)), select("SELECT * FROM rfm ORDER BY monetary DESC"))
register(
    "segment_summary",
    lambda c: segments.segment_summary(rfm(c)),
    select("""SELECT segment, count(*) AS customers, round(round(sum(monetary), 2) / count(monetary), 2) AS avg_monetary,
  round(avg(frequency), 1) AS avg_frequency, round(avg(recency_days), 0) AS avg_recency_days,
  round(sum(monetary), 2) AS total_revenue,
  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct_of_customers
FROM rfm GROUP BY segment"""),
)
for _name, _segments in {
    "segment_champions": ["Champions"], "segment_at_risk": segments.AT_RISK,
    "segment_lost": segments.LOST, "segment_promising": ["Promising"],
}.items():
    _in = ", ".join(f"'{s}'" for s in _segments)
    register(
        _name,
        lambda c, s=_segments: segments.segment_customers(rfm(c), *s),
        select(f"SELECT * FROM rfm WHERE segment IN ({_in})"),
    )
register(
    "cohort_retention_upto_12",
    lambda c: segments.retention_upto(retention(c)),
    select("SELECT * FROM keep WHERE months_since_signup <= 12"),
)
register(
    "cohort_retention_matrix",
    lambda c: segments.retention_matrix(retention(c)),
    select("SELECT CAST(cohort_month AS VARCHAR) AS cohort_month, " + ", ".join(
        f"avg(retention_pct) FILTER (months_since_signup = {n}) AS M{n}" for n in range(7)
    ) + " FROM keep WHERE months_since_signup <= 6 GROUP BY 1"),
)
register(
    "best_cohort",
    lambda c: segments.best_cohort(retention(c)),
    select("""SELECT CAST(cohort_month AS VARCHAR) AS cohort, retention_pct AS m3_retention_pct FROM keep
WHERE months_since_signup = 3 ORDER BY retention_pct DESC, cohort_month LIMIT 1"""),
)
register(
    "average_retention",
    lambda c: segments.average_retention(retention(c)),
    select("""SELECT months_since_signup, round(round(sum(retention_pct), 1) / count(*), 1) AS avg_retention_pct,
  count(DISTINCT cohort_month) AS cohorts FROM keep GROUP BY 1"""),
)
register("merchants_by_fraud_rate", lambda c: segments.by_fraud_rate(scorecard(c)), select("SELECT * FROM cards"))
register(
    "merchants_critical", lambda c: segments.in_band(scorecard(c), "critical"),
    select("SELECT * FROM cards WHERE risk_band = 'critical'"),
)
register(
    "merchants_elevated", lambda c: segments.in_band(scorecard(c), "elevated"),
    select("SELECT * FROM cards WHERE risk_band = 'elevated'"),
)
register(
    "merchants_top_by_volume", lambda c: segments.top_by_volume(scorecard(c)),
    select("SELECT * FROM cards ORDER BY total_volume DESC NULLS LAST, merchant_id LIMIT 10"),
)
register(
    "merchant_category_summary", lambda c: segments.category_summary(scorecard(c)),
    select("""SELECT merchant_category, count(*) AS merchants, CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
  round(sum(total_volume), 2) AS total_volume,
  round(round(sum(fraud_rate_pct), 2) / count(*), 2) AS avg_fraud_rate_pct,
  round(round(sum(completion_rate_pct), 2) / count(*), 2) AS avg_completion_pct
FROM cards GROUP BY 1"""),
)
register(
    "merchant_velocity_alerts", lambda c: segments.velocity_alerts(scorecard(c), 1.5),
    select("""SELECT c.*, round((total_transactions - m) / s, 2) AS z_score
FROM cards c, (SELECT avg(total_transactions) AS m, stddev_samp(total_transactions) AS s FROM cards)
WHERE (total_transactions - m) / s > 1.5"""),
)

# ---- explanations ------------------------------------------------------------------

POPULATION = """
SELECT avg(recency_days) AS avg_recency, avg(frequency) AS avg_freq, round(sum(monetary), 2) / count(monetary) AS avg_monetary,
  quantile_cont(monetary, 0.75) AS p75_monetary, quantile_cont(frequency::DOUBLE, 0.75) AS p75_freq,
  quantile_cont(recency_days::DOUBLE, 0.25) AS p25_recency
FROM rfm"""

LADDER = """
SELECT segment, place FROM (VALUES ('Lost',1),('Hibernating',2),('Cannot Lose Them',3),('At Risk',4),('About to Sleep',5),
  ('Need Attention',6),('Others',7),('Promising',8),('Recent Customers',9),('Potential Loyalists',10),
  ('Loyal Customers',11),('Champions',12)) l(segment, place)"""

ADVICE = """
SELECT * FROM (VALUES
  ('Champions','Reach R=5, F≥4, M≥4 — transact within 30 days AND make 3+ more transactions totalling significant spend'),
  ('Loyal Customers','Reach F≥4, M≥3 — make frequent repeat transactions to build habit and increase lifetime spend'),
  ('Potential Loyalists','Reach R≥4, F≥2 — return within 30 days and make at least 2 transactions'),
  ('Recent Customers','Reach R≥4 — make one transaction in the next 30 days'),
  ('Promising','Reach R=3, F≥2 — return within 60 days and make at least 2 more purchases'),
  ('Need Attention','Reach R=3, F<2, M≥3 — make one high-value transaction within the next 60 days')) v(goal, advice)"""

EXPLAINED = """
SELECT customer_id, segment, r_score, f_score, m_score, rfm_total, recency_days, frequency, monetary, recommended_action,
  CASE WHEN r_score >= 4 THEN format('Recency score {}/5 — transacted {} days ago (population avg: {:.0f} days) — recently active', r_score, recency_days, avg_recency)
       WHEN r_score = 3 THEN format('Recency score {}/5 — transacted {} days ago (avg: {:.0f}) — starting to go quiet', r_score, recency_days, avg_recency)
       ELSE format('Recency score {}/5 — last transaction {} days ago (avg: {:.0f}) — significantly lapsed', r_score, recency_days, avg_recency) END AS d1,
  format('Frequency score {}/5 — {}{} transactions (avg: {:.0f}) — {}', f_score, if(f_score < 3, 'only ', ''), frequency, avg_freq,
    CASE WHEN f_score >= 4 THEN 'highly engaged' WHEN f_score = 3 THEN 'average engagement' ELSE 'low engagement' END) AS d2,
  format('Monetary score {}/5 — ${:,.0f} lifetime spend (avg: ${:,.0f}) — {}', m_score, monetary, avg_monetary,
    CASE WHEN m_score >= 4 THEN 'high value customer' WHEN m_score = 3 THEN 'mid-value customer' ELSE 'low value so far' END) AS d3,
  concat_ws('|',
    CASE WHEN r_score < 4 AND recency_days > p25_recency THEN format('Recency is the main drag — needs to transact within {} days to reach top quartile', CAST(floor(p25_recency) AS BIGINT)) END,
    CASE WHEN f_score < 4 AND p75_freq - frequency > 1 THEN format('Frequency is below top quartile — {:.0f} more transactions needed to reach top 25%', p75_freq - frequency) END,
    CASE WHEN m_score < 4 AND p75_monetary > monetary THEN format('Spend is below top quartile — ${:,.0f} more needed to reach top 25%', p75_monetary - monetary) END) AS gaps,
  CASE WHEN r_score < 3 THEN format('Make a transaction within {} days', greatest(30, recency_days // 2))
       WHEN f_score < 3 THEN format('Complete {} more transactions', greatest(1, 3 - f_score))
       WHEN m_score < 3 THEN 'Increase spend to top 40% of customer base' ELSE 'Increase engagement and recency' END AS derived
FROM rfm, population"""

STEPS = """
SELECT customer_id, string_agg(goal, '|' ORDER BY place) AS goals, string_agg(step, '|' ORDER BY place) AS steps,
  min_by(goal, place) AS next_segment, min_by(step, place) AS next_step
FROM (SELECT e.customer_id, up.segment AS goal, up.place, coalesce(a.advice, e.derived) AS step,
        row_number() OVER (PARTITION BY e.customer_id ORDER BY up.place) AS nth
      FROM explained e JOIN ladder here ON here.segment = e.segment
      JOIN ladder up ON up.place > here.place AND up.segment <> 'Others' LEFT JOIN advice_texts a ON a.goal = up.segment)
WHERE nth <= 2 GROUP BY 1"""
_EXPLAIN = {"population": POPULATION, "ladder": LADDER, "advice_texts": ADVICE, "explained": EXPLAINED, "next_steps": STEPS}


def _flat_explanations(c: Context):
    rows = explain.explain_segments(rfm(c))
    return rows.select(
        "customer_id", "segment", "r_score", "f_score", "m_score", "rfm_total", "recency_days",
        "frequency", "monetary", "recommended_action",
        F.array_join("what_drives_this", "|").alias("drivers"),
        F.array_join("what_changed", "|").alias("gaps"),
        F.array_join(F.col("to_move_up.segment"), "|").alias("goals"),
        F.array_join(F.col("to_move_up.step"), "|").alias("steps"),
    )


def _population(c: Context):
    return explain.population(rfm(c)).select(
        *[F.round(x, 6).alias(x) for x in
          ("avg_recency", "avg_freq", "avg_monetary", "p75_monetary", "p75_freq", "p25_recency")]
    )


register(
    "rfm_population", _population,
    select("SELECT " + ", ".join(f"round({x}, 6) AS {x}" for x in (
        "avg_recency", "avg_freq", "avg_monetary", "p75_monetary", "p75_freq", "p25_recency")) + " FROM population",
        **_EXPLAIN),
)
register(
    "segment_explanations", _flat_explanations,
    select("""SELECT customer_id, segment, r_score, f_score, m_score, rfm_total, recency_days, frequency, monetary,
  recommended_action, concat_ws('|', d1, d2, d3) AS drivers, gaps, coalesce(goals, '') AS goals, coalesce(steps, '') AS steps
FROM explained LEFT JOIN next_steps USING (customer_id)""", **_EXPLAIN),
)
_BATCH = """SELECT customer_id, segment, r_score, f_score, m_score, recency_days, frequency, monetary, d1 AS key_driver,
  recommended_action, coalesce(next_segment, '') AS next_segment, coalesce(next_step, '') AS next_step
FROM explained LEFT JOIN next_steps USING (customer_id)"""
register("batch_explain", lambda c: explain.batch_explain(rfm(c)), select(_BATCH, **_EXPLAIN))
register(
    "batch_explain_at_risk", lambda c: explain.batch_explain(rfm(c), "At Risk"),
    select(_BATCH + " WHERE segment = 'At Risk'", **_EXPLAIN),
)

# ---- forecasts -----------------------------------------------------------------------

HISTORY = """
SELECT {by} month, round(sum(total_volume), 2) AS revenue,
  round(round(sum(fraud_rate_pct), 3) / count(fraud_rate_pct), 4) AS fraud_rate_pct,
  CAST(sum(total_transactions) AS BIGINT) AS txn_count,
  round(round(sum(completion_pct), 2) / count(completion_pct), 2) AS completion_pct
FROM perf GROUP BY ALL"""
FIT = """
SELECT {by} count(*) AS n, max(month) AS last, avg(y) AS mean, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
  sqrt(greatest(0, regr_syy(y, x) - regr_sxy(y, x) ^ 2 / nullif(regr_sxx(y, x), 0)) / count(*)) AS sigma
FROM (SELECT {by} month, coalesce({metric}, 0)::DOUBLE AS y,
        (row_number() OVER ({part} ORDER BY month) - 1)::DOUBLE AS x FROM history)
GROUP BY ALL"""


def _forecast_sql(metric: str, months: int, by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    low, high, digits = ("0", "15", 3) if metric == "fraud_rate_pct" else ("0", "1e300", 2)
    fit = lambda e: f"round(least(greatest({e}, {low}), {high}), {digits})"
    p = "(intercept + slope * (n + step - 1))"
    return select(
        f"""SELECT {by} strftime(last + to_months(CAST(step AS INTEGER)), '%Y-%m') AS month, {fit(p)} AS predicted,
  {fit(f'{p} - sigma * 1.96')} AS lower_95, {fit(f'{p} + sigma * 1.96')} AS upper_95
FROM fit, range(1, {months + 1}) s(step)""",
        history=HISTORY.format(by=by), fit=FIT.format(by=by, metric=metric, part=part),
    )


register(
    "monthly_history", lambda c: forecast.monthly_history(performance(c)),
    select("SELECT * FROM history", history=HISTORY.format(by="")),
)
for _metric in ("revenue", "fraud_rate_pct"):
    register(
        f"forecast_{_metric}",
        lambda c, m=_metric: forecast.linear_forecast(forecast.monthly_history(performance(c)), m, 6),
        _forecast_sql(_metric, 6),
    )
    register(
        f"forecast_{_metric}_by_currency",
        lambda c, m=_metric: forecast.linear_forecast(
            forecast.monthly_history(performance(c), ["currency"]), m, 12, ["currency"]),
        _forecast_sql(_metric, 12, "currency, "),
    )
register(
    "forecast_quality",
    lambda c: forecast.forecast_quality(forecast.monthly_history(performance(c)), 30).withColumn(
        "warnings", F.array_join("warnings", "|")),
    select("""SELECT 12 AS months_forecast, count(*) AS months_history, 'linear_trend' AS model, 'high' AS confidence,
  '' AS warnings FROM history""", history=HISTORY.format(by="")),
)


def _with(name: str, sql: str) -> str:
    """Turn a forecast query into a table of its own."""
    return f"{name} AS ({sql})"


register(
    "forecast_summary",
    lambda c: forecast.forecast_summary(forecast.monthly_history(performance(c)), 3),
    f"WITH {_with('r', _forecast_sql('revenue', 1))}, {_with('f', _forecast_sql('fraud_rate_pct', 1))}, "
    f"{_with('h', select('SELECT count(*) AS n FROM history', history=HISTORY.format(by='')))} "
    "SELECT r.predicted AS next_month_revenue, f.predicted AS next_month_fraud_rate_pct, 3 AS months_forecast, "
    "h.n AS months_history, 'linear_trend' AS model, 'high' AS confidence FROM r, f, h",
)
register(
    "forecast_revenue_table",
    lambda c: forecast.revenue_table(
        forecast.linear_forecast(forecast.monthly_history(performance(c)), "revenue", 6)),
    f"WITH {_with('r', _forecast_sql('revenue', 6))} "
    "SELECT *, round((predicted - (SELECT round(sum(predicted), 2) / count(*) FROM r)) / "
    "greatest((SELECT round(sum(predicted), 2) / count(*) FROM r), 1) * 100, 1) AS vs_mean_pct FROM r",
)
register(
    "forecast_fraud_table",
    lambda c: forecast.fraud_table(
        forecast.linear_forecast(forecast.monthly_history(performance(c)), "fraud_rate_pct", 6)),
    f"WITH {_with('r', _forecast_sql('fraud_rate_pct', 6))} "
    "SELECT *, CASE WHEN predicted > 3 THEN 'red' WHEN predicted > 2 THEN 'yellow' ELSE 'green' END AS zone FROM r",
)

# ---- dashboard datasets ----------------------------------------------------------------

register(
    "dashboard_monthly", lambda c: reports.dashboard_monthly(performance(c)),
    select("SELECT * REPLACE (strftime(month, '%Y-%m') AS month) FROM perf"),
)
register(
    "dashboard_segments", lambda c: reports.dashboard_segments(rfm(c)),
    select("""SELECT segment, count(*) AS customers, round(round(sum(monetary), 2) / count(*), 2) AS avg_spend,
  round(sum(monetary), 2) AS total_spend FROM rfm GROUP BY 1"""),
)
register(
    "dashboard_merchants", lambda c: reports.dashboard_merchants(scorecard(c)),
    select("SELECT * FROM cards ORDER BY fraud_rate_pct DESC, merchant_id LIMIT 20"),
)
register(
    "dashboard_cohorts", lambda c: reports.cohort_report(retention(c)),
    select("""SELECT strftime(cohort_month, '%Y-%m') AS cohort, months_since_signup, retention_pct, cohort_size
FROM keep WHERE months_since_signup <= 6"""),
)
register(
    "dashboard_trend", lambda c: reports.dashboard_trend(performance(c)),
    select("""SELECT strftime(month, '%Y-%m') AS month, round(sum(coalesce(total_volume, 0)), 2) AS volume,
  round(round(sum(completion_pct), 2) / count(*), 4) AS completion_pct,
  round(round(sum(fraud_rate_pct), 3) / count(*), 4) AS fraud_rate_pct FROM perf GROUP BY 1"""),
)
register(
    "dashboard_counts", lambda c: reports.dashboard_counts(rfm(c), scorecard(c)),
    select("""SELECT count(*) FILTER (segment = 'Champions') AS champions,
  count(*) FILTER (segment = 'Loyal Customers') AS loyal_customers, count(*) FILTER (segment = 'At Risk') AS at_risk,
  count(*) FILTER (segment = 'Lost') AS lost,
  (SELECT count(*) FILTER (risk_band = 'critical') FROM (
     SELECT * FROM cards ORDER BY fraud_rate_pct DESC, merchant_id LIMIT 20)) AS critical_merchants FROM rfm"""),
)

_BENCHMARKS = {
    "payments_global": [("Completion Rate", "completion_pct", 94.1, 97.2, 1), ("Fraud Rate", "fraud_rate_pct", 2.1, 0.8, -1)],
    "payments_uk": [("Completion Rate", "completion_pct", 95.2, 98.1, 1), ("Fraud Rate", "fraud_rate_pct", 1.8, 0.6, -1)],
    "ecommerce": [("Completion Rate", "completion_pct", 92.5, 96.0, 1), ("Fraud Rate", "fraud_rate_pct", 2.8, 1.2, -1)],
}
for _industry, _lines in _BENCHMARKS.items():
    register(
        f"benchmark_{_industry}",
        lambda c, i=_industry: reports.benchmark_comparison(payments.headline_metrics(c.tables.payments), i),
        select(" UNION ALL ".join(
            f"SELECT '{label}' AS metric, {column} AS your_value, {average}::DOUBLE AS industry_avg, {top}::DOUBLE AS top_quartile, "
            f"CASE WHEN ({column} - {top}::DOUBLE) * {sign} >= 0 THEN 'Top quartile ✓' "
            f"WHEN ({column} - {average}::DOUBLE) * {sign} >= 0 THEN 'Above average' "
            f"ELSE '{'Below average ↓ investigate' if sign > 0 else 'Below average ↑ improve'}' END AS assessment FROM metrics"
            for label, column, average, top, sign in _lines
        )),
    )
