"""Staged tables, intermediate tables and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import register
from checks.sql_tables import select
from ledgerlens.operators import risk
from ledgerlens.storage import stage


def _mart(name: str, attribute: str, table: str) -> None:
    register(name, lambda c: getattr(c.warehouse, attribute), select(f"SELECT * FROM {table}"))


_mart("staged_customers", "customers", "customers")
_mart("staged_merchants", "merchants", "merchants")
_mart("staged_transactions", "transactions", "transactions")
_mart("staged_fx_rates", "fx_rates", "fx")
_mart("staged_disputes", "disputes", "disputes")
register("enriched_transactions", lambda c: c.whole_rows.warehouse.enriched_rows, select("SELECT * FROM enriched"))
register(
    "enriched_transactions_as_written",
    lambda c: c.whole_rows.warehouse_as_written.enriched_rows,
    select("SELECT * FROM enriched_ref"),
)
register(
    "risk_tier_counts",
    lambda c: c.warehouse.enriched.groupBy("risk_tier").agg(F.count("*").alias("transactions")),
    select("SELECT risk_tier, count(*) AS transactions FROM enriched GROUP BY risk_tier"),
)
register(
    "customer_transaction_summary",
    lambda c: c.warehouse.customer_summary.withColumn(
        "median_transaction_gbp", F.round("median_transaction_gbp", 3)
    ),
    select("SELECT * FROM summary"),
)
_mart("monthly_payment_performance", "monthly_payment_performance", "performance")
register(
    "customers_360",
    lambda c: c.warehouse.customers_360.withColumn(
        "median_transaction_gbp", F.round("median_transaction_gbp", 3)
    ),
    select("SELECT * FROM c360"),
)
_mart("cohort_retention", "cohort_retention", "retention")
_mart("rfm_segmentation", "rfm_segmentation", "rfm_mart")
register(
    "rfm_segmentation_as_written",
    lambda c: c.warehouse_as_written.rfm_segmentation,
    select("SELECT * FROM rfm_mart_ref"),
)
_mart("fraud_events", "fraud_events", "fraud_events")
_mart("merchant_risk_scorecard", "merchant_risk_scorecard", "scorecard")


def _cut(c):
    """Fraud events stored at the start of 1999, and the tables as they are now."""
    w = c.warehouse
    early = w.enriched.filter(F.col("transaction_date") < "1999-01-01")
    return w, risk.fraud_events(early, w.disputes)


def _refreshed(c):
    w, stored = _cut(c)
    stored = stage(stored, "stored-events")
    return risk.refresh_fraud_events(stored, w.enriched, w.disputes)


def _appended(c):
    w, stored = _cut(c)
    return risk.append_fraud_events_as_written(stored, w.enriched, w.disputes)


register("fraud_events_refreshed", _refreshed, select("SELECT * FROM fraud_events"))
register(
    "fraud_events_appended_as_written",
    _appended,
    select("""
SELECT * REPLACE (count(*) OVER (PARTITION BY customer_id ORDER BY transaction_at
    RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS customer_fraud_velocity_30d)
FROM fraud_events
WHERE transaction_at > (SELECT max(transaction_at) FROM fraud_events WHERE transaction_date < DATE '1999-01-01')"""),
)
