"""A spread of registered queries against their SQL; ``python -m checks.compare`` runs them all."""

import pytest

from checks.catalog import QUERIES, SQL
from checks.compare import differences

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "monthly_payment_performance", "customer_transaction_summary", "rfm_segmentation", "rfm_segmentation_as_written",
    "fraud_events", "merchant_risk_scorecard", "segment_explanations", "forecast_fraud_rate_pct", "fraud_reason_codes",
    "drift_report", "aml_flags", "canonical_transactions", "stream_rows", "quality_raw_tables",
]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    problem = differences(spark, FOLDER, QUERIES[name], SQL[name])
    assert problem in (None, "both results are empty")
