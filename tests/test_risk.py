import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import mapping, quality, risk
from ledgerlens.operators.skew import KeyLoad
from ledgerlens.plans.warehouse import Warehouse, read_marts

START = dt.datetime(2023, 1, 10)
DISPUTES = (
    "dispute_id string, transaction_id string, customer_id string, opened_at string, reason string, "
    "status string, amount double, currency string"
)


def flagged(i, day, customer="a"):
    return {"customer_id": customer, "is_fraud": True, "transaction_at": START + dt.timedelta(days=day), "amount": 10.0 + i}


@pytest.fixture(scope="module")
def rows(make_payments):
    days = [0, 5, 30, 31, 60, 61, 95, 200]
    return make_payments(
        [flagged(i, d) for i, d in enumerate(days)] + [flagged(i, 3 * d, "b") for i, d in enumerate(days)]
        + [{"customer_id": "c", "transaction_at": START + dt.timedelta(days=7)}]
    )


@pytest.fixture(scope="module")
def disputes(spark):
    found = [("d1", "t2"), ("d2", "t2"), ("d3", "t5")]
    return spark.createDataFrame(
        [(d, t, "a", "2023-03-01", "duplicate", "won", 5.0, "GBP") for d, t in found], DISPUTES)


def warehouse(rows, disputes):
    raw = mapping.raw_transactions(rows)
    return Warehouse(
        raw, mapping.derived_customers(raw), mapping.derived_merchants(raw), mapping.derived_fx_rates(raw),
        disputes, F.lit("2024-01-01").cast("date"),
    )


def table(df):
    names = sorted(df.columns)
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))


def test_velocity_and_fan_out(rows, disputes):
    events = warehouse(rows, disputes).fraud_events
    got = {}
    for r in events.filter("customer_id = 'a'").collect():
        got.setdefault(r["transaction_id"], []).append(r["customer_fraud_velocity_30d"])
    # t2 is disputed twice: two rows, both counted; t0 lies exactly 30 days before t2
    assert got == {"t0": [1], "t1": [2], "t2": [4, 4], "t3": [4], "t4": [4], "t5": [3], "t6": [1], "t7": [1]}
    assert events.filter("transaction_id = 't2' and has_dispute").count() == 2
    assert events.filter("transaction_id = 't0' and has_dispute").isEmpty()


def test_velocity_of_hot_customers(rows, disputes, spark):
    w = warehouse(rows, disputes)
    hot = spark.createDataFrame([("a", True)], "_hot_key string, _is_hot boolean")
    assert table(risk.fraud_events(w.enriched, w.disputes, KeyLoad(hot))) == table(w.fraud_events)


@pytest.mark.parametrize("stored_ids", [
    ["t0", "t1", "t8"],                                       # new rows only
    ["t0", "t2", "t3", "t4", "t5", "t6", "t7", "t8", "t9"],   # t1 arrives late
    [f"t{i}" for i in range(17)],                             # nothing new
])
def test_refresh_equals_a_full_rebuild(rows, disputes, stored_ids):
    w = warehouse(rows, disputes)
    before = warehouse(rows.filter(F.col("transaction_id").isin(stored_ids)), disputes).fraud_events
    assert table(risk.refresh_fraud_events(before, w.enriched, w.disputes)) == table(w.fraud_events)


def test_late_dispute_refreshes(rows, disputes):
    w = warehouse(rows, disputes)
    before = warehouse(rows, disputes.filter("dispute_id <> 'd2'")).fraud_events
    assert table(risk.refresh_fraud_events(before, w.enriched, w.disputes)) == table(w.fraud_events)


def test_append_as_written_misses_history(rows, disputes):
    w = warehouse(rows, disputes)
    before = w.fraud_events.filter("transaction_at < '2023-02-01'")
    added = risk.append_fraud_events_as_written(before, w.enriched, w.disputes)
    assert added.filter("transaction_id = 't2'").first()["customer_fraud_velocity_30d"] < 4


def test_written_table_is_replayable(spark, rows, disputes, tmp_path):
    w = warehouse(rows, disputes)
    path = f"{tmp_path}/fraud_events"
    early = warehouse(rows.filter("transaction_at < '2023-02-20'"), disputes)
    risk.write_fraud_events(path, early.enriched, early.disputes)
    for _ in range(2):
        written = risk.write_fraud_events(path, w.enriched, w.disputes)
        assert table(written) == table(w.fraud_events)


def test_marts_round_trip(spark, rows, disputes, tmp_path):
    w = warehouse(rows, disputes)
    w.materialise(str(tmp_path))
    marts = read_marts(spark, str(tmp_path))
    assert table(marts["customers_360"]) == table(w.customers_360)
    results = quality.check_tables(marts, quality.MART_EXPECTATIONS)
    failed = [(r["table_name"], r["test"]) for r in results.filter("not passed").collect()]
    assert failed == [("fraud_events", "unique")]             # the fan-out by disputes


def test_customer_tiers_and_churn(rows, disputes):
    got = {r["customer_id"]: r for r in warehouse(rows, disputes).customers_360.collect()}
    assert got["a"]["ltv_tier"] == "bronze" and got["a"]["total_disputes"] == 3
    assert got["c"]["churn_risk_segment"] == "at_risk"


def test_summary_with_hot_customers(rows, disputes, spark):
    from ledgerlens.operators.enrichment import customer_summary

    w = warehouse(rows, disputes)
    hot = spark.createDataFrame([("a", True)], "_hot_key string, _is_hot boolean")
    assert table(customer_summary(w.enriched, hot)) == table(w.customer_summary)


def test_missing_rate_counts_as_one_and_zero_rate_as_null(spark, rows, disputes):
    w = warehouse(rows, disputes)
    fx = spark.createDataFrame([("2023-01-10", "GBP", 0.0)], "rate_date string, currency string, rate_to_gbp double")
    w = Warehouse(w.raw_transactions, w.raw_customers, w.raw_merchants, fx, disputes, F.lit("2024-01-01").cast("date"))
    got = {r["transaction_id"]: r["amount_gbp"] for r in w.enriched.collect()}
    assert got["t0"] is None and got["t1"] == 11.0
    assert w.fx_rates.first()["gbp_to_currency"] is None


def test_quality_finds_problems(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("b", None)], "id string, s string")
    checks = [quality.Expect("id", not_null=True, unique=True), quality.Expect("s", accepted=("x",))]
    got = {(r["column_name"], r["test"]): r["failures"] for r in quality.check_table("t", df, checks).collect()}
    assert got == {("id", "not_null"): 1, ("id", "unique"): 1, ("s", "accepted_values"): 2}
    summary = quality.check_summary(quality.check_table("t", df, checks)).first()
    assert (summary["tests_passed"], summary["tests_failed"], summary["export_allowed"]) == (0, 3, False)
    with pytest.raises(ValueError, match="empty"):
        quality.require_rows({"full": df, "none": df.limit(0)})
    total = sum(
        e.not_null + e.unique + bool(e.accepted)
        for group in (quality.RAW_EXPECTATIONS, quality.MART_EXPECTATIONS) for es in group.values() for e in es
    )
    assert total == 30


def test_fraud_events_follow_every_change(spark, tmp_path):
    columns = {
        "amount_gbp": "double", "transaction_at": "timestamp", "transaction_date": "date", "is_flagged_fraud": "boolean",
        "is_kyc_verified": "boolean", "is_high_risk_merchant": "boolean", "is_cross_border": "boolean",
    }
    schema = ", ".join(f"{c} {columns.get(c, 'string')}" for c in [*risk.FRAUD_EVENT_COLUMNS, "is_flagged_fraud"])

    def enriched(rows):
        made = []
        for i, day, flagged in rows:
            at = None if day is None else dt.datetime(2023, *day)
            values = {"transaction_id": f"t{i}", "customer_id": "c", "transaction_at": at, "transaction_date": at and at.date(),
                      "is_flagged_fraud": flagged, "amount_gbp": 1.0}
            made.append(tuple(values.get(c) for c in [*risk.FRAUD_EVENT_COLUMNS, "is_flagged_fraud"]))
        return spark.createDataFrame(made, schema)

    def disputes(rows):
        return spark.createDataFrame(rows, "transaction_id string, dispute_id string, reason string, status string")

    path = f"{tmp_path}/events"
    states = [
        ([(1, (1, 5), False)], []),
        ([(1, (1, 5), True), (2, (1, 20), True), (3, None, True), (4, (3, 1), True)], [("t1", "d1", "x", "pending")]),
        ([(1, (1, 5), True), (2, (1, 20), False), (3, None, True), (4, (3, 1), False)], [("t1", "d1", "x", "won")]),
        ([(1, (1, 5), True), (5, (2, 1), True)], [("t1", "d1", "x", "won")]),
        ([], []),
    ]
    for rows, open_disputes in states:
        table, d = enriched(rows), disputes(open_disputes)
        rebuilt = risk.fraud_events(table, d)
        got = risk.write_fraud_events(path, table, d)
        assert sorted(map(str, got.select(*rebuilt.columns).collect())) == sorted(map(str, rebuilt.collect()))
