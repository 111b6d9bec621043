"""What the joins of all transactions move, and how often they are made."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import enrichment, fraud, mapping, ordering, payments, quality, risk, skew
from ledgerlens.plans.sample_tables import CURRENCIES, SampleTables
from ledgerlens.plans.warehouse import Warehouse

DAY = dt.datetime(1998, 3, 4)


def warehouse(rows, semantics="corrected"):
    raw = mapping.raw_transactions(rows)
    return Warehouse(
        raw, mapping.derived_customers(raw), mapping.derived_merchants(raw), mapping.derived_fx_rates(raw),
        mapping.no_disputes(raw), F.lit("2024-01-01").cast("date"), semantics,
    )


def table(df):
    return sorted(map(repr, map(tuple, df.collect())))


def counted(monkeypatch, module):
    """Names of the tables that ``module`` stages."""
    names, stage = [], module.stage

    def noted(df, name):
        names.append(name)
        return stage(df, name)

    monkeypatch.setattr(module, "stage", noted)
    return names


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_short_when_they_meet_their_orders(spark, tmp_path):
    """Values of a line pass the join ready-made; null values stay null."""
    lines = [
        (1, 5, 3, 1, 1005.0, 0.1, 0.0, "R", "F", DAY), (1, 7, 3, 2, 20.0, 0.0, 0.08, "N", "O", DAY),
        (2, None, None, 3, None, None, None, None, None, None),
    ]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 9, "P"), (2, None, "F")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    found = SampleTables(spark, str(tmp_path)).transactions
    got = {r["transaction_id"]: tuple(r)[1:] for r in found.collect()}
    blank = got.pop("2-3")
    at = lambda second: DAY + dt.timedelta(seconds=second % 86400)
    assert got == {
        "1-1-5-3-19980304-100500": ("9", "3", 1.01, CURRENCIES[5], at(5 * 7919 + 104729), "pending", True, "app", "CA"),
        "1-2-7-3-19980304-2000": ("9", "3", 0.02, CURRENCIES[1], at(7 * 7919 + 2 * 104729), "completed", False, "web", "US"),
    }
    assert blank[:3] == (None, None, None) and blank[4:-1] == (None, "completed", None, "atm")
    above = plan(payments.payment_performance(found)).split("Join")[0]
    assert "l_discount" not in above and "l_extendedprice" not in above


def test_whole_rows_are_enriched_after_the_move(sample):
    """Same columns, order and rows, but only typed columns meet the customers."""
    for semantics in ("corrected", "reference"):
        w = warehouse(sample, semantics)
        assert w.enriched_rows.columns == w.enriched.columns
        assert table(w.enriched_rows) == table(w.enriched)
    twice = warehouse(sample)
    args = twice.transactions, twice.customers.union(twice.customers), twice.merchants, twice.fx_rates
    assert table(enrichment.enrich(*args, whole_rows=True)) == table(enrichment.enrich(*args))


def test_a_tested_table_is_computed_once(spark, monkeypatch):
    names = counted(monkeypatch, quality)
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "id string, n int")
    got = {r["test"]: r["failures"] for r in quality.check_table("t", df, [quality.Expect("id", not_null=True, unique=True)]).collect()}
    assert got == {"not_null": 1, "unique": 1} and names == ["tested-t"]
    quality.check_table("t", df, [quality.Expect("id", not_null=True)]).collect()
    assert names == ["tested-t"]


def test_percentiles_read_their_input_once(spark, monkeypatch):
    names = counted(monkeypatch, ordering)
    assert ordering.exact_percentiles(spark.range(1, 6), "id", [0.5, 0.25]) == [3.0, 2.0]
    assert names == ["percentile-values"]


def test_same_day_counts_are_not_moved_again(spark, make_payments):
    """Rows and counts are moved once each; customers without an id are one customer."""
    rows = make_payments([{"customer_id": None}] * 6 + [{"customer_id": ""}] * 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reasons = fraud.reason_codes(rows)
        moves = reasons._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moves == 2
    fast = [r["customer_id"] for r in reasons.collect() if "HIGH_VELOCITY" in r["risk_signals"]]
    assert fast == [None] * 6


def test_features_of_one_customer(spark, sample, monkeypatch):
    """One pass finds both columns' values, and the totals of slices go to the rows."""
    names = counted(monkeypatch, fraud)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = fraud.fraud_features(sample.withColumn("customer_id", F.lit("c")), hot_limit=100)
        rows = skew.with_running_total(
            spark.range(9).selectExpr("'k' AS key", "id"), "key", "id", [], F.lit(1), "n", skew.find_hot(spark.range(9).selectExpr("'k' AS key"), "key", 3))
        joins = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert names == ["occurring-values"] and "BroadcastHashJoin" in joins
    assert sorted(r["customer_txn_count"] for r in found.collect()) == [float(i) for i in range(1, 481)]
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [(i, i + 1) for i in range(9)]


def test_a_refresh_finds_flagged_rows_once(sample, monkeypatch):
    w = warehouse(sample)
    early = risk.fraud_events(w.enriched.filter("transaction_at < '2023-01-12'"), w.disputes)
    expected = table(w.fraud_events.select(*early.columns))
    names = counted(monkeypatch, risk)
    assert table(risk.refresh_fraud_events(early, w.enriched, w.disputes).select(*early.columns)) == expected
    assert names.count("flagged-now") == 1


def test_whole_lines_pass_what_their_values_follow_from(spark, tmp_path):
    """Transactions with all columns: fewer columns meet the orders, and rows are the same, null values too."""
    lines = [
        (o, part, 3, n, price, discount, tax, returned, status, day)
        for o, day in ((1, DAY + dt.timedelta(hours=5)), (2, None), (3, DAY))
        for n, (part, price, discount, tax, returned, status) in enumerate([
            (5, 1005.0, 0.1, 0.0, "R", "F"), (7, 20.0, 0.09, 0.08, "R", "O"), (6, 33.33, 0.0, 0.06, "N", "O"),
            (None, None, None, None, None, None), (10, 5.05, None, 0.065, "R", None), (11, 7.0, 0.1, None, None, "O"),
        ])
    ]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 9, "P"), (2, None, "F"), (3, 4, "O"), (3, 5, None)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    marts, whole = SampleTables(spark, str(tmp_path)), SampleTables(spark, str(tmp_path), whole_rows=True)
    assert len(table(whole.transactions)) == 24
    assert table(whole.transactions) == table(marts.transactions)
    assert len(table(whole.disputes)) > 0
    assert table(whole.disputes) == table(marts.disputes)
    moved = plan(whole.transactions).split("Join")[1]
    assert "l_extendedprice" in moved and "price_cents" not in moved and "at_second" not in moved
