import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import drift, fraud


def test_features(sample, sample_rows):
    got = {r["transaction_id"]: r for r in fraud.fraud_features(sample).collect()}
    assert len(got) == 480
    categories = sorted({r["merchant_category"] for r in sample_rows})
    for i in (0, 77, 479):
        r, row = got[f"t{i}"], sample_rows[i]
        at = row["transaction_at"]
        assert (r["hour"], r["day_of_week"]) == (at.hour, at.weekday())
        assert r["is_night"] == float(at.hour < 6 or at.hour > 22)
        assert r["customer_txn_count"] == sum(x["customer_id"] == row["customer_id"] for x in sample_rows[:i + 1])
        assert r["merchant_category_enc"] == categories.index(row["merchant_category"])
        assert r["amount_log"] == pytest.approx(np.log1p(row["amount"]))


def test_hot_customers_do_not_change_features(sample):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(fraud.fraud_features(sample)) == rows(fraud.fraud_features(sample, hot_limit=3))


def test_mode(make_payments, sample):
    assert fraud.detection_mode(sample).first()["mode"] == "supervised"
    assert fraud.detection_mode(make_payments([{}])).first()["mode"] == "unsupervised"


def test_unsupervised_scores(make_payments, sample_rows):
    odd = {"customer_id": "odd", "amount": 90_000.0, "transaction_at": dt.datetime(2023, 1, 7, 23, 30), "channel": "zzz"}
    rows = make_payments([*sample_rows, odd])
    scores = fraud.unsupervised_scores(rows, contamination=0.05, trees=50, sample=128)
    got = sorted(scores.collect(), key=lambda r: -r["fraud_probability"])
    assert len(got) == 481 and got[0]["amount"] == 90_000.0
    assert all(0 <= r["fraud_probability"] <= 1 for r in got)
    assert sum(r["is_predicted_fraud"] for r in got) == pytest.approx(24, abs=2)
    assert {r["risk_level"] for r in got} <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"}
    s = fraud.fraud_summary(scores).first()
    assert s["total_transactions"] == 481 and s["predicted_fraud"] == sum(r["is_predicted_fraud"] for r in got)


def test_supervised_scores(make_payments, sample_rows):
    rows = make_payments([{**r, "is_fraud": r["amount"] > 250} for r in sample_rows])
    got = fraud.supervised_scores(rows, trees=5).collect()
    assert len(got) == 480 and all(0 <= r["fraud_probability"] <= 1 for r in got)
    right = [r for r in got if r["actual_label"] == int(r["is_predicted_fraud"])]
    assert len(right) > 470


def test_reasons(make_payments):
    night = dt.datetime(2023, 1, 1, 3)
    rows = make_payments(
        [{"amount": 10.0, "customer_id": f"x{i}", "transaction_at": dt.datetime(2023, 1, 2, 12)} for i in range(9)]
        + [{"amount": 35.0, "customer_id": "y", "transaction_at": night, "merchant_category": "Bank Transfer", "currency": "USD"}]
        + [{"amount": 10.0, "customer_id": "z", "transaction_at": dt.datetime(2023, 1, 2, 12)}] * 6
    ).withColumn("country", F.when(F.col("customer_id") == "y", "GB"))
    got = {r["transaction_id"]: r for r in fraud.reason_codes(rows).collect()}
    assert got["t0"]["risk_signals"] == []
    assert got["t0"]["reasons"] == ["No specific risk signals detected — flagged by anomaly model"]
    assert got["t9"]["risk_signals"] == ["HIGH_AMOUNT", "ODD_HOURS", "HIGH_RISK_MERCHANT_CATEGORY", "CROSS_BORDER_MISMATCH"]
    assert got["t9"]["reasons"][0] == "Amount $35.00 is 250% above median transaction"
    assert got["t9"]["reasons"][1] == "Transaction at 03:xx — unusual hour (high fraud window)"
    assert got["t10"]["risk_signals"] == ["HIGH_VELOCITY"]


def numpy_psi(reference, current, bins=10):
    edges = np.unique(np.percentile(reference, np.linspace(0, 100, bins + 1)))
    if len(edges) < 2:
        return 0.0
    e, a = np.histogram(reference, edges)[0], np.histogram(current, edges)[0]
    p = (e + 1e-6) / (len(reference) + 1e-6 * bins)
    q = (a + 1e-6) / (len(current) + 1e-6 * bins)
    return float(np.sum((q - p) * np.log(q / p)))


def test_psi_matches_numpy(sample):
    ref, cur = drift.feature_tables(
        sample.filter("transaction_at < '2023-01-12'"), sample.filter("transaction_at >= '2023-01-12'"))
    got = {r["feature"]: r["psi"] for r in drift.feature_psi(ref, cur).collect()}
    assert set(got) == set(drift.DRIFT_FEATURES)
    a, b = ref.toPandas(), cur.toPandas()
    for f in drift.DRIFT_FEATURES:
        assert got[f] == pytest.approx(numpy_psi(a[f], b[f]), abs=1e-4), f


def test_large_domains_use_the_same_edges(sample, monkeypatch):
    ref, _ = drift.feature_tables(sample, sample)
    buffered = drift.bin_edges(ref, drift.DRIFT_FEATURES)
    monkeypatch.setattr(drift, "BUFFERED_VALUES", 0)
    counted = drift.bin_edges(ref, drift.DRIFT_FEATURES)
    for f in drift.DRIFT_FEATURES:
        assert counted[f] == pytest.approx(buffered[f])


def test_identical_periods_are_stable(sample):
    ref, cur = drift.feature_tables(sample, sample)
    psi = drift.feature_psi(ref, cur)
    assert psi.filter("psi <> 0 or status <> 'stable'").isEmpty()
    r = drift.drift_report(ref, cur, psi).first()
    assert (r["overall_psi"], r["status"], r["should_retrain"], r["volume_change_pct"]) == (0.0, "stable", False, 0.0)
    assert r["recommendations"] == ["PSI 0.000 is stable — no retraining needed."]


def test_constant_feature_and_big_shift(make_payments):
    calm = make_payments([{"amount": 10.0, "customer_id": f"c{i}"} for i in range(20)])
    wild = make_payments([{"amount": 99.0, "customer_id": f"c{i}", "is_fraud": i % 2 == 0} for i in range(40)])
    ref, cur = drift.feature_tables(calm, wild)
    psi = drift.feature_psi(ref, cur)
    assert {r["psi"] for r in psi.collect()} == {0.0}
    r = drift.drift_report(ref, cur, psi).first()
    assert r["should_retrain"] and r["fraud_rate_cur"] == 50.0
    assert any(t.startswith("Fraud rate increased +50.00%") for t in r["recommendations"])
    assert any(t.startswith("Transaction volume changed +100%") for t in r["recommendations"])


def test_explanations_of_repeated_ids_and_missing_times(make_payments):
    rows = make_payments([{"amount": 10.0}, {"amount": 20.0}, {"amount": 20.0, "transaction_at": None}])
    rows = rows.withColumn("transaction_id", F.lit("same"))
    scores = rows.select(
        "transaction_id", "amount", F.lit(0.5).alias("fraud_probability"), F.lit("MEDIUM").alias("risk_level"))
    assert sorted(r["amount"] for r in fraud.explain_transactions(rows, scores, "supervised").collect()) == [10.0, 20.0, 20.0]
    night = fraud.fraud_features(make_payments([{"transaction_at": None}])).first()
    assert (night["hour"], night["is_night"]) == (0.0, 0.0)


def test_forest_samples_each_tree_alike_and_whatever_the_partitions(spark):
    rows = spark.range(20_000).selectExpr("concat('t', id) AS transaction_id", *[f"cast(hash(id, {i}) % 100 AS double) AS {c}" for i, c in enumerate(fraud.FEATURES)])
    forest = fraud.isolation_forest(rows, trees=20, sample=64)
    again = fraud.isolation_forest(rows.repartition(7), trees=20, sample=64)
    nodes = sorted(map(tuple, forest.collect()))
    assert nodes == sorted(map(tuple, again.collect()))
    samples = fraud.forest_samples(rows, 20, 64, 42, 20_000)
    assert [tuple(r) for r in samples.groupBy("tree").count().orderBy("tree").collect()] == [(t, 64) for t in range(20)]
    # The table is not multiplied by the number of trees before rows are chosen: below the generator stands a filter.
    plan = samples._jdf.queryExecution().optimizedPlan().toString()
    assert "_entered" in plan[plan.index("Generate"):] and "Filter" in plan[plan.index("Generate"):]
    few = fraud.forest_samples(rows.limit(10), 5, 64, 42, 10)
    assert [r["count"] for r in few.groupBy("tree").count().collect()] == [10] * 5


def test_binomial_limits():
    limits = fraud._binomial_limits(100, 0.01)
    assert abs(limits[0] - 0.99 ** 100) < 1e-12 and limits == sorted(limits) and len(limits) < 20
    assert fraud._binomial_limits(5, 1.0) == [0.0] * 5


def test_explanations_of_repeated_ids_do_not_depend_on_the_run(make_payments, sample_rows):
    rows = make_payments([{**r, "amount": 9000.0 if i < 6 else r["amount"], "transaction_id": "same" if i < 6 else f"t{i}"} for i, r in enumerate(sample_rows[:120])])
    scores = rows.selectExpr("transaction_id", "amount", "hash(transaction_at) % 100 / 100.0D AS fraud_probability", "'HIGH' AS risk_level")
    one = fraud.explain_transactions(rows, scores, "unsupervised").collect()
    two = fraud.explain_transactions(rows.repartition(5), scores.repartition(3), "unsupervised").collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and sum(r["transaction_id"] == "same" for r in one) == 6


def test_trees_walked_together_equal_trees_walked_one_by_one():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    parts, trees = [], []
    for tree in (3, 7, 9):
        nodes = fraud._grow(rng.normal(size=(64 if tree < 9 else 1, len(fraud.FEATURES))), rng, 6)
        trees.append(nodes)
        parts.append(pd.DataFrame(nodes, columns=["feature", "cut", "lft", "rgt", "path"]).assign(tree=tree, node=range(len(nodes))))
    x = rng.normal(size=(40, len(fraud.FEATURES)))
    x[3, 0] = np.nan

    def path(row, nodes):
        at = 0
        while nodes[at][0] >= 0:
            at = nodes[at][2] if row[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
        return nodes[at][4]

    got = fraud._mean_path(x, *fraud._laid_out(pd.concat(parts[::-1])))
    assert got.tolist() == [sum(path(r, t) for t in trees) / 3 for r in x]
