import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import fixed
from ledgerlens.operators import customers, explain, payments, risk, segments

LADDER = {
    (5, 5, 5): "Champions", (5, 4, 3): "Loyal Customers", (1, 5, 5): "Loyal Customers",
    (4, 3, 1): "Potential Loyalists", (5, 1, 5): "Recent Customers", (3, 2, 1): "Promising",
    (3, 1, 3): "Need Attention", (3, 1, 2): "Others", (2, 2, 5): "About to Sleep", (2, 3, 3): "At Risk",
    (1, 3, 5): "At Risk", (1, 4, 2): "Cannot Lose Them", (1, 2, 2): "Hibernating", (1, 1, 3): "Lost",
    (1, 1, 1): "Hibernating", (2, 4, 2): "Others", (4, 4, 2): "Others",
}


def test_every_score_has_a_segment(spark):
    grid = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(grid, "r int, f int, m int")
    segment = customers.segment_of(F.col("r"), F.col("f"), F.col("m"))
    rows = df.select("r", "f", "m", segment.alias("s"), customers.group_of(segment).alias("g"),
                     customers.action_of(segment).alias("a"), customers.simple_action_of(segment).alias("b")).collect()
    got = {(r["r"], r["f"], r["m"]): r for r in rows}
    assert {r["s"] for r in rows} == set(fixed.SEGMENT_ORDER)
    for score, name in LADDER.items():
        assert got[score]["s"] == name, score
    assert got[(1, 4, 2)]["g"] == "At Risk" and got[(3, 1, 2)]["g"] == "Others"
    assert got[(3, 1, 2)]["a"] == "Monitor" and got[(2, 2, 5)]["b"] == "Monitor and re-engage."


def by_day(make_payments, days):
    return make_payments([
        {"customer_id": f"c{i}", "transaction_at": dt.datetime(2023, 1, 1) + dt.timedelta(days=d), "amount": 10.0 + d}
        for i, d in enumerate(days)
    ])


def test_recency_score_direction(make_payments):
    rows = by_day(make_payments, range(0, 50, 10))
    corrected = {r["customer_id"]: r["r_score"] for r in customers.rfm(rows).collect()}
    written = {r["customer_id"]: r["r_score"] for r in customers.rfm(rows, "reference").collect()}
    assert corrected == {f"c{i}": i + 1 for i in range(5)}
    assert written == {f"c{i}": 5 - i for i in range(5)}


def test_one_customer_and_none(make_payments):
    one = customers.rfm(by_day(make_payments, [3])).collect()
    assert [(r["r_score"], r["f_score"], r["m_score"], r["frequency"]) for r in one] == [(1, 1, 1, 1)]
    none = make_payments([{"status": "declined"}])
    assert customers.rfm(none).count() == 0
    assert customers.first_purchase_retention(none).count() == 0


def test_retention(make_payments):
    at = lambda *ymd: dt.datetime(*ymd)
    rows = make_payments([
        {"customer_id": "a", "transaction_at": at(2023, 1, 31)}, {"customer_id": "a", "transaction_at": at(2023, 2, 1)},
        {"customer_id": "a", "transaction_at": at(2023, 2, 20)}, {"customer_id": "b", "transaction_at": at(2023, 1, 2)},
        {"customer_id": "b", "transaction_at": at(2023, 2, 2), "status": "declined"},
    ])
    got = {r["months_since_signup"]: (r["active_customers"], r["cohort_size"], r["retention_pct"])
           for r in customers.first_purchase_retention(rows).collect()}
    assert got == {0: (2, 2, 100.0), 1: (1, 2, 50.0)}


def test_invariants(sample):
    rfm = customers.rfm(sample)
    scores = rfm.agg(*[f(F.col(c)) for c in ("r_score", "f_score", "m_score") for f in (F.min, F.max)]).first()
    assert list(scores) == [1, 5, 1, 5, 1, 5]
    assert rfm.filter("rfm_total <> r_score + f_score + m_score").isEmpty()
    assert segments.segment_summary(rfm).agg(F.sum("customers")).first()[0] == rfm.count() == 37
    retention = customers.first_purchase_retention(sample)
    assert retention.filter("retention_pct < 0 or retention_pct > 100").isEmpty()
    assert "M0" in segments.retention_matrix(retention).columns
    cards = risk.merchant_scorecard(sample)
    assert {r[0] for r in cards.select("risk_band").distinct().collect()} <= {"critical", "elevated", "standard"}
    assert segments.top_by_volume(cards, 3).count() == 3
    m = payments.headline_metrics(sample).first()
    assert m["total_transactions"] == 480 and 0 <= m["completion_pct"] <= 100


def test_metrics_of_nothing(make_payments, sample):
    m = payments.headline_metrics(sample.limit(0)).first()
    assert (m["total_transactions"], m["total_volume"], m["completion_pct"], m["date_from"]) == (0, 0.0, 0.0, None)


def test_explanations(sample):
    rfm = customers.rfm(sample)
    rows = explain.explain_segments(rfm).collect()
    assert len(rows) == 37
    for r in rows:
        assert len(r["what_drives_this"]) == 3
        assert (len(r["to_move_up"]) == 0) == (r["segment"] == "Champions")
        assert all(s["segment"] != "Others" for s in r["to_move_up"])
    one = explain.explain_customer(rfm, "person01").first()
    assert one["customer_id"] == "person01"
    with pytest.raises(ValueError, match="nobody"):
        explain.explain_customer(rfm, "nobody")
    some = explain.batch_explain(rfm, "At Risk")
    assert some.count() == rfm.filter("segment = 'At Risk'").count()
