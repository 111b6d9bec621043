import datetime as dt

import pytest

from ledgerlens.operators import compliance

DAY = dt.datetime(2023, 3, 1)


def on(day, amount=9500.0, **more):
    return {"transaction_at": DAY + dt.timedelta(days=day), "amount": amount, **more}


@pytest.mark.parametrize("days,found", [
    ([0, 2, 5], (3, 28500.0)),      # the window is five days back, both ends included
    ([0, 2, 6], None),
    ([0, 0], (4, 38000.0)),         # each row of a day counts all rows of the day
    ([0], None),
])
def test_structuring(make_payments, days, found):
    got = compliance.structuring(make_payments([on(d) for d in days])).collect()
    assert [(r["txn_count"], r["total_amount"]) for r in got] == ([found] if found else [])


def test_structuring_band(make_payments):
    outside = [on(0, 6999.99), on(0, 10000.0), on(0, 9000.0, status="declined")] * 3
    assert compliance.structuring(make_payments(outside)).isEmpty()
    assert compliance.structuring(make_payments([on(0, 7000.0)] * 2)).count() == 1


def test_velocity_windows(make_payments):
    burst = [{"transaction_at": dt.datetime(2023, 3, 1, 23, 59, 50) + dt.timedelta(seconds=i)} for i in range(21)]
    rows = make_payments(burst)
    assert compliance.velocity(rows).isEmpty()                     # ten before midnight, eleven after
    assert compliance.velocity(rows, {"velocity_max_txns": 10}).count() == 1
    same = make_payments([{"transaction_at": dt.datetime(2023, 3, 1, 5)}] * 21)
    assert compliance.velocity(same).first()["txn_count"] == 21
    assert compliance.velocity(same, semantics="reference").first()["txn_count"] == 21
    assert compliance.velocity(rows, {"velocity_max_txns": 10}, "reference").isEmpty()


def test_round_numbers(make_payments):
    rows = [{"amount": 100.0 * i} for i in range(1, 4)] + [{"amount": 12.5}] * 2
    assert compliance.round_numbers(make_payments(rows)).first()["round_pct"] == 60.0
    assert compliance.round_numbers(make_payments(rows[:4])).isEmpty()


@pytest.mark.parametrize("gap,count", [(90, 0), (91, 1)])
def test_dormant_edge(make_payments, gap, count):
    rows = [on(0, 5.0), on(gap, 7.0), on(gap, 9.0)]
    got = compliance.dormant_activity(make_payments(rows)).collect()
    assert [(r["max_gap_days"], r["recent_amount"], r["recent_txns"]) for r in got] == [(gap, 7.0, 1)] * count


def test_flags(make_payments):
    rows = make_payments([
        on(0), on(2), on(5), on(200, 6000.0, merchant_category="Wire Transfer"), on(201, 5000.0, merchant_category="ATM"),
    ])
    flags = compliance.aml_flags(rows)
    assert flags.columns == compliance.FLAG_COLUMNS
    got = [(r["flag_type"], r["severity"], r["transaction_count"], r["amount_total"]) for r in flags.collect()]
    assert got == [
        ("STRUCTURING", "HIGH", 0, 28500.0), ("LARGE_CASH_TRANSACTION", "HIGH", 1, 6000.0),
        ("DORMANT_ACCOUNT_ACTIVITY", "MEDIUM", 0, 6000.0), ("ROUND_NUMBER_BIAS", "LOW", 0, 39500.0),
    ]
    text = flags.first()["description"]
    assert text == "Possible structuring: 3 transactions totalling $28,500.00 — all below $10,000 threshold within 5 days"
    assert {r["severity"]: r["flags"] for r in compliance.flag_counts(flags).collect()} == {"HIGH": 2, "MEDIUM": 1, "LOW": 1}


def test_no_flags_keep_the_columns(make_payments):
    none = compliance.aml_flags(make_payments([{"amount": 3.5}]))
    assert none.isEmpty() and none.columns == compliance.FLAG_COLUMNS
