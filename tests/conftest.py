import datetime as dt
import random

import pytest

from ledgerlens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PAYMENT_SCHEMA = (
    "transaction_id string, customer_id string, merchant_id string, merchant_name string, "
    "merchant_category string, amount double, currency string, transaction_at timestamp, "
    "status string, channel string, is_fraud boolean"
)


def payment(i, **changes):
    row = {
        "transaction_id": f"t{i}", "customer_id": "c1", "merchant_id": "m1", "merchant_name": "Shop",
        "merchant_category": "Retail", "amount": 10.0, "currency": "GBP",
        "transaction_at": dt.datetime(2023, 1, 1), "status": "completed", "channel": "card",
        "is_fraud": False,
    }
    return tuple({**row, **changes}.values())


@pytest.fixture(scope="session")
def make_payments(spark):
    def make(rows):
        df = spark.createDataFrame([payment(i, **r) for i, r in enumerate(rows)], PAYMENT_SCHEMA)
        return df.withColumn("is_flagged_fraud", df["is_fraud"])
    return make


@pytest.fixture(scope="session")
def sample_rows():
    """480 payments in January, 80 minutes apart, of 37 customers at 12 shops; each shop has one category."""
    rng = random.Random(2023)
    shops = [("Harbour Books", "Books"), ("Station Cash", "ATM"), ("Oak Bakery", "Bakery"), ("Quick Send", "Transfer")]
    rows = []
    for i in range(480):
        shop = rng.randrange(12)
        name, category = shops[shop % len(shops)]
        rows.append({
            "customer_id": f"person{rng.randrange(37):02d}", "merchant_id": f"shop{shop}",
            "merchant_name": f"{name} {shop}", "merchant_category": category,
            "amount": round(rng.lognormvariate(4, 0.8), 2), "currency": rng.choice(["GBP", "GBP", "USD", "EUR"]),
            "transaction_at": dt.datetime(2023, 1, 1) + dt.timedelta(minutes=80 * i),
            "status": rng.choices(["completed", "declined", "pending"], [0.85, 0.1, 0.05])[0],
            "channel": rng.choice(["card", "app", "web"]), "is_fraud": rng.random() < 0.05,
        })
    return rows


@pytest.fixture(scope="session")
def sample(make_payments, sample_rows):
    return make_payments(sample_rows)
