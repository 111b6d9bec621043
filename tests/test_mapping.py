import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.columns import uuid5_dns
from ledgerlens.operators import mapping


def normalised(spark, rows, schema, **kwargs):
    df = spark.createDataFrame(rows, schema)
    return mapping.normalise(df, mapping.mapping_for(df.columns, **kwargs))


def test_detects_other_names():
    found = mapping.detect_columns(["record_id", "member_id", "debit", "payee", "outcome", "occurred_at"])
    assert found.sources() == {
        "transaction_id": "record_id", "amount": "debit", "customer_id": "member_id",
        "merchant_name": "payee", "status": "outcome", "transaction_at": "occurred_at",
    }
    assert found.confidence["amount"] == 100


def test_similar_names_and_threshold():
    assert mapping.detect_columns(["amounts"]).confidence["amount"] == 92
    assert "amount" not in mapping.detect_columns(["amounts"], threshold=95).mapping
    assert mapping.name_similarity("abc", "abc") == 100
    assert mapping.name_similarity("abc", "xyz") == 0


def test_later_field_wins_a_shared_column():
    found = mapping.detect_columns(["price"]).override({"customer_id": "x", "merchant_id": "x"})
    found = mapping.ColumnMapping(found.mapping, found.confidence, found.unmatched, ("price", "x"))
    assert found.sources() == {"amount": "price", "merchant_id": "x"}


def test_override_and_preset():
    assert mapping.mapping_for(["zzz"], {"amount": "zzz"}).confidence["amount"] == 100
    preset = mapping.mapping_for(["Time", "Amount", "Class"], preset="mlg-ulb/creditcardfraud")
    assert preset.mapping["is_fraud"] == "Class"
    with pytest.raises(ValueError, match="amount"):
        mapping.mapping_for(["zzz"])


def test_amounts_and_defaults(spark):
    got = normalised(spark, [("a", "12.5"), ("b", "-3"), ("c", "abc"), (None, None)], "ref string, amount string").collect()
    by_id = {r["transaction_id"]: r for r in got}
    assert by_id["a"]["amount"] == 12.5 and by_id["b"]["amount"] == 3.0 and by_id["c"]["amount"] is None
    r = by_id["a"]
    assert (r["customer_id"], r["currency"], r["merchant_category"], r["is_fraud"]) == ("unknown", "USD", "Other", False)
    assert r["merchant_id"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "Unknown Merchant"))
    generated = [r["transaction_id"] for r in got if r["transaction_id"] not in ("a", "b", "c")]
    assert len(generated) == 1 and uuid.UUID(generated[0])


def test_filled_ids_stay_the_same(spark):
    df = normalised(spark, [("a", 1.0), (None, 2.0), (None, 3.0)], "ref string, amount double")
    first = sorted(r["transaction_id"] for r in df.collect())
    assert first == sorted(r["transaction_id"] for r in df.collect()) and len(set(first)) == 3


def test_generated_ids_stay_the_same(spark):
    df = normalised(spark, [(1.0,), (2.0,), (2.0,)], "amount double")
    first = sorted(r["transaction_id"] for r in df.collect())
    assert first == sorted(r["transaction_id"] for r in df.collect()) and len(set(first)) == 3
    assert sorted(r["transaction_at"] for r in df.collect()) == [
        dt.datetime(2023, 1, 1, 0, 0, s) for s in (0, 30)
    ] + [dt.datetime(2023, 1, 1, 0, 1)]


def test_status_flags_currency(spark):
    rows = [("a", " OK ", "YES", " gbp"), ("b", "refused", "0", None), ("c", "in_progress", None, "usd"), ("d", None, "fraud", "x")]
    got = {r["transaction_id"]: r for r in normalised(
        spark, [(1.0, *r) for r in rows], "amount double, ref string, status string, fraud string, ccy string").collect()}
    assert [got[k]["status"] for k in "abcd"] == ["completed", "declined", "pending", "unknown"]
    assert [got[k]["is_fraud"] for k in "abcd"] == [True, False, False, True]
    assert [got[k]["currency"] for k in "abcd"] == ["GBP", None, "USD", "X"]


def test_timestamps(spark):
    text = normalised(spark, [("a", 1.0, "2023-05-01 10:00:00"), ("b", 1.0, "bad"), ("c", 1.0, None)],
                      "ref string, amount double, date string")
    got = {r["transaction_id"]: r["transaction_at"] for r in text.collect()}
    assert got == {"a": dt.datetime(2023, 5, 1, 10), "b": dt.datetime(2023, 1, 1), "c": dt.datetime(2023, 1, 1, 0, 0, 30)}
    numeric = normalised(spark, [("a", 1.0, 90.5)], "ref string, amount double, time double").first()
    assert numeric["transaction_at"] == dt.datetime(2023, 1, 1, 0, 1, 30, 500000)


def test_uuid5(spark):
    names = ["a", "Tesco", "café ☕", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(uuid5_dns(F.col("n"))).collect()] == [
        str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names
    ]


def test_flag_survives_unless_as_written(spark):
    canonical = normalised(spark, [("a", 1.0, "1")], "ref string, amount double, fraud string")
    assert mapping.payments_for_analytics(canonical).first()["is_flagged_fraud"] is True
    assert mapping.payments_for_analytics(canonical, "reference").first()["is_flagged_fraud"] is False
    assert mapping.payments_for_analytics(canonical).first()["status"] == "completed"


def test_exact_profile_gathers_each_field_alone(spark):
    rows = spark.createDataFrame([("1", "c1", "x"), ("2", "c1", None), ("2", "c2", "x")], "amount string, member_id string, status string")
    made = mapping.mapping_profile(rows, mapping.mapping_for(rows.columns), exact=True)
    assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    found = {r["field"]: (r["non_null"], r["distinct_values"]) for r in made.collect()}
    assert (found["amount"], found["customer_id"], found["status"], found["channel"]) == ((3, 2), (3, 2), (2, 1), (0, 0))
    none = mapping.mapping_profile(rows.limit(0), mapping.mapping_for(rows.columns), exact=True).collect()
    assert {r["distinct_values"] for r in none} == {0} and len(none) == len(made.collect())
