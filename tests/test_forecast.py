import datetime as dt

import numpy as np
import pytest

from ledgerlens.operators import forecast


def performance(spark, revenue, fraud):
    months = [dt.date(2023 + i // 12, i % 12 + 1, 1) for i in range(len(revenue))]
    rows = [(m, "GBP", 10, r, f, 90.0) for m, r, f in zip(months, revenue, fraud)]
    return spark.createDataFrame(
        rows, "month date, currency string, total_transactions bigint, total_volume double, "
        "fraud_rate_pct double, completion_pct double")


@pytest.mark.parametrize("revenue", [[100.0, 140.0], [100.0, 90.5, 130.25, 170.0, 160.0, 210.0], [500.0, 300.0, 20.0]])
def test_matches_least_squares(spark, revenue):
    history = forecast.monthly_history(performance(spark, revenue, [1.0] * len(revenue)))
    got = forecast.linear_forecast(history, "revenue", 4).collect()
    x = np.arange(len(revenue))
    line = np.poly1d(np.polyfit(x, revenue, 1))
    band = 1.96 * np.std(np.array(revenue) - line(x))
    for i, r in enumerate(got):
        p = line(len(revenue) + i)
        assert r["predicted"] == pytest.approx(max(p, 0), abs=0.011)
        assert r["lower_95"] == pytest.approx(max(p - band, 0), abs=0.011)
        assert r["upper_95"] == pytest.approx(max(p + band, 0), abs=0.011)


def test_single_month(spark):
    history = forecast.monthly_history(performance(spark, [200.0], [2.0]))
    r = forecast.linear_forecast(history, "revenue", 1).first()
    assert (r["month"], r["predicted"], r["lower_95"], r["upper_95"]) == ("2023-02", 200.0, 160.8, 239.2)


def test_fraud_is_clamped(spark):
    history = forecast.monthly_history(performance(spark, [1.0] * 3, [2.0, 9.0, 14.0]))
    got = forecast.linear_forecast(history, "fraud_rate_pct", 30).collect()
    assert len(got) == 12 and all(0 <= r["lower_95"] <= r["predicted"] <= r["upper_95"] <= 15 for r in got)
    assert [r["month"] for r in got][:2] == ["2023-04", "2023-05"]


@pytest.mark.parametrize("months,confidence,warnings", [(0, "low", 2), (2, "low", 1), (5, "medium", 1), (6, "high", 0)])
def test_quality(spark, months, confidence, warnings):
    history = forecast.monthly_history(performance(spark, [1.0] * months, [1.0] * months)) if months else \
        forecast.monthly_history(performance(spark, [1.0], [1.0]).limit(0))
    r = forecast.forecast_quality(history).first()
    assert (r["months_history"], r["confidence"], len(r["warnings"])) == (months, confidence, warnings)
    assert forecast.linear_forecast(history, "revenue").count() == (3 if months else 0)


def test_many_series_in_one_job(spark):
    one = performance(spark, [10.0, 20.0, 30.0], [1.0] * 3)
    both = one.unionByName(performance(spark, [5.0, 5.0], [1.0] * 2).replace("GBP", "USD"))
    got = forecast.linear_forecast(forecast.monthly_history(both, ["currency"]), "revenue", 1, ["currency"]).collect()
    assert {r["currency"]: r["predicted"] for r in got} == {"GBP": 40.0, "USD": 5.0}


def test_zones_and_differences(spark):
    df = spark.createDataFrame([("2023-01", 4.0), ("2023-02", 2.5), ("2023-03", 1.0)], "month string, predicted double")
    assert [r["zone"] for r in forecast.fraud_table(df).orderBy("month").collect()] == ["red", "yellow", "green"]
    assert [r["vs_mean_pct"] for r in forecast.revenue_table(df).orderBy("month").collect()] == [60.0, 0.0, -60.0]
