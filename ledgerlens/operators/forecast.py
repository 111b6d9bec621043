"""Monthly history and linear-trend forecasts, for one series or many at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.columns import money, ratio, round_to

MIN_MONTHS = 3
FULL_MONTHS = 6
MODEL = "linear_trend"


def monthly_history(performance: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Months with their volume, counts and the plain mean of the groups' rates."""
    return performance.groupBy(*(by or []), F.trunc("month", "month").alias("month")).agg(
        money(F.sum("total_volume")).alias("revenue"),
        round_to(ratio(F.round(F.sum("fraud_rate_pct"), 3), F.count("fraud_rate_pct")), 4).alias("fraud_rate_pct"),
        F.sum("total_transactions").alias("txn_count"),
        round_to(ratio(F.round(F.sum("completion_pct"), 2), F.count("completion_pct")), 2).alias("completion_pct"),
    )


def _clamped(metric: str, value: Column) -> Column:
    if metric == "fraud_rate_pct":
        return round_to(F.least(F.greatest(value, F.lit(0.0)), F.lit(15.0)), 3)
    return round_to(F.greatest(value, F.lit(0.0)), 2)


def linear_forecast(
    history: DataFrame, metric: str, months: int = 3, by: list[str] | None = None
) -> DataFrame:
    """Project ``metric`` by least squares on the month's position, with a 95 % band.

    The band is 1.96 population deviations of the residuals, from the regression sums; a
    single month is carried forward with a tenth of its value as deviation. ``by`` fits one
    line per group in the same job; a group's months are few whatever the data size.
    """
    months = min(max(months, 1), 12)
    by = by or []
    place = F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("month")) - 1
    # Months are an aggregate (twelve rows a year), so ordering them in one task is cheap.
    points = history.select(
        *by, "month", F.coalesce(F.col(metric).cast("double"), F.lit(0.0)).alias("y"),
        place.cast("double").alias("x"),
    )
    fit = points.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.max("month").alias("last"),
        F.avg("y").alias("mean"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.regr_syy("y", "x").alias("syy"),
        F.regr_sxy("y", "x").alias("sxy"),
    ).filter(F.col("n") > 0)
    single = F.col("n") == 1
    unexplained = F.greatest(F.lit(0.0), F.col("syy") - ratio(F.col("sxy") * F.col("sxy"), F.col("sxx")))
    sigma = F.when(single, F.col("mean") * 0.1).otherwise(F.sqrt(unexplained / F.col("n")))
    ahead = fit.select("*", sigma.alias("sigma"), F.explode(F.sequence(F.lit(1), F.lit(months))).alias("step"))
    predicted = F.when(single, F.col("mean")).otherwise(
        F.col("intercept") + F.col("slope") * (F.col("n") + F.col("step") - 1)
    )
    band = F.col("sigma") * 1.96
    return ahead.select(
        *by,
        F.date_format(F.add_months("last", F.col("step")), "yyyy-MM").alias("month"),
        _clamped(metric, predicted).alias("predicted"),
        _clamped(metric, predicted - band).alias("lower_95"),
        _clamped(metric, predicted + band).alias("upper_95"),
    ).orderBy(*by, "month")


def forecast_quality(history: DataFrame, months: int = 3) -> DataFrame:
    """One row: length of history, model, confidence and warnings."""
    n = F.col("months_history")
    count = n.cast("string")
    # fixed values: wording of the warnings
    warnings = F.array_compact(F.array(
        F.when(n < MIN_MONTHS, F.concat(
            F.lit("Only "), count, F.lit(" month(s) of data — forecasts will have low accuracy. "),
            F.lit(f"At least {MIN_MONTHS} months recommended."),
        )).when(n < FULL_MONTHS, F.concat(
            F.lit("Only "), count,
            F.lit(" months of history — seasonal patterns may not be captured. Forecasts are indicative only."),
        )),
        F.when(n == 0, "No historical data available for forecasting."),
    ))
    return history.agg(F.count("*").alias("months_history")).select(
        F.lit(min(max(months, 1), 12)).alias("months_forecast"),
        "months_history",
        F.when(n == 0, "none").otherwise(MODEL).alias("model"),
        F.when(n < MIN_MONTHS, "low").when(n < FULL_MONTHS, "medium").otherwise("high").alias("confidence"),
        warnings.alias("warnings"),
    )


def forecast_summary(history: DataFrame, months: int = 3) -> DataFrame:
    """One row: next month's revenue and fraud rate with the quality of the forecast.

    A prediction of exactly zero is reported as null.
    """
    def next_month(metric: str, name: str) -> DataFrame:
        first = linear_forecast(history, metric, 1)
        return first.agg(F.nullif(F.first("predicted"), F.lit(0.0)).alias(name))

    return (
        next_month("revenue", "next_month_revenue")
        .crossJoin(F.broadcast(next_month("fraud_rate_pct", "next_month_fraud_rate_pct")))
        .crossJoin(F.broadcast(forecast_quality(history, months).drop("warnings")))
    )


def revenue_table(forecast: DataFrame) -> DataFrame:
    """Revenue forecast with each month's difference from the forecast's mean."""
    mean = forecast.agg(ratio(money(F.sum("predicted")), F.count("predicted")).alias("_mean"))
    change = (F.col("predicted") - F.col("_mean")) / F.greatest(F.col("_mean"), F.lit(1.0)) * 100.0
    return (
        forecast.crossJoin(F.broadcast(mean))
        .withColumn("vs_mean_pct", round_to(change, 1))
        .drop("_mean")
    )


def fraud_table(forecast: DataFrame) -> DataFrame:
    """Fraud-rate forecast with its colour zone."""
    p = F.col("predicted")
    return forecast.withColumn("zone", F.when(p > 3.0, "red").when(p > 2.0, "yellow").otherwise("green"))
