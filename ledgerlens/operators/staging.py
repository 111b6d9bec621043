"""Typed projections of the raw tables: renames, casts and derived columns, no joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import days_apart, month_of, years_apart


def stage_customers(raw: DataFrame, as_of: Column) -> DataFrame:
    born = F.col("date_of_birth").cast("date")
    return raw.select(
        "customer_id",
        "full_name",
        F.lower(F.trim("email")).alias("email"),
        "phone",
        F.col("country").alias("country_code"),
        "account_tier",
        F.col("signup_date").cast("date").alias("signup_date"),
        "kyc_status",
        born.alias("date_of_birth"),
        F.col("currency").alias("account_currency"),
        years_apart(born, as_of).alias("age_years"),
        F.coalesce(F.col("kyc_status") == "verified", F.lit(False)).alias("is_kyc_verified"),
    )


def stage_merchants(raw: DataFrame, as_of: Column) -> DataFrame:
    onboarded = F.col("onboarded_date").cast("date")
    return raw.select(
        "merchant_id",
        "merchant_name",
        F.col("category").alias("merchant_category"),
        "mcc_code",
        F.col("country").alias("merchant_country"),
        F.col("is_high_risk").cast("boolean").alias("is_high_risk"),
        onboarded.alias("onboarded_date"),
        days_apart(onboarded, as_of).alias("days_since_onboarding"),
    )


def stage_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions with what follows from their own columns, see ``derived_columns``."""
    at = F.col("transaction_at").cast("timestamp")
    typed = raw.select(
        "transaction_id",
        "customer_id",
        "merchant_id",
        F.col("amount").cast("double").alias("amount"),
        "currency",
        at.alias("transaction_at"),
        "status",
        F.col("is_flagged_fraud").cast("boolean").alias("is_flagged_fraud"),
        "channel",
        "ip_country",
    )
    return typed.withColumns(derived_columns())


def derived_columns() -> dict[str, Column]:
    """Columns that follow from a typed transaction.

    ``is_cross_border`` here compares the country code with the currency code as the
    source model does, so it is true whenever both are present; see ``enrich``.
    """
    at = F.col("transaction_at")
    day = at.cast("date")
    return {
        "transaction_date": day,
        "transaction_month": month_of(day),
        "transaction_week": F.trunc(day, "week"),
        "transaction_hour": F.hour(at).cast("bigint"),
        "day_of_week": (F.dayofweek(day) - 1).cast("bigint"),
        "is_completed": F.col("status") == "completed",
        "is_declined": F.col("status") == "declined",
        "is_cross_border": F.col("ip_country") != F.col("currency"),
    }


def stage_fx_rates(raw: DataFrame) -> DataFrame:
    rate = F.col("rate_to_gbp").cast("double")
    return raw.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        "currency",
        rate.alias("rate_to_gbp"),
        F.try_divide(F.lit(1.0).cast("double"), rate).alias("gbp_to_currency"),
    )


def stage_disputes(raw: DataFrame) -> DataFrame:
    opened = F.col("opened_at").cast("timestamp")
    return raw.select(
        "dispute_id",
        "transaction_id",
        "customer_id",
        opened.alias("opened_at"),
        opened.cast("date").alias("opened_date"),
        "reason",
        "status",
        F.col("amount").cast("double").alias("amount"),
        "currency",
        (F.col("status") == "won").alias("is_won"),
        (F.col("status") == "pending").alias("is_pending"),
    )
