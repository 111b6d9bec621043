"""Payment performance: the GBP mart, the simplified variant and the headline metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import (
    count_where, money, month_of, percent, ratio, round_to, sum_where, with_share,
)


def monthly_payment_performance(enriched: DataFrame) -> DataFrame:
    """Monthly KPIs by currency, channel and merchant category, in GBP."""
    done, flagged = F.col("is_completed"), F.col("is_flagged_fraud")
    volume = money(sum_where(done, F.col("amount_gbp")))
    monthly = enriched.groupBy(
        F.col("transaction_month").alias("month"), "currency", "channel", "merchant_category"
    ).agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed_transactions"),
        count_where(F.col("is_declined")).alias("declined_transactions"),
        count_where(F.col("status") == "pending").alias("pending_transactions"),
        volume.alias("total_volume_gbp"),
        ratio(volume, F.count(F.when(done, F.col("amount_gbp")))).alias("avg_transaction_gbp"),
        ratio(count_where(done), F.count("*")).alias("completion_rate"),
        count_where(flagged).alias("fraud_flagged_count"),
        ratio(count_where(flagged), F.count("*")).alias("fraud_rate"),
        count_where(F.col("is_cross_border")).alias("cross_border_count"),
    )
    return with_share(monthly, "total_volume_gbp", "pct_of_monthly_volume", by=["month"])


def payment_performance(payments: DataFrame) -> DataFrame:
    """Monthly KPIs by currency in the currency's own units."""
    done, flagged = F.col("status") == "completed", F.col("is_flagged_fraud")
    volume = money(sum_where(done, F.col("amount")))
    return payments.groupBy(
        month_of(F.col("transaction_at").cast("date")).alias("month"), "currency"
    ).agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed"),
        count_where(F.col("status") == "declined").alias("declined"),
        volume.alias("total_volume"),
        ratio(volume, F.count(F.when(done, F.col("amount")))).alias("avg_transaction"),
        count_where(flagged).alias("fraud_count"),
        percent(count_where(done), F.count("*"), 2).alias("completion_pct"),
        percent(count_where(flagged), F.count("*"), 3).alias("fraud_rate_pct"),
    )


def headline_metrics(payments: DataFrame) -> DataFrame:
    """One row of totals; nulls become zero."""
    done = F.col("status") == "completed"
    flagged = F.coalesce(F.col("is_flagged_fraud").cast("string").try_cast("boolean"), F.lit(False))
    day = F.col("transaction_at").cast("date")
    volume = money(sum_where(done, F.col("amount")))
    zero = F.lit(0.0)
    return payments.agg(
        F.count("*").alias("total_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("merchant_id").alias("unique_merchants"),
        F.coalesce(volume, zero).alias("total_volume"),
        F.coalesce(
            round_to(ratio(volume, F.count(F.when(done, F.col("amount")))), 2), zero
        ).alias("avg_transaction"),
        F.coalesce(percent(count_where(done), F.count("*"), 1), zero).alias("completion_pct"),
        F.coalesce(percent(count_where(flagged), F.count("*"), 2), zero).alias("fraud_rate_pct"),
        F.min(day).alias("date_from"),
        F.max(day).alias("date_to"),
    )
