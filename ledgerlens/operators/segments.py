"""Views over the RFM, cohort and merchant results of a payments table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import money, percent, ratio, round_to, with_share

AT_RISK = ["At Risk", "Cannot Lose Them"]
LOST = ["Hibernating", "Lost"]


# ---- customers -------------------------------------------------------------

def by_spend(rfm: DataFrame) -> DataFrame:
    return rfm.orderBy(F.col("monetary").desc_nulls_last(), "customer_id")


def segment_customers(rfm: DataFrame, *names: str) -> DataFrame:
    return by_spend(rfm.filter(F.col("segment").isin(list(names))))


def segment_summary(rfm: DataFrame) -> DataFrame:
    spend = money(F.sum("monetary"))
    groups = rfm.groupBy("segment").agg(
        F.count("*").alias("customers"),
        round_to(ratio(spend, F.count("monetary")), 2).alias("avg_monetary"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"),
        round_to(F.avg("recency_days"), 0).alias("avg_recency_days"),
        spend.alias("total_revenue"),
    )
    return with_share(groups, "customers", "pct_of_customers", digits=1).orderBy(
        F.col("total_revenue").desc_nulls_last(), "segment"
    )


# ---- cohorts ---------------------------------------------------------------

def retention_upto(retention: DataFrame, max_months: int = 12) -> DataFrame:
    return retention.filter(F.col("months_since_signup") <= max_months).orderBy(
        "cohort_month", "months_since_signup"
    )


def retention_matrix(retention: DataFrame, max_months: int = 6) -> DataFrame:
    """Cohorts as rows, month offsets as columns ``M0``..; the columns are listed, not scanned for."""
    offsets = list(range(max_months + 1))
    wide = (
        retention.filter(F.col("months_since_signup") <= max_months)
        .groupBy(F.col("cohort_month").cast("string").alias("cohort_month"))
        .pivot("months_since_signup", offsets)
        .agg(F.avg("retention_pct"))
    )
    return wide.select("cohort_month", *[F.col(str(n)).alias(f"M{n}") for n in offsets]).orderBy("cohort_month")


def best_cohort(retention: DataFrame, month: int = 3) -> DataFrame:
    """The cohort with the highest retention at ``month``; the older one on a tie."""
    return (
        retention.filter(F.col("months_since_signup") == month)
        .orderBy(F.col("retention_pct").desc_nulls_last(), "cohort_month")
        .limit(1)
        .select(F.col("cohort_month").cast("string").alias("cohort"),
                F.col("retention_pct").alias("m3_retention_pct"))
    )


def average_retention(retention: DataFrame) -> DataFrame:
    return (
        retention.groupBy("months_since_signup")
        .agg(
            round_to(ratio(F.round(F.sum("retention_pct"), 1), F.count("retention_pct")), 1)
            .alias("avg_retention_pct"),
            F.countDistinct("cohort_month").alias("cohorts"),
        )
        .orderBy("months_since_signup")
    )


# ---- merchants -------------------------------------------------------------

def by_fraud_rate(scorecard: DataFrame) -> DataFrame:
    return scorecard.orderBy(F.col("fraud_rate_pct").desc_nulls_last(), "merchant_id", "merchant_name", "merchant_category")


def in_band(scorecard: DataFrame, band: str) -> DataFrame:
    return scorecard.filter(F.col("risk_band") == band)


def top_by_volume(scorecard: DataFrame, n: int = 10) -> DataFrame:
    return scorecard.orderBy(
        F.col("total_volume").desc_nulls_last(), "merchant_id", "merchant_name", "merchant_category"
    ).limit(n)


def category_summary(scorecard: DataFrame) -> DataFrame:
    return (
        scorecard.groupBy("merchant_category")
        .agg(
            F.count("*").alias("merchants"),
            F.sum("total_transactions").alias("total_transactions"),
            money(F.sum("total_volume")).alias("total_volume"),
            round_to(ratio(F.round(F.sum("fraud_rate_pct"), 2), F.count("fraud_rate_pct")), 2)
            .alias("avg_fraud_rate_pct"),
            round_to(ratio(F.round(F.sum("completion_rate_pct"), 2), F.count("completion_rate_pct")), 2)
            .alias("avg_completion_pct"),
        )
        .orderBy(F.col("total_volume").desc_nulls_last(), "merchant_category")
    )


def velocity_alerts(scorecard: DataFrame, z_threshold: float = 2.5) -> DataFrame:
    """Merchants whose transaction count lies more than ``z_threshold`` deviations above the mean."""
    stats = scorecard.agg(
        F.avg("total_transactions").alias("_mean"), F.stddev_samp("total_transactions").alias("_sd")
    )
    z = ratio(F.col("total_transactions") - F.col("_mean"), F.col("_sd"))
    return (
        scorecard.crossJoin(F.broadcast(stats))
        .filter(z > z_threshold)
        .withColumn("z_score", round_to(z, 2))
        .drop("_mean", "_sd")
        .orderBy(F.col("z_score").desc(), "merchant_id")
    )


# ---- mart results in the shape of the simplified results --------------------

def rfm_from_mart(mart: DataFrame) -> DataFrame:
    return mart.select(
        "customer_id", "recency_days", "frequency",
        F.col("monetary_gbp").alias("monetary"),
        F.col("last_transaction_date").alias("last_txn_date"),
        "r_score", "f_score", "m_score", "rfm_total",
        F.col("rfm_segment").alias("segment"),
        "recommended_action",
    )


def retention_from_mart(mart: DataFrame) -> DataFrame:
    return mart.select(
        "cohort_month", "months_since_signup", "active_customers", "cohort_size",
        percent(F.col("active_customers"), F.col("cohort_size"), 1).alias("retention_pct"),
    )


def performance_from_mart(mart: DataFrame) -> DataFrame:
    return mart.select(
        "month", "currency", "total_transactions",
        F.col("completed_transactions").alias("completed"),
        F.col("declined_transactions").alias("declined"),
        F.col("total_volume_gbp").alias("total_volume"),
        F.col("avg_transaction_gbp").alias("avg_transaction"),
        F.col("fraud_flagged_count").alias("fraud_count"),
        round_to(F.col("completion_rate") * 100.0, 2).alias("completion_pct"),
        round_to(F.col("fraud_rate") * 100.0, 3).alias("fraud_rate_pct"),
    )


def scorecard_from_mart(mart: DataFrame) -> DataFrame:
    return mart.select(
        "merchant_id", "merchant_name", "merchant_category", "total_transactions",
        F.col("completed_transactions").alias("completed"),
        F.col("total_volume_gbp").alias("total_volume"),
        F.col("fraud_flagged_count").alias("fraud_count"),
        round_to(F.col("fraud_rate") * 100.0, 2).alias("fraud_rate_pct"),
        round_to(F.col("completion_rate") * 100.0, 2).alias("completion_rate_pct"),
        "unique_customers", "risk_band",
    )
