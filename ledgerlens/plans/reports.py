"""Executive queries and report datasets over the marts and the simplified results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import (
    count_where, money, percent, ratio, round_to, with_share,
)
from ledgerlens.operators.customers import group_of


def _mean_pct(rate: str, digits: int) -> Column:
    """Plain mean of a rate column as a percentage; the mean is fixed to 12 digits first so
    that it does not depend on the order of addition."""
    return round_to(F.round(F.avg(rate), 12) * 100.0, digits)


def _text_month(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


# ---- executive queries -------------------------------------------------------

def monthly_health(performance: DataFrame) -> DataFrame:
    """Volume, rates and month-on-month growth."""
    months = performance.groupBy("month").agg(
        money(F.sum("total_volume_gbp")).alias("total_volume_gbp"),
        F.sum("total_transactions").alias("total_transactions"),
        _mean_pct("completion_rate", 2).alias("avg_completion_pct"),
        _mean_pct("fraud_rate", 3).alias("avg_fraud_pct"),
    )
    # Twelve rows a year, already aggregated: one task orders them.
    before = F.lag("total_volume_gbp").over(Window.orderBy("month"))
    growth = ratio(F.col("total_volume_gbp"), before) * 100.0 - 100.0
    return months.withColumn("mom_volume_growth_pct", round_to(growth, 1)).orderBy("month")


def value_by_tier(customers_360: DataFrame) -> DataFrame:
    spend = money(F.sum("total_spend_gbp"))
    return (
        customers_360.groupBy("account_tier", "ltv_tier")
        .agg(
            F.count("*").alias("customer_count"),
            round_to(ratio(spend, F.count("*")), 2).alias("avg_ltv_gbp"),
            round_to(ratio(F.round(F.sum("engagement_score"), 1), F.count("*")), 1).alias("avg_engagement"),
            percent(count_where(F.col("churn_risk_segment").isin("at_risk", "churned")), F.count("*"), 1)
            .alias("churn_risk_pct"),
        )
        .orderBy("account_tier", F.col("avg_ltv_gbp").desc())
    )


def cohort_matrix(retention: DataFrame) -> DataFrame:
    """Retention at months 0, 1, 2, 3, 6 and 12, one row per cohort."""
    offsets = [0, 1, 2, 3, 6, 12]
    wide = (
        retention.groupBy(_text_month("cohort_month").alias("cohort"), "cohort_size")
        .pivot("months_since_signup", offsets)
        .agg(F.max(round_to(F.col("retention_rate") * 100.0, 1)))
    )
    return wide.select(
        "cohort", "cohort_size", *[F.col(str(n)).alias(f"M{n}") for n in offsets]
    ).orderBy("cohort")


def riskiest_merchants(scorecard: DataFrame, n: int = 10, at_least: int = 10) -> DataFrame:
    return (
        scorecard.filter(F.col("total_transactions") >= at_least)
        .orderBy(F.col("risk_score").desc_nulls_last(), "merchant_id")
        .limit(n)
        .select(
            "merchant_name", "merchant_category", "merchant_country", "total_transactions",
            round_to(F.col("total_volume_gbp"), 2).alias("total_volume_gbp"),
            round_to(F.col("fraud_rate") * 100.0, 2).alias("fraud_rate_pct"),
            round_to(F.col("dispute_rate") * 100.0, 2).alias("dispute_rate_pct"),
            "risk_score", "risk_band",
        )
    )


def repeat_fraud_customers(fraud_events: DataFrame, customers: DataFrame, at_least: int = 3) -> DataFrame:
    """Customers with several fraud events; ``customers`` is the 360 mart or the staged table.

    Events are reduced per customer before the join."""
    per_customer = fraud_events.groupBy("customer_id").agg(
        F.count("*").alias("fraud_events"),
        F.max("customer_fraud_velocity_30d").alias("max_30d_velocity"),
        money(F.sum("amount_gbp")).alias("total_fraud_amount_gbp"),
        count_where(F.col("has_dispute")).alias("disputed_count"),
        F.countDistinct("merchant_category").alias("merchant_categories_hit"),
    ).filter(F.col("fraud_events") >= at_least)
    who = customers.select("customer_id", "account_tier", "country_code", "is_kyc_verified")
    return per_customer.join(who, "customer_id").orderBy(
        F.col("fraud_events").desc(), F.col("total_fraud_amount_gbp").desc_nulls_last(), "customer_id"
    )


def success_by_channel(performance: DataFrame) -> DataFrame:
    return (
        performance.groupBy("channel", "merchant_category")
        .agg(
            F.sum("total_transactions").alias("total_txns"),
            _mean_pct("completion_rate", 2).alias("completion_pct"),
            _mean_pct("fraud_rate", 3).alias("fraud_pct"),
            money(F.sum("total_volume_gbp")).alias("volume_gbp"),
        )
        .orderBy(F.col("volume_gbp").desc_nulls_last())
    )


def fx_exposure(performance: DataFrame) -> DataFrame:
    totals = performance.groupBy("currency").agg(
        F.sum("total_transactions").alias("total_txns"),
        money(F.sum("total_volume_gbp")).alias("volume_gbp"),
    )
    return with_share(totals, "volume_gbp", "pct_of_total").orderBy(F.col("volume_gbp").desc_nulls_last())


# ---- report datasets over the marts --------------------------------------------

def monthly_volume(performance: DataFrame) -> DataFrame:
    return performance.groupBy(_text_month("month").alias("month")).agg(
        money(F.sum("total_volume_gbp")).alias("volume_gbp"),
        F.sum("total_transactions").alias("transactions"),
        _mean_pct("completion_rate", 2).alias("completion_pct"),
        _mean_pct("fraud_rate", 3).alias("fraud_pct"),
        F.sum("fraud_flagged_count").alias("fraud_events"),
    ).orderBy("month")


def kpis(performance: DataFrame) -> DataFrame:
    return performance.agg(
        round_to(money(F.sum("total_volume_gbp")) / 1_000_000.0, 2).alias("total_volume_m"),
        F.sum("total_transactions").alias("total_transactions"),
        _mean_pct("completion_rate", 1).alias("avg_completion_pct"),
        _mean_pct("fraud_rate", 2).alias("avg_fraud_pct"),
        F.sum("fraud_flagged_count").alias("total_fraud_events"),
    )


def rfm_kpis(rfm_mart: DataFrame) -> DataFrame:
    group = F.col("segment_group")
    return rfm_mart.agg(
        F.count("*").alias("total_customers"),
        count_where(group == "High Value").alias("high_value"),
        count_where(group == "At Risk").alias("at_risk"),
        money(F.sum("monetary_gbp")).alias("total_ltv_gbp"),
    )


def fraud_kpis(fraud_events: DataFrame) -> DataFrame:
    return fraud_events.agg(
        F.count("*").alias("total_fraud_events"),
        money(F.sum("amount_gbp")).alias("total_fraud_gbp"),
        count_where(F.col("has_dispute")).alias("disputed"),
        F.countDistinct("customer_id").alias("affected_customers"),
    )


def volume_mix(performance: DataFrame, by: str) -> DataFrame:
    """Volume and transactions per channel or currency."""
    return performance.groupBy(by).agg(
        money(F.sum("total_volume_gbp")).alias("volume_gbp"),
        F.sum("total_transactions").alias("transactions"),
    ).orderBy(F.col("volume_gbp").desc_nulls_last())


def segment_sizes(rfm_mart: DataFrame) -> DataFrame:
    spend = money(F.sum("monetary_gbp"))
    return (
        rfm_mart.groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customers"),
            round_to(ratio(spend, F.count("monetary_gbp")), 2).alias("avg_spend"),
            spend.alias("total_spend"),
        )
        .withColumn("segment_group", group_of(F.col("rfm_segment")))
        .orderBy(F.col("customers").desc(), "rfm_segment")
    )


def segment_group_spend(rfm_mart: DataFrame) -> DataFrame:
    return rfm_mart.groupBy("segment_group").agg(
        F.count("*").alias("customers"), money(F.sum("monetary_gbp")).alias("total_spend")
    ).orderBy(F.col("total_spend").desc_nulls_last())


def cohort_report(retention: DataFrame, max_months: int = 6) -> DataFrame:
    pct = (
        F.col("retention_pct") if "retention_pct" in retention.columns
        else round_to(F.col("retention_rate") * 100.0, 1)
    )
    return retention.filter(F.col("months_since_signup") <= max_months).select(
        _text_month("cohort_month").alias("cohort"), "months_since_signup",
        pct.alias("retention_pct"), "cohort_size",
    ).orderBy("cohort", "months_since_signup")


def top_customers(rfm_mart: DataFrame, n: int = 20) -> DataFrame:
    return rfm_mart.orderBy(F.col("monetary_gbp").desc_nulls_last(), "customer_id").limit(n).select(
        "full_name", "country_code", "account_tier", "rfm_segment", "segment_group",
        F.col("monetary_gbp").alias("spend_gbp"), "frequency", "recency_days", "rfm_total",
        "recommended_action",
    )


def fraud_by(fraud_events: DataFrame, column: str) -> DataFrame:
    """Fraud events and amount per merchant category or channel."""
    return fraud_events.groupBy(column).agg(
        F.count("*").alias("fraud_events"), money(F.sum("amount_gbp")).alias("fraud_amount")
    ).orderBy(F.col("fraud_events").desc())


def risk_bands(scorecard: DataFrame) -> DataFrame:
    return scorecard.groupBy("risk_band").agg(
        F.count("*").alias("merchants"),
        money(F.sum("total_volume_gbp")).alias("total_volume"),
        _mean_pct("fraud_rate", 2).alias("avg_fraud_pct"),
    )


def merchant_risk(scorecard: DataFrame, n: int = 20) -> DataFrame:
    return scorecard.orderBy(F.col("risk_score").desc_nulls_last(), "merchant_id").limit(n).select(
        "merchant_name", "merchant_category", "total_transactions",
        round_to(F.col("total_volume_gbp"), 2).alias("volume_gbp"),
        round_to(F.col("fraud_rate") * 100.0, 2).alias("fraud_pct"),
        round_to(F.col("dispute_rate") * 100.0, 2).alias("dispute_pct"),
        "risk_score", "risk_band",
    )


def run_summary(performance: DataFrame) -> DataFrame:
    """Totals of a run with its alerts: fraud above 5 %, completion below 85 %."""
    totals = performance.agg(
        round_to(money(F.sum("total_volume_gbp")) / 1_000_000.0, 2).alias("volume_m"),
        _mean_pct("completion_rate", 1).alias("completion_pct"),
        _mean_pct("fraud_rate", 2).alias("fraud_pct"),
        F.max("month").alias("latest_month"),
    )
    return totals.withColumns({
        "fraud_alert": F.coalesce(F.col("fraud_pct") > 5, F.lit(False)),
        "completion_alert": F.coalesce(F.col("completion_pct") < 85, F.lit(False)),
    })


# ---- report datasets over the simplified results -------------------------------

def dashboard_monthly(performance: DataFrame) -> DataFrame:
    return performance.withColumn("month", _text_month("month")).orderBy("month", "currency")


def dashboard_segments(rfm: DataFrame) -> DataFrame:
    spend = money(F.sum("monetary"))
    return rfm.groupBy("segment").agg(
        F.count("*").alias("customers"),
        round_to(ratio(spend, F.count("monetary")), 2).alias("avg_spend"),
        spend.alias("total_spend"),
    ).orderBy(F.col("customers").desc(), "segment")


def dashboard_merchants(scorecard: DataFrame, n: int = 20) -> DataFrame:
    return scorecard.orderBy(
        F.col("fraud_rate_pct").desc_nulls_last(), "merchant_id", "merchant_name", "merchant_category"
    ).limit(n)


def dashboard_trend(performance: DataFrame) -> DataFrame:
    """Per month: summed volume and the plain means of the currencies' percentages."""
    zero = F.lit(0.0)
    return performance.groupBy(_text_month("month").alias("month")).agg(
        money(F.sum(F.coalesce("total_volume", zero))).alias("volume"),
        round_to(ratio(F.round(F.sum(F.coalesce("completion_pct", zero)), 2), F.count("*")), 4).alias("completion_pct"),
        round_to(ratio(F.round(F.sum(F.coalesce("fraud_rate_pct", zero)), 3), F.count("*")), 4).alias("fraud_rate_pct"),
    ).orderBy("month")


def dashboard_counts(rfm: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Sizes of four segments, and critical merchants among the twenty shown."""
    segment = F.col("segment")
    counts = rfm.agg(
        count_where(segment == "Champions").alias("champions"),
        count_where(segment == "Loyal Customers").alias("loyal_customers"),
        count_where(segment == "At Risk").alias("at_risk"),
        count_where(segment == "Lost").alias("lost"),
    )
    critical = dashboard_merchants(scorecard).agg(
        count_where(F.col("risk_band") == "critical").alias("critical_merchants")
    )
    return counts.crossJoin(F.broadcast(critical))


def benchmark_comparison(metrics: DataFrame, industry: str = "payments_global") -> DataFrame:
    """Completion and fraud percentages against an industry; unknown industries use the global one."""
    rows = fixed.BENCHMARKS.get(industry, fixed.BENCHMARKS["payments_global"])
    lines = F.array(*[
        F.struct(
            F.lit(label).alias("metric"), F.col(name).alias("your_value"),
            F.lit(average).alias("industry_avg"), F.lit(top).alias("top_quartile"),
            F.lit("fraud" in name).alias("lower_is_better"),
        )
        for name, label, average, top in rows
    ])
    sign = F.when(F.col("lower_is_better"), -1.0).otherwise(1.0)
    mine = F.col("your_value") * sign
    # fixed values: the assessments
    assessment = (
        F.when(mine >= F.col("top_quartile") * sign, "Top quartile ✓")
        .when(mine >= F.col("industry_avg") * sign, "Above average")
        .when(F.col("lower_is_better"), "Below average ↑ improve")
        .otherwise("Below average ↓ investigate")
    )
    return metrics.select(F.explode(lines).alias("l")).select("l.*").withColumn(
        "assessment", assessment
    ).drop("lower_is_better")
