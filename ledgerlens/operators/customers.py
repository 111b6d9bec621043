"""Customer marts: the 360 view, cohort retention and RFM segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import (
    count_where, days_apart, money, month_of, months_apart, percent, ratio, round_to,
)
from ledgerlens.operators.ordering import with_ntiles
from ledgerlens.storage import stage

SUMMARY_COUNTS = [
    "total_transactions", "active_months", "distinct_merchants", "distinct_categories",
    "customer_tenure_days", "fraud_flagged_count", "cross_border_count",
]
SUMMARY_AMOUNTS = ["total_spend_gbp", "avg_transaction_gbp", "median_transaction_gbp", "engagement_score"]


def customers_360(
    customers: DataFrame, summary: DataFrame, disputes: DataFrame, as_of: Column
) -> DataFrame:
    """One row per customer with spend, engagement, disputes, value tier and churn risk."""
    per_customer = disputes.groupBy("customer_id").agg(
        F.count("*").alias("total_disputes"),
        count_where(F.col("is_won")).alias("disputes_won"),
        money(F.sum("amount")).alias("total_disputed_amount"),
    )
    joined = customers.join(
        summary.select(
            "customer_id", *SUMMARY_COUNTS, *SUMMARY_AMOUNTS,
            "first_transaction_date", "last_transaction_date",
        ),
        "customer_id", "left",
    ).join(per_customer, "customer_id", "left")
    spend = F.coalesce(F.col("total_spend_gbp"), F.lit(0.0))
    quiet = days_apart(F.col("last_transaction_date"), as_of)
    whole = [*SUMMARY_COUNTS, "total_disputes", "disputes_won"]
    amounts = [*SUMMARY_AMOUNTS, "total_disputed_amount"]
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in whole}
    filled |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in amounts}
    return joined.select(
        "customer_id", "full_name", "email", "country_code", "account_tier", "signup_date",
        "kyc_status", "is_kyc_verified", "account_currency", "age_years",
        "first_transaction_date", "last_transaction_date",
        *[expr.alias(c) for c, expr in filled.items()],
        month_of(F.col("signup_date")).alias("signup_cohort"),
        F.when(spend >= 10000, "platinum").when(spend >= 3000, "gold")
        .when(spend >= 500, "silver").otherwise("bronze").alias("ltv_tier"),
        F.when(quiet.isNull(), "churned").when(quiet > 60, "at_risk")
        .when(quiet > 30, "cooling").otherwise("active").alias("churn_risk_segment"),
        days_apart(F.col("signup_date"), as_of).alias("days_since_signup"),
    )


def cohort_retention(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of each signup cohort that transacted N months after signup.

    Both sides are made distinct first, (customer, cohort) and (customer, month), so the
    distinct customers of the report are plain counts and no customer brings more rows to
    the join than there are months.
    """
    members = customers.select("customer_id", month_of(F.col("signup_date")).alias("cohort_month")).distinct()
    months = (
        transactions.filter("is_completed")
        .select("customer_id", F.col("transaction_month").alias("active_month"))
        .distinct()
    )
    sizes = members.groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))
    active = (
        members.join(months, "customer_id")
        .withColumn("months_since_signup", months_apart(F.col("cohort_month"), F.col("active_month")))
        .filter(F.col("months_since_signup") >= 0)
        .groupBy("cohort_month", "months_since_signup")
        .agg(F.count("*").alias("active_customers"))
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month", "months_since_signup", "active_customers", "cohort_size",
        ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )


def first_purchase_retention(payments: DataFrame) -> DataFrame:
    """Retention of cohorts defined by the month of the first completed transaction.

    One pass: rows become distinct (customer, month) pairs, whose first month per customer
    is the cohort. Every member is active in month 0, so that count is the cohort's size.
    """
    months = (
        payments.filter((F.col("status") == "completed") & F.col("transaction_at").isNotNull())
        .select("customer_id", month_of(F.col("transaction_at").cast("date")).alias("active_month"))
        .distinct()
    )
    first = F.min("active_month").over(Window.partitionBy("customer_id"))
    active = (
        months.withColumn("cohort_month", first)
        .groupBy("cohort_month", months_apart(F.col("cohort_month"), F.col("active_month")).alias("months_since_signup"))
        .agg(F.count("*").alias("active_customers"))
    )
    at_start = F.when(F.col("months_since_signup") == 0, F.col("active_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return active.withColumn("cohort_size", size).withColumn(
        "retention_pct", percent(F.col("active_customers"), F.col("cohort_size"), 1)
    )


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """Segment of an RFM score. The first rung that fits wins, so the order is the rule."""
    # fixed values: the rungs
    return (
        F.when((r == 5) & (f >= 4) & (m >= 4), "Champions")
        .when((f >= 4) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & (f >= 2) & (f <= 3), "Potential Loyalists")
        .when((r >= 4) & (f == 1), "Recent Customers")
        .when((r == 3) & (f >= 2), "Promising")
        .when((r == 3) & (f == 1) & (m >= 3), "Need Attention")
        .when((r == 2) & (f <= 2), "About to Sleep")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r == 1) & (f >= 4), "Cannot Lose Them")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Hibernating")
        .when((r == 1) & (f == 1), "Lost")
        .otherwise("Others")
    )


def group_of(segment: Column) -> Column:
    result = F.lit("Others")
    for group, members in fixed.SEGMENT_GROUPS.items():
        result = F.when(segment.isin(members), group).otherwise(result)
    return result


def action_of(segment: Column) -> Column:
    result = F.lit(fixed.SEGMENT_ACTION_DEFAULT)
    for name, action in fixed.SEGMENT_ACTIONS.items():
        result = F.when(segment == name, action).otherwise(result)
    return result


def simple_action_of(segment: Column) -> Column:
    return F.when(segment.isin(fixed.SIMPLE_ACTION_SEGMENTS), action_of(segment)).otherwise(
        fixed.SIMPLE_ACTION_DEFAULT
    )


def _score(activity: DataFrame, monetary: str, semantics: str) -> DataFrame:
    """Quintile scores, total and segment.

    ``activity`` holds one row per customer and is read once per score, so it is stored.
    As first written the recency score is 6 minus its quintile, which gives the stalest
    customers a 5; the corrected score gives it to the most recent.
    """
    scored = with_ntiles(
        stage(activity, "rfm-activity"),
        {
            "r_score": ("recency_days", True),
            "f_score": ("frequency", False),
            "m_score": (monetary, False),
        },
        id_col="customer_id",
    )
    if semantics == "reference":
        scored = scored.withColumn("r_score", F.lit(6).cast("bigint") - F.col("r_score"))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn("rfm_total", r + f + m).withColumn("rfm_segment", segment_of(r, f, m))


def _activity(completed: DataFrame, day: Column, amount: str, today: DataFrame, names: dict) -> DataFrame:
    per_customer = completed.groupBy("customer_id").agg(
        F.max(day).alias(names["last"]),
        F.count("*").alias("frequency"),
        money(F.sum(amount)).alias(names["monetary"]),
    )
    return per_customer.crossJoin(F.broadcast(today)).select(
        "customer_id",
        days_apart(F.col(names["last"]), F.col("_today")).alias("recency_days"),
        "frequency",
        names["monetary"],
        names["last"],
    )


def rfm_segmentation(
    transactions: DataFrame, priced: DataFrame, customers: DataFrame, semantics: str = "corrected"
) -> DataFrame:
    """RFM segments of customers with completed transactions, in GBP, with customer context.

    The reference date is the last day of all ``transactions``, completed or not.
    """
    today = transactions.agg(F.max("transaction_date").alias("_today"))
    activity = _activity(
        priced.filter("is_completed"), F.col("transaction_date"), "amount_gbp", today,
        {"last": "last_transaction_date", "monetary": "monetary_gbp"},
    )
    scored = _score(activity, "monetary_gbp", semantics)
    context = customers.select(
        "customer_id", "full_name", "email", "country_code", "account_tier",
        "account_currency", "signup_date", "is_kyc_verified",
    )
    segment = F.col("rfm_segment")
    return (
        scored.join(context, "customer_id")
        .withColumn("monetary_gbp", round_to(F.col("monetary_gbp"), 2))
        .withColumn("segment_group", group_of(segment))
        .withColumn("recommended_action", action_of(segment))
    )


def rfm(payments: DataFrame, semantics: str = "corrected") -> DataFrame:
    """RFM segments straight from a payments table, in the table's own currency units."""
    day = F.col("transaction_at").cast("date")
    today = payments.agg(F.max(day).alias("_today"))
    activity = _activity(
        payments.filter(F.col("status") == "completed"), day, "amount", today,
        {"last": "last_txn_date", "monetary": "monetary"},
    )
    return (
        _score(activity, "monetary", semantics)
        .withColumnRenamed("rfm_segment", "segment")
        .withColumn("recommended_action", simple_action_of(F.col("segment")))
    )
