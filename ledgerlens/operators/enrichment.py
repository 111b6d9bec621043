"""Transactions with customer, merchant and FX context, and their per-customer summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where, days_apart, money, ratio, round_to
from ledgerlens.operators import parcels
from ledgerlens.operators.skew import hot_medians, mark_hot
from ledgerlens.operators.staging import derived_columns

CUSTOMER_KEYS = ["customer_id", "account_tier", "customer_country", "is_kyc_verified"]


def price(transactions: DataFrame, fx: DataFrame) -> DataFrame:
    """Add ``amount_gbp`` at the rate of the day; a day without a rate counts as 1."""
    rates = fx.select(
        F.col("rate_date").alias("transaction_date"), "currency", F.col("rate_to_gbp").alias("_rate")
    )
    in_gbp = F.try_divide(F.col("amount"), F.coalesce(F.col("_rate"), F.lit(1.0)))
    return (
        transactions.join(rates, ["transaction_date", "currency"], "left")
        .withColumn("amount_gbp", round_to(in_gbp, 2))
        .drop("_rate")
    )


def enrich(
    transactions: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    fx: DataFrame,
    semantics: str = "corrected",
    whole_rows: bool = False,
) -> DataFrame:
    """Three left joins onto the transaction grain.

    Customers are too many to broadcast, so the join with them moves all transactions. Marts read few columns, and it is
    best to move those few. With ``whole_rows`` every column is wanted: customers are joined first, and what follows from
    a moved row or from the smaller tables (calendar columns, flags, rate, merchant) is added after the move. Rows move as
    parcels (``parcels.left_join``), and customers or merchants that are few by count are broadcast.

    For marts no side is hinted: Catalyst broadcasts a dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it beyond, where AQE splits the
    partition of a hot customer or merchant.

    ``semantics="corrected"`` calls a payment cross-border when its origin differs from the
    customer's country; ``"reference"`` keeps the staged flag.
    """
    c = customers.select(
        "customer_id",
        F.col("country_code").alias("customer_country"),
        "account_tier",
        "is_kyc_verified",
        "account_currency",
    )
    m = merchants.select(
        "merchant_id",
        "merchant_name",
        "merchant_category",
        "mcc_code",
        "merchant_country",
        F.col("is_high_risk").alias("is_high_risk_merchant"),
    )
    if whole_rows:
        derived = derived_columns()
        keys = ["customer_id", "merchant_id", "transaction_date", "currency"]
        rest = [name for name in transactions.columns if name not in keys]
        located = parcels.left_join(transactions.drop(*derived), c, "customer_id").withColumns(derived)
        joined = parcels.left_join(price(located, fx), m, "merchant_id").select(
            *keys, *rest, "amount_gbp", *m.columns[1:], *c.columns[1:]
        )
    else:
        joined = price(transactions, fx).join(m, "merchant_id", "left").join(c, "customer_id", "left")
    if semantics == "corrected":
        joined = joined.withColumn(
            "is_cross_border", F.col("ip_country") != F.col("customer_country")
        )
    risky, abroad = F.col("is_high_risk_merchant"), F.col("is_cross_border")
    tier = (
        F.when(F.col("is_flagged_fraud"), "fraud_flagged")
        .when(risky & abroad, "high_risk_cross_border")
        .when(risky, "high_risk_merchant")
        .when(abroad, "cross_border")
        .otherwise("standard")
    )
    return joined.withColumn("risk_tier", tier)


def customer_summary(enriched: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Completed activity per customer.

    Normally one aggregate does it all: the rows already lie by customer after the customer
    join, and the sets behind the distinct counts are as small as a customer's activity.
    With customers in ``hot`` (see ``skew.find_hot``) nothing is gathered by customer:
    distinct values are counted per (customer, value) first, which spreads a busy customer,
    and the median of such a customer is located by ``hot_medians``.
    """
    done = enriched.filter("is_completed")
    total = money(F.sum("amount_gbp"))
    plain = [
        F.count("*").alias("total_transactions"),
        total.alias("total_spend_gbp"),
        ratio(total, F.count("amount_gbp")).alias("avg_transaction_gbp"),
        F.max("amount_gbp").alias("max_transaction_gbp"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        days_apart(F.min("transaction_date"), F.max("transaction_date")).alias("customer_tenure_days"),
        count_where(F.col("is_flagged_fraud")).alias("fraud_flagged_count"),
        count_where(F.col("is_cross_border")).alias("cross_border_count"),
        count_where(F.col("channel") == "app").alias("app_txn_count"),
        count_where(F.col("channel") == "card").alias("card_txn_count"),
        count_where(F.col("channel") == "web").alias("web_txn_count"),
    ]
    distinct = {
        "active_months": "transaction_month",
        "distinct_merchants": "merchant_id",
        "distinct_categories": "merchant_category",
    }
    median = F.percentile("amount_gbp", F.lit(0.5)).alias("median_transaction_gbp")
    if hot is None:
        sets = [F.size(F.collect_set(c)).cast("bigint").alias(n) for n, c in distinct.items()]
        summary = done.groupBy(*CUSTOMER_KEYS).agg(*plain, *sets, median)
    else:
        marked = mark_hot(done, "customer_id", hot)
        medians = (
            marked.filter(~F.col("_hot")).groupBy(*CUSTOMER_KEYS).agg(median)
            .unionByName(hot_medians(marked.filter("_hot"), CUSTOMER_KEYS, "amount_gbp", "median_transaction_gbp"))
            .select(*[F.col(k).alias(f"_k_{k}") for k in CUSTOMER_KEYS], "median_transaction_gbp")
        )
        same = F.lit(True)
        for k in CUSTOMER_KEYS:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        counts = [F.countDistinct(c).alias(n) for n, c in distinct.items()]
        summary = (
            done.groupBy(*CUSTOMER_KEYS).agg(*plain, *counts)
            .join(medians, same, "left").drop(*[f"_k_{k}" for k in CUSTOMER_KEYS])
        )
    engagement = (
        F.col("active_months") * F.lit(3.0).cast("double")
        + F.col("distinct_categories") * F.lit(2.0).cast("double")
        + F.least("total_transactions", F.lit(100)) * F.lit(0.5).cast("double")
    )
    return summary.withColumn("engagement_score", round_to(engagement, 1))
