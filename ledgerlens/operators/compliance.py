"""AML checks on a payments table. Every threshold can be overridden."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import count_where, days_apart, money, percent, round_to, thousands

FLAG_COLUMNS = [
    "flag_type", "severity", "customer_id", "description", "transaction_count",
    "amount_total", "recommended_action",
]


def thresholds_with(overrides: dict | None = None) -> dict:
    return {**fixed.AML_THRESHOLDS, **(overrides or {})}


def _completed(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("status") == "completed")


def structuring(payments: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Several completed payments just below the reporting threshold within a few days.

    Each customer-day is compared with the days up to ``window_days`` before it, and every
    row of the day counts all rows of that window, so a day of n rows counts it n times.
    The rows are first reduced to one per customer and day: the pairs of a self-join are
    never built, and a busy customer orders days, not payments.
    """
    t = thresholds_with(overrides)
    ceiling = t["structuring_threshold_gbp"]
    days = (
        _completed(payments)
        .filter((F.col("amount") >= ceiling * 0.7) & (F.col("amount") < ceiling))
        .groupBy("customer_id", F.col("transaction_at").cast("date").alias("day"))
        .agg(F.count("transaction_id").alias("n"), F.count("*").alias("rows"), F.sum("amount").alias("amount"))
    )
    window = (
        Window.partitionBy("customer_id").orderBy(F.unix_date("day"))
        .rangeBetween(-int(t["structuring_window_days"]), 0)
    )
    return (
        days.withColumn("txn_count", F.col("rows") * F.sum("n").over(window))
        .withColumn("total_amount", money(F.col("rows") * F.sum("amount").over(window)))
        .filter(F.col("txn_count") >= t["structuring_min_txns"])
        .groupBy("customer_id")
        .agg(F.max("txn_count").alias("txn_count"), F.max("total_amount").alias("total_amount"))
    )


def velocity(
    payments: DataFrame, overrides: dict | None = None, semantics: str = "corrected"
) -> DataFrame:
    """More completed payments than allowed in one window of ``velocity_window_hours``.

    Windows tumble from the epoch. As first written the window number was a fraction, so
    only payments of the very same instant fell together.
    """
    t = thresholds_with(overrides)
    seconds = int(t["velocity_window_hours"] * 3600)
    at = F.col("transaction_at").cast("timestamp")
    slot = at if semantics == "reference" else F.floor(F.unix_micros(at) / F.lit(seconds * 1_000_000))
    return (
        _completed(payments)
        .groupBy("customer_id", slot.alias("slot"))
        .agg(
            F.count("*").alias("txn_count"),
            money(F.sum("amount")).alias("total_amount"),
            F.min(at).alias("window_start"),
            F.max(at).alias("window_end"),
        )
        .filter(F.col("txn_count") > t["velocity_max_txns"])
        .drop("slot")
    )


def round_numbers(payments: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Customers with at least five completed payments, too many of them multiples of 100."""
    t = thresholds_with(overrides)
    is_round = F.col("amount") % 100 == 0
    return (
        _completed(payments)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_txns"),
            count_where(is_round).alias("round_txns"),
            percent(count_where(is_round), F.count("*"), 1).alias("round_pct"),
            money(F.sum("amount")).alias("total_amount"),
        )
        .filter((F.col("total_txns") >= 5) & (F.col("round_pct") > t["round_number_threshold_pct"]))
    )


def dormant_activity(payments: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Payments that end a pause of more than ``dormancy_days``.

    Only the first payment of a day can end a pause, so customer-days are enough: the gap
    to the previous day with activity, and the amount of the day's first payment.
    """
    t = thresholds_with(overrides)
    days = (
        _completed(payments)
        .groupBy("customer_id", F.col("transaction_at").cast("date").alias("day"))
        .agg(F.min_by("amount", F.struct("transaction_at", "transaction_id")).alias("amount"))
    )
    gap = days_apart(F.lag("day").over(Window.partitionBy("customer_id").orderBy("day")), F.col("day"))
    return (
        days.withColumn("days_gap", gap)
        .filter(F.col("days_gap") > t["dormancy_days"])
        .groupBy("customer_id")
        .agg(
            F.max("days_gap").alias("max_gap_days"),
            money(F.sum("amount")).alias("recent_amount"),
            F.count("*").alias("recent_txns"),
        )
    )


def large_cash(payments: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Large completed payments in a cash-like category, one row each."""
    t = thresholds_with(overrides)
    category = F.lower("merchant_category")
    cash_like = category.contains("atm") | category.contains("cash") | category.contains("transfer")
    return (
        _completed(payments)
        .filter((F.col("amount") > t["large_cash_threshold_gbp"]) & cash_like)
        .select("customer_id", "transaction_id", "amount", "merchant_category")
    )


def _dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), thousands(value, 2))


def _flags(rows: DataFrame, flag_type: str, description: Column, amount: str, count: int = 0) -> DataFrame:
    return rows.select(
        F.lit(flag_type).alias("flag_type"),
        F.lit(fixed.AML_SEVERITY[flag_type]).alias("severity"),
        F.col("customer_id").cast("string").alias("customer_id"),
        description.alias("description"),
        F.lit(count).cast("bigint").alias("transaction_count"),
        round_to(F.col(amount), 2).alias("amount_total"),
        F.lit(fixed.AML_ACTIONS[flag_type]).alias("recommended_action"),
    )


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def aml_flags(
    payments: DataFrame, overrides: dict | None = None, semantics: str = "corrected"
) -> DataFrame:
    """All flags, most severe first, larger amounts first. Without findings: no rows, same columns."""
    t = thresholds_with(overrides)
    c = F.col
    # fixed values: wording of the descriptions
    parts = [
        _flags(
            structuring(payments, t), "STRUCTURING",
            _say("Possible structuring: ", c("txn_count"), " transactions totalling ",
                 _dollars(c("total_amount")), f" — all below ${t['structuring_threshold_gbp']:,} threshold "
                 f"within {t['structuring_window_days']} days"),
            "total_amount",
        ),
        _flags(
            velocity(payments, t, semantics), "VELOCITY_ANOMALY",
            _say("Velocity flag: ", c("txn_count"), f" transactions in {t['velocity_window_hours']}h window — "
                 f"exceeds {t['velocity_max_txns']} threshold. Total: ", _dollars(c("total_amount"))),
            "total_amount",
        ),
        _flags(
            round_numbers(payments, t), "ROUND_NUMBER_BIAS",
            _say(c("round_pct"), "% of transactions are round numbers "
                 f"(threshold: {t['round_number_threshold_pct']}%) — possible manual fraud"),
            "total_amount",
        ),
        _flags(
            dormant_activity(payments, t), "DORMANT_ACCOUNT_ACTIVITY",
            _say("Account was dormant for ", c("max_gap_days"), " days, then made ", c("recent_txns"),
                 " transaction(s) totalling ", _dollars(c("recent_amount"))),
            "recent_amount",
        ),
        _flags(
            large_cash(payments, t), "LARGE_CASH_TRANSACTION",
            _say("Large ", c("merchant_category"), " transaction: ", _dollars(c("amount")),
                 f" — exceeds ${t['large_cash_threshold_gbp']:,} threshold"),
            "amount", count=1,
        ),
    ]
    flags = parts[0]
    for part in parts[1:]:
        flags = flags.unionByName(part)
    rank = F.lit(len(fixed.SEVERITY_RANK))
    for severity, place in fixed.SEVERITY_RANK.items():
        rank = F.when(c("severity") == severity, place).otherwise(rank)
    return flags.orderBy(rank, c("amount_total").desc_nulls_last(), "flag_type", "customer_id")


def flag_counts(flags: DataFrame) -> DataFrame:
    return flags.groupBy("severity").agg(F.count("*").alias("flags"))
