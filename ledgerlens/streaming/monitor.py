"""Health of the stream: totals, freshness, recent anomalies and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where, money, percent, ratio, round_to

MAX_LAG = 5_000
STALE_MINUTES = 10
RECENT_ROWS = 100
MAX_FRAUD_PCT = 10.0
MAX_AVERAGE_GBP = 800.0
MAX_DECLINE_PCT = 20.0


def _average() -> Column:
    return round_to(ratio(money(F.sum("amount_gbp")), F.count("amount_gbp")), 2)


def running_totals(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Events, volume, fraud and customers so far; ``approximate`` also works on a stream."""
    customers = F.approx_count_distinct if approximate else F.countDistinct
    return rows.agg(
        F.count("*").alias("events"),
        money(F.sum("amount_gbp")).alias("volume_gbp"),
        count_where(F.col("is_flagged_fraud")).alias("fraud_flags"),
        customers("customer_id").alias("customers"),
    )


def stream_totals(rows: DataFrame) -> DataFrame:
    flagged, done = F.col("is_flagged_fraud"), F.col("status") == "completed"
    return rows.agg(
        F.count("*").alias("events"),
        money(F.sum("amount_gbp")).alias("volume_gbp"),
        _average().alias("avg_txn_gbp"),
        count_where(flagged).alias("fraud_flags"),
        F.countDistinct("customer_id").alias("customers"),
        percent(count_where(flagged), F.count("*"), 2).alias("fraud_rate_pct"),
        count_where(done).alias("completed"),
        percent(count_where(done), F.count("*"), 2).alias("completion_pct"),
    )


def freshness(rows: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Minutes since the last write, by minute boundaries, and whether that is too long."""
    now = F.current_timestamp() if as_of is None else as_of
    minute = lambda t: F.floor(F.unix_timestamp(F.date_trunc("minute", t)) / 60)
    latest = rows.agg(
        F.count("*").alias("total_events"),
        F.max("event_time").alias("latest_event_time"),
        F.max("consumed_at").alias("latest_consumed_at"),
    )
    stale = (minute(now) - minute(F.col("latest_consumed_at"))).cast("bigint")
    return latest.withColumn("minutes_since_write", stale).withColumn(
        "status", F.when(F.col("minutes_since_write") > STALE_MINUTES, "stale").otherwise("healthy")
    )


def recent_anomalies(rows: DataFrame) -> DataFrame:
    """Statistics of the last 100 stored events and the limits they exceed."""
    recent = rows.orderBy(F.col("consumed_at").desc_nulls_last(), "event_id").limit(RECENT_ROWS)
    flagged, declined = F.col("is_flagged_fraud"), F.col("status") == "declined"
    stats = recent.agg(
        F.count("*").alias("total"),
        count_where(flagged).alias("fraud_count"),
        percent(count_where(flagged), F.count("*"), 2).alias("fraud_rate_pct"),
        _average().alias("avg_amount_gbp"),
        round_to(F.max("amount_gbp"), 2).alias("max_amount_gbp"),
        F.countDistinct("customer_id").alias("unique_customers"),
        count_where(declined).alias("declined_count"),
        percent(count_where(declined), F.count("*"), 2).alias("decline_rate_pct"),
    )
    over = lambda c, limit: F.coalesce(F.col(c) > limit, F.lit(False))
    return stats.withColumns({
        "fraud_anomaly": over("fraud_rate_pct", MAX_FRAUD_PCT),
        "amount_anomaly": over("avg_amount_gbp", MAX_AVERAGE_GBP),
        "decline_anomaly": over("decline_rate_pct", MAX_DECLINE_PCT),
    })


def partition_lag(committed: DataFrame, ends: DataFrame) -> DataFrame:
    """Lag per partition; a partition without an end offset counts as caught up."""
    end = F.coalesce("end_offset", "committed_offset")
    return committed.join(ends, "partition", "left").select(
        "partition", "committed_offset", end.alias("end_offset"),
        F.greatest(end - F.col("committed_offset"), F.lit(0)).alias("lag"),
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(F.sum("lag").alias("total_lag")).withColumn(
        "status", F.when(F.col("total_lag") < MAX_LAG, "healthy").otherwise("lagging")
    )
