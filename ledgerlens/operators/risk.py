"""Risk marts: fraud events with trailing velocity, and merchant scorecards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where, money, percent, ratio, round_to, sum_where
from ledgerlens.operators.skew import KeyLoad, with_trailing_count
from ledgerlens.storage import delete, stage, table_exists

VELOCITY_DAYS = 30
VELOCITY = "customer_fraud_velocity_30d"

FRAUD_EVENT_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount_gbp", "currency",
    "transaction_at", "transaction_date", "channel", "ip_country", "customer_country",
    "account_tier", "is_kyc_verified", "merchant_category", "mcc_code",
    "is_high_risk_merchant", "is_cross_border", "risk_tier", "status",
]


def _with_disputes(flagged: DataFrame, disputes: DataFrame) -> DataFrame:
    d = disputes.select(
        "transaction_id",
        "dispute_id",
        F.col("reason").alias("dispute_reason"),
        F.col("status").alias("dispute_status"),
    )
    return flagged.join(d, "transaction_id", "left").withColumn(
        "has_dispute", F.col("dispute_id").isNotNull()
    )


def fraud_events(
    enriched: DataFrame, disputes: DataFrame, load: KeyLoad | None = None
) -> DataFrame:
    """Flagged transactions with their disputes and the customer's 30-day velocity.

    A transaction with several disputes yields several rows, and each counts towards the
    velocity. ``load`` tells how the flagged rows lie over the customers (see ``skew.key_load``).
    """
    flagged = _with_disputes(enriched.filter("is_flagged_fraud").select(*FRAUD_EVENT_COLUMNS), disputes)
    if load is None or load.crowded:
        # The velocity of busy customers reads the rows twice.
        flagged = stage(flagged, "flagged")
    return with_trailing_count(flagged, "customer_id", "transaction_at", VELOCITY_DAYS, VELOCITY, load)


def _flagged_once(enriched: DataFrame) -> DataFrame:
    """What fraud events need of ``enriched``, computed once for several readers."""
    return stage(enriched.filter("is_flagged_fraud").select(*FRAUD_EVENT_COLUMNS, "is_flagged_fraud"), "flagged-now")


def append_fraud_events_as_written(
    stored: DataFrame, enriched: DataFrame, disputes: DataFrame
) -> DataFrame:
    """Rows an append run adds when it only looks past the newest stored instant.

    Velocity sees the new rows alone, and late rows never arrive; kept for comparison with
    ``refresh_fraud_events``.
    """
    newest = stored.agg(F.max("transaction_at").alias("_newest"))
    fresh = (
        enriched.crossJoin(F.broadcast(newest))
        .filter(F.col("_newest").isNull() | (F.col("transaction_at") > F.col("_newest")))
        .drop("_newest")
    )
    return fraud_events(fresh, disputes)


def stale_months(stored: DataFrame, enriched: DataFrame, disputes: DataFrame) -> list[date | None]:
    """Months whose stored fraud events are out of date; None stands for rows without a time.

    Any difference counts, in either direction: rows that are new, late, changed, disputed, or no longer flagged. Each
    also changes the velocity of the same customer's rows up to 30 days after it.
    """
    current = _with_disputes(enriched.filter("is_flagged_fraud").select(*FRAUD_EVENT_COLUMNS), disputes)
    # Columns that older months do not have yet compare as null on both sides.
    shared = [c for c in current.columns if c in stored.columns]

    def marked(df: DataFrame, sign: int) -> DataFrame:
        return df.select("transaction_date", F.xxhash64(*shared).alias("h1"), F.xxhash64(F.lit(1), *shared).alias("h2"), F.lit(sign).alias("n"))

    changed = (
        marked(current, 1).unionByName(marked(stored, -1)).groupBy("transaction_date", "h1", "h2")
        .agg(F.sum("n").alias("n")).filter("n <> 0")
    )
    reach = F.array(
        F.col("transaction_date"),
        F.trunc(F.date_add("transaction_date", VELOCITY_DAYS), "month"),
    )
    months = changed.select(F.explode(reach).alias("day")).select(F.trunc("day", "month").alias("month")).distinct()
    return sorted((r["month"] for r in months.collect()), key=lambda m: (m is None, m or date.min))


def fraud_events_of(
    months: list[date | None], enriched: DataFrame, disputes: DataFrame, load: KeyLoad | None = None
) -> DataFrame:
    """Fraud events of the given months; 30 days of history are read for the velocity."""
    month = F.trunc("transaction_date", "month")
    needed = F.lit(False)
    for m in months:
        if m is None:
            needed = needed | F.col("transaction_date").isNull()
        else:
            first = F.date_sub(F.lit(m), VELOCITY_DAYS)
            needed = needed | F.col("transaction_date").between(first, F.last_day(F.lit(m)))
    return fraud_events(enriched.filter(needed), disputes, load).filter(_in_months(month, months))


def _in_months(month: Column, months: list[date | None]) -> Column:
    dated = F.coalesce(month.isin([m for m in months if m is not None]), F.lit(False))
    return dated | month.isNull() if None in months else dated


def refresh_fraud_events(
    stored: DataFrame, enriched: DataFrame, disputes: DataFrame, load: KeyLoad | None = None
) -> DataFrame:
    """The table after rows were added, changed, disputed or withdrawn; equal to a full rebuild."""
    enriched = _flagged_once(enriched)
    months = stale_months(stored, enriched, disputes)
    kept = stored.filter(~_in_months(F.trunc("transaction_date", "month"), months))
    return kept.unionByName(fraud_events_of(months, enriched, disputes, load), allowMissingColumns=True)


def write_fraud_events(
    path: str, enriched: DataFrame, disputes: DataFrame, load: KeyLoad | None = None
) -> DataFrame:
    """Bring the table at ``path``, partitioned by month, up to date and return it.

    Only stale months are rewritten, each as a whole, so a replay changes nothing.
    """
    spark = enriched.sparkSession
    month = F.trunc("transaction_date", "month")
    if table_exists(spark, path):
        stored = read_fraud_events(spark, path)
        enriched = _flagged_once(enriched)
        months = stale_months(stored, enriched, disputes)
        rows = fraud_events_of(months, enriched, disputes, load)
        # A month that has lost all its rows is not overwritten by any.
        left = {r["m"] for r in rows.select(month.alias("m")).distinct().collect()}
        gone = [m for m in months if m is not None and m not in left]
        if None in months and None not in left:
            _write_empty(path, rows)
    else:
        rows, gone = fraud_events(enriched, disputes, load), []
        _write_empty(path, rows)
    (
        rows.withColumn("event_month", month)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month")
        .parquet(path)
    )
    for m in gone:
        delete(spark, f"{path}/event_month={m.isoformat()}")
    return read_fraud_events(spark, path)


def _write_empty(path: str, rows: DataFrame) -> None:
    """No rows without a month: a file that holds the schema, so that a table without any rows can be read."""
    empty = rows.sparkSession.createDataFrame([], rows.schema)
    empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/event_month=__HIVE_DEFAULT_PARTITION__")


def read_fraud_events(spark: SparkSession, path: str) -> DataFrame:
    """Stored fraud events; columns added over time are null in older months."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("event_month")


def merchant_risk_scorecard(
    merchants: DataFrame, priced: DataFrame, transactions: DataFrame, disputes: DataFrame
) -> DataFrame:
    """One row per merchant with volumes, rates, a 0-100 risk score and a band.

    Distinct customers are counted per (merchant, customer) first, so a merchant with a
    third of all rows is spread over tasks.
    """
    done = F.col("is_completed")
    volume = money(sum_where(done, F.col("amount_gbp")))
    stats = priced.groupBy("merchant_id").agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed_transactions"),
        count_where(F.col("is_flagged_fraud")).alias("fraud_flagged_count"),
        volume.alias("total_volume_gbp"),
        ratio(volume, F.count(F.when(done, F.col("amount_gbp")))).alias("avg_transaction_gbp"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    disputed = (
        disputes.select("dispute_id", "transaction_id", "amount")
        .join(transactions.select("transaction_id", "merchant_id"), "transaction_id")
        .groupBy("merchant_id")
        .agg(
            F.countDistinct("dispute_id").alias("total_disputes"),
            money(F.sum("amount")).alias("total_disputed_amount"),
        )
    )
    joined = merchants.join(stats, "merchant_id", "left").join(disputed, "merchant_id", "left")
    fraud = ratio(F.col("fraud_flagged_count"), F.col("total_transactions"))
    dispute = ratio(F.col("total_disputes"), F.col("completed_transactions"))
    zero, none = F.lit(0.0), F.lit(0).cast("bigint")
    score = (
        F.coalesce(fraud, zero) * 4000.0
        + F.coalesce(dispute, zero) * 3000.0
        + F.when(F.col("is_high_risk"), 20.0).otherwise(0.0)
    )
    return joined.select(
        "merchant_id", "merchant_name", "merchant_category", "mcc_code", "merchant_country",
        "is_high_risk", "onboarded_date",
        *[
            F.coalesce(F.col(c), none).alias(c)
            for c in ("total_transactions", "completed_transactions", "fraud_flagged_count",
                      "unique_customers", "total_disputes")
        ],
        *[
            F.coalesce(F.col(c), zero).alias(c)
            for c in ("total_volume_gbp", "avg_transaction_gbp", "total_disputed_amount")
        ],
        fraud.alias("fraud_rate"),
        dispute.alias("dispute_rate"),
        ratio(F.col("completed_transactions"), F.col("total_transactions")).alias("completion_rate"),
        round_to(F.least(F.lit(100.0), score), 1).alias("risk_score"),
        F.when(F.col("is_high_risk") | (F.coalesce(fraud, zero) > 0.05), "critical")
        .when(F.coalesce(fraud, zero) > 0.02, "elevated")
        .otherwise("standard").alias("risk_band"),
    )


def merchant_scorecard(payments: DataFrame) -> DataFrame:
    """Scorecard per (merchant, name, category) of a payments table, banded by fraud alone."""
    done, flagged = F.col("status") == "completed", F.col("is_flagged_fraud")
    fraud = ratio(count_where(flagged), F.count("*"))
    return payments.groupBy("merchant_id", "merchant_name", "merchant_category").agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed"),
        money(sum_where(done, F.col("amount"))).alias("total_volume"),
        count_where(flagged).alias("fraud_count"),
        percent(count_where(flagged), F.count("*"), 2).alias("fraud_rate_pct"),
        percent(count_where(done), F.count("*"), 2).alias("completion_rate_pct"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.when(fraud > 0.05, "critical").when(fraud > 0.02, "elevated")
        .otherwise("standard").alias("risk_band"),
    )
