"""Payment events: decoding, defaults, dead letters and alerts. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.columns import uuid5_dns

EVENT_TEXT = [
    "event_id", "transaction_id", "event_time", "customer_id", "merchant_id", "merchant_name",
    "merchant_category", "mcc_code", "currency", "status", "channel", "ip_country",
    "customer_tier", "customer_country",
]
EVENT_NUMBERS = ["amount", "amount_gbp", "risk_score"]
EVENT_FLAGS = ["is_kyc_verified", "is_high_risk_merchant", "is_cross_border", "is_flagged_fraud"]

CORRUPT = "_corrupt"
EVENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in EVENT_TEXT]
    + [T.StructField(c, T.DoubleType()) for c in EVENT_NUMBERS]
    + [T.StructField(c, T.BooleanType()) for c in EVENT_FLAGS]
    + [T.StructField(CORRUPT, T.StringType())]
)

SINK_COLUMNS = [
    "kafka_partition", "kafka_seq", "consumed_at", "event_id", "transaction_id", "event_time",
    "customer_id", "merchant_id", "merchant_name", "merchant_category", "mcc_code", "amount",
    "currency", "amount_gbp", "status", "channel", "ip_country", "customer_tier",
    "customer_country", "is_kyc_verified", "is_high_risk_merchant", "is_cross_border",
    "is_flagged_fraud", "risk_score",
]

_SINK_TYPES = {
    "kafka_partition": "int", "kafka_seq": "bigint", "consumed_at": "timestamp", "event_time": "timestamp",
    **dict.fromkeys(EVENT_NUMBERS, "double"), **dict.fromkeys(EVENT_FLAGS, "boolean"),
}
#: Columns of the stored tables.
TABLE_SCHEMAS = {
    "transactions": ", ".join(f"{c} {_SINK_TYPES.get(c, 'string')}" for c in SINK_COLUMNS),
    "dlq": "dlq_id string, raw_message string, error_message string, failed_at timestamp",
    "fraud_alerts": "alert_id string, transaction_id string, customer_id string, amount_gbp double, risk_score double, "
                    "alert_time timestamp, reason string",
    "batches": "rows_written bigint, fraud_rows bigint, last_event_time timestamp",
}

ALERT_ABOVE = 60.0
UNUSUAL_AMOUNT_GBP = 800.0


def decode(messages: DataFrame) -> DataFrame:
    """Parse ``value`` into the event's columns; ``error`` says why a message cannot be used.

    The parsed struct goes through a generator, which evaluates it once per message; as a
    plain column it would be parsed again for every field that is read.
    """
    parsed = F.from_json(
        "value", EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    error = (
        F.when(F.col("value").isNull() | F.col(CORRUPT).isNotNull(), "malformed JSON")
        .when(F.col("event_id").isNull(), "missing event_id")
    )
    return messages.select("*", F.inline_outer(F.array(parsed))).withColumn("error", error).drop(CORRUPT)


def sink_rows(decoded: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """Usable messages as the 24 stored columns; absent values get their defaults."""
    e = F.col
    values: dict[str, Column] = {
        "kafka_partition": F.coalesce(F.col("partition").cast("int"), F.lit(0)),
        "kafka_seq": F.coalesce(F.col("offset").cast("bigint"), F.lit(0).cast("bigint")),
        "event_id": e("event_id"),
        "event_time": e("event_time").try_cast("timestamp"),
        "currency": F.coalesce(e("currency"), F.lit("GBP")),
    }
    for name in EVENT_TEXT:
        values.setdefault(name, F.coalesce(e(name), F.lit("")))
    for name in EVENT_NUMBERS:
        values[name] = F.coalesce(e(name), F.lit(0.0))
    for name in EVENT_FLAGS:
        values[name] = F.coalesce(e(name), F.lit(False))
    rows = decoded.filter(F.col("error").isNull()).select(*[v.alias(n) for n, v in values.items()])
    return rows.withColumn("consumed_at", F.current_timestamp() if consumed_at is None else consumed_at).select(
        *SINK_COLUMNS
    )


def dead_letters(decoded: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Unusable messages. The id is derived from the place in the topic, so a replay repeats it."""
    place = F.concat_ws("/", F.lit("dead-letter"), F.col("partition"), F.col("offset"))
    return decoded.filter(F.col("error").isNotNull()).select(
        uuid5_dns(place).alias("dlq_id"),
        F.col("value").alias("raw_message"),
        F.col("error").alias("error_message"),
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
    )


def fraud_alerts(rows: DataFrame) -> DataFrame:
    """One alert per flagged event whose risk score exceeds 60."""
    # fixed values: the alert reasons
    reason = (
        F.when(F.col("is_high_risk_merchant"), "high_risk_merchant")
        .when(F.col("is_cross_border"), "unusual_geography")
        .when(F.col("amount_gbp") > UNUSUAL_AMOUNT_GBP, "amount_anomaly")
        .otherwise("velocity_check")
    )
    return rows.filter(F.col("is_flagged_fraud") & (F.col("risk_score") > ALERT_ABOVE)).select(
        uuid5_dns(F.concat(F.lit("alert/"), F.col("event_id"))).alias("alert_id"),
        "transaction_id", "customer_id", "amount_gbp", "risk_score",
        F.col("consumed_at").alias("alert_time"),
        reason.alias("reason"),
    )


def first_per_event(rows: DataFrame) -> DataFrame:
    """One row per event id: the one that stands first in the topic."""
    order = F.struct("kafka_partition", "kafka_seq")
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy("event_id").agg(F.min_by(whole, order).alias("row")).select("row.*")


def deduplicated(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming form without a table look-up: repeats within ``delay`` of event time are dropped."""
    return rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
