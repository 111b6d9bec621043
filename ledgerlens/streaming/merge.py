"""Stream rows into the warehouse's raw transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.storage import stage, table_exists
from ledgerlens.streaming.lookup import unseen

LOG_SCHEMA = "merged_at timestamp, last_event_time timestamp, rows_merged int, last_batch_id bigint"

MERGED_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_at",
    "status", "is_flagged_fraud", "channel", "ip_country",
]


def last_mark(log: DataFrame) -> DataFrame:
    """One row: the event time up to which rows were merged, null at first."""
    return log.agg(F.max("last_event_time").alias("_mark"))


def candidates(stream: DataFrame, mark: DataFrame | None = None) -> DataFrame:
    """Stream rows in the warehouse's ten columns, the earliest copy of each transaction.

    With ``mark`` (a one-row table) only events after it are considered, which reads less
    and loses late rows.
    """
    if mark is not None:
        stream = (
            stream.crossJoin(F.broadcast(mark))
            .filter(F.col("_mark").isNull() | (F.col("event_time") > F.col("_mark")))
            .drop("_mark")
        )
    mapped = stream.withColumnRenamed("event_time", "transaction_at").select(*MERGED_COLUMNS, "event_id")
    order = F.struct("transaction_at", "event_id")
    return (
        mapped.groupBy(F.col("transaction_id").alias("_id"))
        .agg(F.min_by(F.struct(*MERGED_COLUMNS), order).alias("row"))
        .select("row.*")
    )


def new_transactions(stream: DataFrame, stored: DataFrame, mark: DataFrame | None = None) -> DataFrame:
    """Candidates the warehouse does not hold yet."""
    return unseen(candidates(stream, mark), stored, "transaction_id")


def merge_into_warehouse(
    stream: DataFrame, transactions_path: str, log_path: str, merged_at: Column | None = None,
    late_rows: bool = True,
) -> int:
    """Append new rows and log the merge; returns the number of rows added.

    The new rows are fixed in a stored table before they are appended, and the mark advances
    even when every row was known already. A replay appends nothing.

    A stream with ``batch_id`` (``StreamTables.read("transactions", with_batch=True)``) is read from the last
    merged batch on, so a merge costs what has arrived since the one before and misses no late row. Otherwise all of
    it is compared; ``late_rows=False`` then reads only event times after the last merged one and loses late rows.
    """
    spark = stream.sparkSession
    stored = spark.read.parquet(transactions_path)
    log = (
        spark.read.schema(LOG_SCHEMA).parquet(log_path) if table_exists(spark, log_path)
        else spark.createDataFrame([], LOG_SCHEMA)
    )
    arrival = F.lit(None).cast("bigint")
    if "batch_id" in stream.columns:
        merged_up_to = log.agg(F.max("last_batch_id")).first()[0]
        if merged_up_to is not None:
            stream = stream.filter(F.col("batch_id") > merged_up_to)
        arrival, late_rows = F.max("batch_id"), True
    found = stage(candidates(stream, None if late_rows else last_mark(log)), "stream-candidates")
    fresh = stage(unseen(found, stored, "transaction_id", found.count()), "stream-merge")
    added = fresh.count()
    if added:
        fresh.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields if f.name in fresh.columns]) \
            .write.mode("append").parquet(transactions_path)
    seen = stream.agg(F.max("event_time").alias("last_event_time"), arrival.alias("last_batch_id"))
    seen.filter("last_event_time IS NOT NULL OR last_batch_id IS NOT NULL").select(
        (F.current_timestamp() if merged_at is None else merged_at).alias("merged_at"),
        "last_event_time", F.lit(added).cast("int").alias("rows_merged"),
        "last_batch_id",
    ).write.mode("append").parquet(log_path)
    return added
