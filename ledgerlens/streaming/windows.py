"""Event-time windows over the stream: 30-day velocity per customer, and five-minute fraud and decline rates.

Both work on a batch and on a stream alike. On a stream the watermark closes a window; its row is then emitted once and its
state is dropped, so the state holds open windows only. Rows that come later cannot change a closed window; ``late_counts``
compares the emitted windows with all stored rows and counts such rows apart.

The original has no such operator; both are additions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.columns import count_where, money, percent
from ledgerlens.streaming import events

VELOCITY_DAYS, VELOCITY_STEP_DAYS = 30, 1
RATE_MINUTES = 5
#: How long rows may lag behind the latest event time.
ALLOWED_DELAY = "1 day"


def _timed(rows: DataFrame) -> DataFrame:
    """Rows with an event time; without one a row belongs to no window."""
    return rows.filter(F.col("event_time").isNotNull())


def customer_velocity(rows: DataFrame) -> DataFrame:
    """Per customer and window of 30 days, one starting each day: window_start, window_end, customer_id, payments,
    volume_gbp, flagged.

    Days are added up first and each day then enters the 30 windows that hold it, so it is customer-days that are
    multiplied by 30, not payments, and a busy customer leaves a task as one row per day.
    """
    days = _timed(rows).groupBy(F.window("event_time", f"{VELOCITY_STEP_DAYS} days").alias("d"), "customer_id").agg(
        F.count("*").alias("payments"), F.sum(_pence()).alias("pence"), count_where(F.col("is_flagged_fraud")).alias("flagged"),
    )
    window = F.window(F.window_time("d"), f"{VELOCITY_DAYS} days", f"{VELOCITY_STEP_DAYS} days")
    return days.groupBy(window.alias("w"), "customer_id").agg(
        F.sum("payments").alias("payments"), F.sum("pence").alias("pence"), F.sum("flagged").alias("flagged"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "customer_id", "payments", _pounds(), "flagged",
    )


def _pence() -> Column:
    """Whole pence, so that sums do not depend on the order of addition."""
    return F.round(F.col("amount_gbp") * 100).cast("bigint")


def _pounds() -> Column:
    return (F.col("pence") / 100).alias("volume_gbp")


def rates(rows: DataFrame) -> DataFrame:
    """Per five minutes: window_start, window_end, events, flagged, declined, fraud_rate_pct, decline_rate_pct."""
    window = F.window("event_time", f"{RATE_MINUTES} minutes")
    flagged, declined = count_where(F.col("is_flagged_fraud")), count_where(F.col("status") == "declined")
    return _timed(rows).groupBy(window.alias("w")).agg(
        F.count("*").alias("events"), flagged.alias("flagged"), declined.alias("declined"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "flagged", "declined",
        percent(F.col("flagged"), F.col("events"), 2).alias("fraud_rate_pct"),
        percent(F.col("declined"), F.col("events"), 2).alias("decline_rate_pct"),
    )


def start_windows(
    messages: DataFrame, build, folder: str, delay: str = ALLOWED_DELAY, every: str | None = "1 minute",
) -> StreamingQuery:
    """Write the closed windows of ``build`` (``rates`` or ``customer_velocity``) over a stream of messages to ``folder``.

    Repeated events within the delay count once. ``every=None`` takes what is there and stops; windows that the watermark
    has not closed by then stay in the checkpoint's state and come with a later run.
    """
    once = events.deduplicated(_timed(events.sink_rows(events.decode(messages))), delay)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        build(once).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(**trigger).start()
    )


def closed(windows: DataFrame, latest: Column, delay: str = ALLOWED_DELAY) -> DataFrame:
    """The windows of a batch result that a stream whose latest event time is ``latest`` has closed."""
    return windows.filter(F.col("window_end") <= latest - F.expr(f"INTERVAL {delay}"))


def late_counts(emitted: DataFrame, all_windows: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Emitted windows that lack rows which came late: the keys, ``count`` as emitted, and ``late`` rows left out.

    ``all_windows`` are the same windows of all stored rows, late ones included. A closed window whose rows were all late
    was never emitted; it has a null count.
    """
    whole = all_windows.select(*keys, F.col(count).alias("_all"))
    return whole.join(emitted.select(*keys, count), keys, "left").withColumn(
        "late", F.col("_all") - F.coalesce(F.col(count), F.lit(0))
    ).filter("late > 0").drop("_all")
