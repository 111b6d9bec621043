"""Stream to tables: rows, dead letters, alerts and batch statistics, safe to replay and to restart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.columns import count_where
from ledgerlens.streaming import events
from ledgerlens.streaming.commits import CommitLog
from ledgerlens.streaming.id_index import IdIndex
from ledgerlens.streaming.lookup import unseen

#: Spark keeps the running query's id, which its checkpoint holds, in this property of the thread that runs a batch.
_QUERY_ID = "sql.streaming.queryId"


def spread(messages: DataFrame) -> DataFrame:
    """Messages in pieces of bounded size. A file's compressed piece may hold millions of messages, which one task would
    decode and keep; a rebalance splits such a piece and leaves small ones together."""
    return messages.hint("rebalance", F.col("offset"))


@dataclass(frozen=True)
class StreamTables:
    """The stream's tables under one folder.

    Every micro-batch owns one folder of each table, named by the query that ran it and its number there, and counts
    from the moment its marker stands in the commit log. A replay of a stored batch does nothing; one of a batch
    that was cut off writes it anew. Rows are also partitioned by event date. Ids that are stored already are found by
    an index (``id_index``), of which a batch reads only the files in its reach.
    """

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path("commits"))

    @property
    def index(self) -> IdIndex:
        return IdIndex(self.spark, self.path("ids"))

    def read(self, name: str, with_batch: bool = False) -> DataFrame:
        """``transactions``, ``dlq``, ``fraud_alerts`` or ``batches``; ``with_batch`` adds the number of the commit that
        stored a row.

        Only committed batches are read. The schema is given, so a table without rows yet is an empty table.
        """
        log = self.log.table().withColumnRenamed("seq", "batch_id")
        schema = events.TABLE_SCHEMAS[name] + ", commit string" + (", event_date date" if name == "transactions" else "")
        if self.log.last() is None:
            rows = self.spark.createDataFrame([], schema + ", batch_id bigint")
        else:
            rows = self.spark.read.schema(schema).parquet(self.path(name)).join(log, "commit")
        rows = rows.drop("event_date", "commit")
        return rows if with_batch else rows.drop("batch_id")

    def _place(self, name: str, commit: str) -> str:
        return f"{self.path(name)}/commit={commit}"

    def _write(self, df: DataFrame, name: str, commit: str, by: str | None = None) -> None:
        writer = df.write.mode("overwrite")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(self._place(name, commit))

    def _query_id(self) -> str:
        return self.spark.sparkContext.getLocalProperty(_QUERY_ID) or "batch"

    def write_batch(self, messages: DataFrame, batch_id: int, query: str | None = None) -> None:
        """Store one micro-batch: its tables, the index's new segment, and last its marker."""
        commit = f"{query or self._query_id()}-{batch_id}"
        if self.log.has(commit):
            return
        last = self.log.last()
        segments = last.segments if last else []
        # Of the messages' texts only those of dead letters are read again; kept whole, they would be most of what is held.
        text = F.when(F.col("error").isNotNull(), F.col("value"))
        decoded = events.decode(spread(messages)).withColumn("value", text).persist()
        rows = events.first_per_event(events.sink_rows(decoded))
        if segments:
            rows = rows.persist()
        try:
            known = self.index.known(rows.select(F.col("event_id").alias("id")), segments)
            fresh = rows if known is None else unseen(rows, known.withColumnRenamed("id", "event_id"), "event_id")
            fresh = fresh.select(*events.SINK_COLUMNS)
            self._write(fresh.withColumn("event_date", F.to_date("event_time")), "transactions", commit, by="event_date")
            self._write(events.dead_letters(decoded), "dlq", commit)
        finally:
            rows.unpersist()
            decoded.unpersist()
        # What the new rows say is read from where they now lie; without the batch's marker they do not exist for others.
        stored = self.spark.read.schema(events.TABLE_SCHEMAS["transactions"]).parquet(self._place("transactions", commit))
        self._write(events.fraud_alerts(stored), "fraud_alerts", commit)
        statistics = stored.agg(
            F.count("*").alias("rows_written"),
            count_where(F.col("is_flagged_fraud")).alias("fraud_rows"),
            F.max("event_time").alias("last_event_time"),
        )
        self._write(statistics, "batches", commit)
        added = stored.count()
        if added:
            segments = [*segments, self.index.write(stored.select(F.col("event_id").alias("id")), 0, added)]
        self.log.add(commit, self.index.merged(segments))

    def vacuum(self) -> int:
        """Delete index segments that the last commit no longer names, between batches; returns how many."""
        last = self.log.last()
        return self.index.vacuum(last.segments) if last else 0


def start_ingest(
    messages: DataFrame, tables: StreamTables, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Run ``write_batch`` on each micro-batch; ``every=None`` takes what is there and stops.

    Offsets are committed to the checkpoint after the batch's marker is written: at-least-once
    delivery, and exactly one stored row per event. A new checkpoint reads the topic from its beginning and
    stores only what is not there yet.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        messages.writeStream.foreachBatch(tables.write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
