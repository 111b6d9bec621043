"""Batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; ``path`` may be a pattern or a list. Without a schema the files are read twice to infer one."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """Parquet rows. ``spread_by`` redistributes an input of fewer pieces than there are
    cores, such as one file with one row group, which would otherwise run as a single task.
    Larger inputs are left as they lie."""
    df = spark.read.parquet(path)
    if spread_by:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            return df.repartition(cores, spread_by)
    return df


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Messages of a topic from its beginning: ``value``, ``partition``, ``offset``.

    Needs the Kafka connector on the class path. Offsets live in the query's checkpoint and
    advance only after a batch is written. A batch takes all that has arrived, or at most ``per_trigger`` messages.
    """
    limits = {} if per_trigger is None else {"maxOffsetsPerTrigger": str(per_trigger)}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**limits, **options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value", "partition", "offset")
    )


def file_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same envelope from parquet files that arrive in ``folder``; a batch takes all of them, or so many at most."""
    limits = {} if files_per_trigger is None else {"maxFilesPerTrigger": str(files_per_trigger)}
    return spark.readStream.schema("value string, partition int, offset bigint").options(**limits).parquet(folder)
