"""Registry of check queries: a Spark callable and, where SQL can express it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.plans.sample_tables import AS_OF, SampleTables
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.session import configure

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that results do not depend on the reader's zone."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    })


def register(name: str, build: Callable[[Context], DataFrame], sql: str | None = None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return plain(build(Context(spark, folder)))

    assert name not in QUERIES, name
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql


class Context:
    """The tables a query starts from."""

    def __init__(self, spark: SparkSession, folder: str, whole_rows: bool = False):
        self.spark = spark
        self.folder = folder
        self.tables = SampleTables(spark, folder, whole_rows)

    @property
    def whole_rows(self) -> Context:
        """The same tables, for results that keep transactions with all their columns."""
        return Context(self.spark, self.folder, whole_rows=True)

    @property
    def warehouse(self) -> Warehouse:
        return Warehouse.from_tables(self.tables, F.lit(AS_OF).cast("date"))

    @property
    def warehouse_as_written(self) -> Warehouse:
        return Warehouse.from_tables(self.tables, F.lit(AS_OF).cast("date"), "reference")
