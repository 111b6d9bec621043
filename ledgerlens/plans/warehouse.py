"""The warehouse: raw tables to staged, enriched and mart DataFrames, all lazy."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import customers as customer_ops
from ledgerlens.operators import enrichment, payments, risk, staging
from ledgerlens.operators.skew import KeyLoad, find_hot, key_load

MARTS = [
    "monthly_payment_performance", "customers_360", "cohort_retention", "rfm_segmentation",
    "merchant_risk_scorecard", "fraud_events",
]


@dataclass(frozen=True)
class Warehouse:
    """Models over the five raw tables.

    ``as_of`` stands for "today". ``semantics`` is ``corrected`` or ``reference``; the latter
    keeps the as-written cross-border flag and recency score.
    """

    raw_transactions: DataFrame
    raw_customers: DataFrame
    raw_merchants: DataFrame
    raw_fx_rates: DataFrame
    raw_disputes: DataFrame
    as_of: Column = field(default_factory=F.current_date)
    semantics: str = "corrected"

    @classmethod
    def from_tables(cls, tables, as_of: Column, semantics: str = "corrected") -> Warehouse:
        return cls(
            tables.transactions, tables.customers, tables.merchants, tables.fx_rates,
            tables.disputes, as_of, semantics,
        )

    @property
    def spark(self) -> SparkSession:
        return self.raw_transactions.sparkSession

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stage_customers(self.raw_customers, self.as_of)

    @cached_property
    def merchants(self) -> DataFrame:
        return staging.stage_merchants(self.raw_merchants, self.as_of)

    @cached_property
    def transactions(self) -> DataFrame:
        return staging.stage_transactions(self.raw_transactions)

    @cached_property
    def fx_rates(self) -> DataFrame:
        return staging.stage_fx_rates(self.raw_fx_rates)

    @cached_property
    def disputes(self) -> DataFrame:
        return staging.stage_disputes(self.raw_disputes)

    @cached_property
    def priced(self) -> DataFrame:
        """Transactions in GBP, for marts that need no customer or merchant attribute.

        Catalyst cannot know that customer and merchant ids are unique (the quality checks
        test it), so it would keep those joins, and with them a shuffle of all transactions.
        """
        return enrichment.price(self.transactions, self.fx_rates)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrichment.enrich(
            self.transactions, self.customers, self.merchants, self.fx_rates, self.semantics
        )

    @cached_property
    def enriched_rows(self) -> DataFrame:
        """The same table, planned for readers of all its columns."""
        return enrichment.enrich(
            self.transactions, self.customers, self.merchants, self.fx_rates, self.semantics, whole_rows=True
        )

    @cached_property
    def _busy_customers(self) -> DataFrame | None:
        """Customers with very many completed transactions, counted before any join."""
        return find_hot(self.transactions.filter("is_completed"), "customer_id")

    @cached_property
    def _flagged_load(self) -> KeyLoad:
        return key_load(self.transactions.filter("is_flagged_fraud"), "customer_id")

    @cached_property
    def customer_summary(self) -> DataFrame:
        return enrichment.customer_summary(self.enriched, self._busy_customers)

    @cached_property
    def monthly_payment_performance(self) -> DataFrame:
        return payments.monthly_payment_performance(self.enriched)

    @cached_property
    def customers_360(self) -> DataFrame:
        return customer_ops.customers_360(
            self.customers, self.customer_summary, self.disputes, self.as_of
        )

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return customer_ops.cohort_retention(self.transactions, self.customers)

    @cached_property
    def rfm_segmentation(self) -> DataFrame:
        return customer_ops.rfm_segmentation(
            self.transactions, self.priced, self.customers, self.semantics
        )

    @cached_property
    def merchant_risk_scorecard(self) -> DataFrame:
        return risk.merchant_risk_scorecard(
            self.merchants, self.priced, self.transactions, self.disputes
        )

    @cached_property
    def fraud_events(self) -> DataFrame:
        return risk.fraud_events(self.enriched, self.disputes, self._flagged_load)

    def materialise(self, folder: str) -> dict[str, DataFrame]:
        """Write the marts as parquet tables under ``folder``; fraud events incrementally."""
        written = {}
        for name in MARTS:
            path = f"{folder}/{name}"
            if name == "fraud_events":
                written[name] = risk.write_fraud_events(
                    path, self.enriched, self.disputes, self._flagged_load
                )
            else:
                getattr(self, name).write.mode("overwrite").parquet(path)
                written[name] = self.spark.read.parquet(path)
        return written


def read_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Read marts written by ``materialise``."""
    marts = {name: spark.read.parquet(f"{folder}/{name}") for name in MARTS if name != "fraud_events"}
    return marts | {"fraud_events": risk.read_fraud_events(spark, f"{folder}/fraud_events")}
