"""One object per payments table: ingest, run, then ask for results."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import (
    compliance, customers, drift, explain, forecast, fraud, mapping, payments, risk, segments,
)
from ledgerlens.plans import reports
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.sources.readers import read_csv
from ledgerlens.sources.writers import export_results
from ledgerlens.storage import stage

RESULTS = ["rfm", "cohort_retention", "merchant_scorecard", "payment_performance"]


class Segments:
    def __init__(self, rfm: DataFrame):
        self._rfm = rfm

    def rfm(self) -> DataFrame:
        return segments.by_spend(self._rfm)

    def summary(self) -> DataFrame:
        return segments.segment_summary(self._rfm)

    def get_segment(self, name: str) -> DataFrame:
        return segments.segment_customers(self._rfm, name)

    @property
    def champions(self) -> DataFrame:
        return self.get_segment("Champions")

    @property
    def at_risk(self) -> DataFrame:
        return segments.segment_customers(self._rfm, *segments.AT_RISK)

    @property
    def lost(self) -> DataFrame:
        return segments.segment_customers(self._rfm, *segments.LOST)

    def explain(self, customer_id: str) -> DataFrame:
        return explain.explain_customer(self._rfm, customer_id)

    def batch_explain(self, segment: str | None = None) -> DataFrame:
        return explain.batch_explain(self._rfm, segment)


class Cohorts:
    def __init__(self, retention: DataFrame):
        self._retention = retention

    def retention(self, max_months: int = 12) -> DataFrame:
        return segments.retention_upto(self._retention, max_months)

    def retention_matrix(self, max_months: int = 6) -> DataFrame:
        return segments.retention_matrix(self._retention, max_months)

    def best_cohort(self) -> DataFrame:
        return segments.best_cohort(self._retention)

    def average_retention(self) -> DataFrame:
        return segments.average_retention(self._retention)


class Merchants:
    def __init__(self, scorecard: DataFrame):
        self._scorecard = scorecard

    def risk_scorecard(self) -> DataFrame:
        return segments.by_fraud_rate(self._scorecard)

    def critical(self) -> DataFrame:
        return segments.in_band(self._scorecard, "critical")

    def elevated(self) -> DataFrame:
        return segments.in_band(self._scorecard, "elevated")

    def top_by_volume(self, n: int = 10) -> DataFrame:
        return segments.top_by_volume(self._scorecard, n)

    def category_summary(self) -> DataFrame:
        return segments.category_summary(self._scorecard)

    def velocity_alerts(self, z_threshold: float = 2.5) -> DataFrame:
        return segments.velocity_alerts(self._scorecard, z_threshold)


class Fraud:
    def __init__(self, rows: DataFrame):
        self._rows = rows
        self._scores: tuple[DataFrame, str] | None = None

    def detect(self, mode: str = "auto", contamination: float = 0.02, threshold: float = 0.5) -> DataFrame:
        if mode == "auto":
            mode = fraud.detection_mode(self._rows).first()["mode"]
        scores = stage(fraud.detect(self._rows, mode, contamination, threshold), "fraud-scores")
        self._scores = (scores, mode)
        return scores

    def explain(self, transaction_id: str | None = None) -> DataFrame:
        """Reasons for every transaction, or for one."""
        if self._scores is None:
            raise RuntimeError("call detect() before explain()")
        found = fraud.explain_transactions(self._rows, *self._scores)
        if transaction_id is None:
            return found
        found = found.filter(F.col("transaction_id") == transaction_id)
        if found.isEmpty():
            raise ValueError(f"transaction {transaction_id!r} not found")
        return found

    def summary(self) -> DataFrame:
        return fraud.fraud_summary(self._scores[0] if self._scores else self.detect())

    def drift(self, other: Workspace | DataFrame) -> tuple[DataFrame, DataFrame]:
        """PSI per feature, and the one-row report, against another period."""
        rows = other.rows if isinstance(other, Workspace) else other
        reference, current = drift.feature_tables(self._rows, rows)
        psi = stage(drift.feature_psi(reference, current), "psi")
        return psi, drift.drift_report(reference, current, psi)


class Compliance:
    def __init__(self, rows: DataFrame):
        self._rows = rows

    def aml_flags(self, thresholds: dict | None = None) -> DataFrame:
        return compliance.aml_flags(self._rows, thresholds)

    def flag_counts(self, thresholds: dict | None = None) -> DataFrame:
        return compliance.flag_counts(self.aml_flags(thresholds))


class Forecasts:
    def __init__(self, performance: DataFrame):
        self._performance = performance

    def history(self, by: list[str] | None = None) -> DataFrame:
        return forecast.monthly_history(self._performance, by)

    def revenue(self, months: int = 3, by: list[str] | None = None) -> DataFrame:
        return forecast.linear_forecast(self.history(by), "revenue", months, by)

    def fraud_rate(self, months: int = 3, by: list[str] | None = None) -> DataFrame:
        return forecast.linear_forecast(self.history(by), "fraud_rate_pct", months, by)

    def quality(self, months: int = 3) -> DataFrame:
        return forecast.forecast_quality(self.history(), months)

    def summary(self, months: int = 3) -> DataFrame:
        return forecast.forecast_summary(self.history(), months)


class Workspace:
    """Analytics over one payments table.

    ``run(engine="native")`` computes the simplified results from the rows;
    ``run(engine="warehouse")`` derives the warehouse tables and takes the results from its
    marts. Results are lazy DataFrames.
    """

    def __init__(self, canonical: DataFrame, mapping_: mapping.ColumnMapping, source: DataFrame):
        self.spark: SparkSession = canonical.sparkSession
        self.canonical = canonical
        self.mapping = mapping_
        self._source = source
        self.engine: str | None = None
        self.results: dict[str, DataFrame] = {}

    @classmethod
    def from_dataframe(
        cls, df: DataFrame, schema_mapping: dict[str, str] | None = None, preset: str | None = None,
        threshold: int = 70, order_by: list[str] | None = None, timestamp_format: str | None = None,
    ) -> Workspace:
        chosen = mapping.mapping_for(df.columns, schema_mapping, preset, threshold)
        return cls(mapping.normalise(df, chosen, order_by, timestamp_format), chosen, df)

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, schema=None, **options) -> Workspace:
        return cls.from_dataframe(read_csv(spark, path, schema), **options)

    @cached_property
    def rows(self) -> DataFrame:
        return mapping.payments_for_analytics(self.canonical)

    def profile(self, exact: bool = False) -> DataFrame:
        return mapping.mapping_profile(self._source, self.mapping, exact)

    def warehouse(self, as_of: Column | None = None, semantics: str = "corrected") -> Warehouse:
        raw = mapping.raw_transactions(self.canonical)
        return Warehouse(
            raw, mapping.derived_customers(raw), mapping.derived_merchants(raw),
            mapping.derived_fx_rates(raw), mapping.no_disputes(raw),
            F.current_date() if as_of is None else as_of, semantics,
        )

    def run(self, engine: str = "native", as_of: Column | None = None, semantics: str = "corrected") -> Workspace:
        if engine == "native":
            rows = self.rows
            self.results = {
                "rfm": customers.rfm(rows, semantics),
                "cohort_retention": customers.first_purchase_retention(rows),
                "merchant_scorecard": risk.merchant_scorecard(rows),
                "payment_performance": payments.payment_performance(rows),
            }
        elif engine == "warehouse":
            w = self.warehouse(as_of, semantics)
            self.results = {
                "rfm": segments.rfm_from_mart(w.rfm_segmentation),
                "cohort_retention": segments.retention_from_mart(w.cohort_retention),
                "merchant_scorecard": segments.scorecard_from_mart(w.merchant_risk_scorecard),
                "payment_performance": segments.performance_from_mart(w.monthly_payment_performance),
            }
        else:
            raise ValueError(f"unknown engine {engine!r}: use 'native' or 'warehouse'")
        self.engine = engine
        return self

    def _result(self, name: str) -> DataFrame:
        if self.engine is None:
            raise RuntimeError("call run() first")
        return self.results[name]

    @property
    def metrics(self) -> DataFrame:
        if self.engine is None:
            raise RuntimeError("call run() first")
        return payments.headline_metrics(self.rows)

    @property
    def segment(self) -> Segments:
        return Segments(self._result("rfm"))

    @property
    def cohorts(self) -> Cohorts:
        return Cohorts(self._result("cohort_retention"))

    @property
    def merchants(self) -> Merchants:
        return Merchants(self._result("merchant_scorecard"))

    @property
    def forecast(self) -> Forecasts:
        return Forecasts(self._result("payment_performance"))

    @cached_property
    def fraud(self) -> Fraud:
        return Fraud(self.rows)

    @property
    def compliance(self) -> Compliance:
        return Compliance(self.rows)

    def dashboard(self) -> dict[str, DataFrame]:
        """The datasets of the dashboard."""
        return {
            "metrics": self.metrics,
            "monthly": reports.dashboard_monthly(self._result("payment_performance")),
            "rfm": reports.dashboard_segments(self._result("rfm")),
            "merchants": reports.dashboard_merchants(self._result("merchant_scorecard")),
            "cohort": reports.cohort_report(self._result("cohort_retention")),
            "trend": reports.dashboard_trend(self._result("payment_performance")),
            "counts": reports.dashboard_counts(self._result("rfm"), self._result("merchant_scorecard")),
        }

    def benchmark(self, industry: str = "payments_global") -> DataFrame:
        return reports.benchmark_comparison(self.metrics, industry)

    def export(self, folder: str) -> list[str]:
        names = {
            "rfm_segments": "rfm", "cohort_retention": "cohort_retention",
            "merchant_scorecard": "merchant_scorecard", "payment_performance": "payment_performance",
        }
        return export_results(folder, self.metrics, {f: self._result(r) for f, r in names.items()})

    def query(self, sql: str) -> DataFrame:
        """Run SQL over the views ``transactions``, ``rfm``, ``cohort_retention``,
        ``merchant_scorecard`` and ``payment_performance``."""
        self._result("rfm")
        self.rows.createOrReplaceTempView("transactions")
        for name in RESULTS:
            self.results[name].createOrReplaceTempView(name)
        return self.spark.sql(sql)
