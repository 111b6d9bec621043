"""Declarative data checks. Results are DataFrames; the caller decides what to do with them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where
from ledgerlens.storage import stage


@dataclass(frozen=True)
class Expect:
    """Expectations on one column."""

    column: str
    not_null: bool = False
    unique: bool = False
    accepted: tuple[str, ...] = ()


STATUSES = ("completed", "declined", "pending", "failed")

RAW_EXPECTATIONS: dict[str, list[Expect]] = {
    "customers": [
        Expect("customer_id", not_null=True, unique=True),
        Expect("email", not_null=True),
        Expect("kyc_status", accepted=("verified", "pending", "failed")),
    ],
    "merchants": [
        Expect("merchant_id", not_null=True, unique=True),
        Expect("mcc_code", not_null=True),
    ],
    "transactions": [
        Expect("transaction_id", not_null=True, unique=True),
        Expect("customer_id", not_null=True),
        Expect("merchant_id", not_null=True),
        Expect("status", accepted=STATUSES),
        Expect("amount", not_null=True),
    ],
    "fx_rates": [Expect("rate_date", not_null=True), Expect("currency", not_null=True)],
    "disputes": [
        Expect("dispute_id", not_null=True, unique=True),
        Expect("transaction_id", not_null=True),
    ],
}

MART_EXPECTATIONS: dict[str, list[Expect]] = {
    "monthly_payment_performance": [Expect("month", not_null=True)],
    "customers_360": [
        Expect("customer_id", not_null=True, unique=True),
        Expect("ltv_tier", accepted=("platinum", "gold", "silver", "bronze")),
        Expect("churn_risk_segment", accepted=("active", "cooling", "at_risk", "churned")),
    ],
    "cohort_retention": [Expect("cohort_month", not_null=True)],
    "fraud_events": [
        Expect("transaction_id", not_null=True, unique=True),
        Expect("risk_tier", accepted=(
            "fraud_flagged", "high_risk_cross_border", "high_risk_merchant", "cross_border", "standard",
        )),
    ],
    "merchant_risk_scorecard": [
        Expect("merchant_id", not_null=True, unique=True),
        Expect("risk_band", accepted=("critical", "elevated", "standard")),
    ],
}


def _long(row: DataFrame, table: str, tests: dict[str, tuple[str, str]]) -> DataFrame:
    results = F.array(*[
        F.struct(F.lit(column).alias("column_name"), F.lit(test).alias("test"), F.col(key).alias("failures"))
        for key, (column, test) in tests.items()
    ])
    return row.select(F.lit(table).alias("table_name"), F.explode(results).alias("r")).select("table_name", "r.*")


def check_table(table: str, df: DataFrame, expectations: list[Expect]) -> DataFrame:
    """Failures per expectation: null rows, values that repeat, distinct values out of the set.

    Null and set tests share one pass. Uniqueness counts rows per value with map-side
    combining, so a value that repeats very often is no burden. A table that takes more
    than one pass is computed once, and the tested columns are kept.
    """
    passes = any(e.not_null or e.accepted for e in expectations) + sum(e.unique for e in expectations)
    if passes > 1:
        df = stage(df.select(*dict.fromkeys(e.column for e in expectations)), f"tested-{table}")
    aggregates, tests = [], {}
    for i, e in enumerate(expectations):
        if e.not_null:
            aggregates.append(count_where(F.col(e.column).isNull()).alias(f"n{i}"))
            tests[f"n{i}"] = (e.column, "not_null")
        if e.accepted:
            unexpected = F.when(~F.col(e.column).isin(list(e.accepted)), F.col(e.column))
            aggregates.append(F.countDistinct(unexpected).alias(f"a{i}"))
            tests[f"a{i}"] = (e.column, "accepted_values")
    parts = [_long(df.agg(*aggregates), table, tests)] if aggregates else []
    for e in expectations:
        if e.unique:
            repeated = (
                df.filter(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count("*").alias("n"))
                .filter(F.col("n") > 1).agg(F.count("*").alias("u"))
            )
            parts.append(_long(repeated, table, {"u": (e.column, "unique")}))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def check_tables(
    tables: Mapping[str, DataFrame], expectations: Mapping[str, list[Expect]]
) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [check_table(name, tables[name], e) for name, e in expectations.items()]
    )


def check_summary(results: DataFrame) -> DataFrame:
    """Passed and failed tests, and whether an export may go ahead."""
    return results.agg(
        count_where(F.col("passed")).alias("tests_passed"),
        count_where(~F.col("passed")).alias("tests_failed"),
        (count_where(~F.col("passed")) == 0).alias("export_allowed"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and whether it is empty."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("is_empty", F.col("rows") == 0)


def require_rows(tables: Mapping[str, DataFrame]) -> None:
    """Raise when a table is empty."""
    for name, df in tables.items():
        if df.isEmpty():
            raise ValueError(f"table {name} is empty")


def raw_issues(transactions: DataFrame) -> DataFrame:
    """Four non-blocking checks on raw transactions, in one pass."""
    checks = {
        "NULL transaction_ids": F.col("transaction_id").isNull(),
        "amount <= 0": F.col("amount") <= 0,
        "unknown status": ~F.col("status").isin(list(STATUSES)),
        "NULL customer_id": F.col("customer_id").isNull(),
    }
    row = transactions.agg(*[count_where(test).alias(name) for name, test in checks.items()])
    pairs = F.array(*[
        F.struct(F.lit(n).alias("issue"), F.col(f"`{n}`").alias("rows")) for n in checks
    ])
    return row.select(F.explode(pairs).alias("r")).select("r.*")
