"""Any payments table to the canonical 13 fields, and canonical rows to warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import uuid5_dns
from ledgerlens.operators.ordering import with_row_index
from ledgerlens.storage import stage

REQUIRED = ("amount",)
BASE_INSTANT = "2023-01-01 00:00:00"
STEP_SECONDS = 30


def name_similarity(a: str, b: str) -> int:
    """0-100: twice the longest common subsequence over the summed lengths."""
    if not a and not b:
        return 100
    row = [0] * (len(b) + 1)
    for ch in a:
        diagonal = 0
        for j, other in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if ch == other else max(row[j], row[j - 1])
    return round(200 * row[-1] / (len(a) + len(b)))


@dataclass(frozen=True)
class ColumnMapping:
    """Canonical field to user column, with how sure the match is."""

    mapping: dict[str, str]
    confidence: dict[str, int]
    unmatched: tuple[str, ...]
    columns: tuple[str, ...]

    @property
    def missing(self) -> list[str]:
        return [f for f in REQUIRED if f not in self.mapping]

    def override(self, chosen: dict[str, str]) -> ColumnMapping:
        return replace(
            self,
            mapping={**self.mapping, **chosen},
            confidence={**self.confidence, **dict.fromkeys(chosen, 100)},
            unmatched=tuple(f for f in self.unmatched if f not in chosen),
        )

    def sources(self) -> dict[str, str]:
        """Canonical field to the column that supplies it. When two fields claim a column,
        the later field gets it."""
        renamed = {user: field for field, user in self.mapping.items()}
        supplied: dict[str, str] = {}
        for column in self.columns:
            supplied.setdefault(renamed.get(column, column), column)
        return {f: supplied[f] for f in self.mapping if f in supplied}


def detect_columns(columns: Sequence[str], threshold: int = 70) -> ColumnMapping:
    """Match column names: a known alias counts 100, else the most similar name from ``threshold`` up."""
    mapping: dict[str, str] = {}
    confidence: dict[str, int] = {}
    for field, aliases in fixed.FIELD_ALIASES.items():
        best, score = None, 0
        for column in columns:
            name = column.lower().strip()
            if name in aliases:
                best, score = column, 100
                break
            close = max(name_similarity(name, alias) for alias in aliases)
            if close >= threshold and close > score:
                best, score = column, close
        if best is not None:
            mapping[field], confidence[field] = best, score
    unmatched = tuple(f for f in fixed.FIELD_ALIASES if f not in mapping)
    return ColumnMapping(mapping, confidence, unmatched, tuple(columns))


def mapping_for(
    columns: Sequence[str], overrides: dict[str, str] | None = None,
    preset: str | None = None, threshold: int = 70,
) -> ColumnMapping:
    """Detected names, then a data-set preset, then the caller's choice; later ones win."""
    found = detect_columns(columns, threshold)
    if preset in fixed.DATASET_PRESETS:
        present = {f: c for f, c in fixed.DATASET_PRESETS[preset].items() if c in columns}
        found = found.override(present)
    if overrides:
        found = found.override(overrides)
    if found.missing:
        raise ValueError(f"no amount column among {list(columns)}; name it in the mapping")
    return found


def canonical_status(value: Column) -> Column:
    variants = F.create_map(*[
        F.lit(x) for status, names in fixed.STATUS_VARIANTS.items() for n in names for x in (n, status)
    ])
    return F.coalesce(F.try_element_at(variants, F.lower(F.trim(value.cast("string")))), F.lit("unknown"))


def parse_amount(value: Column) -> Column:
    """A number without sign; text that is no number becomes null."""
    text = value.cast("string")
    number = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.abs(F.when(~F.isnan(number), number))


def _instant(value: Column, kind: T.DataType, pattern: str | None) -> Column:
    if isinstance(kind, T.NumericType):
        seconds = value.cast("double")
        base = F.unix_micros(F.lit(BASE_INSTANT).cast("timestamp"))
        return F.timestamp_micros((base + F.round(seconds * 1_000_000)).cast("bigint"))
    if isinstance(kind, T.StringType):
        if pattern:
            return F.try_to_timestamp(value, F.lit(pattern))
        return value.try_cast("timestamp")
    return value.cast("timestamp")


def _synthetic(place: str) -> Column:
    base = F.unix_timestamp(F.lit(BASE_INSTANT).cast("timestamp"))
    return F.timestamp_seconds(base + F.col(place) * STEP_SECONDS)


def normalise(
    df: DataFrame, mapping: ColumnMapping, order_by: Sequence[str] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Canonical rows from user rows.

    Positions ("the n-th row without a time stamp") follow the canonical columns in
    ``order_by``, by default the transaction id where there is one. Generated ids are random,
    so the table is written once to keep them.
    """
    if mapping.missing:
        raise ValueError(f"no amount column among {list(mapping.columns)}; name it in the mapping")
    sources = mapping.sources()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(*[F.col(f"`{c}`").alias(field) for field, c in sources.items()])
    has_id = "transaction_id" in sources
    text = lambda name: F.col(name).cast("string")

    changes: dict[str, Column] = {
        "amount": parse_amount(F.col("amount")),
        "transaction_id": F.coalesce(text("transaction_id"), F.uuid()) if has_id else F.uuid(),
        "is_fraud": (
            F.coalesce(F.lower(text("is_fraud")).isin(fixed.FRAUD_TRUE), F.lit(False))
            if "is_fraud" in sources else F.lit(False)
        ),
        "currency": F.upper(F.trim("currency")) if "currency" in sources else F.lit("USD"),
        "customer_id": F.coalesce(text("customer_id"), F.lit("unknown")) if "customer_id" in sources else F.lit("unknown"),
        "merchant_name": F.col("merchant_name") if "merchant_name" in sources else F.lit("Unknown Merchant"),
        "merchant_category": F.col("merchant_category") if "merchant_category" in sources else F.lit("Other"),
    }
    if "status" in sources:
        changes["status"] = canonical_status(F.col("status"))
    if "transaction_at" in sources:
        changes["transaction_at"] = _instant(
            F.col("transaction_at"), kinds[sources["transaction_at"]], timestamp_format
        )
    out = out.withColumns(changes)
    if "merchant_id" not in sources:
        out = out.withColumn("merchant_id", uuid5_dns(F.coalesce(text("merchant_name"), F.lit("None"))))
    if not has_id or not df.filter(F.col(f"`{sources['transaction_id']}`").isNull()).isEmpty():
        out = stage(out, "normalised")
    order = list(order_by) if order_by else (["transaction_id"] if has_id else [])
    if "transaction_at" not in sources:
        return (
            with_row_index(out, order, "_nth")
            .withColumn("transaction_at", _synthetic("_nth")).drop("_nth")
        )
    timed = out.filter(F.col("transaction_at").isNotNull())
    untimed = out.filter(F.col("transaction_at").isNull())
    if untimed.isEmpty():
        return out
    repaired = (
        with_row_index(untimed, order, "_nth")
        .withColumn("transaction_at", _synthetic("_nth")).drop("_nth")
    )
    return timed.unionByName(repaired)


def mapping_profile(
    df: DataFrame, mapping: ColumnMapping, exact: bool = False, timestamp_format: str | None = None
) -> DataFrame:
    """Per canonical field: source column, confidence, and non-null, unparseable and distinct counts.

    Distinct counts are HyperLogLog estimates unless ``exact``, which reads each field once more and gathers its values
    alone: all fields in one pass would hold every field's values, as wide as all fields, in one task's table.
    """
    sources = mapping.sources()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggregates, alone = [], []
    for field, column in sources.items():
        raw = F.col(f"`{column}`")
        parsed = raw
        if field == "amount":
            parsed = parse_amount(raw)
        elif field == "transaction_at":
            parsed = _instant(raw, kinds[column], timestamp_format)
        bad = F.count(F.when(raw.isNotNull() & parsed.isNull(), 1))
        aggregates += [F.count(raw).alias(f"{field}_n"), bad.alias(f"{field}_bad")]
        if exact:
            values = df.select(raw.alias("value")).filter("value IS NOT NULL").distinct()
            alone.append(values.agg(F.count("*").alias(f"{field}_d")))
        else:
            aggregates.append(F.approx_count_distinct(raw).alias(f"{field}_d"))
    row = reduce(DataFrame.crossJoin, alone, df.agg(*aggregates))
    none = F.lit(0).cast("bigint")
    lines = F.array(*[
        F.struct(
            F.lit(field).alias("field"),
            F.lit(sources.get(field)).cast("string").alias("source_column"),
            F.lit(mapping.confidence.get(field, 0) if field in sources else 0).alias("confidence"),
            F.lit(field in REQUIRED).alias("required"),
            (F.col(f"{field}_n") if field in sources else none).alias("non_null"),
            (F.col(f"{field}_bad") if field in sources else none).alias("unparseable"),
            (F.col(f"{field}_d") if field in sources else none).alias("distinct_values"),
        )
        for field in fixed.FIELD_ALIASES
    ])
    return row.select(F.explode(lines).alias("l")).select("l.*")


# ---- canonical rows to the raw tables of the warehouse ---------------------------

def payments_for_analytics(canonical: DataFrame, semantics: str = "corrected") -> DataFrame:
    """Canonical rows as the simplified analytics expect them.

    As first written the fraud flag was lost on the way, so every fraud rate was zero.
    """
    flag = F.lit(False) if semantics == "reference" else F.coalesce(F.col("is_fraud"), F.lit(False))
    out = canonical if "is_flagged_fraud" in canonical.columns else canonical.withColumn("is_flagged_fraud", flag)
    return out if "status" in out.columns else out.withColumn("status", F.lit("completed"))


def raw_transactions(canonical: DataFrame) -> DataFrame:
    has = canonical.columns
    defaults = {
        "is_flagged_fraud": F.col("is_fraud") if "is_fraud" in has else F.lit(False),
        "ip_country": F.col("country") if "country" in has else F.lit("GB"),
        "status": F.lit("completed"),
        "channel": F.lit("card"),
        "merchant_category": F.lit("Other"),
        "merchant_name": F.lit("Unknown Merchant"),
        "currency": F.lit("USD"),
        "customer_id": F.lit("unknown"),
    }
    out = canonical.withColumns({c: v for c, v in defaults.items() if c not in has})
    if "merchant_id" not in has:
        out = out.withColumn("merchant_id", uuid5_dns(F.col("merchant_name").cast("string")))
    return out.select(
        "transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_at",
        "status", "is_flagged_fraud", "channel", "ip_country", "merchant_name", "merchant_category",
    )


def derived_customers(transactions: DataFrame) -> DataFrame:
    """One customer per id seen, all signed up on the first day of the data.

    The account currency is that of the earliest transaction.
    """
    first = transactions.agg(
        F.min(F.col("transaction_at").cast("date")).cast("string").alias("signup_date"),
        F.min_by("currency", F.struct("transaction_at", "transaction_id")).alias("currency"),
    )
    customer = F.col("customer_id").cast("string")
    return (
        transactions.select("customer_id").distinct()
        .crossJoin(F.broadcast(first))
        .select(
            "customer_id",
            F.concat(F.lit("Customer "), customer).alias("full_name"),
            F.concat(customer, F.lit("@example.com")).alias("email"),
            F.lit("000-000-0000").alias("phone"),
            F.lit("GB").alias("country"),
            F.lit("standard").alias("account_tier"),
            "signup_date",
            F.lit("verified").alias("kyc_status"),
            F.lit("1990-01-01").alias("date_of_birth"),
            "currency",
        )
    )


def derived_merchants(transactions: DataFrame) -> DataFrame:
    """One merchant per id with its earliest non-null name and category."""
    order = F.struct("transaction_at", "transaction_id")
    earliest = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order))
    return (
        transactions.filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(
            earliest("merchant_name").alias("merchant_name"),
            earliest("merchant_category").alias("category"),
        )
        .select(
            "merchant_id", "merchant_name", "category",
            F.lit("5999").alias("mcc_code"), F.lit("GB").alias("country"),
            F.lit(False).alias("is_high_risk"), F.lit("2020-01-01").alias("onboarded_date"),
        )
    )


def derived_fx_rates(transactions: DataFrame) -> DataFrame:
    """Base rates for each day of the data and each currency seen, plus GBP, USD and EUR."""
    day = F.col("transaction_at").cast("date")
    bounds = transactions.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    always = bounds.sparkSession.createDataFrame([("GBP",), ("USD",), ("EUR",)], "currency string")
    seen = transactions.select("currency").filter(F.col("currency").isNotNull()).union(always).distinct()
    rate = F.lit(1.0)
    for currency, base in fixed.FX_BASE.items():
        rate = F.when(F.col("currency") == currency, base).otherwise(rate)
    # One row of bounds meets the currencies; each has its own days.
    days = seen.crossJoin(F.broadcast(bounds)).select("currency", F.explode(F.sequence("first", "last")).alias("rate_date"))
    return days.select(
        F.col("rate_date").cast("string").alias("rate_date"), "currency", rate.alias("rate_to_gbp")
    )


def no_disputes(transactions: DataFrame) -> DataFrame:
    schema = (
        "dispute_id string, transaction_id string, customer_id string, opened_at string, "
        "reason string, status string, amount double, currency string"
    )
    return transactions.sparkSession.createDataFrame([], schema)
