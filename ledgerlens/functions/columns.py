"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UUID_NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero on its binary value.

    Spark's own ``round`` goes through the decimal text of a double, so 1.005 becomes 1.01;
    SQL engines which scale, round and unscale give 1.0. This is the second form.
    """
    scaled = value.cast("double") * F.lit(float(10**digits))
    whole = F.when(scaled >= 0, F.floor(scaled + 0.5)).otherwise(F.ceil(scaled - 0.5))
    return whole.cast("double") / F.lit(float(10**digits))


def money(total: Column) -> Column:
    """A sum of pennies, freed of the noise that depends on the order of addition."""
    return F.round(total, 2)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """``100 * numerator / denominator`` rounded; null when there is nothing to divide by."""
    return round_to(F.try_divide(numerator.cast("double") * 100.0, denominator.cast("double")), digits)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def months_apart(earlier: Column, later: Column) -> Column:
    """Month boundaries crossed, so 31 January to 1 February is one."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("bigint")


def years_apart(earlier: Column, later: Column) -> Column:
    return (F.year(later) - F.year(earlier)).cast("bigint")


def days_apart(earlier: Column, later: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def uuid5_dns(name: Column) -> Column:
    """Name-based UUID (version 5, DNS namespace): SHA-1 with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(UUID_NAMESPACE_DNS)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def thousands(value: Column, digits: int) -> Column:
    """Text with thousands separators, rounded half to even as C's printf does."""
    return F.format_number(value, digits)


def convert_currency(
    rows: DataFrame, rates: DataFrame, amount: str, currency: str, as_of: Column, out: str
) -> DataFrame:
    """Convert with the rate of day ``as_of``; null where there is no rate or it is zero."""
    today = (
        rates.filter(F.col("rate_date") == as_of)
        .groupBy(F.col("currency").alias(currency))
        .agg(F.max("rate_to_gbp").alias("_rate"))
    )
    return (
        rows.join(today, currency, "left")
        .withColumn(out, round_to(F.try_divide(F.col(amount), F.col("_rate")), 2))
        .drop("_rate")
    )


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return spark.range(1).select(F.explode(days).alias("calendar_date"))


def with_share(df: DataFrame, metric: str, out: str, by: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Add ``metric`` as a percentage of its total, over all rows or within ``by``.

    ``df`` is an aggregate. The overall total is a one-row table joined back; a window
    without partition keys would move every row to one task.
    """
    if by:
        total = F.sum(metric).over(Window.partitionBy(*by))
        return df.withColumn(out, percent(F.col(metric), total, digits))
    total = df.agg(F.sum(metric).alias("_total"))
    return (
        df.crossJoin(F.broadcast(total))
        .withColumn(out, percent(F.col(metric), F.col("_total"), digits))
        .drop("_total")
    )
