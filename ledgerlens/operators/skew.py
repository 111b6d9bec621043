"""Per-key running totals and medians that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.storage import stage

# A key with more rows than this is split; below it one task orders the key's rows.
# At 10^12 rows at most 10^6 keys can exceed it, so the list of such keys stays small.
HOT_ROWS = 1_000_000
# A sliding frame re-adds its rows for each row; keys up to this size may use one.
FRAME_ROWS = 10_000
# Up to this many hot keys travel with the plan; more are kept in a stored table.
LISTED_KEYS = 10_000


def find_hot(df: DataFrame, key: str, limit: int | None = None) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    Runs one count per key (map-side combined, only the key column is read) so that the
    usual case, no such key, gets a plan without any detour. Which keys are found decides
    how the work is cut up, never the result, so ``df`` may be a slimmer or earlier version
    of the table that is processed.
    """
    hot = (
        df.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > (HOT_ROWS if limit is None else limit))
        .select(F.col(key).alias("_hot_key"), F.lit(True).alias("_is_hot"))
    )
    found = hot.limit(LISTED_KEYS + 1).collect()
    if not found:
        return None
    if len(found) > LISTED_KEYS:
        return stage(hot, "hot-keys")
    return df.sparkSession.createDataFrame(found, hot.schema)


@dataclass(frozen=True)
class KeyLoad:
    """How the rows lie over the keys: the hot ones, and whether any key exceeds ``FRAME_ROWS``."""

    hot: DataFrame | None = None
    crowded: bool = True


def key_load(df: DataFrame, key: str) -> KeyLoad:
    """Count once in the usual case, a second time when some key is crowded."""
    if find_hot(df, key, FRAME_ROWS) is None:
        return KeyLoad(None, False)
    return KeyLoad(find_hot(df, key), True)


def mark_hot(df: DataFrame, key: str, hot: DataFrame, out: str = "_hot") -> DataFrame:
    """Add a boolean telling whether the row's key is in ``hot``.

    Unhinted: a listed or small ``hot`` is broadcast by its size, a large one is not.
    """
    return (
        df.join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn(out, F.coalesce("_is_hot", F.lit(False)))
        .drop("_hot_key", "_is_hot")
    )


def with_running_total(
    df: DataFrame,
    key: str,
    at: str,
    order_by: Sequence[str],
    step: Column,
    out: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Running sum of ``step`` per ``key`` in the order of ``at`` then ``order_by``.

    A normal key is one window partition. The rows of hot keys (see ``find_hot``) are range-partitioned by key and
    order, whatever their times are: a distributed prefix sum adds up inside each partition and carries in the totals
    of the key's earlier partitions, of which there is one row each.
    """
    order = [F.col(at).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in order_by]
    if hot is None:
        upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(step.cast("bigint")).over(upto))
    marked = mark_hot(df, key, hot).withColumn("_step", step.cast("bigint"))
    upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    normal = marked.filter(~F.col("_hot")).withColumn(out, F.sum("_step").over(upto)).drop("_hot", "_step")
    return normal.unionByName(_prefix_sums(marked.filter("_hot").drop("_hot"), key, order, out))


def _prefix_sums(rows: DataFrame, key: str, order: Sequence[Column], out: str) -> DataFrame:
    """Running sums of ``_step`` over slices of the range order; ``_step`` goes."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # Written once, so that a row's slice cannot change between the sums and the totals.
    laid = stage(
        rows.repartitionByRange(parts, F.col(key).asc_nulls_last(), *order).withColumn("_slice", F.spark_partition_id()), "prefix-sums"
    )
    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = laid.groupBy(F.col(key).alias("_k"), F.col("_slice").alias("_s")).agg(F.sum("_step").alias("_sum")).select(
        "_k", "_s", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        laid.withColumn(out, F.sum("_step").over(inside))
        # One row per slice and one more per further key in it.
        .join(F.broadcast(before), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")))
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_slice", "_step", "_k", "_s", "_before")
    )


def with_trailing_count(
    df: DataFrame, key: str, at: str, days: int, out: str, load: KeyLoad | None = None
) -> DataFrame:
    """Rows of the same key in ``[at - days, at]``, peers at the same instant included.

    Where ``load`` shows that no key is crowded, a sliding range frame. It re-adds the whole
    frame for every row, which is quadratic for a busy key; otherwise, and by default, the
    count is a difference of two running totals, the second one probed just before
    ``at - days``.
    """
    load = load or KeyLoad()
    if not load.crowded:
        return df.withColumn(out, F.expr(
            f"count(*) over (partition by {key} order by {at} "
            f"range between interval {days} days preceding and current row)"
        ))
    instants = df.groupBy(key, at).agg(F.count("*").alias("_n")).filter(F.col(at).isNotNull())
    shifted = F.col(at) - F.make_dt_interval(F.lit(days))
    marks = instants.select(
        F.col(key), F.col(at).alias("_at"),
        F.explode(F.array(
            F.struct(shifted.alias("t"), F.lit(0).alias("is_row"), F.lit(0).cast("bigint").alias("n")),
            F.struct(F.col(at).alias("t"), F.lit(1).alias("is_row"), F.col("_n").alias("n")),
        )).alias("_m"),
    ).select(key, "_at", "_m.*")
    running = with_running_total(marks, key, "t", ["is_row"], F.col("n"), "_upto", load.hot)
    signed = F.when(F.col("is_row") == 1, F.col("_upto")).otherwise(-F.col("_upto"))
    counts = running.groupBy(F.col(key).alias("_k"), "_at").agg(F.sum(signed).alias(out))
    return df.join(
        counts, F.col(key).eqNullSafe(F.col("_k")) & (F.col(at) == F.col("_at")), "left"
    ).drop("_k", "_at")


def hot_medians(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact medians for keys too large for one task's ``percentile`` buffer.

    Values are first counted per (key, value), then per coarse bin, which locates the bin
    of the middle ranks; only that bin's distinct values are ordered.
    """
    order_of = F.signum(F.col(value)) * F.floor(F.log1p(F.abs(F.col(value))) * 200)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value).agg(F.count("*").alias("_n"))
        .withColumn("_bin", order_of)
    )
    bins = counts.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_binned"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    middle = (
        bins.withColumn("_total", F.sum("_binned").over(whole))
        .withColumn("_end", F.sum("_binned").over(upto))
        .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_high", F.floor((F.col("_total") + 2) / 2))
        .withColumn("_start", F.col("_end") - F.col("_binned"))
        .filter(
            ((F.col("_low") > F.col("_start")) & (F.col("_low") <= F.col("_end")))
            | ((F.col("_high") > F.col("_start")) & (F.col("_high") <= F.col("_end")))
        )
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                F.col("_bin").alias("_k_bin"), "_low", "_high", "_start")
    )
    same = F.col("_bin") == F.col("_k_bin")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        counts.join(middle, same)
        .withColumn("_end", F.col("_start") + F.sum("_n").over(inside))
        .withColumn("_first", F.col("_end") - F.col("_n"))
    )
    holds = lambda rank: (F.col(rank) > F.col("_first")) & (F.col(rank) <= F.col("_end"))
    return placed.groupBy(*keys).agg(
        (
            (F.max(F.when(holds("_low"), F.col(value))) + F.max(F.when(holds("_high"), F.col(value)))) / 2.0
        ).alias(out)
    )
