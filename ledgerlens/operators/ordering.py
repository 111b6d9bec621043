"""Exact positions in a global order without a one-task sort.

``ntile``, ``percentile`` and row numbers over a whole table normally pull the table into
one task. Here the positions of interest are narrowed down by counting rows between split
points, and only a bounded remainder is ever put in order in one place. Split points come
from a sample; they decide how evenly the work is spread, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.storage import stage

# Rows that may be ordered in one task. Anything larger is split again first.
ORDERED_ROWS = 1_000_000
# Split points per round. Few, so that the comparisons stay inside generated code.
SPLITS_PER_ROUND = 32
SAMPLE_ROWS = 8_000


def _after(keys: Sequence[str], bound: tuple) -> Column:
    """Lexicographic ``keys > bound``."""
    result = F.col(keys[-1]) > F.lit(bound[-1])
    for key, value in zip(reversed(keys[:-1]), reversed(bound[:-1])):
        result = (F.col(key) > F.lit(value)) | ((F.col(key) == F.lit(value)) & result)
    return result


def _equal(keys: Sequence[str], bound: tuple) -> Column:
    return reduce(and_, [F.col(k) == F.lit(v) for k, v in zip(keys, bound)])


@dataclass
class _Span:
    """Rows strictly between two keys; ``before`` rows precede them."""

    low: tuple | None
    high: tuple | None
    before: int
    rows: int
    ranks: list[int]

    def condition(self, keys: Sequence[str]) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & _after(keys, self.low)
        if self.high is not None:
            inside = inside & ~_after(keys, self.high) & ~_equal(keys, self.high)
        return inside


def _split(df: DataFrame, keys: Sequence[str], span: _Span, found: dict[int, tuple]) -> list[_Span]:
    """Count the rows at and between split points; keep the parts that hold a wanted rank.

    A rank that falls on a split point is found at once, so a value shared by very many
    rows ends the search instead of prolonging it.
    """
    inside = df.filter(span.condition(keys))
    fraction = min(1.0, SAMPLE_ROWS / span.rows)
    seen = sorted({tuple(r) for r in inside.sample(fraction, seed=17).collect()})
    step = max(1, -(-len(seen) // SPLITS_PER_ROUND))
    bounds = seen[step // 2::step]
    def place(low: int, high: int) -> Column:
        """Twice the number of split points before the row, and one more on a split point; halving, since it is one of
        ``bounds[low:high]``."""
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        after, on = _after(keys, bounds[middle]), _equal(keys, bounds[middle])
        return F.when(after, place(middle + 1, high)).when(on, F.lit(2 * middle + 1)).otherwise(place(low, middle))

    bucket = place(0, len(bounds))
    counted = {
        r["bucket"]: r["rows"]
        for r in inside.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows")).collect()
    }
    parts, before = [], span.before
    for b in range(2 * len(bounds) + 1):
        rows = counted.get(b, 0)
        ranks = [r for r in span.ranks if before < r <= before + rows]
        if b % 2:
            found.update(dict.fromkeys(ranks, bounds[b // 2]))
        elif ranks:
            low = bounds[b // 2 - 1] if b > 0 else span.low
            high = bounds[b // 2] if b // 2 < len(bounds) else span.high
            parts.append(_Span(low, high, before, rows, ranks))
        before += rows
    return parts


def rows_at_ranks(
    df: DataFrame, keys: Sequence[str], ranks: Sequence[int], rows: int
) -> dict[int, tuple]:
    """The key values at the given 1-based ranks in the order of ``keys``, which must not be null.

    Each round reads the table twice and shuffles nothing but counts; only sample rows and
    the wanted keys reach the driver.
    """
    found: dict[int, tuple] = {}
    wanted = sorted({r for r in ranks if 0 < r <= rows})
    if not wanted:
        return found
    df = df.select(*keys)
    pending = [_Span(None, None, 0, rows, wanted)]
    ready: list[_Span] = []
    while pending:
        span = pending.pop()
        if span.rows <= ORDERED_ROWS:
            ready.append(span)
        else:
            pending.extend(_split(df, keys, span, found))
    if not ready:
        return found
    tag = F.lit(None).cast("int")
    hit = F.lit(False)
    for i, span in enumerate(ready):
        tag = F.when(span.condition(keys), F.lit(i)).otherwise(tag)
        hit = hit | ((F.col("_span") == i) & F.col("_nth").isin([r - span.before for r in span.ranks]))
    order = Window.partitionBy("_span").orderBy(*keys)
    placed = (
        df.withColumn("_span", tag)
        .filter(F.col("_span").isNotNull())
        .withColumn("_nth", F.row_number().over(order))
        .filter(hit)
    )
    for row in placed.collect():
        found[ready[row["_span"]].before + row["_nth"]] = tuple(row[k] for k in keys)
    return found


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Rank of the last row of each tile; the first ``rows % tiles`` tiles hold one more."""
    size, extra = divmod(rows, tiles)
    return [size * t + min(t, extra) for t in range(1, tiles + 1)]


def with_ntiles(
    df: DataFrame, scores: dict[str, tuple[str, bool]], id_col: str, tiles: int = 5
) -> DataFrame:
    """Add exact ``ntile`` columns over the whole table.

    ``scores`` maps an output name to (numeric column, descending). Nulls sort last and
    ``id_col`` breaks ties. ``df`` is read several times, so pass a stored table.
    """
    rows = df.count()
    ends = tile_ends(rows, tiles)[:-1]
    for name, (value, descending) in scores.items():
        sign = -1.0 if descending else 1.0
        keys = {
            "_null": F.col(value).isNull().cast("int"),
            "_value": F.coalesce(F.col(value).cast("double"), F.lit(0.0)) * F.lit(sign),
            "_id": F.col(id_col),
        }
        keyed = df.select(*[c.alias(k) for k, c in keys.items()])
        bounds = rows_at_ranks(keyed, list(keys), ends, rows)
        with_keys = df.withColumns(keys)
        tile = F.lit(1)
        for end in ends:
            if end in bounds:
                tile = tile + _after(list(keys), bounds[end]).cast("int")
        df = with_keys.withColumn(name, tile.cast("bigint")).drop(*keys)
    return df


def exact_percentiles(df: DataFrame, column: str, points: Sequence[float]) -> list[float | None]:
    """Interpolated percentiles of a numeric column, exact for any number of rows.

    The interpolation is that of Spark's ``percentile``, to the last bit. The values are
    written once: the search reads them several times, and what they come from may hold joins.
    """
    values = stage(
        df.select(F.col(column).cast("double").alias("_value")).filter(F.col("_value").isNotNull()), "percentile-values"
    )
    rows = values.count()
    if not rows:
        return [None for _ in points]
    places = [(rows - 1) * p for p in points]
    ranks = {int(p) + 1 for p in places} | {min(int(p) + 2, rows) for p in places}
    found = rows_at_ranks(values, ["_value"], sorted(ranks), rows)
    result = []
    for place in places:
        low = found[int(place) + 1][0]
        high = found[min(int(place) + 2, rows)][0]
        part = place - int(place)
        result.append(low if low == high else (int(place) + 1 - place) * low + part * high)
    return result


def with_row_index(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """Add a 0-based position in the order of ``order_by`` (ties: order of arrival).

    The table is range-sorted and written once; each row keeps its place inside its
    partition, and the partitions' sizes give the offsets. The arrival number is part of
    the sort key, so equal keys are spread over partitions too.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    place = 33  # monotonically_increasing_id keeps the partition above bit 33
    order = [F.col(c).asc_nulls_last() for c in order_by] + [F.col("_arrival")]
    ordered = (
        df.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_arrival")
    )
    stored = stage(ordered, "row-index").withColumn("_part", F.shiftright("_place", place))
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition, so this window is as small as the partition count.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << place) - 1))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + inside)
        .drop("_part", "_place", "_before")
    )
