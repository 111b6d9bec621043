"""Joins that move whole rows as parcels: columns of many rows, compressed together."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.skew import find_hot, mark_hot
from ledgerlens.storage import lean

# The functions below run inside tasks; send them along rather than import them there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A table whose rows take less than this, counted, is sent to every executor instead.
BROADCAST_BYTES = 64 << 20
# A task packs its rows whenever it holds this much of them.
HELD_BYTES = 32 << 20
# Rows that leave a task together.
ROWS = 10_000
# Up to this many shards each partition of a shuffle is one; beyond, a shard is a quarter of them at least.
SHARDS = 256

PARCELS = "shard int, side int, parcel binary"


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left.join(right, key, "left")`` for rows that are kept whole, when ``right`` is a dimension.

    Rows of ``right`` are counted. If they are few they are broadcast. Otherwise both sides are moved, and a plain shuffle
    keeps rows of ``left`` one by one on disk. Here a task sorts its rows into shards by key and writes each shard's rows as
    one compressed parquet file, which takes half the space; the parcels of a shard then meet, first those of ``right``.

    A shard's rows of ``right`` must fit in a task. Rows of ``left`` pass one parcel at a time, and rows of a hot key or
    without a key are dealt to all shards, where hot rows of ``right`` are repeated. Equal keys must be equal bytes, as
    strings, whole numbers and dates are.
    """
    if _fits(right):
        return left.join(F.broadcast(right), key, "left")
    with lean(left.sparkSession):
        hot = find_hot(left, key)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(partitions, max(SHARDS, partitions // 4))
    own, anywhere = _shard(n, key), _shard(n, *left.columns)
    spread, everywhere = F.col(key).isNull(), F.array(own)
    if hot is not None:
        left, right = mark_hot(left, key, hot), mark_hot(right, key, hot)
        spread = spread | F.col("_hot")
        everywhere = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(everywhere)
    dealt = left.withColumn("_shard", F.when(spread, anywhere).otherwise(own)).drop("_hot")
    stock = right.filter(F.col(key).isNotNull()).withColumn("_shard", F.explode(everywhere)).drop("_hot")
    names, others = dealt.columns[:-1], [c for c in stock.columns[:-1] if c != key]
    schema = T.StructType([dealt.schema[c] for c in names] + [T.StructField(c, stock.schema[c].dataType) for c in others])
    empty = stock.select(key, *others).limit(0).toArrow()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _joined(batches, names, empty, names.index(key))

    parcels = stock.select(key, *others, "_shard").mapInArrow(_packer(0), PARCELS).unionByName(
        dealt.mapInArrow(_packer(1), PARCELS)
    )
    return parcels.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "side").mapInArrow(meet, schema)


def _shard(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def _fits(df: DataFrame) -> bool:
    """Whether the rows take less than ``BROADCAST_BYTES`` with what a hash table adds to them."""
    text = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    row = df.agg(F.coalesce(F.sum(text + 64 + 8 * len(df.columns)), F.lit(0)).alias("size")).first()
    return row["size"] < BROADCAST_BYTES


def _packer(side: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= HELD_BYTES:
                yield _packed(held, side)
                held, size = [], 0
        if size:
            yield _packed(held, side)

    return pack


def _packed(held: list[pa.RecordBatch], side: int) -> pa.RecordBatch:
    """One parcel per shard; the shard is the last column."""
    rows = pa.Table.from_batches(held).combine_chunks()
    shards = rows.column(rows.num_columns - 1).to_numpy()
    order = np.argsort(shards, kind="stable")
    kinds, starts = np.unique(shards[order], return_index=True)
    rows = rows.remove_column(rows.num_columns - 1).take(pa.array(order))
    rows = rows.rename_columns([str(i) for i in range(rows.num_columns)])
    # A dictionary is worth its place where values come several times.
    some = rows.slice(0, 4 * ROWS)
    often = [c for c in rows.column_names if pa.types.is_string(some[c].type) and 8 * pc.count_distinct(some[c]).as_py() < some.num_rows]
    parcels = []
    for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
        out = io.BytesIO()
        pq.write_table(
            rows.slice(a, b - a), out, compression="zstd", use_dictionary=often, write_statistics=False, store_schema=False
        )
        parcels.append(out.getvalue())
    return pa.record_batch({
        "shard": pa.array(kinds, pa.int32()), "side": pa.array([side] * len(kinds), pa.int32()), "parcel": pa.array(parcels, pa.binary()),
    })


def _opened(parcel: pa.Scalar) -> pa.Table:
    return pq.ParquetFile(pa.BufferReader(parcel.as_buffer())).read(use_threads=False)


def _joined(batches: Iterator[pa.RecordBatch], names: list[str], empty: pa.Table, key: int) -> Iterator[pa.RecordBatch]:
    """Parcels in the order of shard and side to rows; ``empty`` has the columns of the right side, its key first."""
    shard, held, stock = None, [], None
    for batch in batches:
        for i in range(batch.num_rows):
            s, side = batch["shard"][i].as_py(), batch["side"][i].as_py()
            if s != shard:
                shard, held, stock = s, [], None
            rows = _opened(batch["parcel"][i])
            if side == 0:
                held.append(rows.rename_columns(empty.column_names))
                continue
            if stock is None:
                stock = _Stock(pa.concat_tables(held) if held else empty)
                held = []
            yield from stock.met(rows.rename_columns(names), key)


class _Stock:
    """The right rows of a shard, found by key."""

    def __init__(self, rows: pa.Table):
        codes = rows.column(0).combine_chunks().dictionary_encode()
        at = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = codes.dictionary
        self.order = np.argsort(at, kind="stable")
        self.count = np.bincount(at, minlength=len(self.keys))
        self.start = np.cumsum(self.count) - self.count
        self.rows = rows.remove_column(0).combine_chunks()

    def met(self, left: pa.Table, key: int) -> Iterator[pa.RecordBatch]:
        """Left rows with each of their right rows, or with nulls."""
        code = pc.index_in(left.column(key), value_set=self.keys, skip_nulls=True).fill_null(-1)
        code = code.to_numpy().astype(np.int64)
        known = code >= 0
        times, first = np.ones(len(code), np.int64), np.zeros(len(code), np.int64)
        times[known], first[known] = self.count[code[known]], self.start[code[known]]
        ends = np.cumsum(times)
        a = 0
        while a < len(code):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ROWS, side="right")))
            n = times[a:b]
            row = np.repeat(np.arange(a, b), n)
            place = np.repeat(first[a:b], n) + np.arange(len(row)) - np.repeat(ends[a:b] - n - (ends[a - 1] if a else 0), n)
            found = known[row]
            right = np.zeros(len(row), np.int64)
            right[found] = self.order[place[found]]
            tables = left.take(pa.array(row)), self.rows.take(pa.array(right, mask=~found))
            yield pa.RecordBatch.from_arrays(
                [c.combine_chunks() for t in tables for c in t.columns], names=[c for t in tables for c in t.column_names]
            )
            a = b
