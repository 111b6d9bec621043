"""An index of stored ids, so that a batch is compared with few of them.

The index consists of segments. Each holds the ids of one batch or, merged, of many; FAN segments of a level become one of the
next, so that n batches leave about FAN * log(n) segments. Within a segment ids lie in blocks by the leading bits of
their hash, about BLOCK_IDS each, and 2 ** FILE_BITS blocks share a file. For every block the index keeps the least and
greatest hash and a Bloom filter of one bitmap (32,768 bits, HASHES bits per id). A look-up meets a batch's ids with the
blocks they would lie in and reads only files whose filter lets an id pass: those that hold one, and one in a
hundred of the others.

Segments are never changed. Which ones count is part of each commit (see ``commits``), so a merge takes effect with the
commit that names its result; ``vacuum`` deletes what the last commit no longer names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.storage import delete, list_files
from ledgerlens.streaming.commits import Segment

FAN = 8
BLOCK_IDS, FILE_BITS, HASHES = 3_000, 6, 4
BITMAP_BITS = 32_768
#: With more files in reach than this, reading their folders whole is cheaper than listing them one by one.
LISTED_FILES = 10_000
_SCHEMAS = {
    "ids": "id string, hash bigint, segment string, file bigint",
    "blocks": "bits int, block bigint, low bigint, high bigint, bitmap binary, segment string",
}


def hashed(id_column: str) -> Column:
    return F.xxhash64(id_column)


def block_of(hash_: Column, bits: int) -> Column:
    """The leading bits of a hash; Java shifts by 64 not at all."""
    return F.shiftrightunsigned(hash_, 64 - bits) if bits else F.lit(0).cast("long")


def file_of(block: Column) -> Column:
    return F.shiftright(block, FILE_BITS)


def positions(id_column: str) -> Column:
    """An id's bits in its block's filter."""
    second = F.xxhash64(F.lit(1), F.col(id_column))
    return F.array(*[F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long")) for i in range(HASHES)])


def has_bits(bitmap: Column, places: Column) -> Column:
    """Whether all ``places`` of a bitmap are set; bit i is bit i % 8 of byte i / 8."""
    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.expr("1").bitwiseAND(F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7).cast("long")).cast("int"))) == 1

    return F.forall(places, is_set)


@dataclass(frozen=True)
class IdIndex:
    spark: SparkSession
    folder: str

    def _path(self, part: str, segment: str) -> str:
        return f"{self.folder}/{part}/segment={segment}"

    def _read(self, part: str, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[part]).option("basePath", f"{self.folder}/{part}").parquet(*paths)

    def write(self, ids: DataFrame, level: int, rows: int) -> Segment:
        """Store distinct ids (column ``id``) as a new segment."""
        bits = max(0, (-(-rows // BLOCK_IDS) - 1).bit_length())
        made = Segment(f"{level}-{uuid.uuid4().hex}", level, bits, rows)
        placed = ids.select("id", hashed("id").alias("hash")).withColumn("block", block_of(F.col("hash"), bits))
        files = max(1, 2 ** max(0, bits - FILE_BITS))
        placed = placed.withColumn("file", file_of(F.col("block")))
        spread = placed.repartition(files, "file") if files > 1 else placed.coalesce(1)
        spread.select("id", "hash", "file").write.partitionBy("file").parquet(self._path("ids", made.name))
        stored = self.ids([made])
        blocks = stored.select(block_of(F.col("hash"), bits).alias("block"), "hash", F.explode(positions("id")).alias("place"))
        blocks.groupBy("block").agg(
            F.min("hash").alias("low"), F.max("hash").alias("high"), F.bitmap_construct_agg("place").alias("bitmap")
        ).select(F.lit(bits).alias("bits"), "block", "low", "high", "bitmap").coalesce(max(1, files // 8)).write.parquet(
            self._path("blocks", made.name)
        )
        return made

    def ids(self, segments: Sequence[Segment]) -> DataFrame:
        """All ids of some segments."""
        return self._read("ids", [self._path("ids", s.name) for s in segments])

    def reach(self, batch: DataFrame, segments: Sequence[Segment]) -> list[str]:
        """The folders of ids, one file each, that may hold an id of ``batch`` (column ``id``)."""
        held = [s for s in segments if s.ids]
        if not held:
            return []
        blocks = self._read("blocks", [self._path("blocks", s.name) for s in held])
        hash_ = F.col("hash")
        sizes = F.array(*[
            F.struct(F.lit(b).alias("bits"), block_of(hash_, b).alias("block")) for b in sorted({s.bits for s in held})
        ])
        wanted = batch.select("id", hashed("id").alias("hash")).select("hash", positions("id").alias("places"), F.inline(sizes))
        near = blocks.join(wanted, ["bits", "block"]).filter(
            (hash_ >= F.col("low")) & (hash_ <= F.col("high")) & has_bits(F.col("bitmap"), F.col("places"))
        )
        found = near.select("segment", file_of(F.col("block")).alias("file")).distinct().limit(LISTED_FILES + 1).collect()
        if len(found) > LISTED_FILES:
            return [self._path("ids", s.name) for s in held]
        return sorted(f"{self._path('ids', r['segment'])}/file={r['file']}" for r in found)

    def known(self, batch: DataFrame, segments: Sequence[Segment]) -> DataFrame | None:
        """The ids of ``batch`` that are stored already; None if no file may hold one."""
        files = self.reach(batch, segments)
        if not files:
            return None
        stored = self._read("ids", files).select("id")
        return batch.select("id").join(stored, "id", "left_semi")

    def merged(self, segments: Sequence[Segment]) -> list[Segment]:
        """``segments`` with every full level merged into one segment of the next."""
        out = list(segments)
        level = 0
        while any(s.level >= level for s in out):
            full = [s for s in out if s.level == level]
            if len(full) >= FAN:
                out = [s for s in out if s.level != level]
                out.append(self.write(self.ids(full).select("id"), level + 1, sum(s.ids for s in full)))
            level += 1
        return out

    def vacuum(self, segments: Sequence[Segment]) -> int:
        """Delete the segments that are not among ``segments``; nobody may be looking up ids by an older commit."""
        live = {f"segment={s.name}" for s in segments}
        gone = set()
        for part in _SCHEMAS:
            for name in list_files(self.spark, f"{self.folder}/{part}"):
                if name not in live:
                    delete(self.spark, f"{self.folder}/{part}/{name}")
                    gone.add(name)
        return len(gone)
