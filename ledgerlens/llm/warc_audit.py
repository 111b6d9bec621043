"""Merkle fixity audit of replicated WARC files.

A manifest lists each file's records by offset. Leaves hash a record's range and content; FAN neighbours
make a node, whose hash covers their hashes and the range they span, up to a root for each file and then
one for the collection. Every level is written once. The audit compares the roots of two replicas and
descends: at each level only children of differing nodes are read, down to the records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.frames import q, ship
from ledgerlens.operators.ordering import with_row_index
from ledgerlens.storage import Scratch

FAN = 16
FILE_RECORDS = 1024
LEAF = ["file", "place", "offset", "length", "digest"]
PARSED = "file string, offset long, length long, type string, uri string, digest string"


def record_text(uri: Column, body: Column) -> Column:
    """A response record as text: header lines, a blank line, the body, two line ends."""
    body, uri = F.coalesce(body, F.lit("")), F.coalesce(uri, F.lit(""))
    size = F.octet_length(body).cast("string")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Length: "), size,
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def parse(files: DataFrame) -> DataFrame:
    """Records of uncompressed WARC files (``binaryFile`` rows), a file at a time: file, offset, length, type, uri, digest.

    Bytes that are no record become one of type ``damaged`` up to the next record or the end. An empty file has none.
    """
    def records(data: bytes) -> Iterator[tuple]:
        at = 0
        while at < len(data):
            head = data.find(b"\r\n\r\n", at)
            fields = {}
            lines = data[at:head].split(b"\r\n") if head >= 0 else [b""]
            if re.fullmatch(rb"WARC/[0-9]\.[0-9]", lines[0]):
                for line in lines[1:]:
                    name, _, value = line.partition(b":")
                    fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
            size = fields.get(b"content-length", "")
            end = head + 8 + int(size) if size.isdigit() else -1
            kind = fields.get(b"warc-type", "")
            if end < 0 or end > len(data):
                following = data.find(b"WARC/", at + 1)
                end, kind = following if following > 0 else len(data), "damaged"
            yield at, end - at, kind, fields.get(b"warc-target-uri"), hashlib.sha256(data[at:end]).hexdigest()
            at = end

    def run(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                yield pd.DataFrame([(path, *r) for r in records(bytes(data))], columns=["file", "offset", "length", "type", "uri", "digest"])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, PARSED)


def manifest(records: DataFrame, order_by: list[str], file_records: int = FILE_RECORDS) -> DataFrame:
    """``records`` (with ``length``) placed in files of ``file_records``: adds file, place and offset."""
    placed = with_row_index(records, order_by, "_row").withColumn("file", F.floor(F.col("_row") / file_records)).withColumn(
        "place", F.col("_row") % file_records
    )
    earlier = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("_row")


def _above(level: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The nodes over FAN neighbours of a level with ``place``, ``low``, ``high`` and ``hash``."""
    children = F.array_sort(F.collect_list(F.struct(place, "low", "high", "hash")))
    nodes = level.groupBy(*keys, F.floor(F.col(place) / FAN).alias("_up")).agg(
        children.alias("children"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    body = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["low"].cast("string"), c["high"].cast("string"), c["hash"])), ",")
    return nodes.select(*keys, F.col("_up").alias(place), "low", "high", F.sha2(body.cast("binary"), 256).alias("hash"))


def tree(leaves: DataFrame, scratch: Scratch, name: str, heights: tuple[int, int]) -> list[DataFrame]:
    """The stored levels of one replica, leaves first: levels within files, then over files.

    ``leaves``: LEAF columns. ``heights``: levels within and over files, so that two replicas' trees have one shape.
    """
    body = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "digest")
    level = scratch.keep(leaves.select(
        "file", "place", F.col("offset").alias("low"), (F.col("offset") + F.col("length")).alias("high"),
        F.sha2(body.cast("binary"), 256).alias("hash"),
    ), f"{name}-0")
    levels = [level]
    for _ in range(heights[0]):
        levels.append(scratch.keep(_above(levels[-1], ["file"], "place"), f"{name}-{len(levels)}"))
    roots = levels[-1].drop("place")
    for k in range(heights[1]):
        roots = _above(roots if not k else levels[-1], [], "file")
        levels.append(scratch.keep(roots, f"{name}-{len(levels)}"))
    return levels


def _height(count: int) -> int:
    height, width = 0, 1
    while width < count:
        height, width = height + 1, width * FAN
    return height


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which two replicas differ: file, place, offset, length, status.

    ``status`` is ``changed``, ``missing`` (not in the replica) or ``extra`` (only there). Both tables have the columns
    file, place, offset, length and digest, one row per record (a null digest is hashed as an empty one); equal replicas,
    and two empty ones, give no rows. Other columns are not read.
    """
    scratch = Scratch(primary.sparkSession, "audit")
    fill = [F.coalesce(F.col(c), F.lit("")).alias(c) if c == "digest" else F.col(c) for c in LEAF]
    one, two = primary.select(*fill), replica.select(*fill)
    size = one.select("file", "place").unionByName(two.select("file", "place")).agg(
        F.coalesce(F.max("place"), F.lit(0)), F.coalesce(F.max("file"), F.lit(0))
    ).first()
    heights = (_height(size[0] + 1), _height(size[1] + 1))
    a = tree(one, scratch, "primary", heights)
    b = tree(two, scratch, "replica", heights)
    differing = None
    for depth in range(len(a) - 1, -1, -1):
        # Nodes within a file are known by file and place, those above by the number of their group of files.
        keys = ["file", "place"] if depth <= heights[0] else ["file"]
        left, right = a[depth], b[depth]
        if differing is not None:
            up = {"file": F.col("file"), "place": F.floor(F.col("place") / FAN)} if depth < heights[0] else {"file": F.floor(F.col("file") / FAN)}
            parents = differing.select(*[F.col(k).alias(f"up_{k}") for k in up]).distinct()
            left, right = (
                x.withColumns({f"up_{k}": c for k, c in up.items()}).join(parents, [f"up_{k}" for k in up], "left_semi") for x in (left, right)
            )
        one, two = (
            x.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in ("low", "high", "hash")]) for x, side in ((left, "a"), (right, "b"))
        )
        differing = scratch.keep(
            one.join(two, keys, "full").filter(~F.col("hash_a").eqNullSafe(F.col("hash_b"))), f"differing-{depth}"
        )
    return differing.select(
        "file", "place", F.coalesce("low_a", "low_b").alias("offset"),
        F.coalesce(F.col("high_a") - F.col("low_a"), F.col("high_b") - F.col("low_b")).alias("length"),
        F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").otherwise("changed").alias("status"),
    )


def damaged_copy(pages: DataFrame) -> DataFrame:
    """Pages as records of two replicas: page_id, length, digest and the copy's digest (null: lost).

    The copy has a changed byte where page_id modulo 89 is 3 and has lost the records where page_id modulo 97 is 5,
    so that an audit of any table has something to find.
    """
    text = record_text(q("url"), q("html"))
    bad = F.concat(F.lit("X"), F.substring("text", 2, 2**31 - 1))
    made = pages.select(q("page_id").alias("page_id"), text.alias("text"))
    return made.select(
        "page_id", F.octet_length("text").cast("long").alias("length"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.when(F.col("page_id") % 97 == 5, F.lit(None)).when(F.col("page_id") % 89 == 3, F.sha2(bad.cast("binary"), 256))
        .otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("copy_digest"),
    )


def audited_pages(pages: DataFrame) -> DataFrame:
    """The audit of ``damaged_copy``: page_id, file, place, offset, length, status."""
    scratch = Scratch(pages.sparkSession, "warc")
    placed = scratch.keep(manifest(damaged_copy(pages), ["page_id", "digest"]), "manifest")
    lost = placed.filter("copy_digest IS NOT NULL").drop("digest").withColumnRenamed("copy_digest", "digest")
    found = audit(placed, lost)
    return found.join(placed.select("file", "place", "page_id"), ["file", "place"]).select(
        "page_id", "file", "place", "offset", "length", "status"
    )


SQL = """
WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body
  FROM pages
), n AS (
  SELECT page_id, strlen(body) AS length, row_number() OVER (ORDER BY page_id, sha256(body)) - 1 AS i FROM r
), placed AS (
  SELECT page_id, i // 1024 AS file, i % 1024 AS place, length,
    coalesce(sum(length) OVER (PARTITION BY i // 1024 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM n
)
SELECT page_id, file, place, cast(off AS bigint) AS "offset", length,
  CASE WHEN page_id % 97 = 5 THEN 'missing' ELSE 'changed' END AS status
FROM placed WHERE page_id % 97 = 5 OR page_id % 89 = 3
"""
