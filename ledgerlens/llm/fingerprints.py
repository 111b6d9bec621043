"""Document fingerprints by winnowing.

A text is read as units: runs of letters and digits, cut after eight, and other visible characters one by one. Every GRAM
units have a hash; of every WINDOW neighbouring hashes the least is a mark, the rightmost one where several are least,
kept with its position. Two texts that share GRAM + WINDOW - 1 whole units in a row share a mark there, wherever the
passage stands. Units instead of single code points cost a quarter of the time and keep the guarantee.

The hash is the one that rolls along a text by ``h = (h << 1) ^ code``, cut to GRAM units. Rolling it step by step
would copy an array per step; as array functions it is cheaper to double: the hash of 2m places is that of the first
m shifted by m, xor that of the next m. Minima of windows widen in the same way. Everything runs as DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import let, q
from ledgerlens.operators.ordering import with_row_index
from ledgerlens.storage import Scratch

#: Powers of two and of four, as hashes double and minima grow fourfold.
GRAM, WINDOW = 4, 16
#: Units that the shortest passage has of which a mark is certain to be found.
CERTAIN = GRAM + WINDOW - 1
#: Pieces of eight keep long runs and scripts without blanks comparable.
UNIT = r"[\p{L}\p{M}\p{N}]{1,8}|[^ \t\n\x0B\f\r]"
#: A hash and its place in one number: bits 27 to 62 of the hash, then the place counted from the end.
_PLACES = (1 << 27) - 1
_HASH = (1 << 63) - 1 - _PLACES
_MARKS = "array<bigint>"


def _none() -> Column:
    return F.array().cast(_MARKS)


def _codes(text: Column) -> Column:
    """A number for each unit."""
    return F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda c: F.xxhash64(c))


def _grown(values: Column, size: int, times: int, join: Callable[[int], Callable[[Column, Column, Column], Column]]) -> Column:
    """``values`` of single places joined, ``times`` at a time, to values of ``size`` neighbouring places."""
    def step(width: int) -> Callable[[Column], Column]:
        def wider(x: Column) -> Column:
            made = F.transform(x, lambda v, i: join(width)(x, v, i))
            return made if times * width == size else let(made, step(times * width))
        return wider

    return let(values, step(1))


def _gram_hashes(codes: Column) -> Column:
    """Null where no whole gram follows."""
    return _grown(codes, GRAM, 2, lambda width: lambda x, v, i: F.shiftleft(v, width).bitwiseXOR(F.get(x, i + width)))


def _ranked(hashes: Column) -> Column:
    """Hash and place in one number: of equal hashes the rightmost is the least."""
    return F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(_HASH)).bitwiseOR((F.lit(_PLACES) - i).cast("long")))


def _mark(ranked: Column) -> Column:
    """A mark: 31 bits of the hash above bit 32, the position below."""
    place = F.lit(_PLACES).cast("long") - ranked.bitwiseAND(F.lit(_PLACES).cast("long"))
    return ranked.bitwiseAND(F.lit((1 << 63) - (1 << 32))).bitwiseOR(place)


def _window_minima(ranked: Column) -> Column:
    return _grown(ranked, WINDOW, 4, lambda width: lambda x, v, i: F.least(
        v, F.get(x, i + width), F.get(x, i + 2 * width), F.get(x, i + 3 * width)
    ))


def marks(text: Column) -> Column:
    """A text's marks in order of position, as numbers: hash * 2 ** 32 + position. A null text is an empty one.

    A text of fewer than CERTAIN units has one mark, its least gram; one of fewer than GRAM units that of them all; one
    without any has none.
    """
    def made(codes: Column) -> Column:
        whole = F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: F.shiftleft(h, 1).bitwiseXOR(c))
        ranked = _ranked(_gram_hashes(codes))
        least = F.slice(_window_minima(ranked), F.lit(1), F.size(codes) - (CERTAIN - 1))
        return F.when(F.size(codes) == 0, _none()).when(
            F.size(codes) < GRAM, F.array(whole.bitwiseAND(F.lit((1 << 63) - (1 << 32))))
        ).when(F.size(codes) < CERTAIN, F.array(_mark(F.array_min(ranked)))).otherwise(
            F.transform(F.array_distinct(least), _mark)
        )

    return let(_codes(F.coalesce(text, F.lit(""))), made)


def hashes(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda m: F.shiftright(m, 32)))


def likeness(one: Column, two: Column) -> Column:
    """Shared hashes over all hashes of two arrays of marks; two empty fingerprints are equal."""
    return let(F.struct(hashes(one).alias("a"), hashes(two).alias("b")), lambda p: F.when(
        F.size(p["a"]) + F.size(p["b"]) == 0, F.lit(1.0)
    ).otherwise(F.size(F.array_intersect(p["a"], p["b"])) / F.size(F.array_union(p["a"], p["b"]))))


def written(found: Column) -> Column:
    """Marks as ``hash:position``, comma-joined; hashes in hexadecimal."""
    return F.array_join(F.transform(found, lambda m: F.concat(
        F.lower(F.hex(F.shiftright(m, 32))), F.lit(":"), m.bitwiseAND(F.lit(2**32 - 1).cast("long")).cast("string")
    )), ",")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars and ``marks`` of the whole text (null: empty). Other columns are not read."""
    text = F.coalesce(q("text"), F.lit(""))
    return docs.select(q("doc_id").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), marks(text).alias("marks"))


def compared(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A text is compared with an edited copy, whose last quarter is replaced by as many first code points of the next
    document's text, and with that text. The next document is the one that follows by doc_id (null last; equal ids by a hash of
    the text; the first follows the last; of rows that are alike each but one is followed by its like). A null text is an empty one; empty
    texts have an empty fingerprint. An empty table gives no rows.

    Texts travel once, to their key, with their marks; the next text's part travels again.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(q("doc_id").alias("doc_id"), q("text").alias("text")).select("doc_id", text.alias("text")).withColumn(
        "key", F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), "text").cast("binary"), 256))
    )
    keys = own.select("doc_id", "key", F.length("text").cast("long").alias("n")).groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies")
    )
    placed = scratch.keep(with_row_index(keys, ["doc_id", "key"], "row"), "order")
    rows = placed.count()
    before = F.when(F.col("row") == 0, F.lit(rows - 1)).otherwise(F.col("row") - 1)
    following = placed.select(before.alias("row"), F.col("key").alias("next_key"))
    order = scratch.keep(placed.join(following, "row").select("key", "doc_id", "n", "copies", "next_key"), "next")

    # Both uses of the texts and marks, as the own ones and as the next one's, read one exchange by key; all other joins are by
    # key too. So marks are made once, on the way to it, and kept nowhere else.
    texts = own.select("key", "text", marks(F.col("text")).alias("marks")).dropDuplicates(["key"])
    part = F.expr("left(text, int(n div 4))")
    nexts = order.select("next_key", F.col("key").alias("for_key"), "n").join(texts, F.col("next_key") == F.col("key")).select(
        "for_key", part.alias("part"), hashes(F.col("marks")).cast("array<int>").alias("next_hashes")
    )
    joined = order.join(texts, "key").join(nexts, F.col("key") == F.col("for_key"))
    # Of rows that are alike one is followed by the next document, the others by their like.
    cases = F.filter(F.array(
        F.struct("part", "next_hashes", F.lit(1).cast("long").alias("times")),
        F.struct(part.alias("part"), hashes(F.col("marks")).cast("array<int>").alias("next_hashes"), (F.col("copies") - 1).alias("times")),
    ), lambda c: c["times"] > 0)
    all_ = joined.select("doc_id", "n", "text", "marks", F.inline(cases))
    edited = F.concat(F.expr("left(text, int(n - n div 4))"), "part")
    seen = all_.select(
        "doc_id", "n", "times", "next_hashes", "marks", F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        marks(edited).alias("edited_marks"),
    )
    return seen.select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256", written(F.col("marks")).alias("fingerprint"),
        written(F.col("edited_marks")).alias("edited_fingerprint"), likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        let(hashes(F.col("marks")).cast("array<int>"), lambda a: F.when(F.size(a) + F.size("next_hashes") == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(a, "next_hashes")) / F.size(F.array_union(a, "next_hashes"))
        )).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("time"),
    ).drop("time")
