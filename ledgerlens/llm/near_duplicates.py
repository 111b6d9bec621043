"""Near-duplicate documents by b-bit MinHash, confirmed on whole shingle sets.

1. One pass over the texts gives each document its set's size and 128-bit digest, band keys,
   and the low bits of its 128 minima, packed into eight 64-bit numbers. Documents with equal sets
   become one class before anything is compared, so exact copies cost nothing further.
2. Band keys shared by several classes are candidate buckets. In each bucket the class with the
   most bucket mates (the likely original) is the hub; the others are compared with it only.
3. Links to hubs join most of a bucket into one component. While a bucket holds several, members outside
   its largest become hubs in turn, as long as that links anything. What is apart then is compared pair by
   pair, if its sets can have enough in common and the collision-corrected similarity estimated from the packed bits
   is not clearly below the threshold. Pairs whose ends are already connected cannot change a component and are never built.
4. Every candidate is confirmed on whole sets; components of confirmed links are the result.

A pair at similarity 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6, and is
discarded by an estimate (MARGIN and FINE_MARGIN are more than four standard deviations) with about 1e-5.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.frames import by_text, fresh, q
from ledgerlens.llm.words import BLANK, mix, split, windows
from ledgerlens.storage import Scratch

SHINGLE = 5
PERMUTATIONS = 128
BITS = 4
ROWS = 4
BANDS = PERMUTATIONS // ROWS
MARGIN = 0.17
#: Ids (some 30 bytes each in memory) that may be sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

#: Permutations and margin of the finer signatures of classes in buckets that hold several components.
FINE = 512
FINE_MARGIN = 0.09
#: Turns of further hubs before what is still apart is compared pair by pair.
HUB_TURNS = 6

_RNG = np.random.Generator(np.random.PCG64(11))
_FACTORS = _RNG.integers(0, 2**31, FINE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _RNG.integers(0, 2**32, FINE, dtype=np.uint32)
_ROWS_AT_ONCE = 1024


def shingle_sets(texts: Sequence[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size`` consecutive words (A-Z lower-cased).

    A text of fewer words has its whole word sequence as one shingle; none without words.
    """
    words = split(texts, BLANK)
    runs = windows(words.hashes, size)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        elif b > a:
            out.append(windows(words.hashes[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minima(hashes: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """The smallest value of each of the permutations over one set."""
    low = np.full(permutations, 0xFFFFFFFF, np.uint32)
    factors, terms = _FACTORS[:permutations], _TERMS[:permutations]
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), _ROWS_AT_ONCE):
        part = values[at:at + _ROWS_AT_ONCE, None] * factors
        part += terms
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(low, part.min(axis=0), out=low)
    return low


def _packed(low: np.ndarray) -> np.ndarray:
    """The low BITS of each minimum, several to a 64-bit number."""
    per = 64 // BITS
    bits = ((low >> np.uint32(3)) & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, per)
    return np.bitwise_or.reduce(bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def _bands(low: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for row in low.reshape(BANDS, ROWS).T:
        key = key * np.uint64(0x9E3779B97F4A7C15) + row
    return mix(key)


def _signatures(texts: Sequence[str | None]) -> pd.DataFrame:
    rows = []
    for hashes in shingle_sets(texts):
        if not len(hashes):
            rows.append((0, None, None, None))
            continue
        low = minima(hashes)
        rows.append((len(hashes), _digest(hashes), _packed(low).astype(np.int64), _bands(low).astype(np.int64)))
    return pd.DataFrame(rows, columns=["n", "digest", "packed", "bands"])


def _digest(hashes: np.ndarray) -> bytes:
    """Two sums of differently mixed members, and the set's size."""
    one, two = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(), mix(hashes + np.uint64(0x5851F42D4C957F2D)).sum()
    return np.array([one, two], np.uint64).tobytes() + len(hashes).to_bytes(4, "little")


def _sets(texts: Sequence[str | None]) -> pd.DataFrame:
    found = shingle_sets(texts)
    return pd.DataFrame({"digest": [_digest(h) for h in found], "hashes": [h.astype(np.int64) for h in found]})


def _fine(sets: pd.Series) -> pd.Series:
    return pd.Series([_packed(minima(np.asarray(h, np.int64).view(np.uint64), FINE)).astype(np.int64) for h in sets])


def estimate(a: str, b: str, permutations: int = PERMUTATIONS) -> Column:
    """Similarity estimated from two packed signatures: the share of equal low-bit groups, less
    the share that agrees by chance (2**-BITS), rescaled."""
    low = F.lit(0x1111111111111111)
    apart = F.lit(0)
    for k in range(permutations * BITS // 64):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        apart = apart + F.bit_count(x.bitwiseAND(low))
    chance = 2.0 ** -BITS
    return ((1 - apart / F.lit(float(permutations))) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    # The sizes bound the similarity; most failing pairs need no look at the sets.
    return (
        pairs.join(left, "a").join(right, "b")
        .filter(100 * F.least(F.size("ha"), F.size("hb")) >= percent * F.greatest(F.size("ha"), F.size("hb")))
        .withColumn("both", both)
        .filter(100 * F.col("both") >= percent * (F.size("ha") + F.size("hb") - F.col("both")))
        .select("a", "b")
    )


def _sets_of(base: DataFrame, likely: DataFrame) -> DataFrame:
    """(id, hashes): the whole set of each class, from the text of its smallest id."""
    ids = likely.select("smallest").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = base.join(ids, F.col("doc_id").eqNullSafe(F.col("smallest")), "left_semi")
    again = by_text(_sets, "digest binary, hashes array<long>")
    made = texts.select(again("text").alias("s")).select("s.*")
    return made.join(likely.select("id", "digest"), "digest").dropDuplicates(["id"]).select("id", "hashes")


def _rooted(members: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``members`` with the root of each id's component."""
    label = components(links, scratch)
    return members.join(label, members["id"] == label["node"], "left").select(members["*"], F.coalesce("root", "id").alias("root"))


def _open(rooted: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with the root of the bucket's largest one as ``main``."""
    size = rooted.groupBy("key", "root").agg(F.count("*").alias("size"))
    main = size.groupBy("key").agg(F.max(F.struct("size", "root")).alias("m"), F.count("*").alias("roots")).filter("roots > 1")
    return rooted.join(main.select("key", F.col("m.root").alias("main")), "key")


def _could_link(percent: int) -> Column:
    """Whether rows a and b, of different components, can reach the threshold by what they share with others at most, and
    do so by their finer signatures."""
    return (
        (F.col("root_a") != F.col("root_b"))
        & ((100 + percent) * F.least("common_a", "common_b") >= percent * (F.col("n_a") + F.col("n_b")))
        & (estimate("packed_a", "packed_b", FINE) >= percent / 100 - FINE_MARGIN)
    )


def _ends(rows: DataFrame, end: str, *more: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{c}_{end}") for c in ("id", "root", "n", "common", "packed", *more)], "key")


def _pair() -> list[Column]:
    return [F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")]


def _across(members: DataFrame, links: DataFrame, tried: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``links`` and all others between members of a bucket that no path of links connects yet.

    What two sets have in common is at most what either shares with any set still open here. That bound rules out
    most of a group whose members differ in too many places of their own, before any pair is built. Then members
    outside a bucket's largest component become its hubs in turn, as long as that links anything: each turn compares a
    bucket's members with one of them. Only what is apart after that is compared pair by pair, each pair in the first
    bucket that it shares.
    """
    opened = scratch.keep(_open(_rooted(members.select("key", "id"), links, scratch)), "open")
    shingles = sets.join(opened.select("id").distinct(), "id", "left_semi").select("id", F.explode("hashes").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low != high")
    sizes = shingles.join(common, "shingle", "left_semi").groupBy("id").agg(F.count("*").alias("common"))
    sizes = scratch.keep(
        sizes.join(sets, "id").withColumn("n", F.size("hashes")).filter(100 * F.col("common") >= percent * F.col("n"))
        .select("id", "n", "common", F.pandas_udf(_fine, "array<long>")("hashes").alias("packed")), "open-sizes",
    )
    able = opened.select("key", "id").join(sizes.select("id"), "id", "left_semi")
    # An id is in as many buckets as it has bands at most.
    keys = able.groupBy("id").agg(F.collect_set("key").alias("keys"))
    rows = scratch.keep(able.join(sizes, "id").join(keys, "id"), "open-rows")
    scratch.drop("open", "open-sizes")

    for turn in range(HUB_TURNS):
        here = _open(_rooted(rows.drop("keys"), links, scratch))
        next_hub = F.max_by(F.struct("id", "root", "n", "common", "packed"), F.xxhash64(F.lit(turn), "id"))
        hubs = here.filter("root != main").groupBy("key").agg(next_hub.alias("h")).select("key", "h.*")
        to_hubs = _ends(here, "a").join(_ends(hubs, "b"), "key").filter(_could_link(percent)).select(*_pair()).distinct()
        to_hubs = scratch.keep(to_hubs.join(tried, ["a", "b"], "left_anti"), f"to-hubs-{turn}")
        more = scratch.keep(_confirmed(to_hubs, sets, percent), f"links-{turn}")
        tried = tried.unionByName(to_hubs)
        if more.isEmpty():
            break
        links = links.unionByName(more)

    here = scratch.keep(_open(_rooted(rows, links, scratch)), "apart")
    x = _ends(here.filter("root != main"), "a", "keys", "main")
    y = _ends(here, "b", "keys").withColumnRenamed("key", "key_b")
    once = (F.col("root_b") == F.col("main_a")) | (F.col("id_a") < F.col("id_b"))
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    pairs = x.join(y, (F.col("key") == F.col("key_b")) & once & _could_link(percent) & first).select(*_pair())
    return links.unionByName(_confirmed(pairs.join(tried, ["a", "b"], "left_anti"), sets, percent))


def near_duplicates(
    docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and text_key (a hash of the text).

    ``component_id`` is the smallest id reachable by links of at least ``percent`` similarity, itself
    included. Null, empty and blank texts have no shingles and are linked with nothing. A null id
    takes part in links; its component is that of its smallest other member (null without one) and
    it is kept only then. Repeated ids with texts of different components keep a row each; a repeated
    row has the same result each time. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    make = by_text(_signatures, "n long, digest binary, packed array<long>, bands array<long>")
    base = docs.select(q(id_column).alias("doc_id"), q(text_column).alias("text"))
    signed = scratch.keep(
        base.select("doc_id", F.xxhash64("text").alias("text_key"), make("text").alias("s")).select("doc_id", "text_key", "s.*"),
        "signatures",
    )

    classes = scratch.keep(
        signed.filter("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("smallest"), F.first("n").alias("n"), F.first("packed").alias("packed"), F.first("bands").alias("bands")
        ).withColumn("id", F.monotonically_increasing_id()), "classes",
    )
    rows = classes.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("mates")).filter("mates > 1")
    members = scratch.keep(rows.join(shared, "key"), "buckets")
    degree = members.groupBy("id").agg(F.sum("mates").alias("degree"))
    likely = scratch.keep(classes.join(degree, "id").select("id", "digest", "smallest", "n", "packed", "degree"), "likely")
    sets = scratch.keep(_sets_of(base, likely), "sets")

    hubs = (
        members.join(likely.select("id", "degree"), "id").groupBy("key").agg(F.max(F.struct("degree", "id")).alias("hub"))
        .select("key", F.col("hub.id").alias("hub"))
    )
    to_hubs = members.join(hubs, "key").filter("id != hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    ).distinct()
    floor = percent / 100 - MARGIN
    left = likely.select(F.col("id").alias("a"), F.col("packed").alias("pa"))
    right = likely.select(F.col("id").alias("b"), F.col("packed").alias("pb"))
    tried = scratch.keep(to_hubs.join(left, "a").join(right, "b").filter(estimate("pa", "pb") >= floor).select("a", "b"), "to-hubs")
    links = scratch.keep(_confirmed(tried, sets, percent), "links")
    links = scratch.keep(_across(members, links, tried, sets, percent, scratch), "all-links")

    label = components(links, scratch)
    placed = classes.select("digest", "id", "smallest").join(label, classes["id"] == label["node"], "left").select(
        "digest", "smallest", F.coalesce("root", "id").alias("root")
    )
    component = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    by_class = scratch.keep(placed.join(component, "root").select("digest", "component_id"), "by-class")
    scratch.drop("classes", "buckets", "likely", "sets", "to-hubs", "links", "all-links")
    return signed.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "digest").join(by_class, "digest", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key"
    )


def one_of_each(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, columns as they were.

    Repeated rows of a kept id and text stay, as they are one document.
    """
    found = near_duplicates(docs, percent, id_column, text_column)
    gone_id, gone_key = fresh(docs, "dropped_id"), fresh(docs, "dropped_key")
    dropped = found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct()
    same = q(id_column).eqNullSafe(F.col(gone_id)) & (F.xxhash64(q(text_column)) == F.col(gone_key))
    # Dropped documents are a share of all documents, so this join is a shuffle at every size.
    return docs.join(dropped.hint("merge"), same, "left_anti")
