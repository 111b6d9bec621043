"""Hashed word pairs as Spark tables, and interpolated modified Kneser-Ney costs joined to documents.

Tasks count their own rows' pairs before anything is shuffled. A document's pairs are not one row each: tasks pack
those of many documents by shard, a pair that several of them have once, and a shard's costs are looked up for
all of them at a time. Nothing is bounded: tables and shards grow with the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import ship
from ledgerlens.llm.ngrams import _discounts
from ledgerlens.llm.words import chunks, mix, tokens

#: What stands before a text's first token.
BEFORE = np.uint64(1)
#: What stands before a token where a cost belongs to the token alone: as the second of a pair, and as the first of one.
ALONE, LEFT = 2, 3
#: Tokens that a task counts before it hands on, characters and texts that it packs together, and pairs of a shard.
COUNT_TOKENS = 1 << 21
PACK_CHARS = 1 << 22
PACK_TEXTS = 1 << 16
SHARD_PAIRS = 1 << 20


def pairs(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token before and the token itself, of each token, and each text's first token (one more entry at the end)."""
    now, first = tokens(texts)
    prior = np.append(BEFORE, now[:-1])[:len(now)]
    prior[first[:-1][np.diff(first) > 0]] = BEFORE
    return prior, now, first


def key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One hash of each pair."""
    return mix(v * np.uint64(0x9FB21C651E98DF25) + w)


def counts(docs: DataFrame) -> DataFrame:
    """(v, w, n_0, n_1): how often each pair occurs in ``text``, and in those rows where ``chosen`` is true."""
    ship(docs.sparkSession)

    def summed(parts: list[tuple]) -> pd.DataFrame:
        v, w, chosen = (np.concatenate(x) for x in zip(*parts))
        code = key(v, w)
        order = np.argsort(code)
        starts = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
        at = order[starts]
        return pd.DataFrame({
            "v": v[at].view(np.int64), "w": w[at].view(np.int64), "n_0": np.diff(np.append(starts, len(code))),
            "n_1": np.add.reduceat(chosen[order].astype(np.int64), starts),
        })

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            texts, chosen = batch["text"].tolist(), batch["chosen"].to_numpy(bool)
            for a, b in chunks(texts):
                v, w, first = pairs(texts[a:b])
                if len(v):
                    parts.append((v, w, np.repeat(chosen[a:b], np.diff(first))))
                    held += len(v)
                if held >= COUNT_TOKENS:
                    yield summed(parts)
                    parts, held = [], 0
        if parts:
            yield summed(parts)

    found = docs.select("text", "chosen").mapInPandas(count, "v long, w long, n_0 long, n_1 long")
    return found.groupBy("v", "w").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))


def _off(n: Column, discounts: list[float]) -> Column:
    one, two, more = map(F.lit, discounts)
    return F.when(n <= 0, 0.0).when(n == 1, one).when(n == 2, two).otherwise(more)


def costs(counted: DataFrame, scratch) -> DataFrame:
    """(v, w, bits_0, bits_1): bits of w after v under the model of all rows and that of the chosen ones.

    ``counted``: a stored table of ``counts``. Both models share the vocabulary of all rows; one without rows is uniform.
    """
    names = ("0", "1")
    by_pair = {m: _discounts(counted.select(F.col(f"n_{m}").alias("n")).filter("n > 0")) for m in names}
    followed = scratch.keep(
        counted.groupBy("w").agg(*[F.count_if(F.col(f"n_{m}") > 0).alias(f"k_{m}") for m in names]), "followed"
    )
    by_word = {m: _discounts(followed.select(F.col(f"k_{m}").alias("n")).filter("n > 0")) for m in names}
    whole = followed.agg(
        F.count("*").alias("words"), *[F.sum(f"k_{m}").alias(f"k_{m}") for m in names],
        *[F.sum(_off(F.col(f"k_{m}"), by_word[m])).alias(f"off_{m}") for m in names],
    ).first()
    words = max(1, whole["words"] or 0)

    def lowest(m: str) -> Column:
        total, k = whole[f"k_{m}"], F.col(f"k_{m}")
        return (k - _off(k, by_word[m])) / total + whole[f"off_{m}"] / total / words if total else F.lit(1.0 / words)

    before = counted.groupBy("v").agg(
        *[F.sum(f"n_{m}").alias(f"t_{m}") for m in names], *[F.sum(_off(F.col(f"n_{m}"), by_pair[m])).alias(f"r_{m}") for m in names]
    )

    def chance(m: str) -> Column:
        n, total = F.col(f"n_{m}"), F.col(f"t_{m}")
        seen = (n - _off(n, by_pair[m]) + F.col(f"r_{m}") * F.col(f"p_{m}")) / total
        return F.when(total > 0, seen).otherwise(F.col(f"p_{m}"))

    after = followed.select("w", *[lowest(m).alias(f"p_{m}") for m in names])
    joined = counted.join(before, "v").join(after, "w")
    return joined.select("v", "w", *[(-F.log2(chance(m))).cast("float").alias(f"bits_{m}") for m in names])


def open_costs(counted: DataFrame, scratch) -> tuple[DataFrame, list[float]]:
    """Costs for texts that no model has counted: (v, w, bits_0, bits_1), and what a token costs at first under each model.

    ``counted``: a stored table of ``counts``. Model 0 is that of the rows not chosen, model 1 that of the chosen ones; without
    pairs in one of them both are of all rows, without any a token costs one bit. The vocabulary is a model's words and one
    more, any other word. A text's bits are the first cost of each token, the row (ALONE, w) of each token, the row (LEFT, v)
    of each token's prior and the row of each pair; what has no row adds nothing. So an unseen pair costs what its
    first word leaves to such pairs, times its second word's share, without a row of its own.
    """
    names = ("0", "1")
    n_all, n_one = F.col("n_0"), F.col("n_1")
    has = counted.agg(F.count_if(n_all > n_one).alias("0"), F.count_if(n_one > 0).alias("1")).first()
    each = {"0": n_all - n_one, "1": n_one} if has["0"] and has["1"] else {"0": n_all, "1": n_all}
    split = counted.select("v", "w", *[n.alias(f"m_{m}") for m, n in each.items()])
    if not has["0"] and not has["1"]:
        return split.select("v", "w", *[F.lit(0.0).alias(f"bits_{m}") for m in names]).limit(0), [1.0, 1.0]
    by_pair = {m: _discounts(split.select(F.col(f"m_{m}").alias("n")).filter("n > 0")) for m in names}
    after = scratch.keep(split.groupBy("w").agg(*[F.count_if(F.col(f"m_{m}") > 0).alias(f"k_{m}") for m in names]), "after")
    by_word = {m: _discounts(after.select(F.col(f"k_{m}").alias("n")).filter("n > 0")) for m in names}
    whole = after.agg(
        *[F.sum(f"k_{m}").alias(f"k_{m}") for m in names], *[F.count_if(F.col(f"k_{m}") > 0).alias(f"words_{m}") for m in names],
        *[F.sum(_off(F.col(f"k_{m}"), by_word[m])).alias(f"off_{m}") for m in names],
    ).first()
    other = {m: whole[f"off_{m}"] / whole[f"k_{m}"] / (whole[f"words_{m}"] + 1) for m in names}

    def alone(m: str) -> Column:
        return (F.col(f"k_{m}") - _off(F.col(f"k_{m}"), by_word[m])) / whole[f"k_{m}"] + F.lit(other[m])

    before = scratch.keep(split.groupBy("v").agg(
        *[F.sum(f"m_{m}").alias(f"t_{m}") for m in names], *[F.sum(_off(F.col(f"m_{m}"), by_pair[m])).alias(f"r_{m}") for m in names]
    ), "before")

    def left(m: str) -> Column:
        return F.when(F.col(f"t_{m}") > 0, F.col(f"r_{m}") / F.col(f"t_{m}")).otherwise(1.0)

    def gain(m: str) -> Column:
        n, rest, one = F.col(f"m_{m}"), left(m), F.col(f"p_{m}")
        seen = (n - _off(n, by_pair[m])) / F.col(f"t_{m}") + rest * one
        return F.when(n > 0, F.log2(rest * one) - F.log2(seen)).otherwise(0.0)

    joined = split.join(before, "v").join(after.select("w", *[alone(m).alias(f"p_{m}") for m in names]), "w")
    rows = joined.select("v", "w", *[gain(m).alias(f"bits_{m}") for m in names]).unionByName(
        after.select(F.lit(ALONE).cast("long").alias("v"), "w", *[(F.log2(F.lit(other[m])) - F.log2(alone(m))).alias(f"bits_{m}") for m in names])
    ).unionByName(
        before.select(F.lit(LEFT).cast("long").alias("v"), F.col("v").alias("w"), *[(-F.log2(left(m))).alias(f"bits_{m}") for m in names])
    )
    return rows, [-math.log2(other[m]) for m in names]


def _narrow(x: np.ndarray) -> bytes:
    """Small counts as single bytes, since most are."""
    return x.astype(np.uint8 if not len(x) or x.max() < 256 else np.uint32).tobytes()


def _wide(held: bytes, count: int) -> np.ndarray:
    return np.frombuffer(held, np.uint8 if len(held) == count else np.uint32)


def _packed(docs: DataFrame, shards: int, alone: bool = False) -> DataFrame:
    """Rows (shard, chunk, codes, times, texts, n, ids): the pairs of a chunk of texts that a shard has, how many texts have
    each, which, and how often; ``ids``, the texts' keys, in one of the chunk's rows. ``alone`` adds a pair (ALONE, w) for each
    token and a pair (LEFT, v) for each token's prior."""

    def pack(texts: list[str], ids: np.ndarray) -> pd.DataFrame:
        v, w, first = pairs(texts)
        # The chunk's name comes from what it holds, so that a repeated task gives the same.
        chunk = zlib.crc32(ids.tobytes()) << 31 ^ int(ids[0, 0]) & (1 << 62) - 1
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        if alone:
            marks = [np.full(len(v), m, np.uint64) for m in (ALONE, LEFT)]
            v, w, text = np.concatenate([v, *marks]), np.concatenate([w, w, v]), np.tile(text, 3)
        code = key(v, w)
        shard = (v ^ (w << np.uint64(1))).view(np.int64) % shards
        order = np.lexsort((text, code, shard))
        code, text, shard = code[order], text[order], shard[order]
        new_code = np.append(True, (np.diff(code) != 0) | (np.diff(shard) != 0))
        entry = np.flatnonzero(new_code | np.append(True, np.diff(text) != 0))
        n = np.diff(np.append(entry, len(code))).astype(np.uint32)
        own = np.flatnonzero(new_code[entry])
        times = np.diff(np.append(own, len(entry))).astype(np.uint32)
        code, shard = code[entry[own]], shard[entry[own]]
        text = text[entry].astype(np.uint16)
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(shard) != 0)), len(code))
        edge = np.append(own, len(entry))[cuts]
        rows = [
            (shard[a], chunk, code[a:b].tobytes(), _narrow(times[a:b]), text[x:y].tobytes(), _narrow(n[x:y]), b"" if a else ids.tobytes())
            for a, b, x, y in zip(cuts[:-1], cuts[1:], edge[:-1], edge[1:])
        ]
        return pd.DataFrame(rows, columns=["shard", "chunk", "codes", "times", "texts", "n", "ids"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, ids, held = [], [], 0
        for batch in batches:
            for text, a, b in zip(batch["text"], batch["a"], batch["b"]):
                texts.append(text)
                ids.append((a, b))
                held += len(text)
                if held >= PACK_CHARS or len(texts) >= PACK_TEXTS:
                    yield pack(texts, np.array(ids, np.int64))
                    texts, ids, held = [], [], 0
        if texts:
            yield pack(texts, np.array(ids, np.int64))

    return docs.mapInPandas(run, "shard long, chunk long, codes binary, times binary, texts binary, n binary, ids binary")


def text_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("text"))


def scores(docs: DataFrame, cost: DataFrame, pair_count: int, first_bits: Sequence[float] | None = None) -> DataFrame:
    """(a, b, n_tokens, bits_0, bits_1) for each different text with tokens; ``a``, ``b``: its ``text_key`` of 1 and of 2.

    ``cost`` has every pair of ``docs``; or it and ``first_bits`` come from ``open_costs``.
    """
    spark = docs.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + pair_count // SHARD_PAIRS)
    asked = _packed(docs.filter(F.col("text").rlike(r"[^ \t-\r]")).select("text", text_key(1).alias("a"), text_key(2).alias("b")), shards, first_bits is not None)
    given = cost.withColumn("shard", F.pmod(F.col("v").bitwiseXOR(F.shiftleft("w", 1)), F.lit(shards).cast("long")))

    def look_up(one: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        code = key(one["v"].to_numpy().view(np.uint64), one["w"].to_numpy().view(np.uint64))
        order = np.argsort(code)
        code, bits = code[order], np.append(one[["bits_0", "bits_1"]].to_numpy(float)[order], [[0.0, 0.0]], axis=0)
        out = []
        for cell in cells.itertuples(index=False):
            wanted = np.frombuffer(cell.codes, np.uint64)
            at = np.minimum(np.searchsorted(code, wanted), max(0, len(code) - 1))
            found = code[at] == wanted if len(code) else np.zeros(len(wanted), bool)
            if first_bits is None and not found.all():
                raise RuntimeError("the documents changed while they were read")
            # Behind the last row stands one that costs nothing.
            at = np.repeat(np.where(found, at, len(code)), _wide(cell.times, len(wanted)))
            text = np.frombuffer(cell.texts, np.uint16)
            n = _wide(cell.n, len(text)).astype(np.int64)
            total = np.bincount(text, n)
            has = np.flatnonzero(total)
            sums = np.stack([total, *(np.bincount(text, n * bits[at, k]) for k in (0, 1))])[:, has]
            out.append((cell.chunk, has.astype(np.uint16).tobytes(), sums.astype(np.float32).tobytes(), cell.ids))
        return pd.DataFrame(out, columns=["chunk", "texts", "sums", "ids"])

    def add(cells: pd.DataFrame) -> pd.DataFrame:
        # Equal chunks have one name: every one of them brings its ids and its sums, so the mean is taken.
        ids = [x for x in cells["ids"] if len(x)]
        keys = np.frombuffer(ids[0], np.int64).reshape(-1, 2)
        total = np.zeros((3, len(keys)))
        for cell in cells.itertuples(index=False):
            has = np.frombuffer(cell.texts, np.uint16)
            total[:, has] += np.frombuffer(cell.sums, np.float32).reshape(3, -1)
        total /= len(ids)
        if first_bits is not None:
            # Each token came three times: with its prior, alone, and as the next one's prior.
            total[0] /= 3
            total[1:] += np.outer(first_bits, total[0])
        return pd.DataFrame({"a": keys[:, 0], "b": keys[:, 1], "n_tokens": np.rint(total[0]).astype(np.int64), "bits_0": total[1], "bits_1": total[2]})

    found = given.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(look_up, "chunk long, texts binary, sums binary, ids binary")
    every = found.groupBy("chunk").applyInPandas(add, "a long, b long, n_tokens long, bits_0 double, bits_1 double")
    # Copies of a text have one score.
    return every.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("n_tokens", "bits_0", "bits_1")])
