"""Texts scored under two Kneser-Ney models of word pairs, without a table of pairs.

Pairs are handled in slices, by a hash of their first word; a slice's shuffle files go before the next slice is read. Tasks
pack the pairs of many texts by shard. A first round counts the pairs of the rows that teach and keeps what is
summed per word: as the first of pairs, and as the second. A second round moves the pairs of all rows, finds each pair's
counts again among them, meets the words' sums and returns sums per text. Nothing is bounded or left out: the words'
table and the shards grow with the input, and slices only decide how much of it is moved at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import ship
from ledgerlens.llm.ngrams import discounts
from ledgerlens.llm.words import chunks
from ledgerlens.llm.word_pairs import PACK_CHARS, PACK_TEXTS, _narrow, _off, _wide, key, pairs, text_key
from ledgerlens.storage import Scratch

#: Characters of the texts whose pairs make one shard, about.
SHARD_CHARS = 3 << 21
NAMES = ("0", "1")
#: What is summed of each word and model: occurrences as a first word; pairs it begins that occur once, twice, more
#: often; pairs that end with it.
SUMS = [f"{c}_{m}" for m in NAMES for c in ("t", "one", "two", "more", "k")]
CELLS = "shard long, chunk long, v binary, runs binary, w binary, times binary, texts binary, n binary, one int, two int, asks boolean, ids binary"


@dataclass(frozen=True)
class Grid:
    """Shards by first and second word; a slice has every ``slices``-th row of ``rows``, and all ``columns``."""

    slices: int
    rows: int
    columns: int

    @classmethod
    def of(cls, docs: DataFrame, slices: int) -> Grid:
        chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + chars // (SHARD_CHARS * slices))
        # A word goes to every column of one row in one slice, and to every row of one column in each slice.
        rows = max(1, round(math.sqrt(shards / slices)))
        return cls(slices, slices * rows, math.ceil(shards / rows))

    def shard(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return v.view(np.int64) % self.rows // self.slices * self.columns + w.view(np.int64) % self.columns

    def holders(self, part: int, word: Column, first: Column, second: Column) -> Column:
        """The shards of a slice that have pairs which begin (if ``first``) or end (if ``second``) with a word."""
        row, column = (F.pmod(word, F.lit(n).cast("long")) for n in (self.rows, self.columns))
        none = F.array().cast("array<bigint>")
        along = F.sequence(F.lit(0), F.lit(self.columns - 1))
        down = F.sequence(F.lit(0), F.lit(self.rows // self.slices - 1))
        begins = F.transform(along, lambda j: F.floor(row / self.slices) * self.columns + j)
        ends = F.transform(down, lambda i: i * self.columns + column)
        return F.array_distinct(F.concat(
            F.when(first & (row % self.slices == part), begins).otherwise(none), F.when(second, ends).otherwise(none)
        ))


def _cells(docs: DataFrame, grid: Grid, part: int, asks: bool = True) -> DataFrame:
    """Rows of ``CELLS``: the pairs of a chunk of texts that a shard has, by first word, how many texts have each, which, and
    how often. A chunk's texts stand in order of ``part``; those of 1 begin at ``one``, those of 2 at ``two``. ``asks``: whether
    they are to be scored; if not, all texts of a part stand as one text. ``ids``, the texts' keys, are in one of the chunk's rows."""
    ship(docs.sparkSession)

    def pack(texts: list[str], ids: list[tuple[int, int]], parts: list[int]) -> pd.DataFrame:
        turn = sorted(range(len(texts)), key=parts.__getitem__)
        one, two = np.searchsorted(sorted(parts), [1, 2]) if asks else (1, 2)
        keys = np.array(ids, np.int64)[turn]
        ordered = [texts[i] for i in turn]
        # Pieces small enough to stay in the processor's cache.
        pieces = [(a, *pairs(ordered[a:b])) for a, b in chunks(ordered)]
        v, w = (np.concatenate([p[i] for p in pieces]) for i in (1, 2))
        named = np.arange(len(texts), dtype=np.uint16) if asks else np.array(parts, np.uint16)[turn]
        text = np.concatenate([np.repeat(named[a:a + len(first) - 1], np.diff(first)) for a, _, _, first in pieces])
        # The chunk's name comes from what it holds, so that a repeated task gives the same.
        chunk = zlib.crc32(keys.tobytes()) << 31 ^ int(keys[0, 0]) & (1 << 62) - 1
        if grid.slices > 1:
            own = np.flatnonzero(v.view(np.int64) % grid.slices == part)
            v, w, text = v[own], w[own], text[own]
        shard = grid.shard(v, w).astype(np.int16 if grid.rows * grid.columns < 1 << 15 else np.int32)
        order = np.lexsort((w, v, shard))
        v, w, text, shard = v[order], w[order], text[order], shard[order]
        new_shard = np.append(True, np.diff(shard) != 0)[:len(v)]
        new_v = new_shard | np.append(True, np.diff(v) != 0)[:len(v)]
        new_pair = new_v | np.append(True, np.diff(w) != 0)[:len(v)]
        entry = np.flatnonzero(new_pair | np.append(True, np.diff(text) != 0)[:len(v)])
        n = np.diff(np.append(entry, len(v)))
        pair = np.flatnonzero(new_pair[entry])
        times = np.diff(np.append(pair, len(entry)))
        at = entry[pair]
        head = np.flatnonzero(new_v[at])
        runs = np.diff(np.append(head, len(at)))
        heads = v[at[head]]
        w, text = w[at], text[entry]
        # Where each shard begins among first words, pairs and entries.
        cut = np.flatnonzero(new_shard[at[head]])
        cuts = np.append(cut, len(head))
        edge = np.append(head[cut], len(at))
        border = np.append(pair[head[cut]], len(entry))
        names = shard[at[head[cut]]]
        rows = [
            (
                names[i], chunk, heads[cuts[i]:cuts[i + 1]].tobytes(), _narrow(runs[cuts[i]:cuts[i + 1]]), w[edge[i]:edge[i + 1]].tobytes(),
                _narrow(times[edge[i]:edge[i + 1]]), text[border[i]:border[i + 1]].tobytes(), _narrow(n[border[i]:border[i + 1]]),
                one, two, asks, b"" if i or not asks else keys.tobytes(),
            )
            for i in range(len(cut))
        ]
        return pd.DataFrame(rows, columns=["shard", "chunk", "v", "runs", "w", "times", "texts", "n", "one", "two", "asks", "ids"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, ids, parts, held = [], [], [], 0
        for batch in batches:
            for text, a, b, p in zip(batch["text"], batch["a"], batch["b"], batch["part"]):
                texts.append(text)
                ids.append((a, b))
                parts.append(int(p))
                held += len(text)
                if held >= PACK_CHARS or len(texts) >= PACK_TEXTS:
                    yield pack(texts, ids, parts)
                    texts, ids, parts, held = [], [], [], 0
        if texts:
            yield pack(texts, ids, parts)

    rows = docs.filter(F.col("text").rlike(r"[^ \t-\r]"))
    return rows.select("text", "part", text_key(1).alias("a"), text_key(2).alias("b")).mapInPandas(run, CELLS)


def _opened(cells: pd.DataFrame, models: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """First and second words of a shard's different pairs, their counts under each model, and per cell: the place of
    each entry's pair, its text, and how often the text has it."""
    vs, ws = [], []
    for cell in cells.itertuples(index=False):
        head = np.frombuffer(cell.v, np.uint64)
        vs.append(np.repeat(head, _wide(cell.runs, len(head))))
        ws.append(np.frombuffer(cell.w, np.uint64))
    v, w = np.concatenate(vs), np.concatenate(ws)
    code = key(v, w)
    order = np.argsort(code)
    new = np.append(True, np.diff(code[order]) != 0)
    at, place = order[new], np.empty(len(code), np.int32)
    place[order] = np.cumsum(new) - 1
    del code, order, new
    ends = np.cumsum([len(x) for x in ws])
    by_part = np.zeros((3, len(at)))
    entries = []
    for cell, end, own in zip(cells.itertuples(index=False), ends, ws):
        entry = np.repeat(place[end - len(own):end], _wide(cell.times, len(own)))
        text = np.frombuffer(cell.texts, np.uint16)
        n = _wide(cell.n, len(text)).astype(np.int64)
        entries.append((entry, text, n))
        for part, teaches in ((1, (text >= cell.one) & (text < cell.two)), (2, text >= cell.two)):
            if teaches.any():
                by_part[part] += np.bincount(entry[teaches], n[teaches], len(at))
    return v[at], w[at], np.stack([by_part[list(m)].sum(axis=0) for m in models]), entries


def _tallied(docs: DataFrame, grid: Grid, part: int, models: Sequence[Sequence[int]]) -> DataFrame:
    """(word, *SUMS) of a slice; the row without a word has, in place of the first four sums, how many pairs occur once, twice,
    three and four times."""

    def tally(cells: pd.DataFrame) -> pd.DataFrame:
        v, w, n, _ = _opened(cells, models)
        words, at = np.unique(np.concatenate([v, w]), return_inverse=True)
        first, second = at[:len(v)], at[len(v):]
        out = {"word": pd.array(np.append(words.view(np.int64), 0), "Int64")}
        out["word"][-1] = pd.NA
        for m in NAMES:
            own = n[int(m)]
            sums = [np.bincount(first, x, len(words)) for x in (own, own == 1, own == 2, own > 2)]
            sums.append(np.bincount(second, own > 0, len(words)))
            of_all = [(own == i).sum() for i in range(1, 5)] + [0]
            for c, x, y in zip(("t", "one", "two", "more", "k"), sums, of_all):
                out[f"{c}_{m}"] = np.append(x, y).astype(np.int64)
        return pd.DataFrame(out)

    schema = "word long, " + ", ".join(f"{c} long" for c in SUMS)
    found = _cells(docs, grid, part, asks=False).groupBy("shard").applyInPandas(tally, schema)
    return found.groupBy("word").agg(*[F.sum(c).alias(c) for c in SUMS])


def scores(docs: DataFrame, teachers: DataFrame | None, models: Sequence[Sequence[int]], scratch: Scratch, slices: int, other_word: bool) -> DataFrame:
    """(a, b, n_tokens, bits_0, bits_1) for each different text of ``docs`` with tokens; ``a``, ``b``: its ``text_key`` of 1 and of 2.

    ``docs``: text, part; a row teaches if its part is 1 or 2. ``teachers``: if given, the rows that teach in place of those of ``docs``,
    whose parts must then be 0. Both should be stored. ``models``: the parts that teach each of two models. With ``other_word`` a model's vocabulary is its own words and one more, any other word, and without rows to learn
    from a token costs one bit; else both share the words of all rows that teach, and a model without rows is uniform.
    """
    grid = Grid.of(docs, slices)
    tallies = [scratch.keep_lean(_tallied(docs if teachers is None else teachers, grid, k, models), f"tally-{k}") for k in range(slices)]
    every = reduce(DataFrame.unionByName, tallies)
    sums = every.groupBy("word").agg(*[F.sum(c).alias(c) for c in SUMS])
    # Most words are rare and have the same sums as many others: side by side they take little room, here and when they are moved.
    sums = scratch.keep_lean(sums.sortWithinPartitions("t_0", "t_1", "k_0", "k_1", "one_0", "one_1"), "sums")
    scratch.drop(*[f"tally-{k}" for k in range(slices)])
    known = sums.filter("word IS NOT NULL")
    of_all = sums.filter("word IS NULL").first()
    by_pair = [discounts(*(of_all[f"{c}_{m}"] if of_all else 0 for c in ("t", "one", "two", "more"))) for m in NAMES]
    met = known.agg(
        F.count_if((F.col("k_0") > 0) | (F.col("k_1") > 0)).alias("words"),
        *[F.coalesce(F.sum(f"k_{m}"), F.lit(0)).alias(f"all_{m}") for m in NAMES],
        *[F.count_if(F.col(f"k_{m}") > 0).alias(f"words_{m}") for m in NAMES],
        *[F.count_if(F.col(f"k_{m}") == i).alias(f"{i}_{m}") for m in NAMES for i in range(1, 5)],
        *[F.count_if(F.col(f"k_{m}") > 2).alias(f"more_{m}") for m in NAMES],
    ).first()
    by_word = [discounts(*(met[f"{i}_{m}"] for i in range(1, 5))) for m in NAMES]

    def unseen(k: int) -> float:
        """The share of a word that the model has never seen second."""
        m, off = NAMES[k], by_word[k]
        size = met[f"words_{m}"] + 1 if other_word else max(1, met["words"])
        if not met[f"all_{m}"]:
            return 0.5 if other_word else 1 / size
        return sum(d * met[f"{c}_{m}"] for d, c in zip(off, ("1", "2", "more"))) / met[f"all_{m}"] / size

    other = [unseen(k) for k in (0, 1)]

    def alone(k: int) -> Column:
        n = F.col(f"k_{NAMES[k]}")
        return (n - _off(n, by_word[k])) / F.lit(float(max(1, met[f"all_{NAMES[k]}"]))) + F.lit(other[k])

    def left(k: int) -> Column:
        return reduce(Column.__add__, (F.lit(d) * F.col(f"{c}_{NAMES[k]}") for d, c in zip(by_pair[k], ("one", "two", "more"))))

    def look_up(words: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(columns=["chunk", "texts", "n", "sums", "ids"])
        if not len(cells):
            return out
        v, w, n, entries = _opened(cells, models)
        name = words["word"].to_numpy(np.int64)
        order = np.argsort(name)
        name = np.append(name[order], 0)

        def places(asked: np.ndarray) -> np.ndarray:
            # Looked up in order, since neighbours are found next to each other. Behind the last word stands one that no pair has.
            turn = np.argsort(asked)
            at = np.searchsorted(name[:-1], asked[turn])
            out = np.empty(len(asked), np.int64)
            out[turn] = np.where(name[at] == asked[turn], at, len(order)) if len(order) else 0
            return out

        def found(at: np.ndarray, column: str, default: float) -> np.ndarray:
            return np.append(words[column].to_numpy(float)[order], default)[at]

        v, w = (places(x.view(np.int64)) for x in (v, w))
        bits = []
        for k, m in enumerate(NAMES):
            one, two, more = by_pair[k]
            total, rest, share = found(v, f"t_{m}", 0.0), found(v, f"left_{m}", 0.0), found(w, f"alone_{m}", other[k])
            if (n[k] > total).any():
                raise RuntimeError("the documents changed while they were read")
            off = np.array([0.0, one, two, more])[np.minimum(n[k], 3).astype(int)]
            bits.append(-np.log2(np.where(total > 0, (n[k] - off + rest * share) / np.maximum(total, 1), share)))
        rows = []
        for cell, (entry, text, times) in zip(cells.itertuples(index=False), entries):
            if not cell.asks:
                continue
            total = np.bincount(text, times)
            has = np.flatnonzero(total)
            total = total.astype(np.int64)
            sums = np.stack([np.bincount(text, times * b[entry]) for b in bits])[:, has]
            rows.append((cell.chunk, has.astype(np.uint16).tobytes(), _narrow(total[has]), sums.astype(np.float32).tobytes(), cell.ids))
        return pd.DataFrame(rows, columns=out.columns)

    def add(cells: pd.DataFrame) -> pd.DataFrame:
        # Equal chunks have one name: every one of them brings its ids and its sums, so the mean is taken.
        ids = [x for x in cells["ids"] if len(x)]
        keys = np.frombuffer(ids[0], np.int64).reshape(-1, 2)
        total = np.zeros((3, len(keys)))
        for cell in cells.itertuples(index=False):
            has = np.frombuffer(cell.texts, np.uint16)
            total[0, has] += _wide(cell.n, len(has))
            total[1:, has] += np.frombuffer(cell.sums, np.float32).reshape(2, -1)
        total /= len(ids)
        return pd.DataFrame({"a": keys[:, 0], "b": keys[:, 1], "n_tokens": np.rint(total[0]).astype(np.int64), "bits_0": total[1], "bits_1": total[2]})

    values = known.select(
        "word", *[x for k, m in enumerate(NAMES) for x in (F.col(f"t_{m}"), left(k).alias(f"left_{m}"), alone(k).alias(f"alone_{m}"))],
        ((F.col("t_0") > 0) | (F.col("t_1") > 0)).alias("first"), ((F.col("k_0") > 0) | (F.col("k_1") > 0)).alias("second"),
    )

    def part_scores(k: int) -> DataFrame:
        given = values.withColumn("shard", F.explode(grid.holders(k, F.col("word"), F.col("first"), F.col("second")))).drop("first", "second")
        cells = _cells(docs, grid, k)
        if teachers is not None:
            cells = cells.unionByName(_cells(teachers, grid, k, asks=False))
        looked = given.groupBy("shard").cogroup(cells.groupBy("shard")).applyInPandas(
            look_up, "chunk long, texts binary, n binary, sums binary, ids binary"
        )
        summed = looked.groupBy("chunk").applyInPandas(add, "a long, b long, n_tokens long, bits_0 double, bits_1 double")
        # Copies of a text have one score.
        return summed.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("n_tokens", "bits_0", "bits_1")])

    kept = [scratch.keep_lean(part_scores(k), f"slice-{k}") for k in range(slices)]
    whole = reduce(DataFrame.unionByName, kept).groupBy("a", "b")
    made = scratch.keep_lean(whole.agg(*[F.sum(c).alias(c) for c in ("n_tokens", "bits_0", "bits_1")]), "scores")
    scratch.drop("sums", *[f"slice-{k}" for k in range(slices)])
    return made
