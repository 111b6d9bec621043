"""Benchmark decontamination by suffix arrays of the training text.

Every task holds a shard: the words of a chunk of documents. It numbers the words by the
benchmark's vocabulary, builds the shard's suffix array by prefix doubling, and looks up every
suffix of the benchmark in it by binary search. A suffix that meets a word the benchmark does
not have before it is long enough cannot match and is left out of the array; that loses nothing.
Documents are never shuffled, so a passage that a third of them share is no hot key.

The benchmark is the stated query set. It is sent to the tasks in blocks of at most
``block_chars`` characters, and each block is looked up in all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import by_text, fresh, q
from ledgerlens.llm.words import NOT_ALNUM, split

WINDOW = 10
BLOCK_CHARS = 16_000_000
#: Characters of a shard; the block's suffixes are ranked together with each shard's.
SHARD_CHARS = 1 << 21
RESULT = (
    "n_words long, n_hit long, items array<string>, "
    "matches array<struct<item_id: string, item_start: long, doc_start: long, n_words: long>>"
)


@dataclass
class Block:
    """Words of some benchmark items, numbered from 1; 0 stands between items."""

    ids: list[str]
    vocabulary: np.ndarray
    numbers: np.ndarray
    item: np.ndarray
    place: np.ndarray
    left: np.ndarray
    sizes: np.ndarray


def block_of(ids: Sequence[str], texts: Sequence[str | None]) -> Block:
    words = split(texts, NOT_ALNUM)
    vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
    item = words.doc
    return Block(
        list(ids), vocabulary, numbers.astype(np.int64) + 1, item,
        np.arange(len(item)) - words.first[item], words.left(), np.diff(words.first)[item],
    )


def _ranks(numbers: np.ndarray, run: np.ndarray, levels: int) -> list[np.ndarray]:
    """Prefix doubling: ranks[j][p] orders the 2**j words from p, for each p with so many left."""
    ranks = [numbers]
    for j in range(levels):
        step, last = 1 << j, ranks[-1]
        at = np.flatnonzero(run >= 2 * step)
        _, order = np.unique(last[at] * (last.max() + 1) + last[at + step], return_inverse=True)
        following = np.zeros(len(numbers), np.int64)
        following[at] = order + 1
        ranks.append(following)
    return ranks


def occurrences(numbers: np.ndarray, run: np.ndarray, block: Block, window: int):
    """(place in the shard, place in the block, length) of each window of the block found in the shard."""
    shard = len(numbers)
    wanted = np.where(block.sizes >= window, window, block.sizes)
    starts = (block.left >= window) | ((block.sizes < window) & (block.place == 0))
    lengths = np.unique(wanted[starts])
    useful = run >= (lengths[0] if len(lengths) else window)
    if not len(lengths) or not useful.any():
        return np.empty((0, 3), np.int64)
    joint = np.concatenate([numbers, block.numbers])
    joint_run = np.concatenate([run, block.left])
    joint_run = np.minimum(joint_run, window)
    ranks = _ranks(joint, joint_run, int(window).bit_length() - 1)
    found = []
    for length in lengths.tolist():
        level = length.bit_length() - 1
        rank = ranks[level]

        def key(at):
            return rank[at] * (rank.max() + 1) + rank[at + length - (1 << level)]

        place = np.flatnonzero(run >= length)
        test = np.flatnonzero(starts & (wanted == length))
        keys = key(place)
        suffixes = np.argsort(keys, kind="stable")
        keys = keys[suffixes]
        sought = key(test + shard)
        low, high = np.searchsorted(keys, sought, "left"), np.searchsorted(keys, sought, "right")
        count = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        found.append(np.stack([place[suffixes[at]], np.repeat(test, count), np.full(count.sum(), length)], axis=1))
    return np.concatenate(found)


def _shard(texts: Sequence[str | None], blocks: Sequence[Block], window: int) -> pd.DataFrame:
    words = split(texts, NOT_ALNUM)
    doc, total = words.doc, len(words.starts)
    hit = np.zeros(total + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    matches: list[list] = [[] for _ in texts]
    for block in blocks:
        if not total or not len(block.vocabulary):
            continue
        at = np.searchsorted(block.vocabulary, words.hashes)
        at[at == len(block.vocabulary)] = 0
        numbers = np.where(block.vocabulary[at] == words.hashes, at + 1, 0)
        stop = np.where(numbers == 0, np.arange(total), total)
        run = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] - np.arange(total), words.left())
        found = occurrences(numbers, run, block, window)
        if not len(found):
            continue
        np.add.at(hit, found[:, 0], 1)
        np.add.at(hit, found[:, 0] + found[:, 2], -1)
        # Windows one word on in both texts belong to one match.
        shift = found[:, 0] - found[:, 1]
        found = found[np.lexsort((found[:, 0], shift))]
        shift = found[:, 0] - found[:, 1]
        begins = np.ones(len(found), bool)
        begins[1:] = (np.diff(shift) != 0) | (np.diff(found[:, 0]) != 1) | (np.diff(block.item[found[:, 1]]) != 0) | (np.diff(doc[found[:, 0]]) != 0)
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(found)) - 1
        size = found[last, 0] - found[first, 0] + found[last, 2]
        for (p, t, _), n in zip(found[first].tolist(), size.tolist()):
            d, name = doc[p], block.ids[block.item[t]]
            items[d].add(name)
            matches[d].append((name, int(block.place[t]), int(p - words.first[d]), n))
    n_hit = np.add.reduceat(np.append(np.cumsum(hit)[:-1] > 0, False), np.minimum(words.first[:-1], total)) if len(texts) else []
    n_words = np.diff(words.first)
    return pd.DataFrame({
        "n_words": n_words, "n_hit": np.where(n_words > 0, n_hit, 0) if len(texts) else [],
        "items": [sorted(x) for x in items],
        "matches": [[dict(zip(("item_id", "item_start", "doc_start", "n_words"), m)) for m in sorted(x)] for x in matches],
    })


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, block_chars: int) -> list[Block]:
    rows = benchmark.select(
        F.coalesce(q(item_column).cast("string"), F.lit("")).alias("item"), F.coalesce(q(text_column), F.lit("")).alias("text")
    ).distinct()
    out, ids, texts, size = [], [], [], 0
    for row in rows.toLocalIterator():
        ids.append(row["item"])
        texts.append(row["text"])
        size += len(row["text"])
        if size >= block_chars:
            out.append(block_of(ids, texts))
            ids, texts, size = [], [], 0
    return [*out, block_of(ids, texts)] if ids else out


def with_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
    text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", into: str = "found",
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_hit (words inside any occurrence of a benchmark
    window), items (ids with occurring windows, sorted as strings) and matches (longest verbatim
    matches: item, first word there, first word in the document, words).

    A window is ``window`` consecutive words of an item, or a whole shorter one. Null and wordless texts
    have no words and no hits; null item ids are written as an empty string; repeated items
    count once by id; an empty benchmark hits nothing; an empty table gives no rows. Each row of
    ``docs`` stays one row with all its columns.
    """
    blocks = docs.sparkSession.sparkContext.broadcast(_blocks(benchmark, item_column, item_text_column, block_chars))
    find = by_text(lambda texts: _shard(texts, blocks.value, window), RESULT, SHARD_CHARS)
    return docs.select("*", find(q(text_column)).alias(into))


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches."""
    found = with_matches(docs.select(q(id_column).alias("doc_id"), q(options.pop("text_column", "text")).alias("text")), benchmark, **options)
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"), "found.matches",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold any benchmark window; columns as they were."""
    into = fresh(docs, "found")
    found = with_matches(docs, benchmark, into=into, **options)
    return found.filter(F.col(into)["n_hit"] == 0).drop(into)


SQL = """
WITH i AS (
  SELECT coalesce(cast(item_id AS varchar), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[s : s + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), d AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), dw AS (
  SELECT doc_id, l, s, array_to_string(w[s : s + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s
        FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)
), hit AS (
  SELECT doc_id, item, dw.l, s FROM dw JOIN iw ON dw.win = iw.win AND dw.l = iw.l
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM (SELECT DISTINCT doc_id, s, l FROM hit)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
  cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
