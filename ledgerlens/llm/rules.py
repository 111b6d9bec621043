"""Quality rules: an isolation forest over rule statistics.

One pass over the whole texts gives each document's statistics; they are stored, being a few
numbers per document. A forest of random trees is grown from a bounded sample of them, scores
every document by its mean path length, and the labelled rows of both kinds outside the held part
set the threshold: the score at which the share of bad rows caught exceeds the share of good rows
rejected by most. Without bad rows at most REJECT_GOOD of the good ones are rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import by_text, q
from ledgerlens.llm.words import BLANK, SAME, mix, split, sums, windows
from ledgerlens.storage import Scratch

TREES = 100
TREE_ROWS = 256
SAMPLE_ROWS = 16_384
REJECT_GOOD = 0.005
SCORE_STEPS = 10_000
REPEAT_WORDS = 8
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_same_word", "n_marks"]
FEATURES = ["word_length", "symbol_share", "dup_line_share", "repeat_share", "same_word_share", "upper_share", "mark_share"]


def statistics(texts: Sequence[str | None]) -> pd.DataFrame:
    """The rule counts of each text; null counts as empty."""
    words = split(texts, BLANK, SAME)
    data, first = words.data, words.first
    inside = ~BLANK[data]
    chars = sums(inside & ((data & 0xC0) != 0x80), words.offsets)
    doc, total = words.doc, len(words.starts)

    covered = np.zeros(total + 1, np.int64)
    runs = windows(words.hashes, REPEAT_WORDS)
    at = np.flatnonzero(words.left() >= REPEAT_WORDS)
    if len(at):
        keys = mix(runs[at] ^ (doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = at[order[np.append(same, False) | np.insert(same, 0, False)]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WORDS, -1)
    repeated = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    equal = np.zeros(total, bool)
    if total:
        equal[1:] = (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])
    equal = np.concatenate([[0], np.cumsum(equal)])

    n_dup, n_lines = [], []
    for text in texts:
        lines = [x for x in text.split("\n") if x.strip(_BLANKS)] if text else []
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    return pd.DataFrame({
        "n_words": np.diff(first), "word_chars": chars, "n_symbols": sums(SYMBOLS[data], words.offsets),
        "n_dup_lines": np.array(n_dup, np.int64), "n_repeat_words": repeated[first[1:]] - repeated[first[:-1]],
        "n_lines": np.array(n_lines, np.int64), "n_upper": sums((data >= 65) & (data <= 90), words.offsets),
        "n_same_word": equal[first[1:]] - equal[first[:-1]],
        "n_marks": sums(np.isin(data, list(b"!?.,:;-_=/\\~^@+0123456789")), words.offsets),
    })


def features(counts: pd.DataFrame) -> np.ndarray:
    """Shares, so that long and short documents compare; those of an empty text are 0."""
    words = np.maximum(counts["n_words"].to_numpy(float), 1)
    chars = np.maximum(counts["word_chars"].to_numpy(float), 1)
    return np.stack([
        counts["word_chars"] / words, counts["n_symbols"] / words,
        counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1), counts["n_repeat_words"] / words,
        counts["n_same_word"] / words, counts["n_upper"] / chars, counts["n_marks"] / chars,
    ], axis=1)


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


class Forest:
    """Trees as arrays: feature (-1: leaf), cut, children, and the depth a leaf stands for."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.size = min(tree_rows, len(rows))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees)] if len(rows) else []

    @staticmethod
    def _grow(rows: np.ndarray, rng: np.random.Generator):
        limit = int(np.ceil(np.log2(max(2, len(rows)))))
        nodes = [[-1, 0.0, 0, 0, 0.0]]
        todo = [(0, rows, 0)]
        while todo:
            at, part, depth = todo.pop()
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 and depth < limit else []
            if not len(spread):
                nodes[at][4] = depth + _expected(len(part))
                continue
            feature = int(rng.choice(spread))
            cut = float(rng.uniform(part[:, feature].min(), part[:, feature].max()))
            below = part[:, feature] <= cut
            nodes[at][:4] = feature, cut, len(nodes), len(nodes) + 1
            todo += [(len(nodes), part[below], depth + 1), (len(nodes) + 1, part[~below], depth + 1)]
            nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
        return [np.array(x) for x in zip(*nodes)]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores in 0..1; 0 where no tree could be grown."""
        if not self.trees or self.size < 2:
            return np.zeros(len(rows))
        depth = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, right, leaf in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (feature[at] >= 0).any():
                split_on = feature[at]
                go = np.where(rows[every, np.maximum(split_on, 0)] <= cut[at], left[at], right[at])
                at = np.where(split_on >= 0, go, at)
            depth += leaf[at]
        return 2.0 ** (-depth / len(self.trees) / _expected(self.size))


def _bound(steps: pd.DataFrame, reject_good: float | None) -> float:
    """The lowest score that is rejected. ``steps``: score, and the rows that have it: good (all), fit_good and
    fit_bad (outside the held part)."""
    steps = steps.sort_values("score", ascending=False)
    score = steps["score"].to_numpy(float)
    good, fit_good, fit_bad = (steps[c].to_numpy(float) for c in ("good", "fit_good", "fit_bad"))
    if not good.sum():
        return 2.0
    if reject_good is None and fit_good.sum() and fit_bad.sum():
        gain = np.cumsum(fit_bad) / fit_bad.sum() - np.cumsum(fit_good) / fit_good.sum()
        # No score tells the two apart: reject nothing. The first of equal ones rejects least.
        return float(score[gain.argmax()]) if gain.max() > 0 else float(score[0]) + 1 / SCORE_STEPS
    allowed = score[np.cumsum(good) <= (REJECT_GOOD if reject_good is None else reject_good) * good.sum()]
    return float(allowed[-1]) if len(allowed) else float(score[good > 0][0]) + 1 / SCORE_STEPS


def judged(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    trees: int = TREES, tree_rows: int = TREE_ROWS, sample_rows: int = SAMPLE_ROWS, reject_good: float | None = None, seed: int = 5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept, and the anomaly score.

    The forest sees at most ``sample_rows`` documents, those with the smallest seeded hash of their id.
    Null and empty texts have no words, so base_failed is true. Repeated ids are judged row by row; an
    id labelled twice counts as good only if every label says so, and is bad otherwise; null ids and null labels
    calibrate nothing, nor do held-out ids (crc32 of the id as text, modulo 4, is 2). A ``reject_good`` given caps the
    share of good rows rejected instead, over all of them. Without good labels nothing but the base rules rejects. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "rules")
    make = by_text(statistics, ", ".join(f"{c} long" for c in [*COUNTS, *MORE]))
    counted = scratch.keep(
        docs.select(q(id_column).alias("doc_id"), make(q(text_column)).alias("s")).select("doc_id", "s.*"), "counts"
    )
    sample = (
        counted.filter("n_words >= 20").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", *COUNTS).limit(sample_rows)
        .select(*COUNTS, *MORE).toPandas()
    )
    forest = spark.sparkContext.broadcast(Forest(features(sample), trees, tree_rows, seed))

    @F.pandas_udf("double")
    def score(counts: pd.DataFrame) -> pd.Series:
        return pd.Series(np.round(forest.value.scores(features(counts)) * SCORE_STEPS) / SCORE_STEPS)

    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = scratch.keep(
        counted.withColumn("score", score(F.struct(*COUNTS, *MORE))).withColumn("base_failed", failed), "scored"
    )
    marks = (
        labels.select(F.col("doc_id"), F.col("quality")).filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
        .withColumn("fit", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    )
    # At most SCORE_STEPS + 1 rows: how many labelled rows of each kind have each score.
    steps = scored.filter(~F.col("base_failed")).join(marks, "doc_id").groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(F.col("good") & F.col("fit")).alias("fit_good"),
        F.count_if(~F.col("good") & F.col("fit")).alias("fit_bad"),
    )
    bound = _bound(steps.toPandas(), reject_good)
    scratch.drop("counts")
    return scored.select(
        "doc_id", *COUNTS, "base_failed",
        (~F.col("base_failed") & (F.col("score") < F.lit(bound))).alias("kept"), *MORE, "score",
    )
