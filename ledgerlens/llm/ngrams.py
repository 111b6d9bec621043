"""Character trigram models with interpolated modified Kneser-Ney smoothing.

Characters are numbered 0..SYMBOLS-1 (0: any rare character, 1: before the text), so a model
has at most SYMBOLS**3 counts however large the corpus is. Tasks count their own rows into one
array and send what is not zero; the counts, continuation counts and context totals are joined as
DataFrames, sharded by context. The finished model is one table of SYMBOLS**3 costs (8 MB), small
enough by construction to be sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import ship
from ledgerlens.llm.words import chunks

SYMBOLS = 128
RARE, BEFORE = 0, 1


def _codes(texts: Sequence[str | None]) -> list[np.ndarray]:
    return [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]


def alphabet(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The SYMBOLS - 2 most frequent characters of a column (ties: the smaller code), sorted."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            texts = batch.iloc[:, 0].tolist()
            for a, b in chunks(texts):
                total += np.bincount(np.concatenate(_codes(texts[a:b])), minlength=0x110000)
        code = np.flatnonzero(total)
        yield pd.DataFrame({"code": code, "n": total[code]})

    counted = docs.select(text_column).mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.col("n").desc(), "code").limit(SYMBOLS - 2).collect()
    return np.array(sorted(r["code"] for r in top), np.int64)


def numbering(letters: np.ndarray) -> np.ndarray:
    table = np.full(0x110000, RARE, np.uint8)
    table[letters] = np.arange(2, 2 + len(letters))
    return table


def trigrams(texts: Sequence[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigram that ends at each character, and where each text's characters start (one more entry at the end)."""
    codes = _codes(texts)
    sizes = np.array([len(c) for c in codes], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not offsets[-1]:
        return np.empty(0, np.int64), offsets
    now = table[np.concatenate(codes)].astype(np.int32)
    starts = offsets[:-1][sizes > 0]
    one = np.empty_like(now)
    one[1:] = now[:-1]
    one[starts] = BEFORE
    two = np.empty_like(now)
    two[1:] = one[:-1]
    two[starts] = BEFORE
    return (two * SYMBOLS + one) * SYMBOLS + now, offsets


def counts(docs: DataFrame, letters: np.ndarray, text_column: str = "text") -> DataFrame:
    """(u, v, w, n): how often each trigram occurs in the column; null and empty texts have none."""
    ship(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(numbering(letters))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            texts = batch.iloc[:, 0].tolist()
            for a, b in chunks(texts):
                total += np.bincount(trigrams(texts[a:b], table.value)[0], minlength=SYMBOLS**3)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"t": found, "n": total[found]})

    found = docs.select(text_column).mapInPandas(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    return found.select(
        F.floor(F.col("t") / SYMBOLS**2).alias("u"), F.floor(F.col("t") / SYMBOLS % SYMBOLS).alias("v"),
        (F.col("t") % SYMBOLS).alias("w"), "n",
    )


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What modified Kneser-Ney takes off a count of 1, of 2, and of more, from how many counts are 1, 2, 3 and 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw)]


def _discounts(table: DataFrame) -> list[float]:
    """``discounts`` of a table of counts ``n``."""
    seen = {r["n"]: r["k"] for r in table.filter("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    return discounts(*(seen.get(i, 0) for i in range(1, 5)))


def _discounted(table: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
    """``table`` with ``share`` (the discounted count over its context's total), and each context's
    ``rest``: the probability left to the next lower order."""
    d1, d2, d3 = _discounts(table)
    off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    taken = table.withColumn("off", off)
    totals = taken.groupBy(*context).agg(F.sum("n").alias("total"), F.sum("off").alias("off_sum"))
    joined = taken.join(totals, context) if context else taken.withColumn("total", F.lit(totals.first()["total"]))
    shares = joined.withColumn("share", (F.col("n") - F.col("off")) / F.col("total"))
    return shares, totals.withColumn("rest", F.col("off_sum") / F.col("total"))


def costs(counted: DataFrame) -> np.ndarray:
    """Bits for each trigram's last character after its first two. ``counted``: a stored table of ``counts``.

    Without any counts every character costs the same.
    """
    pairs = counted.groupBy("v", "w").agg(F.count("*").alias("n"))
    singles = pairs.groupBy("w").agg(F.count("*").alias("n"))
    s1, r1 = (x.toPandas() for x in _discounted(singles, []))
    s2, r2 = (x.toPandas() for x in _discounted(pairs, ["v"]))
    s3, r3 = (x.toPandas() for x in _discounted(counted, ["u", "v"]))
    p1 = np.full(SYMBOLS, (float(r1["rest"].iloc[0]) if len(s1) else 1.0) / SYMBOLS)
    p1[s1["w"].astype(int)] += s1["share"]
    rest = np.ones(SYMBOLS)
    rest[r2["v"].astype(int)] = r2["rest"]
    p2 = rest[:, None] * p1
    p2[s2["v"].astype(int), s2["w"].astype(int)] += s2["share"]
    rest = np.ones((SYMBOLS, SYMBOLS))
    rest[r3["u"].astype(int), r3["v"].astype(int)] = r3["rest"]
    p3 = rest[:, :, None] * p2
    p3[s3["u"].astype(int), s3["v"].astype(int), s3["w"].astype(int)] += s3["share"]
    return -np.log2(p3).astype(np.float32).reshape(-1)


def bits(texts: Sequence[str | None], table: np.ndarray, models: Sequence[np.ndarray]) -> pd.DataFrame:
    """Characters of each text, and its cost in bits under each model (columns bits_0, bits_1, ...)."""
    found, offsets = trigrams(texts, table)
    out = {"n": np.diff(offsets)}
    for k, model in enumerate(models):
        total = np.concatenate([[0.0], np.cumsum(model[found], dtype=np.float64)])
        out[f"bits_{k}"] = np.diff(total[offsets])
    return pd.DataFrame(out)


def labelled_sample(docs: DataFrame, labels: DataFrame, condition: str, rows: int, seed: int, id_column: str = "doc_id") -> DataFrame:
    """The documents of at most ``rows`` labelled ids that meet ``condition``, those with the smallest seeded hash."""
    ids = labels.filter(condition).filter("doc_id IS NOT NULL").select("doc_id").distinct()
    few = ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows)
    few = docs.sparkSession.createDataFrame(few.collect(), ids.schema).withColumnRenamed("doc_id", "_labelled")
    return docs.join(F.broadcast(few), F.col(id_column) == F.col("_labelled"), "left_semi")
