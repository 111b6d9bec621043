"""Toxicity by compression distance.

Two zstandard dictionaries come from labelled documents. zstandard trains one on ordinary windows of 256 bytes. The other
holds, as content, the passages of toxic documents that ordinary ones have far less often, the most frequent last:
trained by zstandard on toxic text it would be ordinary text for the most part. Every word of a document is a window
of its own, compressed with the ordinary dictionary and with both together; the bytes that the toxic one saves are the
window's distance. A logistic curve over a document's distances, fitted to the same labelled rows by
cross-fitting, gives the score, so that a fixed threshold is calibrated.

Two things make distances of single words tell. The first bytes of a word are written in upper case, so that what a word begins
with matches no word's inside. And every window ends in a run that both dictionaries know, without which
zstandard stores windows that it cannot shrink, and every distance of theirs is 0.

The labelled sample is bounded by rows and, a document at a time, by characters. Its pieces, passages, windows and
features are counted in tasks; the driver holds dictionaries, training windows and one row of numbers per labelled row.
Scoring reads whole texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.frames import by_text, q, ship
from ledgerlens.llm.words import LOWER
from ledgerlens.storage import Scratch

THRESHOLD = 0.3
TOXIC_ROWS = 3_000
ORDINARY_ROWS = 6_000
#: Labelled documents above this length are not used for training.
TRAIN_CHARS = 50_000
#: Bytes of the windows that the ordinary dictionary is trained on, and from one to the next.
WINDOW = 256
STEP = 216
#: Windows that it is trained on, those of all ordinary rows with the smallest hashes.
TRAIN_WINDOWS = 16_000
LEVEL = 11
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 16_384
#: Bytes of a word that are written in upper case, and the longest part of a word that is one window.
HEAD = 8
WORD = 64
#: What every window ends in.
RUN = b"\0" * 64
#: Bytes of the pieces by which passages are found, the share of the toxic rows that a telling piece
#: occurs in at least, and how many times more often than in ordinary text.
PIECES = (5, 7)
PIECE_SHARE = 0.01
PIECE_ODDS = 18
#: Times a passage must occur to enter the toxic dictionary.
PASSAGE_COUNT = 3
#: Distances of different words that a task remembers.
REMEMBERED = 200_000

_MARKS = bytes(32 if chr(i) in " \t\n\x0b\x0c\r.,;:!?|#*$%&\"'()<>[]{}=" else i for i in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text, each after a blank, marks as blanks; long ones in parts."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).translate(_MARKS).split()
    whole = [b" " + w[:HEAD].upper() + w[HEAD:] for w in data]
    if all(len(w) <= WORD for w in whole):
        return whole
    return [w[i:i + WORD] for w in whole for i in range(0, len(w), WORD)]


def windows(text: str | None) -> list[bytes]:
    """Overlapping windows over the whole text; none of an empty one."""
    data = b"".join(words(text))
    return [data[i:i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STEP)), STEP)] if data else []


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def __post_init__(self):
        self._pair, self._known = None, {}

    def __getstate__(self):
        return self.ordinary, self.toxic, self.weights

    def __setstate__(self, state):
        self.ordinary, self.toxic, self.weights = state
        self.__post_init__()

    def distances(self, text: str | None) -> np.ndarray:
        if self._pair is None:
            self._pair = [_compressor(d + RUN) for d in (self.ordinary, self.toxic + self.ordinary)]
        one, two = self._pair
        out = []
        for w in words(text):
            d = self._known.get(w)
            if d is None:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                d = self._known[w] = len(one.compress(w + RUN)) - len(two.compress(w + RUN))
            out.append(d)
        return np.array(out, float)

    def features(self, text: str | None) -> list[float]:
        d = self.distances(text)
        if not len(d):
            return [0.0, 0.0, 0.0]
        above = np.maximum(d - 1, 0)
        return [min(float(d.max()), 40.0) / 10, float(np.log1p(above.sum())), float(above.mean()) / 4]

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        rows = np.array([[1.0, *self.features(t)] for t in texts]).reshape(len(texts), 4)
        return 1 / (1 + np.exp(-np.clip(rows @ np.array(self.weights), -30, 30)))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; samples too few to train on are used as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[:size]


def _pieces(word: bytes) -> Iterator[bytes]:
    for size in PIECES:
        for i in range(len(word) - size + 1):
            yield word[i:i + size]


def passage(word: bytes, telling: Collection[bytes]) -> bytes:
    """The part of a word from its first telling piece to the end of its last; empty without any."""
    at = [(i, i + size) for size in PIECES for i in range(len(word) - size + 1) if word[i:i + size] in telling]
    return word[min(a for a, _ in at):max(b for _, b in at)] if at else b""


def _piece_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a table (text, toxic, half): piece, half, toxic, n (occurrences), rows."""
    for batch in batches:
        for (toxic, half), part in batch.groupby(["toxic", "half"]):
            n, rows = Counter(), Counter()
            for text in part["text"]:
                inside = Counter()
                for word, times in Counter(words(text)).items():
                    for piece in _pieces(word):
                        inside[piece] += times
                n.update(inside)
                rows.update(inside.keys())
            yield pd.DataFrame({
                "piece": list(n), "half": half, "toxic": toxic, "n": list(n.values()), "rows": [rows[p] for p in n]
            })


def _sample_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a table (text, half): the windows, and a hash of each."""
    for batch in batches:
        found = [(w, half, zlib.crc32(w)) for text, half in zip(batch["text"], batch["half"]) for w in windows(text)]
        yield pd.DataFrame(found, columns=["window", "half", "hash"])


def _telling(counted: DataFrame, sizes: dict[tuple[int, int], int]) -> list[set[bytes]]:
    """The telling pieces of half 0, of half 1 and of both: they occur in many toxic rows, and much less in ordinary text.

    ``counted``: a stored table of ``_piece_counts``; ``sizes``: sampled rows by kind and half.
    """
    total = {(r["toxic"], r["half"]): r["n"] for r in counted.groupBy("toxic", "half").agg(F.sum("n").alias("n")).collect()}
    sums = [
        F.sum(F.when((F.col("toxic") == k) & (F.col("half") == h), F.col(c)).otherwise(0)).alias(f"{c}_{k}{h}")
        for c in ("n", "rows") for k in (0, 1) for h in (0, 1)
    ]
    table = counted.groupBy("piece").agg(*sums)
    flags = []
    for model, halves in enumerate(((0,), (1,), (0, 1))):
        bad, good, rows = (sum(F.col(f"{c}{h}") for h in halves) for c in ("n_1", "n_0", "rows_1"))
        all_bad, all_good = (sum(total.get((k, h), 0) for h in halves) for k in (1, 0))
        enough = max(2.0, PIECE_SHARE * sum(sizes.get((1, h), 0) for h in halves))
        flags.append(((rows >= enough) & (bad * float(all_good) > PIECE_ODDS * (good + 0.5) * float(all_bad))).alias(f"in_{model}"))
    found = table.select("piece", *flags).filter("in_0 OR in_1 OR in_2").collect()
    return [{bytes(r["piece"]) for r in found if r[f"in_{m}"]} for m in range(3)]


def _special(sample: DataFrame, telling: list[set[bytes]]) -> list[bytes]:
    """Three toxic dictionaries: the passages of half 0, of half 1 and of both."""
    shared = sample.sparkSession.sparkContext.broadcast(telling)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = Counter()
            for half, part in batch.groupby("half"):
                for word, times in Counter(w for text in part["text"] for w in words(text)).items():
                    for model in (int(half), 2):
                        found = passage(word, shared.value[model])
                        if found:
                            n[model, found] += times
            yield pd.DataFrame({"model": [m for m, _ in n], "passage": [p for _, p in n], "n": list(n.values())})

    counted = (
        sample.filter("toxic = 1").select("text", "half").mapInPandas(count, "model int, passage binary, n long")
        .groupBy("model", "passage").agg(F.sum("n").alias("n")).filter(F.col("n") >= PASSAGE_COUNT)
    )
    # No passage is shorter than the shortest piece, so more than these have no room.
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.col("n").desc(), F.col("passage")))
    top = counted.withColumn("place", place).filter(F.col("place") <= TOXIC_BYTES // min(PIECES)).collect()
    shared.destroy()
    # The most frequent last: zstandard encodes nearer matches in fewer bytes.
    return [
        b"".join(bytes(r["passage"]) for r in sorted(top, key=lambda r: -r["place"]) if r["model"] == m)[-TOXIC_BYTES:]
        for m in range(3)
    ]


def fitted(sample: DataFrame, sizes: dict[tuple[int, int], int], scratch: Scratch) -> Model:
    """Dictionaries and curve from a stored table (text, toxic, half). ``sizes``: its rows by kind and half.

    Without texts of one kind every score is the share of toxic ones.
    """
    toxic, ordinary = (sum(n for (kind, _), n in sizes.items() if kind == k) for k in (1, 0))
    if not toxic or not ordinary:
        rate = min(max(toxic / max(1, toxic + ordinary), 0.01), 0.99)
        return Model(b"", b"", [float(np.log(rate / (1 - rate))), 0.0, 0.0, 0.0])
    ship(sample.sparkSession)
    counted = scratch.keep(sample.mapInPandas(_piece_counts, "piece binary, half int, toxic int, n long, rows long"), "pieces")
    special = _special(sample, _telling(counted, sizes))
    drawn = (
        sample.filter("toxic = 0").select("text", "half").mapInPandas(_sample_windows, "window binary, half int, hash long")
        .orderBy("hash", "window", "half").limit(TRAIN_WINDOWS).collect()
    )
    common = [_trained([bytes(r["window"]) for r in drawn if r["half"] in kinds], ORDINARY_BYTES) for kinds in ((0,), (1,), (0, 1))]
    del drawn
    models = [Model(common[m], special[m], [0.0] * 4) for m in range(3)]
    # The curve meets distances as unseen text has them: each half's come from the other half's dictionaries.
    shared = sample.sparkSession.sparkContext.broadcast(models[:2])

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[float(k), *shared.value[1 - h].features(t)] for t, k, h in zip(batch["text"], batch["toxic"], batch["half"])]
            yield pd.DataFrame(found, columns=["toxic", "a", "b", "c"])

    rows = sample.mapInPandas(features, "toxic double, a double, b double, c double").toPandas().to_numpy()
    shared.destroy()
    rows = rows[np.lexsort(rows.T)]
    models[2].weights = _logistic(rows[:, 1:], rows[:, 0])
    scratch.drop("pieces")
    return models[2]


def _logistic(rows: np.ndarray, wanted: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> list[float]:
    """Ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * rows.shape[1])
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(curve, x.T @ (wanted - p) - penalty @ weights)
        weights = weights + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return weights.tolist()


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def scored(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS,
    seed: int = 13, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Training sees at most ``toxic_rows`` and ``ordinary_rows`` labelled rows, those with the smallest seeded hash of
    their id, none of them held out (crc32 of the id as text, modulo 4, is 2; a null id is not). Scores depend on
    the text only. Null and empty texts score as a text without any toxic window. An id labelled both ways, a null
    label or a null id trains nothing; nor do texts above TRAIN_CHARS. Repeated rows score the same. An empty table gives no rows.
    """
    base = docs.select(q(id_column).alias("doc_id"), q(text_column).alias("text"))
    train = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    )
    order = [F.xxhash64(F.lit(seed), "doc_id"), "doc_id"]
    few = [train.filter(F.col("toxic") == k).orderBy(*order).limit(n) for k, n in ((1, toxic_rows), (0, ordinary_rows))]
    chosen = few[0].unionByName(few[1]).withColumnRenamed("doc_id", "train_id")
    scratch = Scratch(docs.sparkSession, "toxicity")
    half = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(2)).cast("int")
    sample = scratch.keep(
        base.join(F.broadcast(chosen), F.col("doc_id") == F.col("train_id")).filter(F.length("text").between(1, TRAIN_CHARS))
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text", half.alias("half")).distinct()
        .select("text", "toxic", "half"), "sample",
    )
    sizes = {(r["toxic"], r["half"]): r["n"] for r in sample.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    model = fitted(sample, sizes, scratch)
    scratch.drop("sample")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    score = by_text(lambda texts: pd.DataFrame({"score": shared.value.scores(texts)}), "score double")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return base.select("doc_id", out.alias("held_out"), score("text")["score"].alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
