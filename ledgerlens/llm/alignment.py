"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded whole by both tokenizers. Where a token that begins with a blank starts in both encodings
at the same byte, the tokens before it end together: these anchors cut the two id sequences into short windows,
and a window's alignment depends on its ids alone, so it is computed once and remembered by the pair of id tuples.

A link joins two tokens that end together, so one token's bytes end with the other's. The vocabularies therefore
bound the id pairs that can ever be linked (``Pairs``); corpus-wide counts are an array of that length, whatever
the corpus, and documents keep their links as (pair number, count), so that scoring needs no shuffle of links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.frames import by_text, q, ship
from ledgerlens.storage import Scratch

FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of window keys that a worker remembers (about 250,000 windows); past that it starts anew.
REMEMBERED = 3 << 20
#: The byte-level tokenizer's split pattern.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The fast engine's patterns run out of stack on very long blanks.
LONG_BLANK = re.compile(r"\s{1000}")
#: What follows an id in groups: another one of its group and tokenizer, the other tokenizer's, another group, nothing.
AFTER = (",", "|", ";", "")
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, pairs binary, counts binary"


@dataclass
class Tokenizers:
    """Two tokenizers from the bytes of their files, so that tasks need no file system."""

    byte_json: bytes
    piece_model: bytes

    @classmethod
    def read(cls, folder: str) -> Tokenizers:
        with open(f"{folder}/{BYTE_FILE}", "rb") as a, open(f"{folder}/{PIECE_FILE}", "rb") as b:
            return cls(a.read(), b.read())

    @cached_property
    def pieces(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.piece_model)

    @cached_property
    def exact(self):
        """The byte-level tokenizer as its file describes it."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.byte_json.decode())
        made.encode_special_tokens = True
        return made

    @cached_property
    def bytes_a(self) -> list[bytes]:
        """Each id's bytes."""
        held = json.loads(self.byte_json)
        back = _byte_alphabet()
        ids = {**held["model"]["vocab"], **{t["content"]: t["id"] for t in held["added_tokens"]}}
        out = [b""] * (max(ids.values()) + 1)
        for token, number in ids.items():
            out[number] = bytes(back[c] for c in token)
        return out

    @cached_property
    def bytes_b(self) -> list[bytes]:
        out = []
        for i in range(self.pieces.vocab_size()):
            piece = self.pieces.id_to_piece(i)
            as_byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            out.append(bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode())
        return out

    @cached_property
    def fast(self):
        """The same vocabulary in a faster engine, where merges stand in the order of ids; else None.

        Both engines split by character class; a test compares them over all code points.
        """
        import tiktoken

        held = json.loads(self.byte_json)
        vocab, split = held["model"]["vocab"], held["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in held["model"]["merges"]]
        ranked = [vocab.get("".join(m)) for m in merges] == list(range(256, 256 + len(merges)))
        if not ranked or held["normalizer"] or split != {**split, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            return None
        special = {t["id"] for t in held["added_tokens"]}
        ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in special}
        return tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, text: str) -> list[int]:
        if self.fast is None or LONG_BLANK.search(text):
            return self.exact.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)

    def writes_a(self, ids: list[int]) -> bytes:
        """The bytes of A's tokens."""
        return b"".join(map(self.bytes_a.__getitem__, ids)) if self.fast is None else self.fast.decode_bytes(ids)

    def ids_b(self, texts: Sequence[str]) -> list[list[int]]:
        return self.pieces.encode(list(texts), num_threads=1)

    @cached_property
    def pairs(self) -> Pairs:
        return Pairs(self.bytes_a, self.bytes_b)

    @cached_property
    def aligner(self) -> Aligner:
        return Aligner(self)


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pairs:
    """All id pairs of which one's bytes end with the other's, as sorted codes a * size + b; a pair's number is its place."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.size = len(bytes_b)
        of_a, of_b = _by_bytes(bytes_a), _by_bytes(bytes_b)
        codes = {
            a * self.size + b
            for ours, theirs, swap in ((of_a, of_b, False), (of_b, of_a, True))
            for token, left in ours.items() for k in range(len(token)) for x in left for y in theirs.get(token[k:], ())
            for a, b in [(y, x) if swap else (x, y)]
        }
        self.codes = np.array(sorted(codes), np.int64)

    def number(self, codes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, codes).astype(np.int32)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(self.codes[numbers], self.size)


def _by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
    out: dict[bytes, list[int]] = {}
    for number, token in enumerate(tokens):
        out.setdefault(token, []).append(number)
    return out


class Aligner:
    """Aligns texts in one worker; remembers windows by their ids (both sequences of a window packed into one key)."""

    def __init__(self, tokenizers: Tokenizers, remembered: int = REMEMBERED):
        self.tokenizers, self.remembered = tokenizers, remembered
        self.tokens_a, self.tokens_b = tokenizers.bytes_a, tokenizers.bytes_b
        if min(map(len, self.tokens_a + self.tokens_b)) == 0:
            raise ValueError("a token without bytes has no place in an alignment")
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.tokens_a, self.tokens_b))
        self.blank_a, self.blank_b = (np.array([t[:1] == b" " for t in x]) for x in (self.tokens_a, self.tokens_b))
        #: Between the two sequences of a key stands a number that is no id.
        self.between = max(len(self.tokens_a), len(self.tokens_b))
        self.packed = np.dtype(np.uint16 if self.between < 1 << 16 else np.uint32)
        #: Each id as it is written before each mark of AFTER.
        self.spelled = [f"{i}{mark}" for i in range(self.between) for mark in AFTER]
        self.known: dict[bytes, str] = {}
        self.older: dict[bytes, str] = {}
        self.held = 0

    def window(self, key: bytes, written: list[str]) -> str:
        """Join a window that the newer memory does not have; the older memory goes when the newer is full."""
        groups = self.older.get(key)
        if groups is None:
            groups = "".join(written)
        if self.held > self.remembered:
            self.older, self.known, self.held = self.known, {}, 0
        self.known[key] = groups
        self.held += len(key)
        return groups

    def written(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, cut: np.ndarray) -> list[str]:
        """The ids of a text in the order of its groups, each with the mark that follows it.

        ``at_a``, ``at_b``: the last token of each group; ``cut``: where windows begin, in tokens of both.
        """
        wide_a, wide_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        laid = np.empty(len(a) + len(b), np.int64)
        laid[np.arange(len(a)) + np.repeat(at_b + 1 - wide_b, wide_a)] = a
        laid[np.arange(len(b)) + np.repeat(at_a + 1, wide_b)] = b
        laid *= len(AFTER)
        laid[at_a + at_b + 1 - wide_b] += AFTER.index("|")
        laid[at_a + at_b + 1] += AFTER.index(";")
        # Nothing follows a window's last id.
        laid[cut[1:] - 1] += AFTER.index("") - AFTER.index(";")
        return list(map(self.spelled.__getitem__, laid.tolist()))

    def keys(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[bytes]:
        """Each window's ids of both sequences, as bytes."""
        wide_a, wide_b = np.diff(cut_a), np.diff(cut_b)
        ends = np.cumsum(wide_a + wide_b + 1)
        starts = ends - (wide_a + wide_b + 1)
        laid = np.full(ends[-1], self.between, self.packed)
        laid[np.arange(len(a)) + np.repeat(starts - cut_a[:-1], wide_a)] = a
        laid[np.arange(len(b)) + np.repeat(starts + wide_a + 1 - cut_b[:-1], wide_b)] = b
        data, width = laid.tobytes(), self.packed.itemsize
        return [data[i:j] for i, j in zip((starts * width).tolist(), (ends * width).tolist())]

    def text(self, text: str, a: list[int], b: list[int]) -> tuple[int, int, str, np.ndarray] | None:
        """Tokens of A, of B, the groups' text and the links' codes; None if either encoding isn't the text's bytes."""
        want = b" " + text.encode("utf-8", "surrogatepass")
        if b"".join(map(self.tokens_b.__getitem__, b)) != want or self.tokenizers.writes_a(a) != want:
            return None
        a, b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        met = np.searchsorted(ends_b, ends_a)
        at_a = np.flatnonzero(ends_b[met] == ends_a)
        at_b = met[at_a]
        # An anchor: a shared end after which both sequences go on with a blank.
        inner_a, inner_b = at_a[:-1] + 1, at_b[:-1] + 1
        anchor = self.blank_a[a[inner_a]] & self.blank_b[b[inner_b]]
        cut_a, cut_b = (np.concatenate([[0], x[anchor], [len(ids)]]) for x, ids in ((inner_a, a), (inner_b, b)))
        keys = self.keys(a, b, cut_a, cut_b)
        groups = list(map(self.known.get, keys))
        if None in groups:
            written = self.written(a, b, at_a, at_b, cut_a + cut_b)
            cut = (cut_a + cut_b).tolist()
            for w, found in enumerate(groups):
                if found is None:
                    key = keys[w]
                    groups[w] = self.known.get(key) or self.window(key, written[cut[w]:cut[w + 1]])
        return len(a), len(b), ";".join(groups), a[at_a] * np.int64(len(self.tokens_b)) + b[at_b]

    def texts(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, str, np.ndarray] | None]:
        given = [t or "" for t in texts]
        for text, b in zip(given, self.tokenizers.ids_b(given)):
            yield self.text(text, self.tokenizers.ids_a(text), b) if text else None


def _made(aligner: Aligner, texts: Sequence[str | None], keep: bool) -> pd.DataFrame:
    rows = []
    for found in aligner.texts(texts):
        if found is None:
            rows.append((0, 0, 0, 0, "" if keep else None, "", b"", b""))
            continue
        n_a, n_b, groups, links = found
        codes, counts = np.unique(links, return_counts=True)
        rows.append((
            n_a, n_b, len(links), len(links), groups if keep else None, hashlib.sha256(groups.encode()).hexdigest(),
            aligner.tokenizers.pairs.number(codes).tobytes(), counts.astype(np.int32).tobytes(),
        ))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in ALIGNED.split(", ")])


def _shared(spark: SparkSession, folder: str):
    ship(spark)
    return spark.sparkContext.broadcast(Tokenizers.read(folder))


def alignments(docs: DataFrame, folder: str = FOLDER, keep_groups: bool = True, shared=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, pairs, counts.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids between shared ends, in order (null without ``keep_groups``). ``pairs`` and
    ``counts`` are packed 32-bit numbers: which pairs (numbers in ``Pairs``) the text links, and how often. A text that is
    null, empty, or not reproduced byte for byte by either tokenizer has no tokens: zeros and empty strings. Repeated rows
    have results of their own; other columns are not read.
    """
    shared = shared or _shared(docs.sparkSession, folder)
    made = by_text(lambda texts: _made(shared.value.aligner, texts, keep_groups), ALIGNED)
    return docs.select(q("doc_id").alias("doc_id"), made(q("text")).alias("made")).select("doc_id", "made.*")


def pair_totals(aligned: DataFrame, shared) -> DataFrame:
    """How many links of all documents hold each pair: pair, a, b, n. Tasks add up before anything is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = shared.value.pairs
        held = np.zeros(len(pairs.codes), np.int64)
        for batch in batches:
            which, often = (np.frombuffer(b"".join(batch[c]), np.int32) for c in ("pairs", "counts"))
            held += np.bincount(which, often, len(held)).astype(np.int64)
        found = np.flatnonzero(held)
        a, b = pairs.ids(found)
        yield pd.DataFrame({"pair": found, "a": a, "b": b, "n": held[found]})

    parts = aligned.select("pairs", "counts").mapInPandas(run, "pair long, a long, b long, n long")
    return parts.groupBy("pair", "a", "b").agg(F.sum("n").alias("n"))


def scored(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose pair is the most frequent one of its B id in all documents, ties included; ``count_sum``: the
    pairs' corpus-wide counts, added up over the links. Rows without tokens have zeros. An empty table gives no rows.
    The totals that every task gets are bounded by the vocabularies (see ``Pairs``), not by the documents.
    """
    spark = docs.sparkSession
    shared = _shared(spark, folder)
    scratch = Scratch(spark, "alignment")
    aligned = scratch.keep(alignments(docs, folder, False, shared).drop("groups"), "aligned")
    totals = scratch.keep(pair_totals(aligned, shared), "totals")
    highest = totals.groupBy("b").agg(F.max("n").alias("highest"))
    known = totals.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")).toPandas()
    size = int(known["pair"].max()) + 1 if len(known) else 0
    counts, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    counts[known["pair"]], best[known["pair"]] = known["n"], known["best"]
    held = spark.sparkContext.broadcast((counts, best))

    @F.pandas_udf("n_best long, count_sum long")
    def sums(pairs: pd.Series, often: pd.Series) -> pd.DataFrame:
        counts, best = held.value
        rows = []
        for p, c in zip(pairs, often):
            which, times = np.frombuffer(p, np.int32), np.frombuffer(c, np.int32)
            rows.append((int((best[which] * times).sum()), int((counts[which] * times).sum())))
        return pd.DataFrame(rows, columns=["n_best", "count_sum"])

    return aligned.withColumn("sums", sums("pairs", "counts")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "sums.n_best", "sums.count_sum", "groups_sha256"
    )
