"""An interpolated modified Kneser-Ney model of hashed word pairs, small enough to be sent to tasks.

It is fitted to a sample, so its size follows the sample's texts and not the corpus. Its vocabulary is the sample's
words and one more, any other word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from ledgerlens.llm.word_pairs import key, pairs


def _off(n: np.ndarray) -> np.ndarray:
    """What modified Kneser-Ney takes off each count."""
    n1, n2, n3, n4 = (int((n == i).sum()) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0] + [min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw)])[np.minimum(n, 3)]


@dataclass
class Model:
    """``codes``/``chances``: keys of the pairs seen, in order, and their second word's probability after the first;
    ``words``: hashes of words in order, with their probability after an unseen one (``alone``) and what the pairs that
    begin with them leave to unseen ones (``rest``); ``other``: the probability of any other word."""

    codes: np.ndarray
    chances: np.ndarray
    words: np.ndarray
    alone: np.ndarray
    rest: np.ndarray
    other: float

    @classmethod
    def fitted(cls, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> Model:
        """From different pairs and how often each occurs; without any, every word costs the same."""
        words = np.unique(np.concatenate([np.unique(v), np.unique(w)]))
        first, second = (np.searchsorted(words, x).astype(np.int32) for x in (v, w))
        follows = np.bincount(second, minlength=len(words))
        vocabulary = int((follows > 0).sum()) + 1
        if not len(n):
            return cls(np.empty(0, np.uint64), np.empty(0, np.float32), words, np.empty(0), np.empty(0), 1.0)
        off = _off(follows)
        other = off.sum() / len(n) / vocabulary
        alone = (follows - off) / len(n) + other
        off = _off(n)
        total = np.bincount(first, n, len(words))
        rest = np.where(total > 0, np.bincount(first, off, len(words)) / np.maximum(total, 1), 1.0)
        chances = (n - off) / total[first] + rest[first] * alone[second]
        codes = key(v, w)
        order = np.argsort(codes)
        return cls(codes[order], chances[order].astype(np.float32), words, alone, rest, float(other))

    def bits(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text, and its cost in bits."""
        v, w, first = pairs(texts)
        if not len(w) or not len(self.codes):
            return np.diff(first), np.zeros(len(texts)) if len(self.codes) else np.diff(first) * 1.0
        some, at = np.unique(np.concatenate([v, w]), return_inverse=True)
        place = np.minimum(np.searchsorted(self.words, some), len(self.words) - 1)
        known = self.words[place] == some
        alone, rest = np.where(known, self.alone[place], self.other), np.where(known, self.rest[place], 1.0)
        chance = rest[at[:len(v)]] * alone[at[len(v):]]
        # In order, neighbours are found next to each other.
        code = key(v, w)
        order = np.argsort(code)
        code = code[order]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[place] == code
        chance[order[hit]] = self.chances[place[hit]]
        total = np.concatenate([[0.0], np.cumsum(-np.log2(chance))])
        return np.diff(first), np.diff(total[first])
