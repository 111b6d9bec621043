"""Words of a batch of texts as numpy arrays.

Texts are handled as UTF-8 bytes: the separators used here are ASCII, which never occur inside
a longer UTF-8 sequence, so words can be cut and hashed without building one Python object
per word. Equal words have equal 64-bit hashes everywhere; different ones collide with a
probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SAME = bytes(range(256))
#: Bytes that end a word `[^\x20\x09-\x0D]+`.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes that end a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NOT_ALNUM = np.array([i < 0x30 or 0x3A <= i <= 0x60 or 0x7B <= i <= 0x7F for i in range(256)])

CHUNK_BYTES = 1 << 19
_BLOCK = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; changes ``x`` in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def _powers(count: int, step: np.uint64) -> np.ndarray:
    out = np.full(count, step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SMALL = _powers(1 << 16, _MULTIPLIER)
_LARGE = _powers(1 << 12, (_SMALL[-1:] * _MULTIPLIER)[0])


@dataclass
class Words:
    """``data``: the bytes of all texts; ``offsets``: where each text starts in ``data`` (one more
    entry at the end); ``starts``/``ends``: the words' byte ranges; ``first``: index of each
    text's first word (one more entry at the end); ``hashes``: one per word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, separator: np.ndarray) -> np.ndarray:
    values = np.where(separator, np.uint64(0), _VALUES)
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data) + _BLOCK, _BLOCK)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        at, end = starts[a:b], ends[b - 1]
        sizes = np.diff(np.append(at, end))
        place = np.arange(end - at[0]) - np.repeat(at - at[0], sizes)
        product = values[data[at[0]:end]]
        if sizes.max() > 0x10000:
            product *= _SMALL[place & 0xFFFF]
            product *= _LARGE[(place >> 16) & 0xFFF]
        else:
            product *= _SMALL[place]
        out[a:b] = np.add.reduceat(product, at - at[0])
    out += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def split(texts: Sequence[str | None], separator: np.ndarray, table: bytes = LOWER) -> Words:
    """The words of each text (null: none), of bytes changed by ``table``."""
    blobs = [t.encode("utf-8", "surrogatepass").translate(table) if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(b) + 1 for b in blobs], dtype=np.int64)])
    if not blobs:
        offsets = np.zeros(1, np.int64)
    inside = ~separator[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(starts, offsets)
    hashes = _hash(data, starts, ends, separator) if len(starts) else np.empty(0, np.uint64)
    return Words(data, offsets, starts, ends, first, hashes)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words (texts' bounds are not looked at)."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k:k + n]
    return mix(out)


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters each; a longer text is a range of its own."""
    start = total = count = 0
    for count, text in enumerate(texts, 1):
        total += len(text) if text else 0
        if total >= limit:
            yield start, count
            start, total = count, 0
    if count > start:
        yield start, count


def sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many true bytes each text has."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return np.diff(total[offsets])


_LETTER = np.array([chr(i).isalnum() or i >= 0x80 for i in range(256)])


def _alone(data: np.ndarray) -> np.ndarray:
    """First bytes of characters of scripts written without blanks: Thai, Lao, Myanmar, Khmer, and all from U+3000 on."""
    then = np.append(data[1:], 0)
    return (
        (data >= 0xE3) | ((data == 0xE0) & (then >= 0xB8) & (then <= 0xBB))
        | ((data == 0xE1) & (((then >= 0x80) & (then <= 0x82)) | (then == 0x9E) | (then == 0x9F)))
    )


def tokens(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each token, and each text's first token (one more entry at the end).

    Tokens are runs of letters and digits, other ASCII characters one by one, and characters of scripts
    written without blanks one by one.
    """
    blobs = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    if not blobs:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    blank, inside = BLANK[data], _LETTER[data]
    before = np.append(False, inside[:-1])
    lead = (data & 0xC0) != 0x80
    start = ~blank & lead & (~inside | ~before)
    if data.max() >= 0xE0:
        own = _alone(data)
        # A character that stands alone also ends at the next one's first byte.
        last = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0))
        after_own = np.append(False, own[last][:-1])
        start |= ~blank & lead & (own | after_own)
    starts = np.flatnonzero(start)
    edge = np.append(start[1:] | blank[1:], True) & ~blank
    ends = np.flatnonzero(edge) + 1
    sizes = np.array([len(b) + 1 for b in blobs], np.int64)
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return (_hash(data, starts, ends, BLANK) if len(starts) else np.empty(0, np.uint64)), first
