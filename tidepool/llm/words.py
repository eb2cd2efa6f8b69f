"""Words and word n-grams as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))

# Texts that are hashed together, up to this many bytes (or one longer text);
# the arrays that hash them take about 50 bytes to a byte.
GROUP_BYTES = 1 << 19


def mixed(values: np.ndarray) -> np.ndarray:
    out = values * MIX
    out ^= out >> np.uint64(32)
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


def _letters(kept: bytes, lower: bool = True) -> np.ndarray:
    """A random value for each byte that belongs to words, 0 for all others; A-Z as a-z."""
    table = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    inside = np.zeros(256, bool)
    inside[list(kept)] = True
    return np.where(inside, table, np.uint64(0))


# Words of anything but ASCII white space, and words of letters and digits
# only (bytes over 127 count as letters).
ANY_WORD = _letters(bytes(set(range(256)) - set(b" \t\n\x0b\x0c\r")))
PLAIN_WORD = _letters(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


class WordHasher:
    """Hashes of the words of texts, by sums over all bytes at once.

    A word's hash is the sum of its bytes' values times powers of an odd
    number (modulo 2^64), mixed with its length; it does not depend on where
    the word stands.
    """

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, GROUP_BYTES + 1)
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, STEP)]), dtype=np.uint64)
            self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, INVERSE)]), dtype=np.uint64)

    def group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts, and the number of words before each text and after the last."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self._reach(len(data))
        values = self.letters[data]
        inside = values != 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # texts end outside a word
        start, end = edges[::2], edges[1::2]
        sums = np.cumsum(values * self.powers[:len(data)], dtype=np.uint64)
        before = np.where(start > 0, sums[start - 1], np.uint64(0))
        hashes = (sums[end - 1] - before) * self.inverses[start]
        ends = np.cumsum([len(t) + 1 for t in texts])
        bounds = np.concatenate([[0], np.searchsorted(start, ends)])
        return mixed(hashes + (end - start).astype(np.uint64) * MIX), bounds

    def of(self, text: bytes) -> np.ndarray:
        return self.group([text])[0]


def grouped(rows: Iterator[tuple], text_of) -> Iterator[list[tuple]]:
    """Runs of rows whose texts have about GROUP_BYTES together."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(text_of(row))
        if size >= GROUP_BYTES:
            yield kept
            kept, size = [], 0
    if kept:
        yield kept


def plain_text(text: str) -> bytes:
    """Lower-cased UTF-8, for words of letters and digits."""
    return text.lower().encode("utf-8", "replace")


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words, in order; empty if there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    count = len(hashes) - n + 1
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= STEP
        out += hashes[k:k + count]
        out ^= out >> np.uint64(29)
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out
