"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A batch of texts is one byte buffer. A table maps each byte to its folded form, or to
:data:`SEPARATOR`, which is no byte, if it separates words. The hash of a word is a polynomial over its bytes, taken from running
sums, so that no Python loop runs over words. Equal words have equal hashes; two different
ones of a text pair meet with a chance of some 2**-64 each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Texts are hashed in batches of about so many bytes; arrays of some 50 times as many are held meanwhile.
BATCH_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
SEPARATOR = 256
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fold_table(separators: Iterable[int]) -> np.ndarray:
    """Bytes to bytes: A-Z in lower case, ``separators`` (a blank is one) to :data:`SEPARATOR`."""
    table = np.arange(256, dtype=np.uint16)
    table[65:91] += 32
    table[list(separators)] = SEPARATOR
    return table


#: Words are runs of anything but ASCII white space.
SPACED = fold_table([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
ALPHANUMERIC = fold_table([b for b in range(128) if not chr(b).isalnum()])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE), np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in order, and where each text's words begin.

    The second array has one entry more than there are texts, which are parted by blanks.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    buffer = table[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    inside = (buffer != SEPARATOR).view(np.int8)
    edges = np.diff(inside, prepend=np.int8(0))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _powers(1 << max(18, int(len(buffer) - 1).bit_length()))
    sums = np.empty(len(buffer) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[buffer] * up[: len(buffer)], dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[ends] - sums[begins]) * down[begins])
    firsts = np.searchsorted(begins, np.concatenate(([0], np.cumsum(lengths))))
    return hashes, firsts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it has fewer, none if empty."""
    size = min(size, len(words))
    if not size:
        return words
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = mix(total * _BASE + words[i : i + count])
    return total


def batches(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    """Texts as UTF-8 in lists of about :data:`BATCH_BYTES`; null is empty."""
    batch: list[bytes] = []
    held = 0
    for text in texts:
        batch.append(text.encode("utf-8", "surrogatepass") if text else b"")
        held += len(batch[-1])
        if held >= BATCH_BYTES:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def shingle_sets(texts: Iterable[str | None], size: int, table: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the sorted distinct shingle hashes."""
    for batch in batches(texts):
        hashes, firsts = word_hashes(batch, table)
        for i in range(len(batch)):
            yield np.unique(shingle_hashes(hashes[firsts[i] : firsts[i + 1]], size))
