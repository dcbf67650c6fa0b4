"""Word shingle sets of texts as sorted arrays of 64-bit hashes, and what is made from them."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import SPACE_BYTES
from .mph import mix

SHINGLE_WORDS = 5

_TO_SPACE = bytes.maketrans(SPACE_BYTES, b" " * len(SPACE_BYTES))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, in order."""
    words = text.lower().translate(_TO_SPACE).split(b" ")
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words if w], dtype=np.uint64)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-word window; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        out = mix(hashes[:n], width)
        for i in range(1, width):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + hashes[i:n + i]
    return mix(out, 1)


def shingle_set(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending: a pseudo-random order of shingles."""
    return np.unique(windows(word_hashes(text), width))


def prefix_length(n: int, percent: int) -> int:
    """Smallest hashes of which two sets share one if their Jaccard similarity reaches ``percent``.

    A partner has at least percent/100 * n shingles in common, so it cannot
    miss all of any n - ceil(percent/100 * n) + 1 of them.
    """
    return n - -(-percent * n // 100) + 1 if n else 0


def max_difference(n1, n2, percent: int):
    """Largest symmetric difference of two sets of these sizes that still link."""
    # |A & B| >= p/(100+p) * (n1+n2)
    return (n1 + n2) - 2 * -(-(percent * (n1 + n2)) // (100 + percent))


def parity_bits(hashes: np.ndarray) -> int:
    """Length of a set's parity bitmap: a power of two, two to four bits a shingle, 64 at least."""
    return max(64, 1 << int(2 * len(hashes) - 1).bit_length()) if len(hashes) else 64


def parity_bitmap(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of the shingles whose hash is i modulo the length.

    Sets that differ in d shingles differ in at most d bits, so the bits that
    differ bound the symmetric difference from below.
    """
    m = parity_bits(hashes)
    at = (mix(hashes, 7) & np.uint64(m - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """Bits in which two parity bitmaps differ, the longer one folded onto the shorter."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())


def part_signatures(hashes: np.ndarray, n_parts: int, level: int) -> np.ndarray:
    """A hash of every non-empty one of ``n_parts`` parts of a set, parts cut by shingle hash."""
    spread = mix(hashes, 11)
    part = (spread % np.uint64(n_parts)).astype(np.int64)
    with np.errstate(over="ignore"):
        out = mix(np.arange(n_parts, dtype=np.uint64), 13 + level)
        np.add.at(out, part, mix(spread, 17))
    return mix(out[np.bincount(part, minlength=n_parts) > 0], 19)
