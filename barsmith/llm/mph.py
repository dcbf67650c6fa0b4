"""A minimal perfect hash over 64-bit keys, built and probed with numpy.

Cascaded bit arrays: every level hashes the keys left over from the one before
into a bit array of ``GAMMA`` bits a key; keys alone on their bit stay, the
others fall through. A key's index is the number of set bits before its own
(over all levels), so ``n`` keys map onto ``0 .. n-1`` without the keys being
stored. A few bits a key; lookups touch one or two levels.

Keys that were not in the build set land on an arbitrary index or none: the
caller keeps a fingerprint per index to tell them apart.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
MAX_LEVELS = 64
_WORD = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit keys (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64, copy=True) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Index of a set of distinct unsigned 64-bit keys."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes = sizes
        self.bits = bits
        ones = [np.bitwise_count(b).astype(np.int64) for b in bits]
        # Set bits before every 64-bit word, counted over all levels.
        total, self.before = 0, []
        for o in ones:
            self.before.append(total + np.concatenate(([0], np.cumsum(o)[:-1])) if len(o) else o)
            total += int(o.sum())
        self.n = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left = np.asarray(keys, dtype=np.uint64)
        sizes, bits = [], []
        while len(left):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = max(_WORD, int(len(left) * GAMMA + _WORD - 1) // _WORD * _WORD)
            at = mix(left, len(sizes)) % np.uint64(m)
            alone = np.bincount(at.astype(np.int64), minlength=m) == 1
            sizes.append(m)
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at.astype(np.int64)]]
        return cls(sizes, bits)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 for keys that fall through every level."""
        keys = np.asarray(keys, dtype=np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (m, words) in enumerate(zip(self.sizes, self.bits)):
            if not len(open_):
                break
            at = mix(keys[open_], level) % np.uint64(m)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            value = words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = value[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.before[level][word[hit]] + np.bitwise_count(below).astype(np.int64)
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], dtype=np.int64)
        return head.tobytes() + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        levels = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, levels, 8).tolist()
        at, bits = 8 * (levels + 1), []
        for m in sizes:
            bits.append(np.frombuffer(data, np.uint64, m // _WORD, at))
            at += m // 8
        return cls(sizes, bits), at


class FingerprintTable:
    """A perfect hash with, per index, a 64-bit fingerprint, a count and a value."""

    def __init__(self, mph: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray,
                 values: np.ndarray):
        self.mph, self.fingerprints, self.counts, self.values = mph, fingerprints, counts, values

    @classmethod
    def build(cls, keys: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray,
              values: np.ndarray) -> FingerprintTable:
        """``keys`` must be distinct. Counts saturate at 2**32 - 1."""
        keys = np.asarray(keys).view(np.uint64)
        mph = PerfectHash.build(keys)
        order = np.empty(len(keys), dtype=np.int64)
        order[mph.index(keys)] = np.arange(len(keys))
        return cls(mph, np.asarray(fingerprints).view(np.uint64)[order],
                   np.minimum(counts, 2**32 - 1).astype(np.uint32)[order],
                   np.asarray(values, dtype=np.int64)[order])

    def probe(self, keys: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, count, value) per key; count and value are 0 where not found."""
        keys = np.asarray(keys).view(np.uint64)
        if not self.mph.n:
            zero = np.zeros(len(keys), dtype=np.int64)
            return zero.astype(bool), zero, zero
        at = self.mph.index(keys)
        slot = np.maximum(at, 0)
        found = (at >= 0) & (self.fingerprints[slot] == np.asarray(fingerprints).view(np.uint64))
        return found, np.where(found, self.counts[slot], 0), np.where(found, self.values[slot], 0)

    def to_bytes(self) -> bytes:
        return (self.mph.to_bytes() + self.fingerprints.tobytes() + self.values.tobytes()
                + self.counts.tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> FingerprintTable:
        mph, at = PerfectHash.from_bytes(data)
        n = mph.n
        return cls(mph, np.frombuffer(data, np.uint64, n, at),
                   np.frombuffer(data, np.uint32, n, at + 16 * n),
                   np.frombuffer(data, np.int64, n, at + 8 * n))
