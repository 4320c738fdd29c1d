"""Sets of word shingles and their MinHash signatures, a text at a time."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
KEPT_WORDS = 500_000
CHUNK = 2048


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words.

    Letters A-Z are lower-cased; words are separated by ASCII white space. A text with fewer
    words is one shingle; one without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > KEPT_WORDS:
        _HASHES.clear()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    mixed = np.full(len(words) - width + 1, np.uint64(len(words) if len(words) < size else size))
    for i in range(width):
        mixed = mixed * _FACTOR + hashes[i:len(words) - width + 1 + i]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_key(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def hash_family(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and addends of ``count`` multiply-shift hashes."""
    draw = np.random.Generator(np.random.PCG64(seed))
    high = np.iinfo(np.uint64).max
    return (draw.integers(0, high, count, np.uint64) | np.uint64(1),
            draw.integers(0, high, count, np.uint64))


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest value of every hash of the family over the set, as 32-bit numbers."""
    factors, addends = (part[:, None] for part in family)
    least = np.full(len(family[0]), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        values = factors * shingles[None, at:at + CHUNK]
        values += addends
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    return len(np.intersect1d(one, other, assume_unique=True))


PARITY_BITS = 4096


def parity(shingles: np.ndarray) -> np.ndarray:
    """A bit per residue class: whether the set has an odd number of members in it, packed.

    The bits in which two sets differ are at most their symmetric difference, so a pair can be
    refused for certain.
    """
    places = (shingles >> np.uint64(40)).astype(np.int64) % PARITY_BITS
    return np.packbits(np.bincount(places, minlength=PARITY_BITS).astype(np.uint8) & 1)


def may_be_alike(sizes, other_sizes, bits: np.ndarray, other_bits: np.ndarray, percent: int) -> np.ndarray:
    """False where sizes and parities rule out that 100 * |intersection| >= percent * |union|."""
    apart = np.bitwise_count(bits ^ other_bits).sum(axis=-1, dtype=np.int64)
    together = sizes + other_sizes
    most = np.minimum((together - apart) // 2, np.minimum(sizes, other_sizes))
    return 100 * most >= percent * (together - most)


def alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union|."""
    both = overlap(one, other)
    return 100 * both >= percent * (len(one) + len(other) - both)
