"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WORD_TABLE = 100_000  # word hashes a worker keeps before it starts its table anew
# fixed values: odd multipliers of the mixing steps
_K1, _K2, _K3, _K4 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hash_of = _WordHashes()


def forget() -> None:
    """Empty the worker's table; tasks call it at their end, for workers go on to other stages."""
    _hash_of.clear()
    pa.default_memory_pool().release_unused()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return text.lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K4
    return (x ^ (x >> np.uint64(29))) * _K1


def shingle_set(text: bytes | None, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, an empty one none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mixed(out * _K2 + h[i : i + n] + _K3)
    return np.unique(out)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed 64-bit integers."""
    d = xxhash.xxh3_128_digest(hashes.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)
