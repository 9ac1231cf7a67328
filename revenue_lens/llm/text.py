"""Words, shingles and hashes of texts, for use inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE_WORDS = 5
#: Words whose hashes a worker remembers; the memory of a full table is about 40 MB.
REMEMBERED_WORDS = 200_000

# Odd multipliers of the five positions of a shingle; any fixed odd numbers would do.
_POSITION = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, split at space and \\x09-\\x0D, with A-Z in lower case."""
    return text.lower().split() if text else []


def byte_texts(column) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words; forgets all of them when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(hashes: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash per run of ``width`` words, in order; fewer words are one run, no words none."""
    n = len(hashes)
    if n == 0:
        return hashes
    taken = min(width, n)
    total = np.full(n - taken + 1, taken, np.uint64)
    for i in range(taken):
        total += hashes[i : n - taken + 1 + i] * _POSITION[i % len(_POSITION)] + np.uint64(i)
    return mixed(total)
