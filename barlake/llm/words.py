"""Words of a text as 64-bit hashes, and packed arrays that travel through a shuffle."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

# Odd multipliers of the polynomial over word hashes, and those of the finishing mix.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


class WordHashes(dict):
    """Hash of each word; remembers the first ``limit`` distinct words of a task."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.

        ``bytes.lower`` and ``bytes.split`` know ASCII only, which is that rule.
        """
        words = text.lower().split() if text else ()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(MIX[0])
    out ^= out >> np.uint64(33)
    out *= np.uint64(MIX[1])
    return out ^ (out >> np.uint64(33))


def sequence_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbouring ids."""
    count = len(ids) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total *= np.uint64(MULTIPLIERS[0])
        total += ids[k : k + count] * np.uint64(MULTIPLIERS[1])
    return mix(total)


def pieces(batch, most: int = 1 << 20):
    """(key, text) rows of an Arrow batch in slices of about ``most`` text bytes."""
    keys, texts = batch.column(0), batch.column(1)
    rows, size = [], 0
    for k, t in zip(keys.to_pylist(), texts):
        t = t.as_py()
        rows.append((k, t))
        size += len(t or b"")
        if size >= most:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def by_bucket(bucket: np.ndarray):
    """(bucket, positions) for each distinct value, in order of the value."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, ends):
        if len(part):
            yield int(bucket[part[0]]), part


def pack(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def unpack(column, kind) -> np.ndarray:
    """The arrays in a column of binaries, one after another."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.empty(0, kind)
