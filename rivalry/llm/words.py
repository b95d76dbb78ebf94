"""Words of texts as 64-bit numbers, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Multiplier of the rolling hash, odd and large; fixed value.
STEP = 0x9E3779B97F4A7C15

#: Entries a task keeps in its cache of word hashes.
CACHE = 300_000


class WordNumbers(dict):
    """Hash of each word, remembered; forgets all when :data:`CACHE` entries are reached."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text; bytes.split knows just these separators."""
    return text.split() if text else []


def rolling(numbers: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive numbers, spread over 64 bits.

    The polynomial is put together from windows of doubling length.
    """
    count = len(numbers) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    power, piece, size = STEP, numbers, 1
    total, done = np.zeros(count, np.uint64), 0
    while width >> (size.bit_length() - 1):
        if width & size:
            total = total * np.uint64(power) + piece[done : done + count]
            done += size
        if size * 2 <= width:
            piece = piece[:-size] * np.uint64(power) + piece[size:]
            power = power * power % 2**64
        size *= 2
    return mix(total)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A text column as bytes, without decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def starts(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def spans(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
