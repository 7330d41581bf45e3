"""Words of a text as arrays: places, hashes, n-gram hashes. Plain helpers for the Arrow batches of the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_random = np.random.RandomState(20240229)
_BYTE = _random.randint(1, 2**63 - 1, 256).astype(U64)
_PLACE = _random.randint(1, 2**63 - 1, 64).astype(U64) * U64(2) + U64(1)
_powers = np.ones(1, U64)
_BASE = U64(0x9E3779B97F4A7C15)


def _class(ranges: list[tuple[int, int]]) -> np.ndarray:
    member = np.ones(256, bool)
    for first, last in ranges:
        member[first : last + 1] = False
    return member


# Bytes of UTF-8 that belong to a word. All bytes beyond ASCII do in both classes, so no code point is cut.
NOT_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; null is empty. Lone surrogates can't occur in Arrow strings."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def word_places(data: bytes, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of member bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = member[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    global _powers
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    longest = int(lengths.max())
    if longest > len(_powers):
        grown = np.full(longest * 2, _BASE, U64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = np.frombuffer(data, np.uint8)[np.repeat(starts, lengths) + place]
    sums = np.add.reduceat(_BYTE[letters] * _powers[place], first)
    return mix(sums + lengths.astype(U64) * _PLACE[0])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; of the whole sequence if it is shorter, none if it is empty."""
    n = min(n, len(words))
    if not n:
        return np.zeros(0, U64)
    return _gathered(words, range(n), len(words) - n + 1)


def skip_hashes(words: np.ndarray, skip: int) -> np.ndarray:
    """Hash of each pair of words with ``skip`` words between them."""
    count = len(words) - skip - 1
    return _gathered(words, (0, skip + 1), count) if count > 0 else np.zeros(0, U64)


def _gathered(words: np.ndarray, offsets, count: int) -> np.ndarray:
    total = np.zeros(count, U64)
    for i in offsets:
        total += words[i : i + count] * _PLACE[1 + i % 63]
    return mix(total + U64(len(offsets)))


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts take about ``most`` bytes, or of one row. Spark counts rows, and thousands of long
    texts with all that is made of them are too much at a time. At the end, memory goes back to the system: the next stage's
    worker may stand beside this one."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        lot = np.cumsum(lengths) // most
        edges = np.flatnonzero(np.r_[True, lot[1:] != lot[:-1], True]) if len(lot) else np.zeros(1, np.int64)
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield batch.slice(first, last - first)
    pa.default_memory_pool().release_unused()
