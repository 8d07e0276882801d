"""Word shingles of whole texts as sets of 64-bit hashes, made batch by batch in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are hashed in one go; a longer document is a slice of its own.
SLICE = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A number for each byte, A-Z as a-z.
_LETTER = mix(np.arange(256, dtype=np.uint64) + np.array([32 if 65 <= b <= 90 else 0 for b in range(256)], np.uint64))
_PLACE = mix(np.arange(1 << 10, dtype=np.uint64) + np.uint64(1 << 32)) | np.uint64(1)
_BASE = 0xD1342543DE82EF95
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base, and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < count:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(count, base, np.uint64)
            step[0] = 1
            _POWERS[i] = np.cumprod(step, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of runs of rows."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the row it stands in."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~_SPACE[data]
    opens = inside & ~np.append(False, inside[:-1])
    closes = inside & ~np.append(inside[1:], False)
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTER[data] * up[: len(data)], dtype=np.uint64)])
    hashes = mix((sums[end] - sums[start]) * down[start] + mix((end - start).astype(np.uint64)))
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A text of fewer words has its whole sequence as one shingle; null, empty and blank
    texts have none. Words are runs of bytes other than blanks, A-Z lower-cased.
    """
    for _, data, offsets in _slices(texts):
        hashes, row = _words(data, offsets)
        bounds = np.searchsorted(row, np.arange(len(offsets)))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            count = min(words, hi - lo)
            if not count:
                yield np.empty(0, np.uint64)
                continue
            span = hi - lo - count + 1
            total = np.full(span, count, np.uint64)
            for i in range(count):
                total += hashes[lo + i : lo + i + span] * _PLACE[i]
            yield np.unique(mix(total))
