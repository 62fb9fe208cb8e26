"""Vectorised work on whole Arrow columns of texts: word bounds and word hashes without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_RINV = np.uint64(pow(int(_R), -1, 2**64))
_TABLE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes of text handled at once; a longer single text is a piece of its own.
SLICE = 1 << 19


def trim() -> None:
    """Give the worker's freed memory back: workers live on and share their executor's memory with the next stage."""
    pa.default_memory_pool().release_unused()  # Arrow's buffers aren't in libc's heap
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, with a trim() at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        trim()

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i for i < n, kept between calls."""
    if len(_POWERS[0]) < n:
        size = max(n, SLICE + 1)
        for k, r in enumerate((_R, _RINV)):
            p = np.full(size, r, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = the hash of data[i:j] times R**i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(len(data))[0], out=out[1:])
    return out


def gram_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] from its prefix hashes; equal strings have equal hashes wherever they stand."""
    inverse = powers(len(h))[1]
    return mixed((h[end] - h[start]) * inverse[start] + (end - start).astype(np.uint64))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about most bytes of text each."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.cumsum(np.diff(raw(b.column(b.schema.get_field_index(text)))[1]))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield b.slice(at, to - at)
            at = to
    trim()


#: Bytes of words: of the contracts, and of terms, which are letters, digits and all of UTF-8's longer characters.
WORDS = ~_SPACE
TERMS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def bounds(data: np.ndarray, off: np.ndarray, of: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): the words of all texts, and the number of words before each text (one entry more than texts)."""
    inside = of[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads, tails = off[:-1][off[:-1] < off[1:]], off[1:][off[:-1] < off[1:]] - 1
    begin[heads] = inside[heads]
    last[tails] = inside[tails]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(texts: pa.Array, of: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words with A-Z lower-cased, number of words before each text)."""
    data, off = raw(texts)
    data = _FOLD[data]
    start, end, first = bounds(data, off, of)
    return gram_hash(prefix_hash(data), start, end), first


def rows_of(first: np.ndarray) -> np.ndarray:
    """The text's index of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
