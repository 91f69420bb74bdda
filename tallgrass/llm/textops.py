"""Vectorised text helpers for use inside tasks: words, hashes and windows over flat byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_RAND = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        m = max(n, 1 << 16)
        _powers.clear()
        for base in (_MULT, _INV):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_RAND[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes give equal hashes wherever they lie."""
    inv = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def spans_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of every span of ``size``, in order of their starts."""
    inv = powers(len(prefix))[1]
    return mix((prefix[size:] - prefix[:-size]) * inv[: len(prefix) - size] + np.uint64(size))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]] if len(off) else data[:0], off - off[0] if len(off) else np.zeros(1, np.int64)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds at most ``most`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = flat(batch.column(batch.schema.get_field_index(text)))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + most, side="right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, which never cross rows, and for each row the number of words before it."""
    n = len(data)
    w = IS_WORD[data]
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = w.copy()
    start[1:] &= ~w[:-1] | first[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with A-Z lower-cased, and for each row the number of words before it."""
    starts, ends, before = word_spans(data, off)
    return span_hash(prefix_hash(LOWER[data]), starts, ends), before


def digests(h: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each run a:b of words, from two independent hashes of every word."""
    out = []
    for words in (h, other):
        prefix = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers(len(words))[0], out=prefix[1:])
        out.append(span_hash(prefix, a, b))
    return out[0], out[1]


def ints(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))
