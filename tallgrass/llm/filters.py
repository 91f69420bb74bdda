"""Broadcast filters of hashed keys, and sums of arrays over tasks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import mix

#: Bits for a key, how many of them it sets, and the least and most bits of a filter: 8 kB to 32 MB.
BITS_A_KEY = 10
SETS = 4
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
BLOCK = 1 << 13
#: Blocks of a ``twice_filter``, by the first 12 bits of a hash.
BLOCKS = 1 << 12
_ODD = np.uint64(0x85EBCA77C2B2AE63)
_STEPS = [np.uint64(k * 0x85EBCA77C2B2AE63 % (1 << 64)) for k in range(SETS)]


def blocks_of(array: np.ndarray) -> pa.RecordBatch:
    """The blocks of an array that are not all zero, compressed."""
    parts = array.reshape(-1, BLOCK)
    on = np.flatnonzero(parts.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in on], pa.binary())], ["block", "part"])


def _added(combine: Callable, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch["block"].to_pylist(), batch["part"].to_pylist(), strict=True):
                got = np.frombuffer(zlib.decompress(c), kind)
                total[i] = combine(total[i], got) if i in total else got.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())], ["block", "part"])

    return run


def gathered(parts: DataFrame, size: int, combine: Callable, kind: type) -> np.ndarray:
    """Combine per-task arrays of a fixed size, block by block in tasks; the driver gets one array of that size."""
    tasks = min(size // BLOCK, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros(size, kind)
    for row in parts.repartition(tasks, "block").mapInArrow(_added(combine, kind), "block int, part binary").collect():  # as many blocks as the array has
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(bytes(row["part"])), kind)
    return out


def _places(keys: np.ndarray, n_bits: int) -> np.ndarray:
    return (mix(keys * _ODD) >> np.uint64(64 - (n_bits.bit_length() - 1))).astype(np.int64)


def _all_places(keys: np.ndarray, n_bits: int) -> Iterator[np.ndarray]:
    """The places that a key sets, one array after the other."""
    for step in _STEPS:
        yield _places(keys + step, n_bits)


def _on(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def has_key(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a ``key_filter`` lets keys pass."""
    out = np.ones(len(keys), bool)
    for at in _all_places(keys, len(bits) * 8):
        out &= _on(bits, at)
    return out


def has_twice(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a ``twice_filter`` lets keys pass."""
    block, rest = _parted(keys)
    shift = np.uint64((len(bits) * 8 // BLOCKS).bit_length() - 1)
    out = np.ones(len(keys), bool)
    for at in _block_places(rest, len(bits) * 8 // BLOCKS):
        out &= _on(bits, ((block << shift) | at).astype(np.int64))
    return out


def _parted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of a key, and the 32 bits by which keys of a block are told apart."""
    h = mix(keys * _ODD)
    return h >> np.uint64(52), (h >> np.uint64(20)) & np.uint64(0xFFFFFFFF)


def _block_places(rest: np.ndarray, n_bits: int) -> Iterator[np.ndarray]:
    """The places that a key sets in its block of ``n_bits`` bits."""
    for step in _STEPS:
        yield mix(rest + step) >> np.uint64(64 - (n_bits.bit_length() - 1))


def _bit_rows(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(n_bits, bool)
        for batch in batches:
            with np.errstate(over="ignore"):
                for at in _all_places(batch["key"].to_numpy().astype(np.int64).view(np.uint64), n_bits):
                    on[at] = True
        yield blocks_of(np.packbits(on, bitorder="little"))

    return run


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit for the hash of every key of a stored table, with BITS_A_KEY bits for each up to MOST_BITS in all.

    Other keys pass by chance, about one in eighty, and beyond some 10^7 keys ever more: a filter only saves rows that
    a join sorts out afterwards, so results never depend on it and a full filter costs one more shuffle of rows.
    """
    n_bits = LEAST_BITS
    wanted = BITS_A_KEY * keys.count()
    while n_bits < min(wanted, MOST_BITS):
        n_bits *= 2
    return gathered(keys.select(F.col(keys.columns[0]).alias("key")).mapInArrow(_bit_rows(n_bits), "block int, part binary"), n_bits // 8, np.bitwise_or, np.uint8)


def _twice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's numbers by blocks, four bytes each and none more than twice, a row for each block and some 2^21 of them."""
    held: list[np.ndarray] = []
    for batch in batches:
        with np.errstate(over="ignore"):
            block, rest = _parted(batch[0].flatten().to_numpy().astype(np.int64).view(np.uint64))
        held.append((block << np.uint64(32)) | rest)
        if sum(map(len, held)) > 1 << 21:
            yield _by_block(np.concatenate(held))
            held.clear()
    if held:
        yield _by_block(np.concatenate(held))


def _two_each(values: np.ndarray) -> np.ndarray:
    """The values in order, without those that are the third or later of their kind."""
    values = np.sort(values)
    return np.concatenate([values[:2], values[2:][values[2:] != values[:-2]]])


def _by_block(values: np.ndarray) -> pa.RecordBatch:
    values = _two_each(values)
    block = (values >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.diff(block, prepend=-1))
    cut = np.append(first, len(block)).astype(np.int32) * 4
    parts = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(values.astype(np.uint32).tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(block[first]), parts], ["block", "part"])


def _counted_twice(n_bits: int):
    """The bits of a block's numbers that come twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        size, most = 0, 1 << 25
        for batch in batches:
            for block, part in zip(batch["block"].to_pylist(), batch["part"].to_pylist(), strict=True):
                found.setdefault(block, []).append(part)
                size += len(part)
            if size > most:
                for block, parts in found.items():
                    found[block] = [_two_each(np.frombuffer(b"".join(parts), np.uint32)).tobytes()]
                size = sum(len(parts[0]) for parts in found.values())
                most = max(most, 2 * size)
        out: list[tuple[int, bytes]] = []
        for block, parts in found.items():
            values = _two_each(np.frombuffer(b"".join(parts), np.uint32))
            twice = values[1:][values[1:] == values[:-1]].astype(np.uint64)
            if len(twice):
                on = np.zeros(n_bits, bool)
                with np.errstate(over="ignore"):
                    for at in _block_places(twice, n_bits):
                        on[at.astype(np.int64)] = True
                out.append((block, zlib.compress(np.packbits(on, bitorder="little").tobytes(), 1)))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["block", "part"])

    return run


def twice_filter(lists: DataFrame, column: str, total: int) -> np.ndarray:
    """Bits for the hash of every number that the lists hold twice or more, about ``total`` in all; others pass by chance.

    Four bytes a number are shuffled, which with the block tell numbers apart, so that only those held twice take room in
    the filter: BITS_A_KEY bits or more for each up to MOST_BITS in all, whatever the number of those held once. Like
    ``key_filter`` it is bounded, and what it lets through in vain a later aggregate by the number itself sorts out.
    """
    n_bits = LEAST_BITS
    while n_bits < min(BITS_A_KEY * total // 2, MOST_BITS):
        n_bits *= 2
    parts = lists.select(column).mapInArrow(_twice_rows, "block int, part binary")
    tasks = min(BLOCKS, int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = n_bits // 8 // BLOCKS
    out = np.zeros(n_bits // 8, np.uint8)
    for row in parts.repartition(tasks, "block").mapInArrow(_counted_twice(8 * size), "block int, part binary").collect():  # as many blocks as the filter has
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(zlib.decompress(bytes(row["part"])), np.uint8)
    return out
