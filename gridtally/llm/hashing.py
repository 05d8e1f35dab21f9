"""Hashes of words and byte strings, computed for whole batches of texts at once with numpy.

A text's bytes get prefix sums of `table[byte] * base**place` modulo 2**64, so the hash of any of its
substrings is one subtraction and one product, however long the substring is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at a time; every byte takes some 60 bytes of memory meanwhile.
PIECE_BYTES = 1 << 18

_draw = np.random.default_rng(7_541)
BYTE_CODE = _draw.integers(0, 2**64, 256, dtype=np.uint64)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[ord("A") : ord("Z") + 1] = BYTE_CODE[ord("a") : ord("z") + 1]
PLACE_FACTOR = _draw.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, kept from call to call up to a few pieces' length."""
    if len(_powers[base]) < n:
        steps = np.full(n, base & (2**64 - 1), np.uint64)
        steps[0] = 1
        found = np.cumprod(steps, dtype=np.uint64)
        if n > 8 * PIECE_BYTES:
            return found
        _powers[base] = found
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one, so that any of their bits can serve as a hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes of text each, but at least one row.

    What Arrow keeps of freed memory goes back after each batch; a worker would hold it from task to task.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and where each row begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def prefix_sums(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(BASE, len(data) + 1)[:-1], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    back = powers(INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between white space, and each row's first word; words end with their row."""
    inside = ~IS_SPACE[data]
    starting, ending = inside.copy(), inside.copy()
    starting[1:] &= ~inside[:-1]
    ending[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    starting[first], ending[last] = inside[first], inside[last]
    starts = np.flatnonzero(starting)
    return starts, np.flatnonzero(ending) + 1, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words, A-Z in lower case.

    A text of fewer words has its whole sequence as its only element; one without words has none.
    """
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    words = substring_hashes(prefix_sums(data, LOWER_CODE), starts, ends)
    runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        runs += words[i : i + len(runs)] * PLACE_FACTOR[i]
    runs = mix(runs + np.uint64(size))
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        n = high - low
        if n >= size:
            found = np.sort(runs[low : high - size + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif n:
            whole = (words[low:high] * PLACE_FACTOR[:n]).sum(dtype=np.uint64, keepdims=True)
            yield mix(whole + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
