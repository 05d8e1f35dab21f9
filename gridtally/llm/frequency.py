"""Which hashes occur in many rows: exact counts over all data, kept as bitmaps of a fixed size.

Counting rows of single hashes would shuffle a multiple of the input. Instead each task sorts its
hashes, adds up equal ones, and sends one packed array per bucket of the hash space; a bucket's task
adds them up. What comes back to the driver and is broadcast is not the hashes but two bitmaps of 2**26
bits (8 MB each), whatever the input: a hash is looked up by its top bits. A bit may be set by another
hash as well, so readers may use a bitmap only where a false yes costs time and changes no result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 26
# Hashes a task gathers before it adds them up; sorting and packing take some fifty bytes for each.
FLUSH = 1 << 20

Hashes = Callable[[pa.RecordBatch], Iterator[np.ndarray]]


def bucket_bits(rows: int) -> int:
    """Buckets grow with the rows, about a thousand documents each."""
    return min(16, max(8, math.ceil(math.log2(max(rows, 1) / 1000 + 1))))


def _packed(found: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """One row per bucket: its hashes that occur once here, those that occur more often, and how often."""
    values, counts = np.unique(np.concatenate(found) >> np.uint64(32 - bits), return_counts=True)
    cuts = np.searchsorted(values, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(32))
    low = values.astype(np.uint32)
    rows = {"bucket": [], "once": [], "more": [], "counts": []}
    for bucket, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if a < b:
            single = counts[a:b] == 1
            rows["bucket"].append(bucket)
            rows["once"].append(low[a:b][single].tobytes())
            rows["more"].append(low[a:b][~single].tobytes())
            rows["counts"].append(counts[a:b][~single].astype(np.uint32).tobytes())
    return pa.RecordBatch.from_pydict(
        {"bucket": pa.array(rows["bucket"], pa.int32())} | {k: pa.array(rows[k], pa.binary()) for k in ("once", "more", "counts")}
    )


def _slices(bits: int, least: int) -> Callable[[pa.Table], pa.Table]:
    cells = 2 ** (BITMAP_BITS - bits)

    def add_up(table: pa.Table) -> pa.Table:
        once = np.frombuffer(b"".join(table["once"].to_pylist()), np.uint32)
        more = np.frombuffer(b"".join(table["more"].to_pylist()), np.uint32)
        extra = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32)
        values, place = np.unique(np.concatenate((once, more)), return_inverse=True)
        counts = np.bincount(place[: len(once)], minlength=len(values)).astype(np.float64)
        counts += np.bincount(place[len(once) :], weights=extra, minlength=len(values))
        often = float(least)
        while (counts >= often).sum() * 8 > cells:
            often *= 2
        out = {"bucket": pa.array([table["bucket"][0].as_py()], pa.int32())}
        for name, chosen in (("shared", counts >= 2), ("frequent", counts >= often)):
            bitmap = np.zeros(cells, bool)
            bitmap[values[chosen] >> np.uint32(32 - (BITMAP_BITS - bits))] = True
            out[name] = pa.array([np.packbits(bitmap, bitorder="little").tobytes()], pa.binary())
        return pa.table(out)

    return add_up


def frequency_bitmaps(
    df: DataFrame, hashes: Hashes, rows: int, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the hashes that occur in two or more rows, and in `least` or more.

    `hashes` yields each row's distinct 64-bit hashes for a batch. Where more hashes are frequent than
    an eighth of the bitmap can tell apart, `least` doubles for that bucket, so the bitmap never fills up.
    """
    bits = bucket_bits(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for found in hashes(batch):
                waiting.append(found)
                held += len(found)
                if held >= FLUSH:
                    yield _packed(waiting, bits)
                    waiting, held = [], 0
        if held:
            yield _packed(waiting, bits)

    slices = (
        df.mapInArrow(count, "bucket int, once binary, more binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_slices(bits, least), "bucket int, shared binary, frequent binary")
        .toArrow()
    )
    width = 2 ** (BITMAP_BITS - bits) // 8
    out = []
    for name in ("shared", "frequent"):
        bitmap = np.zeros((2**bits, width), np.uint8)
        for bucket, blob in zip(slices["bucket"].to_pylist(), slices[name].to_pylist()):
            bitmap[bucket] = np.frombuffer(blob, np.uint8)
        out.append(bitmap.reshape(-1))
    return out[0], out[1]


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the bitmap's; never no for one that is."""
    cell = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def id_bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size over a column of 64-bit ids, for sieving rows before a shuffle."""
    bits = 10
    cells = 2 ** (BITMAP_BITS - bits)

    def gather(table: pa.Table) -> pa.Table:
        bitmap = np.zeros(cells, bool)
        bitmap[table["cell"].to_numpy()] = True
        blob = np.packbits(bitmap, bitorder="little").tobytes()
        return pa.table({"bucket": table["bucket"][:1].cast(pa.int32()), "blob": pa.array([blob], pa.binary())})

    cell = F.shiftrightunsigned(F.xxhash64(F.col(column).cast("long")), 64 - BITMAP_BITS)
    slices = (
        ids.select(cell.alias("whole"))
        .distinct()
        .select(
            F.shiftright("whole", BITMAP_BITS - bits).cast("int").alias("bucket"),
            F.pmod("whole", F.lit(cells)).alias("cell"),
        )
        .groupBy("bucket")
        .applyInArrow(gather, "bucket int, blob binary")
        .toArrow()
    )
    out = np.zeros((2**bits, cells // 8), np.uint8)
    for bucket, blob in zip(slices["bucket"].to_pylist(), slices["blob"].to_pylist()):
        out[bucket] = np.frombuffer(blob, np.uint8)
    return out.reshape(-1)
