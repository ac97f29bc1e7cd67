"""A count-min sketch of 64-bit hashes, counted by tasks and merged by Spark.

It has ROWS rows of cells and keeps for each cell only whether its count is at least one
and at least two, which is all that a search for repeats asks. A hash is estimated
repeated if its cell in every row is. Counts only ever add up, so a repeated hash is never
missed; a cell that two different hashes share makes an estimate too high, never too low.

A task folds all its hashes into one pair of bit arrays. These are merged in two steps,
each over a sorted stream that holds the pair of one slice of cells. So what a task holds
is bounded by the sketch's size, which is a parameter and does not grow with the data.
With more data than cells more hashes are estimated repeated, and the exact pass after it
has more to do.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 2
#: Cells are merged in slices of so many bits of their number.
SLICE_BITS = 22
#: Streams that a slice's first merge is dealt over.
STREAMS = 256
_U64 = np.uint64


def cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each hash in each row: different bits of it."""
    mask = _U64((1 << bits) - 1)
    return [(hashes & mask).astype(np.uint32), ((hashes >> _U64(64 - bits)) & mask).astype(np.uint32)]


class Counts:
    """For each cell of some slice whether it was counted once and more often, as bit arrays."""

    def __init__(self, bits: int):
        self.once = np.zeros(max((1 << bits) >> 3, 1), np.uint8)
        self.twice = np.zeros_like(self.once)

    def count(self, cell: np.ndarray) -> None:
        if not len(cell):
            return
        cell = np.sort(cell)
        new = np.ones(len(cell), bool)
        new[1:] = cell[1:] != cell[:-1]
        for distinct, again in ((cell[new], False), (np.unique(cell[~new]), True)):
            if not len(distinct):
                continue
            byte = distinct >> 3
            start = np.flatnonzero(np.diff(byte.astype(np.int64), prepend=-1))
            value = np.bitwise_or.reduceat(np.uint8(1) << (7 - (distinct & 7)).astype(np.uint8), start)
            byte = byte[start]
            self.twice[byte] |= value if again else self.once[byte] & value
            self.once[byte] |= value

    def add(self, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice |= twice | (self.once & once)
        self.once |= once


def _pack(bitmap: np.ndarray) -> bytes:
    """The bytes that are not zero with the gaps before them, compressed."""
    used = np.flatnonzero(bitmap)
    gaps = np.diff(used, prepend=0)
    kind = 1 if gaps.max(initial=0) < 1 << 8 else 2 if gaps.max(initial=0) < 1 << 16 else 4
    return bytes([kind]) + zlib.compress(gaps.astype(f"<u{kind}").tobytes() + bitmap[used].tobytes(), 1)


def _unpack(packed: bytes, size: int) -> np.ndarray:
    kind, data = packed[0], zlib.decompress(packed[1:])
    n = len(data) // (kind + 1)
    out = np.zeros(size, np.uint8)
    out[np.cumsum(np.frombuffer(data, f"<u{kind}", n).astype(np.int64))] = np.frombuffer(data, np.uint8, n, n * kind)
    return out


def repeated_cells(
    rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, least: int = 2
) -> Broadcast:
    """For each row of the sketch a bit array of the cells that at least two, or `least` one, of the hashes fall in.

    `hashes_of` gives the hashes of a batch in parts of any size.
    """
    slice_bits = min(SLICE_BITS, bits)
    size = max((1 << slice_bits) >> 3, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [Counts(bits) for _ in range(ROWS)]
        for batch in batches:
            for hashes in hashes_of(batch):
                for counts, cell in zip(mine, cells(hashes, bits), strict=True):
                    counts.count(cell)
        for row, counts in enumerate(mine):
            for k, at in enumerate(range(0, len(counts.once), size)):
                once = counts.once[at : at + size]
                if once.any():
                    yield _packed(row << 32 | k, once, counts.twice[at : at + size])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums up the rows of each slice, which follow each other."""
        number, total = None, Counts(slice_bits)
        for batch in batches:
            for k, once, twice in zip(*(batch.column(c) for c in ("slice", "once", "twice")), strict=True):
                if k.as_py() != number:
                    if number is not None:
                        yield _packed(number, total.once, total.twice)
                    number, total = k.as_py(), Counts(slice_bits)
                total.add(_unpack(once.as_py(), size), _unpack(twice.as_py(), size))
        if number is not None:
            yield _packed(number, total.once, total.twice)

    schema = "slice long, once binary, twice binary"
    counted = rows.mapInArrow(count, schema).withColumn("stream", F.spark_partition_id() % STREAMS)
    some = counted.repartition("slice", "stream").sortWithinPartitions("slice").drop("stream").mapInArrow(merge, schema)
    merged = some.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, schema)
    bitmaps = [np.zeros(1 << max(bits - 3, 0), np.uint8) for _ in range(ROWS)]
    for number, packed in merged.select("slice", "twice" if least == 2 else "once").collect():
        row, k = number >> 32, number & 0xFFFFFFFF
        bitmaps[row][k * size : (k + 1) * size] = _unpack(packed, size)
    return rows.sparkSession.sparkContext.broadcast(bitmaps)


def _packed(number: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([_pack(once)], pa.binary()), pa.array([_pack(twice)], pa.binary())],
        names=["slice", "once", "twice"],
    )


def estimated_repeated(hashes: np.ndarray, bitmaps: list[np.ndarray], bits: int) -> np.ndarray:
    """For each hash whether its cells in all rows hold at least two, or what the bit arrays were made for."""
    found = np.ones(len(hashes), bool)
    for bitmap, cell in zip(bitmaps, cells(hashes, bits), strict=True):
        cell = cell.astype(np.int64)
        found &= (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return found
