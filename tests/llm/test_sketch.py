"""The sketch against counting, and what its tasks hold."""

from collections import Counter

import numpy as np
import pytest

from tarnbeck.llm import sketch
from tarnbeck.llm.sketch import ROWS, Counts, cells, estimated_repeated, repeated_cells


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for share in (0, 0.001, 0.3, 1):
        bitmap = (rng.integers(1, 256, 4096) * (rng.random(4096) < share)).astype(np.uint8)
        assert (sketch._unpack(sketch._pack(bitmap), 4096) == bitmap).all()


@pytest.mark.parametrize("bits", [3, 10, 24])
def test_sketch_is_the_count_of_cells(spark, monkeypatch, bits):
    monkeypatch.setattr(sketch, "SLICE_BITS", 8)
    rng = np.random.default_rng(bits)
    hashes = rng.integers(0, 1 << 63, 300, np.uint64)
    hashes = np.concatenate([hashes, hashes[:40], rng.integers(0, 1 << 63, 50, np.uint64)])
    rows = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long").repartition(7)

    def parts(batch):
        values = batch.column("h").to_numpy().view(np.uint64)
        yield values[: len(values) // 2]
        yield values[len(values) // 2 :]

    found = repeated_cells(rows, parts, bits).value
    for bitmap, cell in zip(found, cells(hashes, bits), strict=True):
        count = Counter(cell.tolist())
        set_bits = set(np.flatnonzero(np.unpackbits(bitmap)).tolist())
        assert set_bits == {c for c, n in count.items() if n > 1}
    assert estimated_repeated(hashes[:40], found, bits).all()


def test_a_task_holds_no_more_for_more_rows(spark, monkeypatch):
    """One pair of bit arrays for each row of the sketch and task, whatever the number of hashes."""
    made = []
    monkeypatch.setattr(Counts, "__init__", lambda self, bits, old=Counts.__init__: (made.append(bits), old(self, bits))[1])
    mine = [Counts(10) for _ in range(ROWS)]
    for _ in range(50):
        for counts, cell in zip(mine, cells(np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64), 10), strict=True):
            counts.count(cell)
    assert len(made) == ROWS and sum(c.once.nbytes + c.twice.nbytes for c in mine) == ROWS * 2 * 128
    empty = spark.createDataFrame([], "h long")
    assert not any(b.any() for b in repeated_cells(empty, lambda batch: iter([np.zeros(0, np.uint64)]), 10).value)
