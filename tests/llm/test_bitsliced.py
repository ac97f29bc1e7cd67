"""Exact top-k by bit slices against whole inner products."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnbeck.llm import bitsliced
from tarnbeck.llm.bitsliced import added, first_rows, places, score_slices, to_slices, top_k


def brute(rows, every, k, scale=256):
    fine = [
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for q, v in sorted({r for r in fine if r[0] % every == 0}):
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in fine if i != q and len(w) == len(v))
        out.update((q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1))
    return out


def test_slices_add_and_select():
    rng = np.random.default_rng(1)
    for rows in (1, 63, 64, 200):
        values = rng.integers(0, 1 << 11, (rows, 7))
        slices = to_slices(values, 11)
        sums = added([slices[d::11] for d in range(11)])
        total = sum(((s[np.arange(rows) >> 6] >> (np.arange(rows) & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << d for d, s in enumerate(sums))
        assert total.tolist() == values.sum(axis=1).tolist()
        query, low = rng.integers(-900, 900, 7), rng.integers(-50, 50, 7)
        found, offset = score_slices(query, slices, low, 11)
        got = sum(((s[np.arange(rows) >> 6] >> (np.arange(rows) & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << d for d, s in enumerate(found))
        want = (values + low) @ query
        assert (got + offset).tolist() == want.tolist()
        every = to_slices(np.ones((rows, 1), np.int64), 1)[0]
        for k in (1, 5, rows, rows + 3):
            best = np.lexsort((np.arange(rows), -want))[:k]
            assert sorted(first_rows(found, every, k)) == sorted(best)
        assert places(every).tolist() == list(range(rows))


@pytest.mark.parametrize("block,batch", [(16_384, 256), (20, 3)])
def test_search_is_the_brute_force(spark, monkeypatch, block, batch):
    """With ties, a hot vector, repeated ids and rows, odd vectors and vectors of other lengths, in small blocks too."""
    monkeypatch.setattr(bitsliced, "BLOCK_ROWS", block)
    monkeypatch.setattr(bitsliced, "QUERY_ROWS", batch)
    rng = random.Random(block)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), float(rng.randint(-1, 1)), 0.25]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5, -0.5, 0.25, 0.0, 1.0, -1.0]) for i in range(300, 400)]
    rows += [(10, rows[10][1])] * 3 + [(20, [1.0] * 6), (20, [1.0] * 6), (21, [9.0] * 6), (21, [8.0] * 6)]
    rows += [(i, [0.0] * 6) for i in range(400, 404)] + [(i, [rng.uniform(-1, 1)] * 3) for i in range(500, 520)] + [(530, []), (531, [])]
    rows += [(1000, None), (1010, [float("nan")] * 6), (1020, [float("inf")] + [1.0] * 5), (1030, [None] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({n: F.lit("x") for n in ("v", "query", "block", "batch", "rank", "width", "copies", "number")}).repartition(5)
    got = Counter(map(tuple, top_k(df, F.col("vec_id") % 10 == 0, k=4).collect()))
    assert got == brute(rows, 10, 4)


def test_search_of_few_or_no_vectors(spark):
    def found(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        return sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect()))

    assert found([]) == [] and found([(0, None)]) == [] and found([(0, [1.0])]) == [] and found([(1, [1.0]), (2, [1.0])]) == []
    assert found([(0, [1.0, -2.0]), (3, [3.0, 4.0]), (2, [3.0, 4.0])]) == [(0, 1, 2, -327680), (0, 2, 3, -327680)]


def test_large_numbers(spark):
    rows = [(i, [(-1.0) ** i * 2.0**14 * (i + 1), 3.5 * i]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect())) == brute(rows, 50, 5)
