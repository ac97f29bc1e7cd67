"""Exact top-k search by a bit-sliced index.

Vectors of whole numbers are indexed in blocks of rows: for each component the bits of
all rows of a block at one binary digit are a bitmap, a slice. The scores of a query
against a block come from bitmap arithmetic alone: for each digit of each component of
the query that is one, the component's slices are added in at that digit, by carry-save
adders over whole bitmaps. The scores are then slices themselves. From the most
significant one downward the rows are split into those sure to be among the k first and
those still tied; what is tied after the last slice has equal scores, and the smallest
ids of it make up the k.

Rows stand in order of id in their block, so ties are settled by place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.store import stored
from tarnbeck.sources.tables import table

NEAREST = 5
SCALE = 256
#: Rows of a block of the index, and queries that meet a block in one task.
BLOCK_ROWS = 16_384
QUERY_ROWS = 256
_U64 = np.uint64
#: Bitmaps are lists of 64-bit words of rows.
Slices = np.ndarray


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def finite(vector: Column) -> Column:
    """Not null, and neither null nor non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def to_slices(values: np.ndarray, planes: int) -> Slices:
    """The bits of numbers from 0 on, one column at a time: (columns * planes) bitmaps over the rows."""
    rows, columns = values.shape
    words = -(-rows // 64)
    out = np.zeros((columns * planes, words * 8), np.uint8)
    for c in range(columns):
        bits = (values[:, c] >> np.arange(planes)[:, None]) & 1
        packed = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")
        out[c * planes : (c + 1) * planes, : packed.shape[1]] = packed
    return out.view(_U64)


def added(terms: list[Slices]) -> list[np.ndarray]:
    """The slices of the sum, lowest first, of all bitmaps of each binary digit: three at a time make a sum and a carry."""
    out, carried = [], None
    digit = 0
    while digit < len(terms) or carried is not None:
        rows = terms[digit] if digit < len(terms) else None
        rows = np.concatenate([r for r in (rows, carried) if r is not None]) if rows is not None or carried is not None else rows
        carries = []
        while len(rows) > 1:
            n = len(rows) // 3
            if n:
                a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
                odd = a ^ b
                carries.append((a & b) | (odd & c))
                rows = np.concatenate([odd ^ c, rows[3 * n :]])
            else:
                carries.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
        out.append(rows[0])
        carried = np.concatenate(carries) if carries else None
        digit += 1
    return out


def score_slices(query: np.ndarray, slices: Slices, low: np.ndarray, planes: int) -> tuple[list[np.ndarray], int]:
    """Slices of query x row for each row, and the number to add to what they say. Rows hold value - low."""
    most = (1 << planes) - 1
    by_digit: list[list[np.ndarray]] = []
    # For a negative factor the complement is added: -f * v is f * (most - v) - f * most.
    offset = sum(int(q) * int(x) - (int(-q) * most if q < 0 else 0) for q, x in zip(query.tolist(), low.tolist(), strict=True))
    size = np.array([abs(int(q)) for q in query.tolist()], object)
    digits = max((int(s).bit_length() for s in size), default=0)
    positive = np.array([q > 0 for q in query.tolist()], bool)
    for digit in range(digits):
        on = np.array([s >> digit & 1 for s in size], bool)
        for sign, flip in ((on & positive, False), (on & ~positive, True)):
            columns = np.flatnonzero(sign)
            if not len(columns):
                continue
            for plane in range(planes):
                rows = slices[columns * planes + plane]
                while len(by_digit) <= digit + plane:
                    by_digit.append([])
                by_digit[digit + plane].append(~rows if flip else rows)
    words = slices.shape[1]
    return added([np.concatenate(r) if r else np.zeros((1, words), _U64) for r in by_digit]), offset


def first_rows(slices: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """The places of the k rows of `among` with the highest numbers, ties to the first rows, most significant slice first."""
    sure, tied, n_sure = np.zeros_like(among), among, 0
    for bitmap in reversed(slices):
        ones = tied & bitmap
        n = n_sure + int(np.bitwise_count(ones).sum())
        if n > k:
            tied = ones
        else:  # all of these are among the k
            sure, n_sure, tied = sure | ones, n, tied & ~bitmap
    found = places(sure)
    return np.concatenate([found, places(tied)[: k - len(found)]])


def places(bitmap: np.ndarray) -> np.ndarray:
    word = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[word].view(np.uint8), bitorder="little").reshape(-1, 64)
    row, bit = np.nonzero(bits)
    return word[row] * 64 + bit


class Block:
    """One row of the index, unpacked."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.copies = np.frombuffer(row["copies"], np.int64)
        self.low = np.frombuffer(row["low"], np.int64)
        self.planes = row["planes"]
        self.slices = np.frombuffer(row["slices"], _U64).reshape(len(self.low) * self.planes, -(-len(self.ids) // 64))
        self.every = to_slices(np.ones((len(self.ids), 1), np.int64), 1)[0]

    def nearest(self, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Places and scores of the k rows of other ids with the highest inner product."""
        slices, offset = score_slices(query, self.slices, self.low, self.planes)
        among = self.every.copy()
        a, b = np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, side="right")
        for own in range(a, b):
            among[own >> 6] &= ~(_U64(1) << _U64(own & 63))
        found = first_rows(slices, among, k)
        scores = [offset] * len(found)
        for digit, bitmap in enumerate(slices):
            bits = (bitmap[found >> 6] >> (found & 63).astype(_U64)) & _U64(1)
            scores = [s + (int(b) << digit) for s, b in zip(scores, bits, strict=True)]
        return found, scores


def index(rows: DataFrame) -> DataFrame:
    """One row (width, block, ids, copies, low, planes, slices) for each block of distinct rows (vec_id, v, copies, width, block)."""

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        width = group.column("width")[0].as_py()
        values = group.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), width)
        order = np.lexsort((*values.T, ids))
        low = values.min(axis=0) if width else np.zeros(0, np.int64)
        spread = values - low
        planes = max(int(spread.max(initial=0)).bit_length(), 1)
        return pa.table(
            {
                "width": pa.array([width], pa.int32()),
                "block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                "ids": pa.array([ids[order].tobytes()], pa.binary()),
                "copies": pa.array([group.column("copies").to_numpy()[order].tobytes()], pa.binary()),
                "low": pa.array([low.tobytes()], pa.binary()),
                "planes": pa.array([planes], pa.int32()),
                "slices": pa.array([to_slices(spread[order], planes).tobytes()], pa.binary()),
            }
        )

    schema = "width int, block int, ids binary, copies binary, low binary, planes int, slices binary"
    return rows.groupBy("width", "block").applyInArrow(build, schema)


def top_k(vectors: DataFrame, is_query: Column, k: int = NEAREST, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: the k rows of largest inner product with each query row, exactly.

    Components are floor(scale * x); the score is the whole inner product of those. Rows
    take part whose vec_id is not null and whose vector is not null and has neither null
    nor non-finite components; zero vectors do. A query is compared with the vectors of
    its own length, of all rows but those of its own id. Ties go to the smaller vec_id.
    Rows that repeat a vec_id are candidates each; queries that repeat an id and a vector
    are one. With fewer than k candidates all are returned; an empty table gives an empty
    one. A score that does not fit in 64 bits is an error. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.where(finite(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v"), is_query.alias("query")
    )
    # Equal rows are one from here on, so copies are neither indexed nor compared again.
    rows = rows.groupBy("vec_id", "v").agg(F.count("*").alias("copies"), F.max("query").alias("query"))
    rows = stored(rows.withColumn("width", F.size("v")))
    sizes = rows.groupBy("width").agg(F.count("*").alias("n"), F.sum(F.col("query").cast("int")).alias("q"))
    sizes = sizes.select(
        "width",
        F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("q") / QUERY_ROWS), F.lit(1)).cast("int").alias("batches"),
    )
    rows = rows.join(sizes, "width")
    key = F.xxhash64("vec_id", "v")
    blocks = stored(index(rows.withColumn("block", F.pmod(key, F.col("blocks")).cast("int"))))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    queries = rows.where("query").withColumn("batch", F.pmod(F.xxhash64(key, F.lit(1)), F.col("batches")).cast("int"))
    queries = queries.select("width", "vec_id", "v", "batch", every("blocks").alias("block"))
    # Each batch of queries meets each block once: their numbers bound a task, not the data.
    wanted = blocks.join(sizes.select("width", "batches"), "width").withColumn("batch", every("batches")).drop("batches")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            block = Block(right.to_pylist()[0])
            ids = left.column("vec_id").to_numpy()
            v = left.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            number = left.column("number").to_numpy()
            for query_id, query, mark in zip(ids.tolist(), v, number.tolist(), strict=True):
                place, scores = block.nearest(query, query_id, k)
                for p, score in zip(place.tolist(), scores, strict=True):
                    found.append((query_id, mark, int(block.ids[p]), score, min(int(block.copies[p]), k)))
        columns = list(zip(*found, strict=True)) or [[]] * 5
        names = ("query_id", "number", "vec_id", "score", "copies")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    keys = ("width", "block", "batch")
    queries = queries.withColumn("number", F.xxhash64("v"))
    found = queries.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(
        compare, "query_id long, number long, vec_id long, score long, copies long"
    )
    order = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id")
    found = found.select("query_id", "number", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
    FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
