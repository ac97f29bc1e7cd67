"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into parts of equal size with few edges
between them. A small neural classifier learns to tell a vector's part. Every vector
goes to the part it is most likely in; a query goes to several of its most probable
parts, where it is compared with every vector in double precision. How many is measured:
as many as bring held-out rows of the sample to TARGET of their nearest in the sample.

Parts are split into blocks of bounded size by a hash, so a part, or one vector with
many copies, is never one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.labelled import first_rows
from tarnbeck.sources.tables import table

NEAREST = 20
SAMPLE = 4096
NEIGHBOURS = 10
#: Vectors for each part, and the bounds of the number of parts, a power of two.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 4000, 32, 256
#: The recall that the number of parts a query looks into is chosen for, over the HELD_OUT
#: nearest of a quarter of the sample. Vectors without clusters need most of the parts.
TARGET = 0.93
HELD_OUT = 10
HIDDEN = 128
STEPS = 100
#: How much of a row's training target is its own part; the rest is where its neighbours are.
OWN = 0.3
BLOCK_ROWS = 8192
QUERY_ROWS = 4096


def usable(vector: Column) -> Column:
    """Not null, zero or holding null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by angle."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        near = unit[a : a + 512] @ unit.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        if k:
            found[a : a + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(graph: np.ndarray, levels: int) -> np.ndarray:
    """2**levels parts of equal size (by one at most) with few edges between them, by halving.

    Each half is first split where the slowest mode of a random walk changes sign most
    evenly, then pairs of rows that have more neighbours on the other side change places.
    """
    n, k = graph.shape
    ends = np.concatenate([np.stack([np.repeat(np.arange(n), k), graph.ravel()]), np.stack([graph.ravel(), np.repeat(np.arange(n), k)])], axis=1)
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(1)
    for _ in range(levels):
        a, b = ends[:, part[ends[0]] == part[ends[1]]]
        degree = np.maximum(np.bincount(a, minlength=n), 1)
        size = np.bincount(part)
        mode = rng.normal(size=n)
        for _ in range(60):
            mode -= (np.bincount(part, mode * degree) / np.bincount(part, degree))[part]
            mode = 0.5 * mode + 0.5 * np.bincount(a, mode[b], n) / degree
            mode /= np.sqrt(np.bincount(part, mode**2) / size + 1e-300)[part]
        order = np.lexsort((mode, part))
        first = np.cumsum(size) - size
        side = np.zeros(n, np.int64)
        side[order] = (np.arange(n) - first[part[order]]) * 2 >= size[part[order]]
        for _ in range(10):
            across = np.bincount(a, side[a] != side[b], n)
            gain = 2 * across - np.bincount(a, minlength=n)
            moved = 0
            for p in range(len(size)):
                sides = [np.flatnonzero((part == p) & (side == s)) for s in (0, 1)]
                best = [m[np.argsort(-gain[m], kind="stable")] for m in sides]
                pairs = min(map(len, best))
                worth = np.flatnonzero(gain[best[0][:pairs]] + gain[best[1][:pairs]] > 0)
                # Half of them at a time: rows that change places change their neighbours' gains.
                pairs = (len(worth) + 1) // 2
                side[best[0][:pairs]], side[best[1][:pairs]] = 1, 0
                moved += pairs
            if not moved:
                break
        part = part * 2 + side
    return part


def train(x: np.ndarray, part: np.ndarray, graph: np.ndarray, n_parts: int) -> list[np.ndarray]:
    """One hidden layer and a softmax over the parts of a row and its neighbours, by Adam over the whole sample."""
    rng = np.random.default_rng(2)
    scale = np.array([1.0 / max(np.sqrt(np.mean(x**2)), 1e-300)])
    x = x * scale
    params = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, n_parts)), np.zeros(n_parts),
    ]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    shares = np.zeros((len(x), n_parts))
    np.add.at(shares, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
    target = OWN * np.eye(n_parts)[part] + (1 - OWN) * shares / max(graph.shape[1], 1)
    for step in range(1, STEPS + 1):
        w1, b1, w2, b2 = params
        hidden = np.maximum(x @ w1 + b1, 0)
        logits = hidden @ w2 + b2
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - target) / len(x)
        back = (error @ w2.T) * (hidden > 0)
        grads = (x.T @ back + 1e-3 * w1, back.sum(axis=0), hidden.T @ error + 1e-3 * w2, error.sum(axis=0))
        for i, (g, (m, v)) in enumerate(zip(grads, moments, strict=True)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[i] = params[i] - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return [scale, *params]


def parts_by_probability(x: np.ndarray, model: list[np.ndarray], n: int) -> np.ndarray:
    """The n most probable parts of each row, most probable first."""
    scale, w1, b1, w2, b2 = model
    logits = np.maximum((x * scale) @ w1 + b1, 0) @ w2 + b2
    return np.argsort(-logits, axis=1, kind="stable")[:, :n]


def fit(x: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray]:
    """A classifier of 2**levels parts, and the recall of held-out rows when 1, 2, ... parts are looked into.

    The model is fitted on three quarters of the rows, so that the recall is that of rows it has not seen.
    """
    n_parts = 1 << levels
    known = x[np.arange(len(x)) % 4 != 0] if levels else x
    graph = neighbour_graph(known, min(2 * NEIGHBOURS, len(known) - 1))
    part = balanced_parts(graph, levels) if levels else np.zeros(len(known), np.int64)
    model = train(known, part, graph, n_parts)
    if not levels:
        return model, np.ones(1)
    asked = np.flatnonzero(np.arange(len(x)) % 4 == 0)
    ranking = parts_by_probability(x[asked], model, n_parts)
    home = parts_by_probability(x, model, 1)[:, 0]
    product = x[asked] @ x.T
    product[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-product, min(HELD_OUT, len(x) - 1) - 1, axis=1)[:, :HELD_OUT]
    place = np.argsort(ranking, axis=1)
    rank = np.take_along_axis(place, home[near], axis=1)
    return model, np.cumsum(np.bincount(rank.ravel(), minlength=n_parts)) / rank.size


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _places(new: np.ndarray) -> np.ndarray:
    """The place of each row in its run, by where a new run begins after the first row."""
    edge = np.concatenate([[0], np.flatnonzero(new) + 1])
    row = np.arange(len(new) + 1)
    return row - edge[np.searchsorted(edge, row, side="right") - 1]


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """For each query the k rows of largest inner product but its own id: query numbers, ids, scores."""
    # Of rows with the same vector and id only k can be among the nearest. Of those with the
    # same vector the 2 k of smallest ids have k besides any query's own.
    keys = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel()
    _, kind = np.unique(keys, return_inverse=True)
    order = np.lexsort((ids, kind))
    repeat = _places((np.diff(kind[order]) != 0) | (np.diff(ids[order]) != 0))
    order = order[repeat < k]
    order = order[_places(np.diff(kind[order]) != 0) < 2 * k]
    # An id may have several vectors: so many of the nearest may be a query's own.
    once = order[_places((np.diff(kind[order]) != 0) | (np.diff(ids[order]) != 0)) == 0]
    own = np.unique(ids[once][np.isin(ids[once], query_ids)], return_counts=True)[1].max(initial=1)
    start = np.flatnonzero(np.concatenate([[True], np.diff(kind[order]) != 0]))
    size = np.diff(np.append(start, len(order)))
    distinct = rows[order[start]]
    out = []
    for a in range(0, len(queries), 256):
        q = queries[a : a + 256]
        product = q @ distinct.T
        most = min(k + own, len(distinct))
        least = np.partition(product, len(distinct) - most, axis=1)[:, len(distinct) - most]
        # Sums in another order differ in the last digits; the margin lets none of them decide.
        margin = 1e-9 * np.abs(q).sum(axis=1) * np.abs(distinct).max(initial=0)
        qi, di = np.nonzero(product >= (least - margin)[:, None])
        score = np.einsum("ij,ij->i", q[qi], distinct[di])
        n = size[di]
        at = np.repeat(start[di], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        qi, score, found = np.repeat(qi, n), np.repeat(score, n), ids[order[at]]
        other = found != query_ids[a + qi]
        qi, score, found = qi[other], score[other], found[other]
        by = np.lexsort((found, -score, qi))
        qi, score, found = qi[by], score[by], found[by]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = place < k
        out.append((a + qi[keep], found[keep], score[keep]))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(c) for c in zip(none, *out, strict=True))


def search(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, sample: int = SAMPLE, probes: int | None = None
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query row among all other rows.

    Nearest is the largest inner product, ties to the smaller vec_id. Rows take part
    whose vec_id is not null and whose vector is not null, not zero and has neither null
    nor non-finite components; if lengths differ, those of the commonest length. Rows
    that repeat a vec_id are candidates each, but never of that id's own query; those
    that repeat a query's vector too are one query. With
    fewer than k candidates all those found are returned; empty tables give none. The
    index is fitted on at most `sample` rows, the first by a hash of the id; all rows
    are indexed. A query looks into `probes` parts, by default as many as TARGET says.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("query"))
    widths = rows.groupBy(F.size("embedding").alias("width")).count()
    common = widths.orderBy(F.desc("count"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    width, total = common
    rows = rows.where(F.size("embedding") == width)
    taken = first_rows(rows, F.xxhash64("vec_id"), sample, total).select("embedding").toArrow()
    x = np.unique(_matrix(taken.column("embedding"), width), axis=0)
    x = x[np.random.default_rng(4).permutation(len(x))]
    levels = max(0, int(np.log2(min(MOST_PARTS, max(LEAST_PARTS, total // PART_ROWS)))))
    levels = min(levels, int(np.log2(max(len(x) // (4 * NEIGHBOURS), 1))))
    n_parts = 1 << levels
    fitted, recall = fit(x, levels)
    model = spark.sparkContext.broadcast(fitted)
    probes = probes or min(int(np.searchsorted(recall, TARGET)) + 1, n_parts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = parts_by_probability(_matrix(batch.column("embedding"), width), model.value, probes)
            parts = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * probes, pa.int32()), pa.array(found.ravel(), pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "embedding", "query")), parts],
                names=["vec_id", "embedding", "query", "parts"],
            )

    types = dict(rows.dtypes)
    placed = rows.mapInArrow(
        place, f"vec_id long, embedding {types['embedding']}, query boolean, parts array<int>"
    )
    # One row for each part: how many blocks its vectors and its queries are split into.
    sizes = placed.select(F.posexplode("parts").alias("place", "part"), "query").groupBy("part").agg(
        F.sum(F.when(F.col("place") == 0, 1).otherwise(0)).alias("n"), F.sum(F.col("query").cast("int")).alias("q")
    )
    blocks, query_blocks = [1] * n_parts, [1] * n_parts
    for p, n, q in sizes.collect():
        blocks[p], query_blocks[p] = max(1, -(-n // BLOCK_ROWS)), max(1, -(-q // QUERY_ROWS))

    def count(of: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, of)), F.col("part") + 1)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    mine = F.xxhash64("vec_id")
    candidates = (
        placed.select("vec_id", "embedding", F.element_at("parts", 1).alias("part"))
        .withColumn("block", F.pmod(mine, count(blocks)).cast("int"))
        .withColumn("query_block", every(count(query_blocks)))
    )
    queries = (
        placed.where("query")
        .dropDuplicates(["vec_id", "embedding"])
        .select("vec_id", "embedding", F.explode("parts").alias("part"))
        .withColumn("query_block", F.pmod(mine, count(query_blocks)).cast("int"))
        .withColumn("block", every(count(blocks)))
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q, found, score = nearest(
            _matrix(left.column("embedding"), width),
            left.column("vec_id").to_numpy(),
            _matrix(right.column("embedding"), width),
            right.column("vec_id").to_numpy(),
            k,
        ) if left.num_rows and right.num_rows else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        ids = left.column("vec_id").to_numpy() if left.num_rows else np.zeros(0, np.int64)
        return pa.table({"query_id": pa.array(ids[q], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})

    keys = ("part", "block", "query_block")
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        compare, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
