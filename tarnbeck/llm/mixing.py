"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put in a stable shuffled order and cut into blocks. Block
k of a source of weight w may run from slot floor(k/w) and must end by slot
ceil((k+1)/w). Earliest deadline first among the released blocks then keeps every
source less than one block from its share at every slot.

Weights are whole numbers out of a period. Unless one is given it grows with the slots
and the sources, so that rounding moves no source by more than 1/FINE of a block over all
slots. The order of blocks is worked out on the driver. A block has LEAST_DOCS rows, or
more in a table of over LEAST_DOCS * MOST_SLOTS rows, so that there are never more than
MOST_SLOTS blocks and one for each source: the driver's time and memory grow with the
sources, not with the rows. All work on rows is DataFrame functions.
When a source has no blocks left, its weight is shared out and a new schedule begins.
Nothing is dropped or repeated.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.sources.tables import table

LEAST_DOCS = 16
FINE = 1000
MOST_SLOTS = 250_000
#: Rows that one task orders at a time.
BUCKET_ROWS = 20_000
ADDED = ("mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_position")


def quotas(weights: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Whole numbers that sum to `period`, at least 1 each, by largest remainder."""
    order = sorted(weights, key=lambda s: (s is not None, s or ""))
    if not 0 < len(order) <= period:
        raise ValueError(f"1 to {period} sources can be mixed, not {len(order)}")
    total = sum(weights.values())
    if min(weights.values()) < 0 or total <= 0:
        raise ValueError("weights are to be 0 or more and not all 0")
    spare = period - len(order)
    exact = {s: spare * weights[s] / total for s in order}
    found = {s: 1 + int(exact[s]) for s in order}
    by_rest = sorted(order, key=lambda s: -(exact[s] - int(exact[s])))
    for s in by_rest[: period - sum(found.values())]:
        found[s] += 1
    return found


def schedule(
    blocks: Mapping[str | None, int], weights: Mapping[str | None, float], period: int | None = None
) -> Iterator[tuple[str | None, int, int, int, int]]:
    """Source, block, slot, release and deadline of every block, by slot.

    A phase lasts as long as the same sources have blocks left.
    """
    done = {s: 0 for s, n in blocks.items() if n}
    slot = 0
    while done:
        start, first = slot, dict(done)
        whole = period or FINE * (len(done) + 1) * sum(blocks[s] - k for s, k in done.items())
        mine = {s: weights[s] for s in done}
        quota = quotas(mine if sum(mine.values()) > 0 else dict.fromkeys(done, 1.0), whole)
        order = list(quota)
        waiting = [(0, i, 0) for i in range(len(order))]  # release, source, block
        ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
        while True:
            while waiting and waiting[0][0] <= slot - start:
                release, i, k = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(k + 1) * whole // quota[order[i]]), i, k, release))
            deadline, i, k, release = heapq.heappop(ready)
            s = order[i]
            if done[s] == blocks[s]:  # the first slot that some source cannot fill ends the phase
                break
            yield s, first[s] + k, slot, start + release, start + deadline
            done[s] += 1
            slot += 1
            heapq.heappush(waiting, ((k + 1) * whole // quota[s], i, k + 1))
        done = {s: k for s, k in done.items() if k < blocks[s]}


def _slots(spark: SparkSession, rows: Iterator[tuple]) -> DataFrame:
    """The schedule as a table."""
    names = ("_mix_source", "_mix_block", "mix_slot", "mix_release", "mix_deadline")
    types = pa.schema([(names[0], pa.string()), *((n, pa.int64()) for n in names[1:])])
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True)), types))


def mix(
    documents: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_docs: int | None = None,
    period: int | None = None,
) -> DataFrame:
    """All rows and columns of `documents`, with where each stands in the mixture.

    `weights` gives each source's target; by default the square root of its rows. A
    source without one counts as weight 0. If a `period` is given, weights are rounded to
    parts of it, at least one for each source, so there may be at most as many sources. A
    null source is a source of its own. Counts by source are all that the driver sees. A
    block has `block_docs` rows; by default as many as MOST_SLOTS says. Added columns (an
    older column of that name or one that starts with `_mix_` goes): mix_block, the
    block's number in its source; mix_slot; mix_release and mix_deadline, the slots from
    which and before which it is due; mix_position, by which to sort. A last block may be
    short, so positions can have gaps. Order within a source is by a hash of doc_id;
    repeated rows all stay, next to each other. Texts, null, empty or long, are only
    carried. Deadlines that tie go to the null source, then by name. An empty table gives
    an empty one.
    """
    spark = documents.sparkSession
    documents = documents.drop(*ADDED, *(c for c in documents.columns if c.startswith("_mix_")))
    counts = {r[0]: r[1] for r in documents.groupBy("source").count().collect()}
    target = weights if weights is not None else {s: n**0.5 for s, n in counts.items()}
    block_docs = block_docs or max(LEAST_DOCS, -(-sum(counts.values()) // MOST_SLOTS))
    blocks = {s: -(-n // block_docs) for s, n in counts.items()}
    slots = _slots(spark, schedule(blocks, {s: target.get(s, 0.0) for s in counts}, period))

    # A source of any size is ordered in buckets of its hash, so none is one task's work.
    buckets = max(1, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("mix"))
    rows = documents.withColumns({"_mix_key": key, "_mix_bucket": F.pmod(key, F.lit(buckets))})
    sizes = rows.groupBy("source", "_mix_bucket").agg(F.count("*").alias("_mix_rows"))
    before = F.sum("_mix_rows").over(Window.partitionBy("source").orderBy("_mix_bucket")) - F.col("_mix_rows")
    offsets = sizes.select(F.col("source").alias("_mix_source"), F.col("_mix_bucket").alias("_mix_b"), before.alias("_mix_before"))
    in_bucket = Window.partitionBy("source", "_mix_bucket").orderBy("_mix_key", "doc_id", F.xxhash64("text"))
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    rows = (
        rows.withColumn("_mix_rank", F.row_number().over(in_bucket))
        .join(offsets, same & (F.col("_mix_bucket") == F.col("_mix_b")))
        .withColumn("_mix_sequence", F.col("_mix_before") + F.col("_mix_rank") - 1)
        .withColumn("mix_block", F.expr(f"_mix_sequence div {block_docs}"))
        .drop("_mix_source", "_mix_b", "_mix_bucket", "_mix_key", "_mix_before", "_mix_rank")
    )

    return (
        rows.join(slots, same & (F.col("mix_block") == F.col("_mix_block")))
        .withColumn("mix_position", F.col("mix_slot") * block_docs + F.col("_mix_sequence") % block_docs)
        .select(*documents.columns, *ADDED)
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", *ADDED)
