"""SimHash near-duplicates by anchor-point covering.

Two fingerprints at most 3 bits apart are at most 1 bit apart in their upper or their
lower half. In 31 bits of each half the Hamming code of that length is the set of
anchors: its covering radius is 1, so every fingerprint has exactly one home anchor
within 1 bit. Each fingerprint is sent to every anchor within 1 + 1 bits (one or 16 of
them) that is a home, so of two fingerprints that link each meets the home of the other,
and pairs are compared at anchors only. Equal fingerprints are one from the start, so
copies cost nothing. An anchor of many fingerprints is compared as a grid: a block of its
home rows with a block of all its rows in each cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.components import components
from tarnbeck.llm.store import stored
from tarnbeck.llm.text import Words, chunked, text_bytes
from tarnbeck.sources.tables import table

SHINGLE_WORDS = 3
SEED = 42
BITS_APART = 3
#: Bits of a half that the code covers, and the checks of a word of that length.
CODE_BITS, CHECKS = 31, 5
#: Rows of an anchor that are compared at a time; in larger anchors as many home rows with as many rows.
ANCHOR_ROWS = 50_000
#: Anchors of up to so many rows are compared row against row, larger ones by spreading links.
FEW = 8


def fingerprint(text: bytes, words: Words, i: int) -> int:
    """Of text i of `words`: a bit is 1 if it is set in over half of the shingles' hashes."""
    first, count = words.first[i], words.count[i]
    if not count:
        return 0
    plain = b" ".join(text.lower().split())
    size = words.end[first : first + count] - words.start[first : first + count]
    start = np.cumsum(size + 1) - size - 1
    last = np.minimum(np.arange(max(count - SHINGLE_WORDS + 1, 1)) + SHINGLE_WORDS, count) - 1
    end = (start + size)[last].tolist()
    ones, n = np.zeros(64, np.int64), len(end)
    starts = start[:n].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 14):
        part = [digest(plain[a:b], SEED) for a, b in zip(starts[at : at + (1 << 14)], end[at : at + (1 << 14)], strict=True)]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int("".join("1" if x else "0" for x in ones * 2 > n), 2)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number, of each row."""
    docs = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, chunk in chunked(text_bytes(batch)):
                words = Words(chunk, folded=True)
                found += [fingerprint(text, words, i) for i, text in enumerate(chunk)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def anchors(half: Column) -> tuple[Column, Column]:
    """The home anchor of 31 bits, and the other anchors within 2 bits, as an array."""
    places = range(1, CODE_BITS + 1)
    checks = [sum(1 << (i - 1) for i in places if i >> j & 1) for j in range(CHECKS)]
    odd = [(F.bit_count(half.bitwiseAND(F.lit(m))) % 2).cast("long") for m in checks]
    wrong = reduce(lambda a, b: a + b, (bit * (1 << j) for j, bit in enumerate(odd)))

    def flip(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))

    home = F.when(wrong == 0, half).otherwise(half.bitwiseXOR(flip(wrong)))
    # Two flips at places whose numbers combine to the failed checks give a code word again.
    pairs = F.filter(
        F.array(*(F.lit(i).cast("long") for i in places)),
        lambda i: (wrong != 0) & (i != wrong) & (i < i.bitwiseXOR(wrong)),
    )
    others = F.transform(pairs, lambda i: half.bitwiseXOR(flip(i)).bitwiseXOR(flip(i.bitwiseXOR(wrong))))
    return home, others


def at_anchors(fps: DataFrame) -> DataFrame:
    """A row (anchor, fp, home) for each fingerprint and anchor that it is sent to."""
    out = []
    for side, shift in enumerate((0, 32)):
        half = F.call_function("shiftrightunsigned", F.col("fp"), F.lit(shift)).bitwiseAND(F.lit((1 << CODE_BITS) - 1))
        home, others = anchors(half)
        out.append(
            fps.select("fp", home.alias("home_anchor"), others.alias("others"))
            .select("fp", "home_anchor", F.explode(F.concat(F.array("home_anchor"), "others")).alias("code"))
            .select(
                (F.col("code") * 2 + side).alias("anchor"), "fp", (F.col("code") == F.col("home_anchor")).alias("home")
            )
        )
    return out[0].unionByName(out[1])


def links_of(cell: np.ndarray, fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at most BITS_APART apart that join what the cells' links join; rows are sorted by cell."""
    edge = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
    size = np.diff(edge)
    few = np.repeat(size <= FEW, size)
    a, b = [], []
    for d in range(1, FEW):
        i = np.flatnonzero(few[:-d] & (cell[:-d] == cell[d:]) & (home[:-d] | home[d:]))
        if not len(i):
            continue
        near = np.bitwise_count(fp[i] ^ fp[i + d]) <= BITS_APART
        a.append(fp[i[near]])
        b.append(fp[i[near] + d])
    for k in np.flatnonzero(size > FEW):
        rest = np.unique(fp[edge[k] : edge[k + 1]])
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                x = reached.pop()
                near = np.bitwise_count(rest ^ x) <= BITS_APART
                if near.any():
                    a.append(np.full(near.sum(), x))
                    b.append(rest[near])
                    reached.extend(rest[near])
                    rest = rest[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _cells_of(sent: DataFrame) -> DataFrame:
    """(anchor, part, fp, home): large anchors in a grid of home blocks and row blocks, others in one part."""
    sizes = sent.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes"))
    large = stored(sizes.where(F.col("n") > ANCHOR_ROWS))
    if large.isEmpty():
        return sent.select("anchor", F.lit(0).cast("long").alias("part"), "fp", "home")
    size = F.lit(ANCHOR_ROWS)
    large = large.select("anchor", F.ceil(F.col("n") / size).alias("rows"), F.ceil(F.col("homes") / size).alias("blocks"))
    sent = sent.join(large, "anchor", "left")
    row, block = (F.pmod(F.xxhash64("fp", F.lit(i)), F.col(c)) for i, c in enumerate(("rows", "blocks")))

    def every(c: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(c) - 1)

    small = sent.where(F.col("rows").isNull()).select("anchor", F.lit(0).cast("long").alias("part"), "fp", "home")
    split = sent.where(F.col("rows").isNotNull())
    as_home = split.where("home").select("anchor", F.explode(F.transform(every("rows"), lambda j: block * F.col("rows") + j)).alias("part"), "fp", "home")
    as_row = split.select(
        "anchor", F.explode(F.transform(every("blocks"), lambda i: i * F.col("rows") + row)).alias("part"), "fp", F.lit(False).alias("home")
    )
    return small.unionByName(as_home).unionByName(as_row)


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all that link."""
    # A few megabytes of fingerprints become many rows, so they are dealt out before.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = at_anchors(fps.repartition(tasks, "fp"))
    homes = every.where("home").select("anchor").distinct()
    cells = _cells_of(stored(every.join(homes, "anchor", "left_semi")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            # Cells are whole but for the last, which the next batch may go on with.
            ends = batch.column("anchor")[0] != batch.column("anchor")[-1] or batch.column("part")[0] != batch.column("part")[-1]
            if ends:
                whole = pa.Table.from_batches(kept)
                done = _last_cell(whole)
                yield from _compared(whole.slice(0, done))
                kept = whole.slice(done).combine_chunks().to_batches()
        if kept:
            yield from _compared(pa.Table.from_batches(kept))

    cells = cells.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return cells.mapInArrow(compare, "a long, b long").distinct()


def _cells(rows: pa.Table) -> np.ndarray:
    anchor, part = rows.column("anchor").to_numpy(), rows.column("part").to_numpy()
    return np.cumsum(np.concatenate([[0], (np.diff(anchor) != 0) | (np.diff(part) != 0)]))


def _last_cell(rows: pa.Table) -> int:
    cell = _cells(rows)
    return int(np.searchsorted(cell, cell[-1]))


def _compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    fp = rows.column("fp").to_numpy().view(np.uint64)
    a, b = links_of(_cells(rows), fp, rows.column("home").to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of the documents linked with it, for each row.

    Null, empty and blank texts have fingerprint zero and link like any other; long texts
    are read whole. Rows that repeat a doc_id are all returned. A null doc_id is never the
    smallest unless no other is there. An empty table gives an empty one. Other columns
    are not read.
    """
    docs = stored(fingerprints(documents))
    distinct = docs.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = stored(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return docs.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
