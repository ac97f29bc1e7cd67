"""Substring dedup by sorted suffixes, on bytes.

Every string of LENGTH bytes has an anchor: of the GRAM-byte grams in it the one with the
smallest hash. Equal strings have equal anchors at the same place, so suffixes need to be
sorted only against suffixes with the same anchor. Strings that start next to each other
and share their anchor form a stretch, on average 85 of them, and travel as one piece of
text. A count-min sketch of the anchors leaves those at home whose anchor occurs once.

A task sends a stretch to be sorted once, however often it meets it; copies of it are
repeated for certain. Splitters from a sample of leading tokens, the first 8 bytes of
anchors, range-partition the stretches. Each bucket sorts the suffixes of its distinct
stretches by multikey quicksort, 8 bytes a key; those still tied after LENGTH bytes are
repeated. A bucket holds all suffixes of its anchors, so ties never cross its boundary.
The runs of repeated strings found in a stretch are then joined with its places; a second
sketch, of the stretches that have such runs, leaves the places of most others at home.

An anchor found in very many stretches, as a frequent phrase is, would be one task's
work. In those of a sample the strings are dealt out further, by all the bytes that
strings with the anchor at about the same place have in common: HOT_WIDTH bytes less than
a string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.labelled import below
from tarnbeck.llm.sketch import estimated_repeated, repeated_cells
from tarnbeck.llm.store import stored
from tarnbeck.llm.text import BYTE_BASE, Spans, chunked, mix, smallest_places, text_bytes
from tarnbeck.sources.tables import table

LENGTH = 200
GRAM = 32
SKETCH_BITS = 26
#: Leading tokens that splitters are chosen from, and the buckets for each shuffle partition.
SAMPLE_TOKENS = 20_000
BUCKETS_PER_PARTITION = 4
#: Bytes of stretches that are sorted at a time; all of one anchor are sorted together.
SORT_BYTES = 1 << 21
#: Stretches that a task remembers having sent.
SENT = 500_000
#: An anchor with so many different stretches in a SAMPLE_SHARE of the texts is split, and
#: so are at most MOST_HOT anchors; strings whose anchors are so many bytes apart stay together.
HOT_STRETCHES, SAMPLE_SHARE, MOST_HOT, HOT_WIDTH = 2000, 50, 1 << 16, 11


class Stretches:
    """Maximal runs of string starts in some texts that share their anchor."""

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.data = np.frombuffer(b" ".join([*texts, b" " * length]), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        doc_start = np.cumsum(sizes + 1) - sizes - 1
        spans = Spans(self.data, BYTE_BASE)
        grams = spans.all(gram)
        anchor = smallest_places(grams, length - gram + 1)
        n = len(anchor)
        inside = np.zeros(n + 1, np.int64)
        long = sizes >= length
        np.add.at(inside, doc_start[long], 1)
        np.add.at(inside, doc_start[long] + sizes[long] - length + 1, -1)
        starts = np.cumsum(inside[:n]) > 0
        opens = starts.copy()
        opens[1:] &= ~starts[:-1] | (anchor[1:] != anchor[:-1])
        opens[doc_start[long]] = True
        self.first = np.flatnonzero(opens)
        bounds = np.append(self.first, n)
        # A stretch ends before the next one or where its text has no more strings.
        self.doc = np.searchsorted(doc_start, self.first, side="right") - 1
        self.last = np.minimum(bounds[1:] - 1, doc_start[self.doc] + sizes[self.doc] - length)
        self.offset = self.first - doc_start[self.doc]
        self.place = anchor[self.first]
        self.anchor = grams[self.place] if len(self.first) else np.zeros(0, np.uint64)
        self.length = length
        self.spans = spans
        self.token = self.place

    def take(self, rows: np.ndarray) -> None:
        """Only these stretches from here on."""
        for name in ("first", "last", "doc", "offset", "place", "anchor", "token"):
            setattr(self, name, getattr(self, name)[rows])

    def split(self, hot: np.ndarray, gram: int) -> None:
        """Stretches of these anchors in parts, with the bytes common to all strings of a part as their anchor."""
        is_hot = np.isin(self.anchor, hot)
        if not is_hot.any():
            return
        width = HOT_WIDTH
        # How far into its string the anchor is, in steps of `width`.
        low, high = (self.place - self.last) // width, (self.place - self.first) // width
        n = np.where(is_hot, high - low + 1, 1)
        rows = np.repeat(np.arange(len(n)), n)
        step = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first, offset = self.first, self.offset
        self.take(rows)
        is_hot = is_hot[rows]
        latest = self.place - step * width
        self.first = np.where(is_hot, np.maximum(self.first, latest - width + 1), self.first)
        self.last = np.where(is_hot, np.minimum(self.last, latest), self.last)
        self.offset = offset[rows] + self.first - first[rows]
        part = np.flatnonzero(is_hot)
        self.anchor[part] = self.spans.of(latest[part], latest[part] - width + 1 + self.length)
        self.token = np.where(is_hot, latest, self.token)

    def content(self) -> np.ndarray:
        """A hash of the text of each stretch; not a weighted sum, in which regular patterns may cancel out."""
        raw, digest = self.data.tobytes(), xxhash.xxh64_intdigest
        ends = (self.last + self.length).tolist()
        return np.array([digest(raw[a:b]) for a, b in zip(self.first.tolist(), ends, strict=True)], np.uint64)

    def tokens(self) -> np.ndarray:
        return leading(self.data)[self.token]


def leading(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number that sorts like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)


def tied(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix equals another of its group in the first `length` bytes, by multikey quicksort."""
    token = leading(data)
    rank, active = group.copy(), np.arange(len(start))
    for depth in [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else []):
        key = token[start[active] + depth]
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        new = np.ones(len(active), bool)
        new[1:] = (key[1:] != key[:-1]) | (rank[active[1:]] != rank[active[:-1]])
        part = np.cumsum(new) - 1
        rank[active] = part
        # A part of one suffix is settled; only ties go on to the next key.
        active = active[np.bincount(part, minlength=1)[part] > 1]
        if not len(active):
            break
    found = np.zeros(len(start), bool)
    found[active] = True
    return found


def repeated_runs(anchor: np.ndarray, whole: np.ndarray, text: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and first and last places in them of runs of repeated strings; rows are distinct stretches, sorted by anchor.

    `whole` stretches are known to be repeated.
    """
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    group = np.cumsum(new) - 1
    rows = np.flatnonzero(whole)
    lows, highs = np.zeros(len(rows), np.int64), pc.binary_length(text).to_numpy()[rows].astype(np.int64) - length
    # Stretches that occur once may still share strings with others of their anchor.
    shared = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if len(group) else rows[:0]
    if not len(shared):
        return rows, lows, highs
    values = text.take(pa.array(shared)).to_pylist()
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    begin = np.cumsum(sizes) - sizes
    n_starts = sizes - length + 1
    piece = np.repeat(np.arange(len(shared)), n_starts)
    local = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
    data = np.frombuffer(b"".join(values), np.uint8)
    hit = tied(data, begin[piece] + local, group[shared][piece], length) & ~whole[shared][piece]
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    # Runs do not go on from one stretch into the next.
    inner = np.flatnonzero(hit[1:] & hit[:-1] & (piece[1:] != piece[:-1])) + 1
    low = np.sort(np.concatenate([np.flatnonzero(edge == 1), inner]))
    high = np.sort(np.concatenate([np.flatnonzero(edge == -1), inner])) - 1
    return np.concatenate([rows, shared[piece[low]]]), np.concatenate([lows, local[low]]), np.concatenate([highs, local[high]])


def _distinct(rows: pa.Table) -> pa.Table:
    """One row for each anchor and content of rows sorted by them: whether it is repeated, and its text."""
    anchor, content = (rows.column(c).to_numpy() for c in ("anchor", "content"))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    kind = np.cumsum(new) - 1
    whole = np.bincount(kind, 1 + rows.column("whole").to_numpy()) > 1
    text = rows.column("stretch").combine_chunks()
    has = np.flatnonzero(text.is_valid().to_numpy(zero_copy_only=False))
    at = np.zeros(len(whole), np.int64)
    at[kind[has]] = has
    first = np.flatnonzero(new)
    columns = {"anchor": pa.array(anchor[first]), "content": pa.array(content[first]), "whole": pa.array(whole)}
    return pa.table({**columns, "stretch": text.take(pa.array(at))})


def sorted_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """anchor, content, low and high of runs of repeated strings, from rows sorted by anchor and content.

    What is held are the distinct stretches of one anchor, or SORT_BYTES of several.
    """

    def runs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        anchor = rows.column("anchor").to_numpy()
        row, low, high = repeated_runs(anchor, rows.column("whole").to_numpy(), rows.column("stretch").combine_chunks(), length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[row]), pa.array(rows.column("content").to_numpy()[row]), pa.array(low), pa.array(high)],
            names=["anchor", "content", "low", "high"],
        )

    kept: list[pa.RecordBatch] = []
    size, limit = 0, SORT_BYTES
    for batch in batches:
        batch = batch.select(["anchor", "content", "whole", "stretch"])
        for at in range(0, batch.num_rows, 1024):
            kept.append(batch.slice(at, 1024))
            size += kept[-1].nbytes
            if size < limit:
                continue
            rows = _distinct(pa.Table.from_batches(kept))
            anchor = rows.column("anchor").to_numpy()
            done = int(np.searchsorted(anchor, anchor[-1]))
            if done:
                yield from runs(rows.slice(0, done))
            kept = rows.slice(done).combine_chunks().to_batches()
            size = sum(b.nbytes for b in kept)
            limit = max(SORT_BYTES, 2 * size)
    if kept:
        yield from runs(_distinct(pa.Table.from_batches(kept)))


def repeated_strings(
    documents: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    bits: int = SKETCH_BITS,
    hot_stretches: int = HOT_STRETCHES,
) -> DataFrame:
    """doc_id, n_bytes, `kept`, the bytes left, and `spans`, the maximal removed runs, for each row.

    A byte goes if a string of `length` bytes over it also starts anywhere else, in the
    same text or another; strings never cross texts, overlapping ones count, and they are
    judged on the input. A null text is empty; empty texts and those shorter than a
    string stay as they are, long ones are read whole. Every row counts as a text of its
    own, so repeated rows remove each other, and of equal strings none is kept. `kept` is
    binary: a cut can fall inside a letter. An empty table gives an empty one. Other
    columns are not read. `length` is at least 8 more than `gram`.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))
    id_type = dict(docs.dtypes)["doc_id"]

    def stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, Stretches]]:
        for base, chunk in chunked(text_bytes(batch)):
            if any(len(t) >= length for t in chunk):
                yield base, Stretches(chunk, length, gram)

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, s in stretches(batch):
            yield s.anchor

    sketch = repeated_cells(docs.select("text"), anchors, bits)

    def repeated(batch: pa.RecordBatch) -> Iterator[tuple[int, Stretches]]:
        """The stretches whose anchor is estimated repeated."""
        for base, s in stretches(batch):
            s.take(np.flatnonzero(estimated_repeated(s.anchor, sketch.value, bits)))
            yield base, s

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, s in repeated(batch):
                s.take(np.unique(s.content(), return_index=True)[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.anchor.view(np.int64)), pa.array(s.tokens().view(np.int64))], names=["anchor", "token"]
                )

    some = docs.where(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SAMPLE_SHARE)) == 0).select("text")
    seen = some.mapInArrow(sample, "anchor long, token long")
    seen = stored(seen.groupBy("anchor").agg(F.min("token").alias("token"), F.count("*").alias("n")))
    total, n_anchors = seen.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot_rows = seen.where(F.col("n") > max(hot_stretches, total // MOST_HOT)).select("anchor").collect()
    hot = spark.sparkContext.broadcast(np.array([r[0] for r in hot_rows], np.int64).view(np.uint64))
    by_hash = F.xxhash64("anchor")
    few = seen.where(below(by_hash, 2 * SAMPLE_TOKENS / max(n_anchors, 1))).select("token", by_hash).collect()
    values = np.sort(np.array([t for t, _ in sorted(few, key=lambda r: r[1])[:SAMPLE_TOKENS]], np.int64).view(np.uint64))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = partitions * BUCKETS_PER_PARTITION
    splitters = values[np.linspace(0, len(values) - 1, n_buckets + 1).astype(int)[1:-1]] if len(values) else values
    splitters = np.unique(splitters)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct stretch once, and once more without its text if it is there again."""
        known: dict[int, bool] = {}
        for batch in batches:
            for _, s in repeated(batch):
                s.split(hot.value, gram)
                content, first, copies = np.unique(s.content(), return_index=True, return_counts=True)
                s.take(first)
                whole = copies > 1
                before = [known.get(c) for c in content.tolist()]
                new = np.array([b is None or (not b) for b in before], bool)
                with_text = np.array([b is None for b in before], bool)
                whole |= ~with_text
                keep = np.flatnonzero(new)
                if len(known) > SENT:
                    known.clear()
                known.update(zip(content[keep].tolist(), whole[keep].tolist(), strict=True))
                raw = s.data.tobytes()
                text = [raw[s.first[i] : s.last[i] + length] if with_text[i] else None for i in keep.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.searchsorted(splitters, s.tokens()[keep], side="right").astype(np.int32)),
                        pa.array(s.anchor[keep].view(np.int64)),
                        pa.array(content[keep].view(np.int64)),
                        pa.array(whole[keep]),
                        pa.array(text, pa.binary()),
                    ],
                    names=["bucket", "anchor", "content", "whole", "stretch"],
                )

    runs = stored(
        docs.select("text")
        .mapInArrow(send, "bucket int, anchor long, content long, whole boolean, stretch binary")
        .repartition("bucket")
        .sortWithinPartitions("anchor", "content")
        .mapInArrow(lambda batches: sorted_runs(batches, length), "anchor long, content long, low long, high long")
    )

    def contents(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column("content").to_numpy().view(np.uint64)

    with_runs = repeated_cells(runs.select("content").distinct(), contents, bits, least=1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where stretches are. Those with copies among the same texts need no join: they get keys of their own."""
        for batch in batches:
            for base, s in repeated(batch):
                s.split(hot.value, gram)
                content = s.content()
                keep = np.flatnonzero(estimated_repeated(content, with_runs.value, bits))
                s.take(keep)
                content = content[keep]
                _, kind, copies = np.unique(content, return_inverse=True, return_counts=True)
                whole = copies[kind] > 1
                at = pa.array(base + s.doc)
                anchor = np.where(whole, mix(s.anchor ^ mix(s.first.astype(np.uint64))), s.anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at),
                        batch.column("text_hash").take(at),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(whole),
                        pa.array(s.offset),
                        pa.array(s.last - s.first),
                    ],
                    names=["_id", "_hash", "_anchor", "_content", "_whole", "offset", "most"],
                )

    placed = docs.mapInArrow(
        places,
        f"_id {id_type}, _hash long, _anchor long, _content long, _whole boolean, offset long, most long",
    )
    # A passage in many texts is a hot key of `placed` only: adaptive execution splits that side.
    joined = placed.join(runs, (F.col("_anchor") == F.col("anchor")) & (F.col("_content") == F.col("content")), "left")
    low, high = (F.when(F.col("_whole"), other).otherwise(F.col(c)) for c, other in (("low", F.lit(0)), ("high", F.col("most"))))
    found = joined.where(F.col("_whole") | F.col("low").isNotNull()).select(
        "_id", "_hash", (F.col("offset") + low).alias("low"), (F.col("offset") + high + length).alias("high")
    )
    by_doc = found.groupBy("_id", "_hash").agg(F.collect_list(F.struct("low", "high")).alias("_gone"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = docs.join(by_doc, same, "left").select("doc_id", "text", "_gone")
    span_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, chunk in chunked(text_bytes(batch)):
                kept, spans = [], []
                gone = batch.column("_gone").slice(base, len(chunk))
                for i, text in enumerate(chunk):
                    cover = np.zeros(len(text) + 1, np.int64)
                    if gone[i].is_valid:
                        pairs = gone[i].values
                        np.add.at(cover, pairs.field("low").to_numpy(), 1)
                        np.add.at(cover, pairs.field("high").to_numpy(), -1)
                    covered = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
                    edge = np.diff(covered.astype(np.int8))
                    low, high = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                    kept.append(b"".join(text[a:b] for a, b in zip([0, *high], [*low, len(text)], strict=True)))
                    spans.append([{"low": a, "high": b} for a, b in zip(low, high, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(base, len(chunk)),
                        pa.array(list(map(len, chunk)), pa.int64()),
                        pa.array(kept, pa.binary()),
                        pa.array(spans, span_type),
                    ],
                    names=["doc_id", "n_bytes", "kept", "spans"],
                )

    return joined.mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, kept binary, spans array<struct<low:long,high:long>>"
    )


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Every string of 200 bytes by its hash; those there more than once, put together to spans.
OP10_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS data FROM documents
),
windows AS (
    SELECT row, i, md5(data[i + 1:i + 200]) AS content
    FROM (SELECT row, data, unnest(range(0, octet_length(data) - 199)) AS i FROM docs)
),
again AS (
    SELECT content FROM windows GROUP BY content HAVING count(*) > 1
),
starts AS (
    SELECT row, i, i - row_number() OVER (PARTITION BY row ORDER BY i) AS island
    FROM windows SEMI JOIN again USING (content)
),
runs AS (
    SELECT row, min(i) AS low, max(i) + 200 AS high FROM starts GROUP BY row, island
),
marked AS (
    SELECT *, max(high) OVER (PARTITION BY row ORDER BY low ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM runs
),
numbered AS (
    SELECT *, count(*) FILTER (WHERE reach IS NULL OR low > reach) OVER (PARTITION BY row ORDER BY low) AS span FROM marked
),
spans AS (
    SELECT row, min(low) AS low, max(high) AS high FROM numbered GROUP BY row, span
),
edges AS (
    SELECT d.row, d.doc_id, d.data,
           coalesce(list(s.low ORDER BY s.low) FILTER (WHERE s.low IS NOT NULL), []) AS low,
           coalesce(list(s.high ORDER BY s.low) FILTER (WHERE s.low IS NOT NULL), []) AS high
    FROM docs d LEFT JOIN spans s ON d.row = s.row GROUP BY d.row, d.doc_id, d.data
)
SELECT doc_id,
       octet_length(data)::BIGINT AS n_bytes,
       coalesce(list_sum(high) - list_sum(low), 0)::BIGINT AS n_removed,
       len(low)::BIGINT AS n_spans,
       sha256(unhex(array_to_string(list_transform(
           list_zip(list_concat([0], high), list_concat(low, [octet_length(data)])),
           lambda p: hex(data[p[1] + 1:p[2]])
       ), ''))) AS kept_sha256
FROM edges
"""
