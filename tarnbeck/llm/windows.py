"""Substring dedup by word windows, with a count-min prefilter.

A first pass counts in partition sketches, which are merged. What it counts are anchors: a
window's anchor is the run of GRAM words in it with the smallest hash, so equal windows
have equal anchors, and an anchor's count is never less than that of its windows. There
are about 20 times fewer anchors than windows. A second pass sends only windows estimated
repeated, each once per text, to be grouped exactly; a window that a text with a smaller
id also has is removed from the larger. Windows are one if 95 bits of hashes agree, of
which 31 come from a polynomial modulo a prime over hashes of whole words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.sketch import estimated_repeated, repeated_cells
from tarnbeck.llm.store import stored
from tarnbeck.llm.text import WORD_BASE, Spans, Words, chunked, prime_hashes, smallest_places, text_bytes, with_columns
from tarnbeck.sources.tables import table

WINDOW = 50
#: Words of an anchor, half a window at most.
GRAM = 8
SKETCH_BITS = 27
#: A window that so many texts of a hundredth of all have is grouped in parts.
HOT_TEXTS = 500
PARTS = 64


def window_hashes(words: Words, i: int, hashes: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of each window of text i."""
    return Spans(hashes[words.first[i] : words.first[i] + words.count[i]], WORD_BASE).all(window)


def window_anchors(words: Words, i: int, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of text i its anchor's hash and place."""
    gram = max(1, min(GRAM, window // 2))
    own = hashes[words.first[i] : words.first[i] + words.count[i]]
    if len(own) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = Spans(own, WORD_BASE).all(gram)
    place = smallest_places(grams, window - gram + 1)
    return grams[place], place


def _candidates(docs: DataFrame, sketch: Broadcast, bits: int, window: int) -> DataFrame:
    """doc_id, h and g of the windows estimated repeated, each once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, chunk in chunked(text_bytes(batch)):
                words = Words(chunk)
                hashes = words.hashes()
                rows, hs, gs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for i in range(len(chunk)):
                    keep = estimated_repeated(window_anchors(words, i, hashes, window)[0], sketch.value, bits)
                    if keep.any():
                        own = hashes[words.first[i] : words.first[i] + words.count[i]]
                        h, first = np.unique(window_hashes(words, i, hashes, window)[keep], return_index=True)
                        g = prime_hashes(own, window)
                        hs.append(h)
                        gs.append(g[keep][first])
                        rows.append(np.full(len(h), base + i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(gs))],
                    names=["doc_id", "h", "g"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, h long, g long")


def _later(candidates: DataFrame, hot: DataFrame | None) -> DataFrame:
    """doc_id and h of windows that a text with a smaller id has too. Null ids come last."""
    order = (F.col("doc_id").isNull(), F.col("doc_id"))

    def split(rows: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
        first = F.min(F.struct(*(c.alias(n) for c, n in zip(order, ("none", "id"), strict=True)))).over(
            Window.partitionBy(*keys)
        )
        rows = rows.withColumn("_first", first)
        later = F.struct(*(c.alias(n) for c, n in zip(order, ("none", "id"), strict=True))) > F.col("_first")
        rows = rows.withColumn("_later", later).drop("_first")
        return rows.where("_later").drop("_later"), rows.where("NOT _later").drop("_later")

    if hot is None:
        return split(candidates, "h", "g")[0].select("doc_id", "h")
    # Within a part of a hot window all but the first text are later ones; the firsts then meet.
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).otherwise(0)
    parted = candidates.join(hot.withColumn("hot", F.lit(True)), ["h", "g"], "left").withColumn("part", part)
    later, firsts = split(parted, "h", "g", "part")
    return later.select("doc_id", "h").unionByName(split(firsts.drop("part"), "h", "g")[0].select("doc_id", "h"))


def repeated_windows(
    documents: DataFrame,
    window: int = WINDOW,
    bits: int = SKETCH_BITS,
    hot_texts: int = HOT_TEXTS,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """n_words, n_removed and `kept`, the words left joined by one blank, after the columns in `carry`, for each row.

    Words are runs of bytes other than the blank and 0x09 to 0x0D, unchanged. A word
    goes if a window of `window` words over it also starts in a document with a smaller
    doc_id; windows are judged on the input. A null or empty text has no words, a text of
    fewer words than a window keeps them, a long one is read whole. Rows that repeat a
    doc_id do not remove each other's windows, so of ties the first id keeps them. A null
    doc_id is larger than any other. An empty table gives an empty one. Columns not
    carried are not read; a carried one with the name of a new one gives way to it.
    """
    docs = documents.select("doc_id", "text")
    carry = tuple(c for c in carry if c not in ("n_words", "n_removed", "kept", "_doc", "_id", "_gone"))

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, chunk in chunked(text_bytes(batch)):
            words = Words(chunk)
            hashes = words.hashes()
            for i in range(len(chunk)):
                anchor, place = window_anchors(words, i, hashes, window)
                # Windows next to each other that share their anchor count it once.
                yield anchor[np.diff(place, prepend=-1) != 0]

    sketch = repeated_cells(docs.select("text"), anchors, bits)
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(100)) == 0)
    hot = _candidates(some, sketch, bits, window).groupBy("h", "g").count().where(F.col("count") >= hot_texts)
    hot = stored(hot.select("h", "g"))
    later = _later(_candidates(docs, sketch, bits, window), None if hot.isEmpty() else hot)
    by_doc = later.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("h").alias("_gone"))
    rows = documents.select("text", F.col("doc_id").alias("_doc"), *(c for c in carry if c not in ("text", "_doc")))
    unread = ("_gone",) if "text" in carry else ("text", "_gone")
    joined = rows.join(by_doc, F.col("_doc").eqNullSafe(F.col("_id")), "left").drop("_doc", "_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, chunk in chunked(text_bytes(batch)):
                words = Words(chunk)
                hashes = words.hashes()
                part = batch.slice(base, len(chunk))
                gone = part.column("_gone")
                removed, kept = [], []
                for i, text in enumerate(chunk):
                    count = words.count[i]
                    covered = np.zeros(count + 1, np.int64)
                    if gone[i].is_valid:
                        bad = gone[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                        bad = np.flatnonzero(np.isin(window_hashes(words, i, hashes, window), bad))
                        np.add.at(covered, bad, 1)
                        np.add.at(covered, np.minimum(bad + window, count), -1)
                    keep = np.cumsum(covered)[:count] == 0
                    left = text.split()
                    if not keep.all():
                        left = [left[j] for j in np.flatnonzero(keep)]
                    removed.append(count - len(left))
                    kept.append(b" ".join(left))
                yield with_columns(
                    part,
                    unread,
                    n_words=pa.array(words.count),
                    n_removed=pa.array(removed, pa.int64()),
                    kept=pa.array(kept, pa.binary()).cast(pa.string()),
                )

    schema = joined.drop(*unread).schema
    return joined.mapInArrow(cut, schema.add("n_words", "long").add("n_removed", "long").add("kept", "string"))


def op6_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = """
WITH split AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
starts AS (
    SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM split
),
windows AS (
    SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS content FROM starts
),
firsts AS (
    SELECT content, min(doc_id) AS doc_id FROM windows GROUP BY content
),
gone AS (
    SELECT DISTINCT w.doc_id, unnest(range(w.pos, w.pos + 50)) AS pos
    FROM windows w JOIN firsts f ON w.content = f.content AND w.doc_id > f.doc_id
),
words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split
),
kept AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.pos) AS text, count(*) AS n
    FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
    GROUP BY w.doc_id
)
SELECT s.doc_id,
       CAST(len(s.words) AS BIGINT) AS n_words,
       CAST(len(s.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
