"""Quality classifier: naive Bayes support vectors.

Each text is a set of n-gram indicators: byte n-grams, and n-grams over the shapes of
its words (repeats the word before, capitals, digits, marks). Indicators are scaled by
the log-count ratio of the two labels, counted by Spark over a large bounded sample of
the rows that may be learnt from. A linear hinge-loss model is then fitted on a smaller
one by dual coordinate descent, and scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.labelled import first_ids, labelled_texts, sample_per_label
from tarnbeck.llm.text import BYTE_BASE, Spans, Words, chunked, in_fold, text_bytes
from tarnbeck.sources.tables import table

BYTE_SIZE = 3
BYTE_BITS = 16
#: A shape is a number of five bits; up to three in a row make an n-gram.
SHAPE_BITS = 5
SHAPE_SIZES = (1, 2, 3)
BUCKETS = (1 << BYTE_BITS) + sum(1 << (SHAPE_BITS * n) for n in SHAPE_SIZES)
#: Texts of each label that the model is fitted on, and that the ratios are counted over.
SAMPLE_PER_LABEL = 2000
RATIOS_PER_LABEL = 20_000
PASSES = 12
COST = 4.0
SMOOTHING = 1.0


def _ranges(*ranges: tuple[int, int]) -> np.ndarray:
    mask = np.zeros(256, np.int64)
    for low, high in ranges:
        mask[low:high] = 1
    return mask


CAPITAL = _ranges((0x41, 0x5B))
DIGIT = _ranges((0x30, 0x3A))
MARK = _ranges((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)) - _ranges((0x2C, 0x2D), (0x2E, 0x2F))
SMALL = _ranges((0x61, 0x7B))


def _shapes(w: Words) -> np.ndarray:
    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask[w.data])])
        return sums[w.end] - sums[w.start]

    hashes = w.hashes()
    repeats = np.zeros(len(hashes), bool)
    repeats[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    small, capital = count(SMALL) > 0, count(CAPITAL)
    parts = (repeats, capital > 1, ~small & (capital > 0), count(DIGIT) > 0, count(MARK) > 0)
    return sum(p.astype(np.int64) << i for i, p in enumerate(parts))


def indicators(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """For each text its distinct buckets, in no fixed order."""
    last = np.zeros(BUCKETS, np.int64)
    for _, chunk in chunked(texts):
        w = Words(chunk)
        of_bytes = (Spans(w.data, BYTE_BASE).all(BYTE_SIZE) & np.uint64((1 << BYTE_BITS) - 1)).astype(np.int64)
        shapes = _shapes(w)
        rows, base = [of_bytes], 1 << BYTE_BITS
        for n in SHAPE_SIZES:
            code = np.zeros(max(len(shapes) - n + 1, 0), np.int64)
            for k in range(n):
                code = code << SHAPE_BITS | shapes[k : k + len(code)]
            rows.append(code + base)
            base += 1 << (SHAPE_BITS * n)
        sizes = np.fromiter(map(len, chunk), np.int64, len(chunk))
        for i in range(len(chunk)):
            at, size, first, count = w.doc_start[i], sizes[i], w.first[i], w.count[i]
            parts = [rows[0][at - 1 : at + size + 2 - BYTE_SIZE]] if count else []
            parts += [r[first : first + max(count - n + 1, 0)] for n, r in zip(SHAPE_SIZES, rows[1:], strict=True)]
            found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            last[found] = np.arange(len(found))
            yield found[last[found] == np.arange(len(found))]


def log_count_ratios(labelled: DataFrame) -> np.ndarray:
    """The log ratio of how often each bucket is in texts of label 1 and of label 0, over all these rows.

    Each task counts its own rows; what it sends, and what the driver gets, is at most
    one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            labels = batch.column("quality").to_pylist()
            for label, buckets in zip(labels, indicators(text_bytes(batch)), strict=True):
                seen[label][buckets] += 1
        used = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[1][used]), pa.array(seen[0][used])], names=["bucket", "good", "bad"]
        )

    rows = (
        labelled.select("text", "quality")
        .mapInArrow(count, "bucket long, good long, bad long")
        .groupBy("bucket")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .collect()
    )
    good, bad = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for bucket, g, b in rows:
        good[bucket] += g
        bad[bucket] += b
    return np.log((good / good.sum()) / (bad / bad.sum()))


def train(texts: list[bytes], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the buckets, ratios included, and the bias, by dual coordinate descent."""
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(BUCKETS), (5.0 if len(labels) and labels[0] == 1 else -5.0 if len(labels) else 0.0)
    rows = []
    for buckets in indicators(texts):
        buckets = np.sort(buckets)
        values = ratios[buckets]
        rows.append((buckets, values / max(np.sqrt(values @ values), 1e-12)))
    sign = np.where(labels == 1, 1.0, -1.0)
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(3)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            buckets, values = rows[i]
            # The bias is one more feature that is always 1; rows have length 1, so each step divides by 2.
            gradient = sign[i] * (weights[buckets] @ values + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), COST)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[buckets] += step * values
                bias += step
                alpha[i] = new
    return weights * ratios, bias


def score_texts(texts: list[bytes | None], weights: np.ndarray, ratios: np.ndarray, bias: float) -> np.ndarray:
    """The hinge model's margin on each text's scaled indicators as a number from 0 to 1."""
    margins = []
    for buckets in indicators(texts):
        length = np.sqrt(np.sum(np.sort(ratios[buckets] ** 2)))
        margins.append(np.sum(weights[buckets]) / max(length, 1e-12) + bias if len(buckets) else bias)
    return 1 / (1 + np.exp(-2 * np.clip(np.array(margins), -15, 15)))


def quality(
    documents: DataFrame,
    labelled: DataFrame,
    labels: DataFrame | None = None,
    per_label: int = SAMPLE_PER_LABEL,
    ratios_per_label: int = RATIOS_PER_LABEL,
) -> DataFrame:
    """doc_id and `score`, above 0.5 where the model takes `quality` for 1, for every document.

    `labelled` has doc_id, text and quality (0 or 1); where a table `labels` is given,
    quality is in that, by doc_id. At most `ratios_per_label` texts of each label, the
    first by a hash of the id, are counted for the ratios, and the first `per_label` of
    those fit the model. Null and empty texts have no indicators and get the score of
    the bias; long texts are read whole, equal texts get equal scores. Without labelled
    rows every score is 0.5. Repeated rows are scored each, an empty table gives an
    empty one. Other columns are not read.
    """
    named = (labelled if labels is None else labels).where(F.col("quality").isin(0, 1))
    named = named.withColumn("quality", F.col("quality").cast("int"))
    texts, labels = (named, None) if labels is None else (labelled, named)
    ids = first_ids(texts, "quality", ratios_per_label, labels)
    ratios = log_count_ratios(labelled_texts(texts, ids, "quality", labels is None))
    sample = sample_per_label(texts, "quality", per_label, labels)
    marks = np.array([r.quality for r in sample], np.int64)
    weights, bias = train([r.text.encode() for r in sample], marks, ratios)
    model = documents.sparkSession.sparkContext.broadcast((weights, ratios, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(text_bytes(batch), *model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(~in_fold("doc_id", 3, 1))
    return quality(documents, documents, learn).select(
        "doc_id",
        in_fold("doc_id", 3, 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
