"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is the mean of the embeddings of its byte n-grams, a text the mean of its
words, and a softmax over the text gives the probability of the label. Embeddings
and softmax are learnt together, in numpy, on a bounded sample of labelled texts.
A misspelt word that was never seen still shares most n-grams with one that was.

Because both means are linear, a learnt n-gram acts on the softmax only by one
number, so scoring all texts reads one table of whole numbers of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.labelled import sample_per_label
from tarnbeck.llm.text import BYTE_BASE, Spans, Words, chunked, in_fold, text_bytes
from tarnbeck.sources.tables import table

SIZES = (4, 5, 6)
BITS = 18
DIMENSIONS = 8
STEPS = 60
DECAY = 1e-3
TELLING = 15.0
#: Texts are means over many words; the factor keeps what the softmax sees near one.
SCALE = 30
#: Neutral words added to each mean, so that one odd word does not decide a text of a few words.
PAD = 8
SAMPLE_PER_LABEL = 1000
#: Tables hold whole numbers of this unit.
UNIT = 1 << 20


def _bag(texts: list[bytes]):
    """Distinct words as n-gram lists, and texts as counts of distinct words."""
    grams, owners, docs, words, n = [], [], [], [], []
    known: dict[int, int] = {}
    base = 0
    for _, chunk in chunked(texts):
        w = Words(chunk, folded=True)
        hashes = w.hashes()
        distinct, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        ids = np.empty(len(distinct), np.int64)
        new = np.zeros(len(distinct), bool)
        for i, h in enumerate(distinct.tolist()):
            new[i] = h not in known
            ids[i] = known.setdefault(h, len(known))
        for word, bucket in w.ngram_buckets(SIZES, BITS):
            pick = new[code[word]] & (first[code[word]] == word)
            grams.append(bucket[pick].astype(np.int32))
            owners.append(ids[code[word[pick]]].astype(np.int32))
        docs.append(w.doc + base)
        words.append(ids[code])
        n.append(w.count)
        base += w.n_docs
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    pair, times = np.unique(np.concatenate(docs) * len(known) + np.concatenate(words), return_counts=True)
    return gram, owner, len(known), pair // max(len(known), 1), pair % max(len(known), 1), times, np.concatenate(n)


class _Sum:
    """Sums rows by index, for one index many times."""

    def __init__(self, index: np.ndarray, n: int):
        self.order = np.argsort(index, kind="stable")
        self.seen, self.starts = np.unique(index[self.order], return_index=True)
        self.n = n

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, rows.shape[1]), rows.dtype)
        if len(self.seen):
            out[self.seen] = np.add.reduceat(rows[self.order], self.starts, axis=0)
        return out


def train(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """The number of each n-gram bucket, in UNIT, and the bias. Adam over the whole sample.

    N-grams that do not go with the label by a chi-square test would only let the
    model learn texts by heart; they keep the number zero, as unseen ones do. With
    only one label all numbers are zero and the bias says that label.
    """
    share = float(np.mean(labels)) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        return np.zeros(1 << BITS, np.int32), (5.0 if share == 1 else -5.0 if share == 0 else 0.0)
    gram, owner, n_words, doc, word, times, length = _bag(texts)
    grams_of = np.maximum(np.bincount(owner, minlength=n_words), 1).astype(np.float32)[:, None]
    used, gram = _telling(gram, owner, doc, word, n_words, labels)
    keep = gram >= 0
    column, owner = gram[keep], owner[keep]
    tells = (np.bincount(owner, minlength=n_words) > 0)[word]  # the other words add nothing to a mean
    doc, word, times = doc[tells], word[tells], times[tells]
    weight = (SCALE * times / (length[doc] + PAD)).astype(np.float32)[:, None]
    by_owner, by_column = _Sum(owner, n_words), _Sum(column, len(used))
    by_doc, by_word = _Sum(doc, len(labels)), _Sum(word, n_words)
    rng = np.random.default_rng(7)
    params = [
        rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    ]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    target = np.eye(2, dtype=np.float32)[labels]
    # Both labels weigh the same, so the score's middle separates them.
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)[:, None] / len(labels)
    for step in range(1, STEPS + 1):
        vectors, softmax, bias = params
        words = by_owner(vectors[column]) / grams_of
        bags = by_doc(words[word] * weight)
        logits = bags @ softmax + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * balance
        to_word = by_word((error @ softmax.T)[doc] * weight) / grams_of
        grads = [
            by_column(to_word[owner]) + np.float32(DECAY / max(len(used), 1)) * vectors,
            bags.T @ error + np.float32(1e-4) * softmax,
            error.sum(axis=0),
        ]
        for i, (g, (m, v)) in enumerate(zip(grads, moments, strict=True)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            rate = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            params[i] = (params[i] - rate).astype(np.float32)
    vectors, softmax, bias = params
    numbers = np.zeros(1 << BITS)
    numbers[used] = SCALE * vectors.astype(np.float64) @ (softmax[:, 1] - softmax[:, 0])
    return np.clip(np.rint(numbers * UNIT), -(2**31) + 1, 2**31 - 1).astype(np.int32), float(bias[1] - bias[0])


def _telling(gram, owner, doc, word, n_words, labels) -> tuple[np.ndarray, np.ndarray]:
    """The buckets whose presence in a text goes with its label, and for each n-gram its place among them or -1."""
    by_word = np.argsort(owner, kind="stable")
    grams = gram[by_word]
    ends = np.cumsum(np.bincount(owner, minlength=n_words))
    by_doc = np.argsort(doc, kind="stable")
    limits = np.searchsorted(doc[by_doc], np.arange(len(labels) + 1))
    seen = np.zeros((2, 1 << BITS))
    for i, label in enumerate(labels):
        words = word[by_doc[limits[i] : limits[i + 1]]]
        parts = [grams[(ends[w - 1] if w else 0) : ends[w]] for w in words]
        if parts:
            seen[label][np.unique(np.concatenate(parts))] += 1
    n1, n0 = labels.sum(), (1 - labels).sum()
    with_it = seen.sum(axis=0)
    spread = np.maximum(with_it * (len(labels) - with_it) * n1 * n0, 1)
    chi_square = len(labels) * (seen[1] * (n0 - seen[0]) - seen[0] * (n1 - seen[1])) ** 2 / spread
    used = np.flatnonzero(chi_square >= TELLING)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    return used, place[gram]


def score_texts(texts: list[bytes | None], numbers: np.ndarray, bias: float) -> np.ndarray:
    """The probability of the label for each text; texts without words get the bias alone."""
    scores = []
    for _, chunk in chunked(texts):
        w = Words(chunk, folded=True)
        spans = Spans(w.data, BYTE_BASE)
        total, grams = np.zeros(len(w.start), np.int64), np.zeros(len(w.start), np.int64)
        for n in SIZES:
            t, c = w.ngram_totals(numbers, n, spans)
            total += t
            grams += c
        by_word = np.rint(total / np.maximum(grams, 1)).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(by_word)])
        mean = (sums[w.first + w.count] - sums[w.first]) / (w.count + PAD) / UNIT
        scores.append(1 / (1 + np.exp(-np.clip(mean + bias, -30, 30))))
    return np.concatenate(scores) if scores else np.zeros(0)


def toxicity(
    documents: DataFrame, labelled: DataFrame, labels: DataFrame | None = None, per_label: int = SAMPLE_PER_LABEL
) -> DataFrame:
    """doc_id and `score`, the probability that `toxic` is 1, for every document.

    `labelled` has doc_id, text and toxic (0 or 1); where a table `labels` is given,
    toxic is in that, by doc_id. At most `per_label` texts of each label, the first by a
    hash of the id, are learnt from. Null and empty texts have no words and get the
    score of the bias; long texts are read whole, equal texts get equal scores. Without
    labelled rows every score is 0.5. Repeated rows are scored each, an empty table
    gives an empty one. Other columns are not read.
    """
    named = (labelled if labels is None else labels).where(F.col("toxic").isin(0, 1))
    named = named.withColumn("toxic", F.col("toxic").cast("int"))
    texts, labels = (named, None) if labels is None else (labelled, named)
    sample = sample_per_label(texts, "toxic", per_label, labels)
    numbers, bias = train([r.text.encode() for r in sample], np.array([r.toxic for r in sample], np.int64))
    model = documents.sparkSession.sparkContext.broadcast((numbers, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(text_bytes(batch), *model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(~in_fold("doc_id", 5, 0))
    return toxicity(documents, documents, learn).select(
        "doc_id",
        in_fold("doc_id", 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
