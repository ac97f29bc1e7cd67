"""Language ID: a linear-chain conditional random field over the words of a text.

A word's features are its affixes and inner byte n-grams (a word counts with one
blank on either side, so n-grams at its ends are affixes) and the lexicon of a
language it belongs to, if any. Transitions between the labels of neighbouring words
are learnt with the feature weights. Forward-backward gives each word its label
probabilities, so text that switches language within a line is labelled word by word;
a text's language is the one with the most probability over all its words.

Training texts carry one label each. They are cut into short runs, and runs of
different texts and languages are strung together, so that switches occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnbeck.llm.labelled import sample_per_label
from tarnbeck.llm.text import BYTE_BASE, Spans, Words, chunked, in_fold, text_bytes, with_columns
from tarnbeck.sources.tables import table

SIZES = (2, 3, 4)
BITS = 16
UNIT = 1 << 20
#: Texts of each language that the field is fitted on.
SAMPLE_PER_LANGUAGE = 60
LEXICON_TEXTS = 3
ROW_WORDS = 100
STEPS = 40
#: Words of a text that are worked through one after the other; longer texts are split and joined exactly.
PIECE = 64
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # languages x buckets, whole numbers of UNIT
    lexicon: np.ndarray  # sorted word hashes
    lexicon_language: np.ndarray
    lexicon_weights: np.ndarray  # languages of the lexicon x languages, whole numbers of UNIT
    transitions: np.ndarray  # exponentials, from x to

    def emissions(self, w: Words) -> np.ndarray:
        """The feature weights of each word summed: languages x words."""
        spans = Spans(w.data, BYTE_BASE)
        total = np.zeros((len(self.languages), len(w.start)), np.int64)
        for n in SIZES:
            total += w.ngram_totals(self.weights, n, spans)[0]
        if len(self.lexicon):
            hashes = spans.of(w.start, w.end)
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == hashes
            total[:, known] += self.lexicon_weights[self.lexicon_language[at[known]]].T
        return total / UNIT


def marginals(emissions: np.ndarray, first: np.ndarray, count: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities (languages x words) by forward-backward, for many texts at once.

    Texts are split into pieces of PIECE words. The product of a piece's step
    matrices carries messages across it, so pieces of one text run side by side and
    the result is that of one pass over the text.
    """
    k = len(emissions)
    n_pieces = -(-count // PIECE)
    total = int(n_pieces.sum())
    result = np.zeros_like(emissions)
    if not total or not k:
        return result
    level = np.arange(total) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    begin = np.repeat(first, n_pieces) + level * PIECE
    length = np.minimum(np.repeat(count, n_pieces) - level * PIECE, PIECE)
    e = np.exp(emissions - emissions.max(axis=0))
    # Longest pieces first: those that still have a word at step t are then a prefix.
    order = np.argsort(-length, kind="stable")
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    begin, length, opens = begin[order], length[order], (level == 0)[order]
    steps = int(length[0])
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]
    of_step = [e[:, begin[:n] + t] for t, n in enumerate(active)]

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(x.sum(axis=tuple(range(x.ndim - 1))), 1e-300)

    across = np.repeat(np.eye(k)[:, :, None], total, axis=2)  # from x to x pieces
    for t, n in enumerate(active):
        step = np.matmul(transitions.T, across[:, :, :n])
        if t == 0:
            step[:, :, opens] = 1.0
        across[:, :, :n] = unit(step * of_step[t])
    ahead = np.full((k, total), 1.0 / k)
    behind = np.full((k, total), 1.0 / k)
    by_level = np.argsort(level, kind="stable")
    bounds = np.searchsorted(level[by_level], np.arange(level.max() + 2))
    for j in range(1, level.max() + 1):
        at = by_level[bounds[j] : bounds[j + 1]]
        ahead[:, place[at]] = unit(np.einsum("ip,ijp->jp", ahead[:, place[at - 1]], across[:, :, place[at - 1]]))
    for j in range(level.max(), 0, -1):
        at = by_level[bounds[j] : bounds[j + 1]]
        behind[:, place[at - 1]] = unit(np.einsum("ijp,jp->ip", across[:, :, place[at]], behind[:, place[at]]))
    forward = []
    for t, n in enumerate(active):
        step = transitions.T @ ahead[:, :n]
        if t == 0:
            step[:, opens] = 1.0
        ahead[:, :n] = unit(step * of_step[t])
        forward.append(ahead[:, :n].copy())
    for t in range(steps - 1, -1, -1):
        n = active[t]
        result[:, begin[:n] + t] = unit(forward[t] * behind[:, :n])
        behind[:, :n] = unit(transitions @ (behind[:, :n] * of_step[t]))
    return result


def _string_together(words: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of 5 to 40 words of all texts, shuffled, as rows of ROW_WORDS word ids and labels."""
    rng = np.random.default_rng(11)
    runs = []
    for ids, label in zip(words, labels, strict=True):
        at = 0
        while at < len(ids):
            size = int(rng.integers(5, 41))
            runs.append((ids[at : at + size], label))
            at += size
    order = rng.permutation(len(runs))
    stream = np.concatenate([runs[i][0] for i in order])
    label = np.concatenate([np.full(len(runs[i][0]), runs[i][1]) for i in order])
    size = -(-len(stream) // ROW_WORDS) * ROW_WORDS
    return np.resize(stream, size).reshape(-1, ROW_WORDS), np.resize(label, size).reshape(-1, ROW_WORDS)


def _gradient(e: np.ndarray, label: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log likelihood by emissions and by log transitions; rows x words x languages."""
    rows, n, k = e.shape
    scaled = np.exp(e - e.max(axis=2, keepdims=True))
    move = np.exp(transitions)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = scaled[:, 0] / scaled[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, n):
        a = (alpha[:, t - 1] @ move) * scaled[:, t]
        alpha[:, t] = a / a.sum(axis=1, keepdims=True)
    by_move = np.zeros((k, k))
    for t in range(n - 1, 0, -1):
        after = scaled[:, t] * beta[:, t]
        joint = alpha[:, t - 1][:, :, None] * move * after[:, None, :]
        by_move += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = after @ move.T
        beta[:, t - 1] = b / b.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    np.subtract.at(by_move, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1)
    gamma[np.arange(rows)[:, None], np.arange(n)[None, :], label] -= 1
    return gamma, by_move


def train(texts: list[bytes], languages: list[str]) -> Field:
    """Maximum likelihood with a small penalty, by Adam over the whole sample."""
    names = sorted(set(languages))
    k = len(names)
    code = {name: i for i, name in enumerate(names)}
    labels = [code[name] for name in languages]
    if k < 2:
        empty = np.zeros(0, np.uint64)
        none = np.zeros((k, k), np.int64)
        return Field(names, np.zeros((k, 1 << BITS), np.int32), empty, np.zeros(0, np.int64), none, np.ones((k, k)))
    grams, owners, per_text, known = [], [], [], {}
    for _, chunk in chunked(texts):
        w = Words(chunk, folded=True)
        distinct, first, index = np.unique(w.hashes(), return_index=True, return_inverse=True)
        new = np.array([h not in known for h in distinct.tolist()], bool)
        ids = np.array([known.setdefault(h, len(known)) for h in distinct.tolist()], np.int64)
        for word, bucket in w.ngram_buckets(SIZES, BITS):
            pick = new[index[word]] & (first[index[word]] == word)
            grams.append(bucket[pick].astype(np.int64))
            owners.append(ids[index[word[pick]]])
        per_text += [ids[index[a : a + c]] for a, c in zip(w.first, w.count, strict=True)]
    gram, owner, n_words = np.concatenate(grams), np.concatenate(owners), len(known)
    seen = np.zeros((k, n_words), np.int64)
    for ids, label in zip(per_text, labels, strict=True):
        seen[label, np.unique(ids)] += 1
    # A word of one language's lexicon is in several of its texts and in few of the others'.
    top = seen.argmax(axis=0)
    most, every = seen.max(axis=0), seen.sum(axis=0)
    in_lexicon = np.where((most >= LEXICON_TEXTS) & (most >= 0.8 * every), top, -1)
    used, column = np.unique(gram, return_inverse=True)
    order_w, order_c = np.argsort(owner, kind="stable"), np.argsort(column, kind="stable")
    first_w, first_c = (np.searchsorted(i[o], np.arange(n)) for i, o, n in
                        ((owner, order_w, n_words), (column, order_c, len(used))))
    rows, label = _string_together(per_text, labels)
    flat, flat_order = rows.ravel(), np.argsort(rows.ravel(), kind="stable")
    flat_seen, flat_first = np.unique(flat[flat_order], return_index=True)
    params = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros((k, k))]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    has = in_lexicon >= 0
    for step in range(1, STEPS + 1):
        weights, lexicon, transitions = params
        by_word = np.add.reduceat(weights[column[order_w]], first_w, axis=0)
        by_word[has] += lexicon[in_lexicon[has]]
        g_rows, g_moves = _gradient(by_word[rows], label, transitions)
        g_words = np.zeros((n_words, k))
        g_words[flat_seen] = np.add.reduceat(g_rows.reshape(-1, k)[flat_order], flat_first, axis=0)
        g_lexicon = np.zeros((k, k))
        np.add.at(g_lexicon, in_lexicon[has], g_words[has])
        grads = (
            np.add.reduceat(g_words[owner[order_c]], first_c, axis=0) / flat.size + 1e-6 * weights,
            g_lexicon / flat.size + 1e-6 * lexicon,
            g_moves / flat.size + 1e-6 * transitions,
        )
        for i, (g, (m, v)) in enumerate(zip(grads, moments, strict=True)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[i] = params[i] - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros((k, 1 << BITS), np.int32)
    weights[:, used] = np.rint(params[0] * UNIT).T
    hashes = np.fromiter(known, np.uint64, n_words)[has]
    by_hash = np.argsort(hashes)
    return Field(names, weights, hashes[by_hash], in_lexicon[has][by_hash],
                 np.rint(params[1] * UNIT).astype(np.int64), np.exp(params[2]))


def label_chunk(texts: list[bytes], field: Field) -> Iterator[tuple[str, float, np.ndarray]]:
    """For each text its language, the mean probability of it, and the label number of each word."""
    w = Words(texts, folded=True)
    gamma = marginals(field.emissions(w), w.first, w.count, field.transitions)
    label = gamma.argmax(axis=0) if field.languages else np.zeros(0, np.int64)
    for text, a, c in zip(texts, w.first, w.count, strict=True):
        if not field.languages or not LETTER.search(text.decode("utf-8", "replace")):
            yield UNKNOWN, 0.0, label[:0]
            continue
        share = gamma[:, a : a + c].mean(axis=1)
        best = int(share.argmax())
        yield field.languages[best], min(round(float(share[best]), 12), 1.0), label[a : a + c]


def identify_language(
    documents: DataFrame,
    labelled: DataFrame,
    per_language: int = SAMPLE_PER_LANGUAGE,
    runs: bool = True,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """lang_pred, score and, unless `runs` is false, the runs of words in one language, after the columns in `carry`.

    `labelled` has doc_id, text and lang; at most `per_language` of its texts of each
    language, the first by a hash of the id, are learnt from. A null text, an empty one
    or one without letters, and every text when nothing is labelled get `und`, score 0
    and no runs. Long texts are read whole. Of languages equally likely the first by
    name is taken. With one labelled language that is every text's language. Repeated
    rows are judged each, an empty table gives an empty one. Columns not carried are not
    read; a carried one named like a new one gives way to it.
    `runs` lists (first word, one past the last word, language) for each maximal run.
    """
    sample = sample_per_label(labelled, "lang", per_language)
    context = documents.sparkSession.sparkContext
    examples = context.broadcast(([r.text.encode() for r in sample], [r.lang for r in sample]))
    # Training takes many times the memory of the sample, and much of it would stay with the driver.
    field = context.parallelize([0], 1).map(lambda _: train(*examples.value)).first()
    examples.destroy()
    model = context.broadcast(field)
    carry = tuple(c for c in carry if c not in ("lang_pred", "score", "runs"))
    docs = documents.select("text", *(c for c in carry if c != "text"))
    unread = () if "text" in carry else ("text",)
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def found(label: np.ndarray) -> list[dict]:
        edge = np.concatenate([[0], np.flatnonzero(np.diff(label)) + 1, [len(label)]]) if len(label) else [0]
        return [
            {"first": int(a), "end": int(b), "lang": model.value.languages[label[a]]}
            for a, b in zip(edge, edge[1:], strict=False)
        ]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, chunk in chunked(text_bytes(batch)):
                judged = list(label_chunk(chunk, model.value))
                new = {
                    "lang_pred": pa.array([name for name, _, _ in judged], pa.string()),
                    "score": pa.array([score for _, score, _ in judged], pa.float64()),
                }
                if runs:
                    new["runs"] = pa.array([found(label) for _, _, label in judged], run_type)
                yield with_columns(batch.slice(base, len(chunk)), unread, **new)

    schema = docs.drop(*unread).schema.add("lang_pred", "string").add("score", "double")
    if runs:
        run = T.StructType().add("first", "long").add("end", "long").add("lang", "string")
        schema = schema.add("runs", T.ArrayType(run))
    return docs.mapInArrow(judge, schema)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learn = documents.where(~in_fold("doc_id", 4, 2) & F.col("lang").isNotNull())
    return identify_language(documents, learn, runs=False).select(
        "doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )
