"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of a byte-level BPE (A) come with character offsets, tokens of a sentencepiece BPE
(B) with the spans of its proto, in characters as well. These are the coarse cuts. Where a span is not what its
token decodes to, as for tokens of parts of a character and for byte fallback, decoded
bytes place the cut. Where tokens of both end, a group ends.

Neither tokenizer has a token across a blank between two words, which is checked for the
pieces of B. So a text is cut there into segments, and a task tokenizes and cuts each
distinct segment once for as long as it remembers it. The ids of every text are stored
once; links, counts and groups are worked out from them over whole batches.

Counts of linked id pairs are summed by Spark over all documents. Pairs above a threshold
are broadcast, at most HOT_PAIRS of them; the others are joined by a shuffle.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.store import stored
from tarnbeck.llm.text import in_runs
from tarnbeck.sources.tables import table

TOKENIZERS = "/opt/tokenizers"
#: The most pairs whose counts are broadcast, 16 bytes each.
HOT_PAIRS = 1 << 18
#: Distinct segments, their ids and pairs that a task remembers; segments of more than LONG characters never.
SEGMENTS, IDS, PAIRS, LONG = 250_000, 3_000_000, 500_000, 40
#: Tokens of A that are aligned at a time, or those of one text.
RUN_TOKENS = 100_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
#: A blank between two words: neither blank nor U+2581, which B takes for one, is next to it.
CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")
OUTER = re.compile("^[\\s▁]|[\\s▁]$")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: Ids of B fit in so many bits of a pair.
ID_BITS = 20


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, as a table to read them back."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


#: Ids and the byte ends of their tokens.
Tokens = tuple[np.ndarray, np.ndarray]


class Tokenizers:
    """Both tokenizers, and the bytes of each id."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        letters = byte_alphabet()
        self.bytes_a: list[bytes | None] = [None] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            if all(c in letters for c in token):
                self.bytes_a[number] = bytes(letters[c] for c in token)
        self.bytes_b: list[bytes | None] = []
        for number in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(number)
            if re.search("[^▁]▁", piece):
                raise ValueError(f"a piece goes on after a blank, so texts cannot be cut at blanks: {piece!r}")
            if self.b.is_byte(number):
                self.bytes_b.append(bytes.fromhex(_BYTE.fullmatch(piece)[1]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.lengths = tuple(np.fromiter((len(x or b"") for x in own), np.int64) for own in (self.bytes_a, self.bytes_b))

    def cut(self, text: str) -> tuple[Tokens, Tokens] | None:
        """The tokens of a blank and the text by A and by B; none if their bytes are not those.

        Spans are needed only where characters are not bytes: ASCII tokens are as long as what they decode to.
        """
        whole = " " + text
        raw = whole.encode()
        plain = len(raw) == len(whole)
        a, b = self.a.encode(whole, add_special_tokens=False), self.b.encode(text, return_type="numpy" if plain else "offset_mapping")
        out = []
        for ids, spans, own, length in (
            (a.ids, None if plain else a.offsets, self.bytes_a, self.lengths[0]),
            (b.tolist() if plain else b["ids"], None if plain else b["offsets"], self.bytes_b, self.lengths[1]),
        ):
            parts = [own[i] for i in ids]
            if None in parts or b"".join(parts) != raw:
                return None
            number = np.array(ids, np.int64)
            if spans is None:
                out.append((number, np.cumsum(length[number])))
                continue
            span = np.fromiter(chain.from_iterable(spans), np.int64, 2 * len(ids)).reshape(-1, 2)
            if own is self.bytes_b:
                span += 1  # of the text, which follows the blank that B adds itself
                span[0, 0] = 0
            code = np.frombuffer(whole.encode("utf-32-le"), "<u4")
            size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000).astype(np.int64)
            byte = np.concatenate([[0], np.cumsum(size)])
            out.append((number, byte_ends(byte[span], length[number])))
        return out[0], out[1]

    def id_type(self) -> str:
        """What ids are stored as."""
        return "<u2" if max(map(len, self.lengths)) <= 1 << 16 else "<u4"


def byte_ends(span: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Where each token ends: where its span does if that is as long as its bytes, else counted on by bytes from the last that is."""
    counted = np.cumsum(length)
    cut = span[:, 1] - span[:, 0] == length
    last = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), -1))
    ahead = np.where(last >= 0, (span[:, 1] - counted)[last], 0)
    return counted + ahead


@cache
def tokenizers(byte_bpe: str, piece_bpe: str) -> Tokenizers:
    """Loaded once for each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(byte_bpe, piece_bpe)


class Segments:
    """The ids of distinct segments, as pieces of two long arrays.

    A full memory becomes the old one of the next, which takes over what is asked for again.
    """

    def __init__(self, both: Tokenizers, old: Segments | None = None):
        self.both, self.old = both, old
        if old is not None:
            old.old = None
        self.number: dict[str, int] = {}
        self.ids = (array("i"), array("i"))
        self.starts = (array("q", [0]), array("q", [0]))
        self.valid = bytearray()

    def full(self) -> bool:
        return len(self.valid) > SEGMENTS or len(self.ids[0]) > IDS

    def _add(self, segment: str, valid: bool, pieces: tuple) -> None:
        self.number[segment] = len(self.valid)
        self.valid.append(valid)
        for ids, starts, new in zip(self.ids, self.starts, pieces, strict=True):
            ids.extend(new)
            starts.append(len(ids))

    def learn(self, fresh: list[str]) -> None:
        """Words are tokenized in one text with blanks between them, other segments each on its own."""
        words: tuple[list[str], list[str]] = [], []  # of other characters too, of ASCII only
        others = []
        for s in fresh:
            k = self.old.number.get(s) if self.old else None
            if k is not None:
                pieces = (ids[starts[k] : starts[k + 1]] for ids, starts in zip(self.old.ids, self.old.starts, strict=True))
                self._add(s, bool(self.old.valid[k]), tuple(pieces))
            elif s and OUTER.search(s) is None:
                words[s.isascii()].append(s)
            else:
                others.append(s)
        for some in filter(None, words):
            found = self.both.cut(" ".join(some))
            if found is None:
                others += some
                continue
            limit = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in some), np.int64, len(some)))
            self.number.update(zip(some, range(len(self.valid), len(self.valid) + len(some)), strict=True))
            self.valid.extend(b"\1" * len(some))
            for (number, ends), ids, starts in zip(found, self.ids, self.starts, strict=True):
                starts.frombytes((np.searchsorted(ends, limit, side="right") + len(ids)).astype(np.int64).tobytes())
                ids.frombytes(number.astype(np.int32).tobytes())
        for segment in others:
            found = self.both.cut(segment)
            self._add(segment, found is not None, ([], []) if found is None else (found[0][0].tolist(), found[1][0].tolist()))

    def of(self, texts: list[str | None]) -> list[pa.Array]:
        """The packed ids of each text by A and by B, none for texts without tokens."""
        parts = [CUT.split(t) if t else [] for t in texts]
        fresh = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.number]
        self.learn(fresh)
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64)
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        row = np.repeat(np.arange(len(parts)), count)
        bad = np.zeros(len(parts), bool)
        bad[row[np.frombuffer(self.valid, np.uint8)[numbers] == 0]] = True
        keep = ~bad[row]
        numbers, row = numbers[keep], row[keep]
        out = []
        for ids, starts in zip(self.ids, self.starts, strict=True):
            start = np.array(starts, np.int64)
            size = start[numbers + 1] - start[numbers]
            ends = np.cumsum(size)
            at = np.repeat(start[numbers] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
            packed = np.frombuffer(ids, np.int32)[at].astype(self.both.id_type())
            limit = np.concatenate([[0], np.cumsum(np.bincount(row, size, len(parts)).astype(np.int64))]) * packed.itemsize
            packed = packed.tobytes()
            out.append(pa.array([packed[i:j] for i, j in zip(limit, limit[1:], strict=False)], pa.binary()))
        for segment in fresh:
            if len(segment) > LONG:
                del self.number[segment]
        return out


_remembered: dict[tuple[str, str], Segments] = {}


def segments(byte_bpe: str, piece_bpe: str) -> Segments:
    """What this Python worker remembers, from task to task."""
    key = byte_bpe, piece_bpe
    known = _remembered.get(key)
    if known is None or known.full():
        known = _remembered[key] = Segments(tokenizers(byte_bpe, piece_bpe), known)
    return known


def tokens(documents: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """row, doc_id and the packed ids of each text by A and by B, stored; `row` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, texts in in_runs(batch.column("text")):
                doc_id = batch.column("doc_id").slice(base, len(texts))
                yield pa.RecordBatch.from_arrays([doc_id, *segments(byte_bpe, piece_bpe).of(texts)], names=["doc_id", "a", "b"])

    docs = documents.select("doc_id", "text")
    found = docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, a binary, b binary")
    return stored(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "a", "b"))


class Aligned:
    """Tokens of some rows, one after the other, with where both tokenizers' tokens end."""

    def __init__(self, batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray], id_type: str):
        self.ids, self.first, self.end = [], [], []
        for name, length in zip("ab", lengths, strict=True):
            packed = batch.column(name).to_pylist()
            ids = np.frombuffer(b"".join(packed), id_type).astype(np.int64)
            size = np.fromiter(map(len, packed), np.int64, len(packed)) // np.dtype(id_type).itemsize
            self.ids.append(ids)
            self.first.append(np.concatenate([[0], np.cumsum(size)]))
            # Rows have as many bytes by either, so ends can be counted on over all rows.
            self.end.append(np.cumsum(length[ids]))
        cuts = np.sort(np.concatenate(self.end), kind="stable")
        again = cuts[1:] == cuts[:-1]
        self.common = cuts[1:][again]
        self.cuts = cuts = cuts[np.concatenate([[True], ~again])] if len(cuts) else cuts
        #: Between two cuts there is one token of each: a link.
        self.linked = [np.searchsorted(e, cuts) for e in self.end]
        self.pair = self.ids[0][self.linked[0]] << ID_BITS | self.ids[1][self.linked[1]]

    def per_row(self, at: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
        """For each row how many of the bytes `at` end in it, or the sum of their values."""
        sums = np.arange(len(at) + 1) if value is None else np.concatenate([[0], np.cumsum(value)])
        limit = np.concatenate([[0], self.end[0]])[self.first[0]]
        return np.diff(sums[np.searchsorted(at, limit, side="right")])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The row and the pair of each link."""
        return np.searchsorted(self.first[0][1:], self.linked[0], side="right"), self.pair

    def groups(self) -> list[str]:
        """For each row its groups, `a1,a2|b1;a3|b2`."""
        group = [np.searchsorted(self.common, e) for e in self.end]
        n = len(self.common)
        before = [np.searchsorted(g, np.arange(n + 1)) for g in group]  # tokens of earlier groups
        # A group's tokens of A stand before those of B.
        place = [np.arange(len(group[0])) + before[1][group[0]], np.arange(len(group[1])) + before[0][group[1] + 1]]
        total = len(place[0]) + len(place[1])
        number, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        for p, ids, e, m in zip(place, self.ids, self.end, "|;", strict=True):
            number[p] = ids
            mark[p[np.searchsorted(e, self.common)]] = ord(m)
        # Each id as its digits and the mark after it; leading zeros are left out.
        width = len(str(number.max(initial=0)))
        ids = np.arange(number.max(initial=0) + 1)
        digits = np.stack([ids // 10**k % 10 + ord("0") for k in range(width - 1, -1, -1)] + [ids], axis=1).astype(np.uint8)
        shown = np.stack([ids >= 10**k for k in range(width - 1, 0, -1)] + [ids >= 0] * 2, axis=1)
        rows = digits[number]
        rows[:, -1] = mark
        stop = np.cumsum(shown.sum(axis=1)[number])
        out = rows[shown[number]]
        ends = np.concatenate([[0], stop])[self.first[0] + self.first[1]]
        text = out.tobytes().decode()
        return [text[s : e - 1] if e > s else "" for s, e in zip(ends, ends[1:], strict=False)]


def _aligned(
    batches: Iterator[pa.RecordBatch], lengths: tuple[np.ndarray, np.ndarray], id_type: str
) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """The batches in slices of RUN_TOKENS, or of one row."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("a")).to_numpy() // np.dtype(id_type).itemsize)
        start = 0
        while start < batch.num_rows:
            limit = (size[start - 1] if start else 0) + RUN_TOKENS
            stop = max(int(np.searchsorted(size, limit, side="right")), start + 1)
            part = batch.slice(start, stop - start)
            yield part, Aligned(part, lengths, id_type)
            start = stop


def pair_counts(found: DataFrame, lengths: tuple[np.ndarray, np.ndarray], id_type: str) -> DataFrame:
    """pair and n, in how many rows it is linked. A task adds up its rows before it sends them, PAIRS at most at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([pair, *waiting])
            times = np.concatenate([n, np.ones(len(every) - len(pair), np.int64)])
            order = np.argsort(every, kind="stable")
            start = np.flatnonzero(np.diff(every[order], prepend=-1))
            return every[order][start], np.add.reduceat(times[order], start) if len(start) else times[:0]

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

        for _, aligned in _aligned(batches, lengths, id_type):
            row, linked = aligned.links()
            order = np.lexsort((linked, row))
            row, linked = row[order], linked[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (linked[1:] != linked[:-1])
            waiting.append(linked[new])
            size += len(waiting[-1])
            if size > PAIRS:
                pair, n = add()
                waiting, size = [], 0
                if len(pair) > PAIRS:
                    yield sent()
                    pair, n = pair[:0], n[:0]
        pair, n = add()
        yield sent()

    return found.select("a", "b").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def hot_threshold(counts: DataFrame, most: int) -> int:
    """A count that at most `most` pairs reach, the least one of those a sixteenth of a power of two apart."""
    size = F.floor(F.log2(F.col("n").cast("double")) * 16)
    by_size = counts.groupBy(size.alias("size")).agg(F.count("*").alias("k"), F.min("n").alias("least")).collect()
    total, threshold = 0, 1 << 62
    for row in sorted(by_size, reverse=True):
        total += row.k
        if total > most:
            break
        threshold = row.least
    return threshold


def align(
    documents: DataFrame,
    byte_bpe: str = f"{TOKENIZERS}/byte_bpe_50k.json",
    piece_bpe: str = f"{TOKENIZERS}/piece_bpe_32k.model",
    hot_pairs: int = HOT_PAIRS,
    keep: Callable[[Column], Column] = lambda groups: groups,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and `groups` for each row.

    A encodes a blank and the text, B the text, before which it puts a blank itself. A
    text that is null or empty, or that either does not give back byte for byte, has no
    tokens: zeros and an empty `groups`. `groups` has the ids of each group, `a1,a2|b1`,
    joined by semicolons, or what `keep` makes of it before anything is shuffled. Links
    are all pairs of an A and a B token that share a byte. A pair's count is the number
    of rows that hold it linked, so repeated rows count each; n_best counts the links
    whose count is the highest of any pair of their A id, ties too, count_sum adds up the
    counts of all links. Long texts are read whole, an empty table gives an empty one,
    other columns are not read. The model files have to be at their paths on every
    executor.
    """
    both = tokenizers(byte_bpe, piece_bpe)
    lengths, id_type = both.lengths, both.id_type()
    found = tokens(documents, byte_bpe, piece_bpe)
    counts = stored(pair_counts(found, lengths, id_type))
    least = hot_threshold(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    # One row for each id of A: its vocabulary bounds them.
    highest = counts.groupBy(F.shiftright("pair", ID_BITS).alias("a")).agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(len(lengths[0]), np.int64)
    best[highest.column("a").to_numpy()] = highest.column("n").to_numpy()
    known = found.sparkSession.sparkContext.broadcast((hot.column("pair").to_numpy(), hot.column("n").to_numpy(), best))

    def counts_of(pair: np.ndarray) -> np.ndarray:
        """Of pairs that are broadcast their counts, of others 0."""
        hot_pair, n, _ = known.value
        if not len(hot_pair):
            return np.zeros(len(pair), np.int64)
        at = np.minimum(np.searchsorted(hot_pair, pair), len(hot_pair) - 1)
        return np.where(hot_pair[at] == pair, n[at], 0)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, aligned in _aligned(batches, lengths, id_type):
            cuts = aligned.cuts
            kinds, of = np.unique(aligned.pair, return_inverse=True)
            n = counts_of(kinds)
            is_best = (n > 0) & (n == known.value[2][kinds >> ID_BITS])
            columns = [
                np.diff(aligned.first[0]), np.diff(aligned.first[1]), aligned.per_row(aligned.common),
                aligned.per_row(cuts), aligned.per_row(cuts, is_best[of]), aligned.per_row(cuts, n[of]),
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns),
                 pa.array(aligned.groups(), pa.string())],
                names=["row", "doc_id", *COUNTS, "groups"],
            )

    schema = f"row long, doc_id {dict(found.dtypes)['doc_id']}, {', '.join(c + ' long' for c in COUNTS)}, groups string"
    rows = found.mapInArrow(judge, schema).withColumn("groups", keep(F.col("groups")))
    rest = counts.where(F.col("n") < least)
    if rest.isEmpty():
        return rows.drop("row")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each row the pairs that are not broadcast, with how often they are linked."""
        for part, aligned in _aligned(batches, lengths, id_type):
            row, pair = aligned.links()
            cold = counts_of(pair) == 0
            row, pair = row[cold], pair[cold]
            order = np.lexsort((pair, row))
            row, pair = row[order], pair[order]
            start = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
            times = np.diff(np.append(start, len(row)))
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(row[start])), pa.array(pair[start]), pa.array(times),
                 pa.array(known.value[2][pair[start] >> ID_BITS])],
                names=["row", "pair", "times", "highest"],
            )

    sent = found.mapInArrow(rare, "row long, pair long, times long, highest long")
    by_row = sent.join(rest, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(by_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups",
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents"), keep=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256)))
    return found.withColumn("doc_id", F.col("doc_id").cast("long")).withColumnRenamed("groups", "groups_sha256")
