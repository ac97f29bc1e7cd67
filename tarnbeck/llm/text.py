"""Words, n-grams and hashes of many texts at once, as numpy arrays over their UTF-8 bytes.

Every function works on a chunk of texts of bounded size, so the memory of a task
does not grow with its partition. One text is never cut; a chunk holds at least one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_BYTES = 1_000_000
# Multipliers for hashes that wrap at 64 bits: odd, otherwise arbitrary.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
OTHER_BASE = 0x165667B19E3779F9

#: Words of more bytes are hashed one by one.
LONG_WORD = 256
#: The lowest 0 to 8 bytes of a number.
LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

_U64 = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_prime_powers: dict[int, tuple[np.ndarray, ...]] = {}


def fold(column: Column) -> Column:
    """A to Z in lower case, all else unchanged."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_fold(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder. A null id counts as the text `null`."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % parts == part


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(29))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(32))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, _U64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        known = (pair[0], pair[1])
        if size <= CHUNK_BYTES * 4:  # do not keep the tables of one huge text
            _powers[base] = known
    return known


class Spans:
    """Hashes of any spans of a sequence of numbers: equal spans have equal hashes.

    Different spans of long regular patterns can have equal ones too, whatever the base.
    """

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        power, self.inverse = _power(base, n + 1)
        self.sums = np.zeros(n + 1, _U64)
        np.cumsum(values.astype(_U64) * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, length: int) -> np.ndarray:
        """Of every span of this length."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, _U64)
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def prime_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """31-bit hashes of every span of this length, by a polynomial modulo a prime."""
    n, prime = len(values) - length, (1 << 31) - 1
    if n < 0:
        return np.zeros(0, np.int64)
    known = _prime_powers.get(prime)
    if known is None or len(known[0]) < len(values):
        size = 1 << len(values).bit_length()
        known = tuple(np.array([1], np.int64) for _ in range(2))
        bases = [OTHER_BASE % prime, pow(OTHER_BASE % prime, -1, prime)]
        while len(known[0]) < size:  # twice as many with each step
            known = tuple(np.concatenate([k, k * pow(b, len(k), prime) % prime]) for k, b in zip(known, bases, strict=True))
        if size <= CHUNK_BYTES * 4:
            _prime_powers[prime] = known
    power, inverse = known
    sums = np.zeros(len(values) + 1, np.int64)
    small = (values >> _U64(33)).astype(np.int64)
    np.cumsum(small * power[: len(values)] % prime, out=sums[1:])
    return (sums[length:] - sums[: n + 1]) % prime * inverse[: n + 1] % prime


def white() -> np.ndarray:
    """For each byte value whether it separates words: the blank and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def _plain(folded: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[white()] = 0x20
    if folded:
        table[0x41:0x5B] += 0x20
    return table


def _letters() -> np.ndarray:
    """Like folded, with ASCII marks as separators too."""
    table = _plain(True)
    for low, high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
        table[low:high] = 0x20
    return table


WHITE = white()
PLAIN = {folded: _plain(folded) for folded in (False, True)}
LETTERS = _letters()


def smallest_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` hashes where its smallest one is, the leftmost on ties.

    Equal runs have it at the same place in them.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    bits = _U64(max(len(hashes).bit_length(), 24))
    # The place in the low bits decides between hashes that agree in the high ones.
    key = hashes >> bits << bits | np.arange(len(hashes), dtype=_U64)
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, _U64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    return (smallest & ((_U64(1) << bits) - _U64(1))).astype(np.int64)


class Words:
    """The words of some texts. Separators are blanks in `data`; a blank stands before and after each text."""

    def __init__(self, texts: list[bytes], folded: bool = False, table: np.ndarray | None = None):
        self.n_docs = len(texts)
        raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        self.data = (PLAIN[folded] if table is None else table)[raw]
        sizes = np.fromiter(map(len, texts), np.int64, self.n_docs)
        self.doc_start = np.cumsum(sizes + 1) - sizes
        blank = self.data == 0x20
        self.start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        self.end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        ends = np.searchsorted(self.start, self.doc_start + sizes)
        self.first = np.concatenate([[0], ends[:-1]]).astype(np.int64) if self.n_docs else np.zeros(0, np.int64)
        self.count = ends.astype(np.int64) - self.first
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words' bytes, 8 bytes mixed in at a time.

        Unlike in a weighted sum of bytes no pattern of two words cancels out.
        """
        size = self.end - self.start
        eight = np.ndarray((len(self.data),), "<u8", np.concatenate([self.data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
        found = mix(size.astype(_U64) * _U64(BYTE_BASE))
        left, done = np.flatnonzero(size <= LONG_WORD), 0
        while len(left):
            rest = size[left] - done
            block = eight[self.start[left] + done] & LOW_BYTES[np.minimum(rest, 8)]
            found[left] = mix((found[left] ^ block) * _U64(WORD_BASE))
            left, done = left[rest > 8], done + 8
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            found[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]], BYTE_BASE)
        return found

    def ngram_buckets(self, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n: the words and hashed buckets of their byte n-grams.

        A word counts with one blank before and after it, so prefixes and suffixes
        are n-grams of their own. Words too short for an n have none of it.
        """
        spans = Spans(self.data, BYTE_BASE)
        owner = np.zeros(len(self.data) + 1, np.int32)
        owner[self.start] = 1
        owner = np.cumsum(owner)  # at or after the start of word i: i + 1
        blank = self.data == 0x20
        last_blank = np.cumsum(blank)
        for n in sizes:
            m = len(self.data) - n + 1
            if m <= 0:
                continue
            # Blanks may stand at either end of an n-gram, not inside it.
            inside = last_blank[n - 2 : n - 2 + m] - last_blank[:m] if n > 2 else np.zeros(m, np.int64)
            whole = inside == 0
            if n == 2:
                whole &= ~(blank[:-1] & blank[1:])
            at = np.flatnonzero(whole)
            word = owner[at + 1] - 1  # the second byte is of the word unless n is 2 and it is the blank after it
            if n == 2:
                word = np.where(blank[at + 1], owner[at] - 1, word)
            yield word, (spans.of(at, at + n) + _U64(n)) & _U64((1 << bits) - 1)

    def ngram_totals(self, table: np.ndarray, n: int, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
        """For each word the total of a table over the buckets of its n-grams, and how many it has.

        A table of several rows gives a row of totals for each. It holds whole numbers, so totals do not depend on how texts are chunked.
        `spans` are those of `data`. n is 2 or more.
        """
        # Signed indexes: numpy looks up with unsigned ones many times slower.
        bucket = ((spans.all(n) + _U64(n)) & _U64(table.shape[-1] - 1)).view(np.int64)
        counts = np.maximum(self.end - self.start + 3 - n, 0)
        low = np.minimum(self.start - 1, len(bucket))
        high = np.minimum(low + counts, len(bucket))
        totals = np.empty((*table.shape[:-1], len(self.start)), np.int64)
        sums = np.zeros(len(bucket) + 1, np.int64)
        for row, total in zip(np.atleast_2d(table), np.atleast_2d(totals), strict=True):
            np.cumsum(np.take(row, bucket), out=sums[1:])
            total[:] = sums[high] - sums[low]
        return totals, counts


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(name).cast(pa.binary())


def chunked(texts: pa.Array | list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of CHUNK_BYTES or one text, each with the index of its first; null becomes empty.

    Of a column only the run at hand is taken apart into texts.
    """
    start, size, run = 0, 0, []
    for at in range(0, len(texts), 64):
        part = texts[at : at + 64]
        for i, text in enumerate(part.to_pylist() if isinstance(part, pa.Array) else part, at):
            text = text or b""
            if run and size + len(text) > CHUNK_BYTES:
                yield start, run
                start, size, run = i, 0, []
            run.append(text)
            size += len(text)
    if run:
        yield start, run


def in_runs(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Like `chunked`, texts as strings and nulls as they are."""
    base = 0
    for start in range(0, len(texts), 64):
        part = texts[start : start + 64].to_pylist()
        run: list[str | None] = []
        size = 0
        for text in part:
            n = len(text or "")
            if run and size + n > CHUNK_BYTES:
                yield base, run
                base, run, size = base + len(run), [], 0
            run.append(text)
            size += n
        yield base, run
        base += len(run)


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...], **more: pa.Array) -> pa.RecordBatch:
    """The batch without some columns and with others after it."""
    kept = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(more.values()), names=kept + list(more))
