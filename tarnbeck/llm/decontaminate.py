"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages at every word and weighted by TF-IDF, with document
frequencies over all documents. A randomised SVD, whose products Spark sums over the
passages, gives their latent space. It has far fewer dimensions than passages, so that
shifted and reworded passages of an item fall together; lengths are taken in the space on
both sides, so the cosine of a window and a passage with the same words is 1 at any rank.

Documents are searched in overlapping windows, for an item where several of its rarer
words stand close together: of half of an item's different words and n more, whoever has
half of the item's words has n at least. A window there that is close to a passage of the item by the latent cosine is a candidate. It counts
if the longest common subsequence of the item's words and the words around the window is
most of the item, or if it is a good part of it, by words and by their weight, and the
item's last words, its answer, are there too. Which words are the rarer ones depends on the item only, so an item that is
copied into much of the corpus is found like any other.

Items are a query set. They are searched for in blocks of bounded size, so what a task
holds does not grow with the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tarnbeck.llm.text import LETTERS, Words, chunked, text_bytes
from tarnbeck.sources.tables import table

BITS = 18
RANK, OVERSAMPLE, POWER_STEPS = 128, 16, 2
#: Items that share a latent space, and words of the items of a block.
SPACE_ITEMS, BLOCK_WORDS = 256, 100_000
#: Characters of the items that come to the driver at a time, about; as many as a block may have.
READ_CHARS = 6 * BLOCK_WORDS
#: Windows of documents: words, and words from one to the next.
SCALES = ((16, 8), (48, 16))
#: Words of a passage, as many as of the smallest windows, or all of a longer stretch of an item.
PASSAGE_WORDS, STRETCH_WORDS = 16, 64
#: One in so many of an item's different words are to stand close together, two at least,
#: and within how many words, or half as many again as the item has.
NEAR_SHARE, NEAR_WORDS = 4, 48
COSINE = 0.45
SIMILAR = 0.8
PARAPHRASED, PARAPHRASED_WEIGHT = 0.5, 0.4
ANSWER_WORDS = 8
SENTENCE = re.compile(rb"[.!?\n]\s*(?=\S)")


def document_frequencies(documents: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts the words of each hash bucket are, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last, n = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for _, chunk in chunked(text_bytes(batch)):
                w = Words(chunk, table=LETTERS)
                bucket = _bucket(w.hashes())
                # Of the places where a text has a bucket only the last one written counts.
                order = np.arange(len(bucket))
                for a, c in zip(w.first, w.count, strict=True):
                    mine = bucket[a : a + c]
                    last[mine] = order[a : a + c]
                    seen[mine[last[mine] == order[a : a + c]]] += 1
            n += batch.num_rows
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], n))], names=["bucket", "n"]
        )

    rows = (
        documents.select("text")
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    # The number of texts comes as bucket -1, the last place of the array.
    found = np.zeros((1 << BITS) + 1, np.int64)
    found[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return found[:-1], int(found[-1])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << BITS) - 1)).view(np.int64)


def weights(frequencies: np.ndarray, total: int) -> np.ndarray:
    """The IDF of each bucket, above 0."""
    return np.log((total + 1) / (frequencies + 1)) + 0.1


@dataclass
class Item:
    item_id: object
    words: np.ndarray  # hashes
    answer: np.ndarray


def item_of(item_id: object, text: bytes) -> Item:
    """The words of an item, and of its last sentence at most ANSWER_WORDS, the last ones."""
    w, last = Words([text], table=LETTERS), SENTENCE.split(text.strip())[-1]
    return Item(item_id, w.hashes(), Words([last], table=LETTERS).hashes()[-ANSWER_WORDS:])


def passages_of(item: Item) -> list[np.ndarray]:
    """Passages from every word on, so that a copy's windows are among them, and longer stretches."""
    words = item.words
    starts = range(max(len(words) - PASSAGE_WORDS, 0) + 1)
    half = STRETCH_WORDS // 2
    stretches = range(0, max(len(words) - half, 1), half) if len(words) > PASSAGE_WORDS else range(0)
    return [words[s : s + PASSAGE_WORDS] for s in starts] + [words[s : s + STRETCH_WORDS] for s in stretches]


def least_near(item: Item) -> int:
    """How many of the item's rarer words are to stand close together."""
    n = len(np.unique(item.words))
    return max(min(2, n), -(-n // NEAR_SHARE))


def rarer_words(item: Item, frequencies: np.ndarray) -> np.ndarray:
    """Half of the item's different words and `least_near` more, the rarest by document frequency."""
    words = np.unique(item.words)
    order = np.lexsort((words, frequencies[_bucket(words)]))
    return words[order[: len(words) // 2 + least_near(item)]]


@dataclass
class Space:
    """Latent space of the passages of some items: vocabulary, its vectors, and the passages in it."""

    vocabulary: np.ndarray  # hashes
    place: np.ndarray  # of a bucket, in the vocabulary, or -1
    vectors: np.ndarray  # vocabulary x rank, times IDF; the last row is zero, for other words
    passages: np.ndarray  # rank x passages, of unit length
    owner: np.ndarray  # item of each passage, by its place in the block, ascending


@dataclass
class Block:
    """Items that are searched for together."""

    items: list[Item]
    rare: np.ndarray  # hashes of rarer words of any item, ascending
    first: np.ndarray  # where the items of each start in `owner`
    owner: np.ndarray
    least: np.ndarray  # how many rarer words of an item are to be close together
    span: np.ndarray  # and within how many words
    spaces: list[Space]
    space_of: np.ndarray
    weight: list[np.ndarray]  # of each item's words


def block_of(spark: SparkSession, items: list[Item], frequencies: np.ndarray, idf: np.ndarray) -> Block | None:
    rare = [rarer_words(item, frequencies) for item in items]
    word = np.concatenate(rare)
    if not len(word):
        return None
    owner = np.repeat(np.arange(len(items)), [len(r) for r in rare])
    order = np.lexsort((owner, word))
    words, first = np.unique(word[order], return_index=True)
    spaces, space_of = [], np.zeros(len(items), np.int64)
    for a in range(0, len(items), SPACE_ITEMS):
        pieces = [(i, p) for i in range(a, min(a + SPACE_ITEMS, len(items))) for p in passages_of(items[i]) if len(p)]
        if pieces:
            space_of[a : a + SPACE_ITEMS] = len(spaces)
            spaces.append(latent_space(spark, pieces, idf))
    least = np.array([least_near(item) for item in items])
    span = np.array([max(NEAR_WORDS, 3 * len(item.words) // 2) for item in items])
    return Block(items, words, np.append(first, len(word)), owner[order], least, span, spaces, space_of, [idf[_bucket(item.words)] for item in items])


def latent_space(spark: SparkSession, pieces: list[tuple[int, np.ndarray]], idf: np.ndarray) -> Space:
    """The latent space of TF-IDF passages, given with their items, by a distributed randomised SVD.

    Its rank is RANK at most and three quarters of the number of different passages.
    """
    distinct = np.unique(np.concatenate([p for _, p in pieces]))
    # One word for each bucket: which of two that share one is kept does not depend on order.
    bucket, first = np.unique(_bucket(distinct), return_index=True)
    vocabulary = distinct[first]
    place = np.full(1 << BITS, -1)
    place[bucket] = np.arange(len(vocabulary))
    rows = []
    for _, words in pieces:
        at = place[_bucket(words)]
        column, times = np.unique(at[vocabulary[at] == words], return_counts=True)
        value = times * idf[bucket[column]]
        rows.append((column, value / max(np.sqrt(value @ value), 1e-12)))
    rank = max(1, min(RANK, 3 * len({(c.tobytes(), v.tobytes()) for c, v in rows}) // 4))
    size = min(rank + OVERSAMPLE, len(rows), len(vocabulary))
    table = spark.createDataFrame(
        pa.table({"column": [c.tolist() for c, _ in rows], "value": [v.tolist() for _, v in rows]})
    ).repartition(min(8, -(-len(rows) // 100)))

    def product(right: np.ndarray) -> np.ndarray:
        """A'A times `right`, summed over the passages by Spark, in slices of rows."""
        known = spark.sparkContext.broadcast(right)
        height = 1024

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(known.value.shape)
            for batch in batches:
                for column, value in zip(batch.column("column"), batch.column("value"), strict=True):
                    c, v = column.values.to_numpy(), value.values.to_numpy()
                    total[c] += np.outer(v, v @ known.value[c])
            starts = list(range(0, len(total), height))
            slices = [total[s : s + height].tobytes() for s in starts]
            yield pa.RecordBatch.from_arrays([pa.array(starts), pa.array(slices, pa.binary())], names=["start", "part"])

        def add(rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x) for x in rows.column("part").to_pylist())
            return pa.table({"start": rows.column("start")[:1], "part": pa.array([total.tobytes()], pa.binary())})

        schema = "start long, part binary"
        summed = table.mapInArrow(part, schema).groupBy("start").applyInArrow(add, schema).collect()
        return np.concatenate([np.frombuffer(r.part).reshape(-1, right.shape[1]) for r in sorted(summed)])

    basis = np.random.default_rng(5).normal(size=(len(vocabulary), size))
    for _ in range(POWER_STEPS):
        basis, _ = np.linalg.qr(product(basis))
    square, turn = np.linalg.eigh(basis.T @ product(basis))
    keep = np.argsort(-square)[: min(rank, int((square > 1e-9).sum()))]
    vectors = basis @ turn[:, keep]
    passages = np.stack([v @ vectors[c] for c, v in rows], axis=1)
    passages /= np.maximum(np.sqrt((passages**2).sum(axis=0)), 1e-12)
    weighted = np.concatenate([vectors * idf[bucket][:, None], np.zeros((1, len(keep)))]).astype(np.float32)
    return Space(vocabulary, place, weighted, passages.astype(np.float32), np.array([i for i, _ in pieces]))


def common_subsequence(needle: np.ndarray, words: np.ndarray) -> int:
    """The length of the longest common subsequence, with one bit for each word of the needle."""
    at: dict[int, int] = {}
    for i, word in enumerate(needle.tolist()):
        at[word] = at.get(word, 0) | 1 << i
    every = (1 << len(needle)) - 1
    row = every
    for word in words.tolist():
        if (match := at.get(word)) is not None:
            both = row & match
            row = (row + both | row - both) & every
    return len(needle) - row.bit_count()


def common_weight(needle: np.ndarray, weight: np.ndarray, words: np.ndarray) -> float:
    """The weight of the heaviest common subsequence, as a share of the needle's."""
    row = np.zeros(len(needle) + 1)
    for word in words:
        match = np.flatnonzero(needle == word)
        if len(match):
            row[match + 1] = np.maximum(row[match + 1], row[match] + weight[match])
            row = np.maximum.accumulate(row)
    return float(row[-1] / weight.sum()) if len(weight) else 0.0


#: Of each text and item the windows, (start, end), with their highest cosine.
Candidates = dict[tuple[int, int], dict[tuple[int, int], float]]


def near_words(w: Words, hashes: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Items and words, where rarer words of the item stand close together in a text."""
    place = np.minimum(np.searchsorted(block.rare, hashes), len(block.rare) - 1)
    at = np.flatnonzero(block.rare[place] == hashes)
    place = place[at]
    n = block.first[place + 1] - block.first[place]
    item = block.owner[np.repeat(block.first[place] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    word = np.repeat(at, n)
    order = np.lexsort((word, item))
    item, word, place = item[order], word[order], np.repeat(place, n)[order]
    # Of one word again and again the first and the last are enough.
    same = (item[1:] == item[:-1]) & (place[1:] == place[:-1]) & (w.doc[word[1:]] == w.doc[word[:-1]])
    inner = np.zeros(len(item), bool)
    inner[1:-1] = same[1:] & same[:-1]
    item, word = item[~inner], word[~inner]
    # From each word to the one that makes them enough: those in between are near each other.
    opens = np.arange(len(item))
    last = np.minimum(opens + block.least[item] - 1, len(item) - 1)
    close = (item[last] == item) & (last - opens == block.least[item] - 1) & (w.doc[word[last]] == w.doc[word])
    opens = np.flatnonzero(close & (word[last] - word < block.span[item]))
    keep = np.zeros(len(item) + 1, np.int64)
    np.add.at(keep, opens, 1)
    np.add.at(keep, last[opens] + 1, -1)
    keep = np.cumsum(keep)[:-1] > 0
    return item[keep], word[keep]


def add_candidates(found: Candidates, w: Words, hashes: np.ndarray, block: Block) -> None:
    """Windows around near words that come close to a passage of their item."""
    items, at = near_words(w, hashes, block)
    if not len(items):
        return
    for width, step in SCALES:
        own = at - w.first[w.doc[at]]
        most = np.maximum(-(-(w.count[w.doc[at]] - width) // step), 0)
        low = np.minimum(np.maximum(-(-(own - width + 1) // step), 0), most)
        n = np.minimum(own // step, most) - low + 1
        k = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = w.first[np.repeat(w.doc[at], n)] + k * step
        # Windows that hold half as many of the words as are to be close together.
        key, times = np.unique(np.repeat(items, n) * len(hashes) + start, return_counts=True)
        item, window = np.divmod(key, len(hashes))
        enough = 2 * times >= block.least[item]
        item, window = item[enough], window[enough]
        doc = w.doc[window]
        end = np.minimum(window + width, w.first[doc] + w.count[doc])
        space_of = block.space_of[item]
        for number, space in enumerate(block.spaces):
            mine = np.flatnonzero(space_of == number)
            for part in np.array_split(mine, max(1, -(-len(mine) // 2000))):
                if len(part):
                    cosine = latent_cosine(hashes, window[part], end[part], item[part], space)
                    for k in np.flatnonzero(cosine >= COSINE).tolist():
                        i = part[k]
                        windows = found.setdefault((int(doc[i]), int(item[i])), {})
                        windows[int(window[i]), int(end[i])] = float(cosine[k])


def latent_cosine(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray, space: Space) -> np.ndarray:
    """The highest cosine of each window and a passage of its item; items are ascending."""
    start, first, window = np.unique(start, return_index=True, return_inverse=True)
    size = end[first] - start
    word = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    place = space.place[_bucket(hashes[word])]
    known = (place >= 0) & (space.vocabulary[place] == hashes[word])
    rows = space.vectors[np.where(known, place, len(space.vectors) - 1)]
    sums = np.add.reduceat(rows, np.cumsum(size) - size, axis=0)
    sums /= np.maximum(np.sqrt((sums**2).sum(axis=1)), 1e-9)[:, None]
    sums = sums[window]
    out = np.zeros(len(item))
    edge = np.concatenate([[0], np.flatnonzero(np.diff(item)) + 1, [len(item)]])
    for a, b in zip(edge, edge[1:], strict=False):
        mine = slice(*np.searchsorted(space.owner, [item[a], item[a] + 1]))
        out[a:b] = (sums[a:b] @ space.passages[:, mine]).max(axis=1)
    return out


def found_in(texts: list[bytes], block: Block) -> Iterator[tuple[int, int, float, float, float]]:
    """Text, item, cosine, share of the item's words and of its answer's, for each item found in a text."""
    w = Words(texts, table=LETTERS)
    hashes = w.hashes()
    near: Candidates = {}
    add_candidates(near, w, hashes, block)
    result: dict[tuple[int, int], tuple[float, float, float]] = {}
    for (doc_i, item_i), windows in near.items():
        item = block.items[item_i]
        reach = len(item.words)
        first, count = w.first[doc_i], w.count[doc_i]
        # Words that are not the item's are in no common subsequence.
        low = max(first, min(windows)[0] - reach)
        stretch = hashes[low : min(first + count, max(e for _, e in windows) + reach)]
        own = np.flatnonzero(np.isin(stretch, item.words))
        stretch = stretch[own]
        in_vain: list[tuple[int, int]] = []
        # The longest first: what they do not hold, stretches within them do not hold either.
        for (start_i, end_i), cosine_i in sorted(windows.items(), key=lambda x: (x[0][0] - x[0][1], -x[1], x[0])):
            if any(a <= start_i and end_i <= b for a, b in in_vain):
                continue
            around = stretch[slice(*np.searchsorted(own, [start_i - reach - low, end_i + reach - low]))]
            if len(around) < PARAPHRASED * reach:
                in_vain.append((start_i, end_i))
                continue
            share = common_subsequence(item.words, around) / max(reach, 1)
            answer = common_subsequence(item.answer, around) / max(len(item.answer), 1)
            enough = share >= SIMILAR or (
                share >= PARAPHRASED
                and answer >= SIMILAR
                and common_weight(item.words, block.weight[item_i], around) >= PARAPHRASED_WEIGHT
            )
            if enough:
                result[doc_i, item_i] = max(result.get((doc_i, item_i), (0.0, 0.0, 0.0)), (share, answer, cosine_i))
            else:
                in_vain.append((start_i, end_i))
            if share == answer == 1:  # no window of a lower cosine can have more
                break
    for (doc_i, item_i), (share, answer, cosine_i) in sorted(result.items()):
        yield doc_i, item_i, cosine_i, share, answer


def _by_part(benchmark: DataFrame) -> Iterator[Row]:
    """The items with a text, those of a part of them at a time, each part sorted and read by one job.

    Parts go by a hash. A sorted table read in turn would take a job for each partition.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    parts = (items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0) // READ_CHARS + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield from sorted(items.where(part == k).collect(), key=lambda r: (r.item_id is not None, r.item_id, r.text))


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, similarity and answer for each item of `benchmark` found in a document.

    `similarity` is the share of the item's words, `answer` that of its last words, in
    order around the place. Words are runs of letters and digits, in lower case. Null
    and empty texts and items hold nothing and are never found; long texts are searched
    whole. Items that tie are all found. Rows that repeat are judged each, an empty table
    of either kind gives an empty one. Other columns are not read.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    types = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {types[0]}, item_id {types[1]}, cosine double, similarity double, answer double"
    to_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)

    frequencies, total = document_frequencies(docs)
    idf = weights(frequencies, total)

    def search(items: list[Item]) -> DataFrame | None:
        block = block_of(spark, items, frequencies, idf)
        if block is None:
            return None
        known = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for base, chunk in chunked(text_bytes(batch)):
                    found = list(found_in(chunk, known.value))
                    if found:
                        doc, item, cosine, share, answer = zip(*found, strict=True)
                        ids = [known.value.items[i].item_id for i in item]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(pa.array([base + d for d in doc])),
                             pa.array(ids, to_arrow), pa.array(cosine), pa.array(share), pa.array(answer)],
                            names=["doc_id", "item_id", "cosine", "similarity", "answer"],
                        )

        return docs.mapInArrow(run, schema)

    out: list[DataFrame | None] = []
    block: list[Item] = []
    size = 0
    for row in _by_part(benchmark):
        item = item_of(row.item_id, row.text.encode())
        if block and size + len(item.words) > BLOCK_WORDS:
            out.append(search(block))
            block, size = [], 0
        block.append(item)
        size += len(item.words)
    if block:
        out.append(search(block))
    found = [rows for rows in out if rows is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
