"""Periodic runs of words: online sparse dynamic programming over diagonals.

For each word an earlier occurrence of the same words at lag d makes the match on
diagonal d one longer. A diagonal that ends with a match long enough, `times` - 1
periods, is emitted at once as a run.

Which occurrences have to be followed is what makes it sparse. On diagonal d a run has a
match of at least g words, where g/2 <= d < g, so only earlier occurrences of the last g
words count. And of those only the nearest does: were it at a lag e < d, both d and e
would be periods of more than d + e words of the run, so their greatest common divisor
would be one too, and d not the smallest. So each word follows one diagonal for each
power of two, and words whose last g words are not repeated follow none. Lags that are
multiples of a run's period never become active.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.text import WORD_BASE, Spans, Words, chunked, mix, text_bytes
from tarnbeck.sources.tables import table

LEAST, TIMES = 24, 3


def find_runs(word: np.ndarray, doc: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and smallest period of each run, by first word and period; words of a text stand together."""
    found = [np.zeros((3, 0), np.int64)]
    gram = max(2 * least // 3, 1)
    # Every run matches so many words on its diagonal, whatever its period.
    hashes = Spans(word, WORD_BASE).all(gram)
    inside = doc[: len(hashes)] == doc[gram - 1 :] if len(hashes) else np.zeros(0, bool)
    key = mix(hashes ^ mix(doc[: len(hashes)].astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(inside)
    key = key[at]
    rank = np.full(len(word), -1)  # of the last `gram` words up to each word, where they are repeated
    at = at + gram - 1
    lowest = 1
    while len(at):
        at, key, same = _repeated(at, key)
        if not len(at):
            break
        lag = np.zeros(len(at), np.int64)
        lag[1:] = np.where(same, at[1:] - at[:-1], 0)
        order = np.argsort(at)
        here, lag = at[order], lag[order]
        active = (lag >= lowest) & (lag < gram)
        here, lag = here[active], lag[active]
        # A diagonal goes on with the next word at the same lag; where it ends it is emitted.
        opens = np.ones(len(here), bool)
        opens[1:] = (here[1:] != here[:-1] + 1) | (lag[1:] != lag[:-1])
        start = np.flatnonzero(opens)
        if len(start):
            last = here[np.append(start[1:], len(here)) - 1]
            period = lag[start]
            first = here[start] - gram + 1 - period
            length = last - first + 1
            long = length >= np.maximum(least, times * period)
            found.append(np.stack([first, length, period])[:, long])
        # Twice as many words: those up to the word and those before them.
        rank[:] = -1
        number = np.concatenate([[0], np.cumsum(~same)])
        rank[at] = number
        ends = at[at >= gram]
        ends = ends[rank[ends - gram] >= 0]
        ends = np.sort(ends[doc[ends - gram] == doc[ends]])
        key = rank[ends - gram] * (number[-1] + 1) + rank[ends]
        at, lowest, gram = ends, gram, 2 * gram
    first, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, first))
    return first[order], length[order], period[order]


def _repeated(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending places those whose key is there again, by key and place, and whether each has the key of the one before it."""
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return at[:0], key[:0], np.zeros(0, bool)
    place = np.minimum(np.searchsorted(again, key), len(again) - 1)
    keep = again[place] == key
    at, key = at[keep], key[keep]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    return at, key, key[1:] == key[:-1]


def periodic_runs(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, `runs` and `collapsed`, the text with each run cut to its first period, for each row.

    Words are runs of bytes other than the blank and 0x09 to 0x0D. A run is a stretch of
    at least `least` words and `times` periods (3 or more) that no neighbouring word
    continues, with its smallest period; (start, length, period), by start and period.
    Words of a run after its first period are dropped from `collapsed`, in which words
    are joined by one blank; a word that is within the first period of one run and later
    in another is dropped. A null or empty text has no words and an empty `collapsed`;
    long texts are read whole; texts do not depend on each other, so repeated rows are
    judged each. An empty table gives an empty one. Other columns are not read.
    """
    if least < 1 or times < 3:
        raise ValueError("runs have at least one word and three periods")
    docs = documents.select("doc_id", "text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, chunk in chunked(text_bytes(batch)):
                words = Words(chunk)
                first, length, period = find_runs(words.hashes(), words.doc, least, times)
                dropped = np.zeros(len(words.doc) + 1, np.int64)
                np.add.at(dropped, first + period, 1)
                np.add.at(dropped, first + length, -1)
                keep = np.cumsum(dropped)[:-1] == 0
                own = words.doc[first] if len(first) else first
                offsets = np.searchsorted(own, np.arange(len(chunk) + 1))
                runs = pa.StructArray.from_arrays(
                    [pa.array(first - words.first[own]), pa.array(length), pa.array(period)], fields=list(kind.value_type)
                )
                collapsed = []
                for i, text in enumerate(chunk):
                    left = text.split()
                    if offsets[i + 1] > offsets[i]:
                        a = words.first[i]
                        left = [left[j] for j in np.flatnonzero(keep[a : a + words.count[i]])]
                    collapsed.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(base, len(chunk)),
                        pa.array(words.count),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.mapInArrow(
        judge,
        f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the texts, by the crc32 of the id, the words from one place on repeat.

    With h that number and g = h div 10: in n words each from place a = g mod n on becomes
    the one at a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8). Texts with a
    null id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = documents.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, split).alias("_words"))
    rows = rows.withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.expr("(_h div 10) % _n")))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    planted = F.expr(
        "array_join(concat(slice(_words, 1, int(_a)), slice(flatten(array_repeat(slice(_words, int(_a) + 1, int(_p)), "
        "int((_n - _a + _p - 1) div _p))), 1, int(_n - _a))), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))


def _best(runs: Column) -> Column:
    """The first run with the greatest length to period, compared exactly."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    return found.withColumn("best", _best(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Pairs of equal 16 words in a text, put together to maximal stretches of one lag. A run has 16 words or more of matches.
OP12_SQL = """
WITH split AS (
    SELECT doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
               lambda c, b: list_reduce(
                   [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda d, z: xor(d >> 1, 3988292384::BIGINT * (d & 1))
               )
           )) AS h
    FROM documents
),
counted AS (
    SELECT doc_id, words, h, len(words) AS n, h // 10 AS g FROM split
),
placed AS (
    SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a,
           CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p
    FROM counted
),
texts AS (
    SELECT doc_id, n,
           CASE WHEN a IS NULL THEN words
                ELSE list_concat(words[1:a], list_transform(range(a, n), lambda i: words[a + (i - a) % p + 1])) END AS words
    FROM placed
),
grams AS (
    SELECT doc_id, n, i, md5(array_to_string(words[i - 14:i + 1], ' ')) AS gram
    FROM (SELECT doc_id, n, words, unnest(range(15, n)) AS i FROM texts)
),
again AS (
    SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1
),
repeated AS (
    SELECT * FROM grams SEMI JOIN again USING (doc_id, gram)
),
pairs AS (
    SELECT x.doc_id, x.i, x.i - y.i AS lag
    FROM repeated x JOIN repeated y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i < x.i
    WHERE 3 * (x.i - y.i) <= x.n
),
islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs
),
stretches AS (
    SELECT doc_id, lag, min(i) - 15 - lag AS start, max(i) - min(i) + 16 + lag AS length
    FROM islands GROUP BY doc_id, lag, island
),
runs AS (
    SELECT doc_id, start, length, min(lag) AS period
    FROM stretches WHERE length >= greatest(24, 3 * lag) GROUP BY doc_id, start, length
),
summed AS (
    SELECT doc_id, count(*) AS n_runs,
           first({'start': start, 'length': length, 'period': period} ORDER BY length::DOUBLE / period DESC, start, period) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM texts) w
    ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
)
SELECT t.doc_id,
       coalesce(s.n_runs, 0)::BIGINT AS n_runs,
       s.best['start']::BIGINT AS start,
       s.best['length']::BIGINT AS length,
       s.best['period']::BIGINT AS period,
       (1000 * s.best['length'] // s.best['period'])::BIGINT AS exponent_milli,
       sha256(coalesce(s.lines, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN summed s ON t.doc_id = s.doc_id LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
