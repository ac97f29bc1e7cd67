"""Periodic runs against a plain dynamic programme over all diagonals."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tarnbeck.llm.runs import op12_runs, periodic_runs, with_planted_runs

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least, times):
    n, found = len(words), {}
    for d in range(1, n // times + 1):
        match = 0
        for i in range(d, n + 1):
            if i < n and words[i] == words[i - d]:
                match += 1
            else:
                start, length = i - match - d, match + d
                if match and length >= max(least, times * d):
                    found.setdefault((start, length), d)
                match = 0
    return sorted((start, length, d) for (start, length), d in found.items())


def brute_collapsed(words, runs):
    gone = {i for start, length, d in runs for i in range(start + d, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute(rows, least, times):
    out = Counter()
    for doc_id, text in rows:
        words = split(text)
        runs = brute_runs(words, least, times)
        out[doc_id, len(words), tuple(runs), brute_collapsed(words, runs)] += 1
    return out


def found(df, **options):
    return Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs(df, **options).collect())


def periodic_text(rng):
    """Blocks that repeat, blocks of blocks, and words in between, over few different words."""
    words = []
    letters = rng.choice(["ab", "abc", "abcdefghij"])
    for _ in range(rng.randint(0, 5)):
        block = [rng.choice(letters) for _ in range(rng.randint(1, rng.choice([2, 5, 30])))]
        if rng.random() < 0.4:
            block = block * rng.randint(2, 5) + [rng.choice(letters)]
        words += block * rng.randint(1, 6)
        words = words[: len(words) - rng.randint(0, 3)] + [rng.choice(letters) for _ in range(rng.randint(0, 6))]
    return rng.choice([" ", "\n", "  "]).join(words)


@pytest.mark.parametrize("least,times", [(24, 3), (3, 3), (1, 3), (10, 4), (7, 3)])
def test_runs_are_the_brute_force(documents, least, times):
    rng = random.Random(least)
    rows = [(i, periodic_text(rng)) for i in range(250)] + [(900, None), (901, ""), (902, " \t"), (7, "a " * 30), (7, "a " * 30), (None, "x y " * 20)]
    assert found(documents(rows), least=least, times=times) == brute(rows, least, times)


def test_runs_in_which_all_parts_of_a_period_repeat(documents):
    """Every few words are there more than once in a period, so near occurrences are at other lags."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        block = "".join(rng.choice(["a" * 30, "a" * 17, "ab" * 12, "b" * 20 + "a", "aab" * 9]) for _ in range(rng.randint(2, 5)))
        rows.append((i, " ".join((block * 4)[: rng.randint(3 * len(block), 4 * len(block))])))
    assert found(documents(rows)) == brute(rows, 24, 3)


def test_runs_edge_cases(documents, clashing):
    assert periodic_runs(documents([])).collect() == []
    long = "wort " * 300_000
    rows = [(1, long), (2, None), (3, "x" * 1_200_000)]
    df = clashing(rows).withColumns({c: F.lit("x") for c in ("runs", "collapsed", "start", "period")})
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect()}
    assert got == {1: (300_000, [(0, 300_000, 1)], "wort"), 2: (0, [], ""), 3: (1, [], "x" * 1_200_000)}
    with pytest.raises(ValueError, match="three periods"):
        periodic_runs(df, times=2)


def planted(doc_id, text):
    words = split(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_is_the_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(split(r.text)) < 4000]
    rows += [(i, t) for i, t in ((None, "a b " * 30), (5, None), (25, ""))]
    got = with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, tuple(split(r.text))) for r in got.collect()) == Counter((i, tuple(planted(i, t))) for i, t in rows)
    by_id = {r.doc_id: r for r in op12_runs(spark, SMALL).collect()}
    assert len(by_id) == docs.count()
    some = 0
    for doc_id, text in rows[:-3]:
        words = planted(doc_id, text)
        runs = brute_runs(words, 24, 3)
        r = by_id[doc_id]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        some += len(runs) > 1
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{d}\n" for s, n, d in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
