"""Near-duplicates and repeated passages against brute force on small tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import brute_windows
from pyspark.sql.classic.dataframe import DataFrame

from tarnbeck.llm import simhash, suffixes
from tarnbeck.llm.components import components
from tarnbeck.llm.simhash import links, near_duplicates, op8_simhash
from tarnbeck.llm.suffixes import repeated_strings
from tarnbeck.llm.windows import repeated_windows

SPACE = " \t\n\v\f\r"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def brute_components(nodes, linked):
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(nodes))]


def word(rng, letters="abcdeé"):
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))


def near_copies(rng, n):
    bases = [[word(rng) for _ in range(rng.choice([0, 1, 2, 40, 200]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            if words:
                words[rng.randrange(len(words))] = word(rng)
        text = "".join(w + rng.choice([" ", "\n", "\t", "  "]) for w in words)
        rows.append((i, rng.choice([text, text.upper(), text]) if text else rng.choice([None, "", " \n"])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_simhash_is_the_brute_force(documents, seed):
    rng = random.Random(seed)
    rows = near_copies(rng, 80)
    rows += [(1000, rows[0][1]), (1001, "x " * 30_000)]  # an exact copy and a long text
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    want = sorted((rows[i][0], fps[i], rows[r][0]) for i, r in enumerate(roots))
    got = near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want


@pytest.mark.parametrize("limit", [50_000, 3])
def test_links_find_all_pairs_within_three_bits(spark, monkeypatch, limit):
    """With anchors split into parts too; some anchors hold many fingerprints."""
    monkeypatch.setattr("tarnbeck.llm.simhash.ANCHOR_ROWS", limit)
    rng = random.Random(4)
    fps = {0, 2**64 - 1}
    for _ in range(30):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(12):
            y = x
            for _ in range(rng.randint(1, 4)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
            x = rng.choice([x, y])
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    edges = links(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4))
    assert all((a ^ b).bit_count() <= 3 for a, b in ((r.a % 2**64, r.b % 2**64) for r in edges.collect()))
    root = {r.node % 2**64: r.root for r in components(edges).collect()}
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    got = [root.get(f, ("alone", f)) for f in fps]
    same = {}
    for g, w in zip(got, want, strict=True):
        assert same.setdefault(g, w) == w
    assert len(set(got)) == len(set(want))


def test_an_anchor_of_many_homes_is_compared_in_bounded_cells(spark, monkeypatch):
    """Most fingerprints have one home anchor: each cell of its grid is bounded, and together they find all links."""
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", 20)
    rng = random.Random(6)
    # In the upper half at most one bit from the code word 0, so that it is the home of all.
    fps = {(1 << rng.randrange(32, 63) if rng.random() < 0.8 else 0) | rng.getrandbits(32) & 0x0F0F0F for _ in range(400)}
    fps |= {1 << rng.randrange(32, 63) | 1 << rng.randrange(32, 63) for _ in range(100)}
    fps = sorted(fps)
    sizes = []
    cells = simhash._cells_of

    def spy(sent):
        out = cells(sent)
        sizes.extend(r["count"] for r in out.groupBy("anchor", "part", "home").count().collect())
        return out

    monkeypatch.setattr(simhash, "_cells_of", spy)
    edges = links(spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4))
    root = {r.node: r.root for r in components(edges).collect()}
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    assert [fps.index(root.get(f, f)) for f in fps] == want
    # Blocks are dealt by a hash, so they differ somewhat in size.
    assert len(sizes) > 100 and max(sizes) <= 3 * 20


def test_components_of_a_long_path(spark):
    edges = [(i + 1, i) if i % 2 else (i, i + 1) for i in range(300)] + [(500, 501), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


def test_fingerprints_of_the_query_are_hex_digits(spark):
    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r.fingerprint for r in op8_simhash(spark, small).collect()}
    assert got == {i: f"{brute_fingerprint(t):016x}" for i, t in texts.items()}


def test_simhash_edge_cases(documents, clashing):
    assert near_duplicates(documents([])).collect() == []
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, None), (9, None), (2, "A B\tC  D")]
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(clashing(rows)).collect())
    assert got == {(5, 2): 2, (None, 2): 1, (None, 9): 1, (9, 9): 1, (2, 2): 1}


def passages(rng, n, size):
    shared = [[word(rng) for _ in range(rng.randint(size // 2, 3 * size))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(shared) if rng.random() < 0.6 else [word(rng, "xyz\x1c ")] * rng.randint(1, 2 * size)
        rows.append((i, "".join(w + rng.choice(SPACE) for w in words)))
    return rows


@pytest.mark.parametrize("hot", [10**9, 0])
@pytest.mark.parametrize("bits", [8, 22])
def test_windows_are_the_brute_force(documents, hot, bits):
    """With a sketch far too small, which only sends more, and with every window split as a hot one."""
    rng = random.Random(bits)
    rows = passages(rng, 40, 5)
    rows += [(100, None), (101, ""), (102, "a " * 20_000), (None, rows[3][1]), (3, rows[3][1])]
    got = repeated_windows(documents(rows), window=5, bits=bits, hot_texts=hot).collect()
    assert Counter(map(tuple, got)) == Counter(brute_windows(rows, 5))


def test_windows_edge_cases(documents, clashing):
    assert repeated_windows(documents([]), window=3, bits=10).collect() == []
    rows = [(2, "a b c d"), (1, "a b c"), (1, "a b c"), (3, "b c"), (None, "a b c")]
    got = repeated_windows(clashing(rows), window=3, bits=10, carry=("doc_id", "kept", "h")).collect()
    assert got[0].asDict().keys() == {"doc_id", "h", "n_words", "n_removed", "kept"}
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(brute_windows(rows, 3))


def thue_morse(length):
    """Two words that a weighted sum of bytes modulo a power of two cannot tell apart."""
    ones = [i.bit_count() % 2 for i in range(length)]
    return "".join("ab"[x] for x in ones), "".join("ba"[x] for x in ones)


@pytest.mark.parametrize("length", [64, 256, 1024, 4096])
def test_windows_differ_in_one_regular_word(documents, length):
    common = " ".join(f"word{i}" for i in range(49))
    rows = [(i, f"{w} {common}") for i, w in enumerate(thue_morse(length))]
    assert Counter(map(tuple, repeated_windows(documents(rows)).collect())) == Counter(brute_windows(rows, 50))
    assert {r.n_removed for r in repeated_windows(documents(rows)).collect()} == {0}


def test_windows_of_a_regular_pattern_of_words(documents):
    """A window of 1,024 words against one with the same words the other way round."""
    rows = [(i, " ".join(w)) for i, w in enumerate(thue_morse(1024))]
    assert {r.n_removed for r in repeated_windows(documents(rows), window=1024).collect()} == {0}


def brute_strings(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[j : j + length] for t in texts for j in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for j in range(len(t) - length + 1):
            if counts[t[j : j + length]] > 1:
                gone[j : j + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[: len(t)], [False]]).astype(int)))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])
        out.append((i, len(t), hashlib.sha256(kept).hexdigest(), tuple(zip(edge[::2], edge[1::2], strict=True))))
    return out


def digest(rows):
    return Counter((r.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest(), tuple(map(tuple, r.spans))) for r in rows)


@pytest.mark.parametrize("bits,hot", [(6, 2000), (20, 2000), (6, 0), (20, 0)])
def test_strings_are_the_brute_force(documents, monkeypatch, bits, hot):
    """With a sketch far too small, and with every anchor of the sample, here all texts, split."""
    monkeypatch.setattr(suffixes, "SAMPLE_SHARE", 1)
    rng = random.Random(bits)
    shared = ["".join(rng.choice("abé ") for _ in range(rng.randint(5, 120))) for _ in range(5)]
    rows = [
        (i, "".join(rng.choice(shared) if rng.random() < 0.5 else word(rng) * rng.randint(1, 9) for _ in range(rng.randint(0, 6))))
        for i in range(60)
    ]
    rows += [(100, None), (101, ""), (102, "ab" * 300), (103, "q" * 5_000), (7, rows[7][1]), (None, rows[8][1])]
    got = repeated_strings(documents(rows), length=20, gram=8, bits=bits, hot_stretches=hot).collect()
    assert digest(got) == Counter(brute_strings(rows, 20))


def test_strings_edge_cases(documents, clashing):
    assert repeated_strings(documents([]), length=20, gram=8, bits=8).collect() == []
    rows = [(1, "x" * 19), (2, "x" * 20), (3, "é" * 15), (3, "é" * 15), (None, None)]
    got = repeated_strings(clashing(rows), length=20, gram=8, bits=8).collect()
    assert digest(got) == Counter(brute_strings(rows, 20))


@pytest.mark.parametrize("seed", range(3))
def test_sorting_in_pieces_is_sorting_at_once(monkeypatch, seed):
    """Rows of a bucket with copies and frequent anchors, held a few at a time."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 60))).encode() for _ in range(300)]
    rows = []
    for text in texts:
        anchor = rng.choice([1, 1, 1, rng.randint(2, 40)])
        rows += [(7, anchor, xxhash.xxh64_intdigest(text) >> 1, rng.random() < 0.1, text if k == 0 else rng.choice([text, None])) for k in range(rng.randint(1, 4))]
    rows.sort(key=lambda r: r[1:3])
    table = pa.table(dict(zip(("bucket", "anchor", "content", "whole", "stretch"), map(list, zip(*rows, strict=True)), strict=True)))

    def found(limit, batch):
        monkeypatch.setattr(suffixes, "SORT_BYTES", limit)
        out = suffixes.sorted_runs(iter(table.to_batches(batch)), 20)
        return sorted(tuple(r.values()) for b in out for r in b.to_pylist())

    assert found(1 << 30, 10_000) and found(1 << 30, 10_000) == found(100, 7) == found(5_000, 64)


@pytest.mark.parametrize("hot", [2000, 3])
def test_long_strings_with_hot_passages(documents, monkeypatch, hot):
    """At the query's length: a passage in a third of the texts, and a phrase too short to go in half of them."""
    monkeypatch.setattr(suffixes, "SAMPLE_SHARE", 2)
    rng = random.Random(hot)
    passage, phrase, near = (" ".join(word(rng) for _ in range(n)) for n in (90, 30, 50))
    phrase = phrase[:120]
    rows = []
    for i in range(240):
        parts = [" ".join(word(rng) for _ in range(rng.randint(0, 120))) for _ in range(3)]
        middle = passage if i % 3 == 0 else near[rng.randint(0, 40) :] if i % 3 == 1 else ""
        rows.append((i, parts[0] + middle + parts[1] + (phrase if i % 2 else "") + parts[2]))
    assert digest(repeated_strings(documents(rows), bits=22, hot_stretches=hot).collect()) == Counter(brute_strings(rows, 200))


def test_each_distinct_stretch_is_sorted_once(spark, documents, monkeypatch):
    """A passage in a third of the texts: one row of each task for each distinct stretch reaches the sort."""
    monkeypatch.setattr("tarnbeck.llm.text.CHUNK_BYTES", 3_000)
    rng = random.Random(3)
    passage = " ".join(word(rng) for _ in range(100))
    rows = [(i, " ".join(word(rng) for _ in range(60)) + (passage if i % 3 == 0 else "")) for i in range(300)]
    sent = []
    sort = DataFrame.sortWithinPartitions

    def spy(df, *keys):
        if keys == ("anchor", "content"):
            sent.append(df.select("content", "stretch").collect())
        return sort(df, *keys)

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", spy)
    repeated_strings(documents(rows), bits=22).collect()
    (found,) = sent
    times = Counter(r.content for r in found)
    # Three tasks, each of which sends a stretch once, and once more where it meets it again.
    assert max(times.values()) <= 6 and max(Counter(r.content for r in found if r.stretch is not None).values()) <= 3
