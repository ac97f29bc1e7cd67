"""Alignment of two tokenizers against a plain version that tokenizes whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnbeck.llm import alignment
from tarnbeck.llm.alignment import TOKENIZERS, align, byte_alphabet, op11_alignment

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
SMALL = "/root/testdata/sf0.001"


def brute(rows):
    """By the decoded bytes of whole texts' tokens, one byte at a time."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_alphabet()
    found = []
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        tokens = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            tokens.append([(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids])
            ids = b.encode(text)
            pieces = [b.id_to_piece(i) for i in ids]
            tokens.append(
                [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, pieces, strict=True)]
            )
        if not text or any(b"".join(d for _, d in t) != raw for t in tokens):
            found.append((doc_id, [], [], [], []))
            continue
        at = [[k for k, (_, d) in enumerate(t) for _ in d] for t in tokens]
        ends = [set() for _ in tokens]
        for t, e in zip(tokens, ends, strict=True):
            n = 0
            for _, d in t:
                e.add(n := n + len(d))
        pairs = sorted(set(zip(*at, strict=True)))
        links = [(tokens[0][i][0], tokens[1][j][0]) for i, j in pairs]
        groups, start = [], 0
        for end in sorted(ends[0] & ends[1]):
            groups.append("|".join(
                ",".join(str(t[k][0]) for k in sorted(set(x[start:end]))) for t, x in zip(tokens, at, strict=True)
            ))
            start = end
        found.append((doc_id, *tokens, links, groups))
    count = Counter(p for row in found for p in set(row[3]))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return Counter(
        (doc_id, len(ta), len(tb), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
         sum(count[p] for p in links), ";".join(groups))
        for doc_id, ta, tb, links, groups in found
    )


def odd_texts(rng, n):
    parts = ["the", "cat", "naïve", "日本語", "🧿🧿", "ஜ", "丂a", "<s>", "<|endoftext|>", "<0x41>", "don't", "123456", "\n", "\t\t", "  ", "   x",
             " ", "　y", "\x1c", "\x00", "é", "‍", "c▁c", "…", "ﬁ", "A" * 50, "\r\n", "<unk>"]
    return [(i, " ".join(rng.choice(parts[:-6] if i % 4 else parts) for _ in range(rng.randint(1, 30)))) for i in range(n)]


def test_a_small_memory_of_segments_changes_nothing(monkeypatch):
    """Segments forgotten, taken over and met again; batches aligned in runs of few tokens."""
    texts = [t for _, t in odd_texts(random.Random(1), 200)] + [None, "", "x" * 500]
    seen = []
    for limit, run in ((10**6, 10**6), (15, 40)):
        monkeypatch.setattr(alignment, "SEGMENTS", limit)
        monkeypatch.setattr(alignment, "RUN_TOKENS", run)
        monkeypatch.setattr(alignment, "_remembered", {})
        packed = [alignment.segments(A, B).of(texts[i : i + 5]) for i in range(0, len(texts), 5)]
        batches = [pa.RecordBatch.from_arrays(columns, names=["a", "b"]) for columns in packed]
        both = alignment.tokenizers(A, B)
        found = [(part.num_rows, a) for part, a in alignment._aligned(iter(batches), both.lengths, both.id_type())]
        seen.append(([c.to_pylist() for columns in packed for c in columns], [g for _, a in found for g in a.groups()]))
    assert seen[0] == seen[1] and len(seen[0][1]) == len(texts)


@pytest.mark.parametrize("hot_pairs", [1 << 18, 40, 0])
def test_alignment_is_the_brute_force(documents, hot_pairs):
    """With most or all pairs joined instead of broadcast too."""
    rows = odd_texts(random.Random(hot_pairs), 120)
    rows += [(500, None), (501, ""), (502, " "), (503, "  a "), (504, "▁"), (505, "x" * 3000), (3, rows[3][1]), (None, rows[4][1]), (506, rows[4][1])]
    got = align(documents(rows), hot_pairs=hot_pairs).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_alignment_edge_cases(documents, clashing):
    assert align(documents([])).collect() == []
    assert [tuple(r) for r in align(documents([(1, None), (2, "")])).select("n_links", "groups").collect()] == [(0, ""), (0, "")]
    rows = [(1, "wort " * 60_000), (2, "x" * 200_000), (2, "a b"), (2, "a b"), (None, "a b")]
    df = clashing(rows).withColumns({c: F.lit("x") for c in ("row", "a", "b", "pair", "n", "groups", "n_best", "times")})
    assert Counter(map(tuple, align(df).collect())) == brute(rows)


def test_query_is_the_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = Counter((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(rows).elements())
    got = op11_alignment(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want
