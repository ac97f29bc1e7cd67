"""The learnt operators: held-out accuracy, independence of partitioning, and odd inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tarnbeck.llm import quality as quality_module
from tarnbeck.llm import toxicity as toxicity_module
from tarnbeck.llm.labelled import sample_per_label
from tarnbeck.llm.language import identify_language, marginals, op1_language
from tarnbeck.llm.neighbours import TARGET, balanced_parts, fit, nearest, neighbour_graph, op2_neighbours, parts_by_probability, search
from tarnbeck.llm.quality import op7_quality, quality
from tarnbeck.llm.text import Words
from tarnbeck.llm.toxicity import op9_toxicity, toxicity

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"


def auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def held_out(spark, query, label):
    found = query(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = found.select(label, "score", "predicted").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    return np.array([r[label] for r in rows]), np.array([r.score for r in rows])


def test_quality_on_held_out_documents(spark):
    label, score = held_out(spark, op7_quality, "quality")
    assert auc(label, score) > 0.99 and np.mean((score >= 0.5) == label) > 0.97


def test_toxicity_on_held_out_documents(spark):
    label, score = held_out(spark, op9_toxicity, "toxic")
    assert auc(label, score) > 0.95 and np.mean((score >= 0.5) == label) > 0.93


def test_toxicity_sees_misspelt_words(documents):
    rng = random.Random(1)

    def text(bad):
        words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randint(1, 3))) for _ in range(40)]
        return " ".join(words + bad)

    rows = [(i, text(["disgusting", "worthless"] if i % 2 else [])) for i in range(400)]
    labelled = documents(rows).withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    docs = documents([(1, text(["disgustting"])), (2, text([])), (3, text(["worthlesss", "disgussting"]))])
    score = {r.doc_id: r.score for r in toxicity(docs, labelled).collect()}
    assert score[1] > score[2] and score[3] > 0.5 > score[2]


def test_language_on_held_out_documents(spark):
    found = op1_language(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    rows = found.select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99


def test_language_labels_each_word_of_mixed_text(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    german, french = (
        docs.where(F.col("lang") == lang).orderBy("n_chars").where("n_chars > 400").first().text.split()[:30]
        for lang in ("de", "fr")
    )
    (row,) = identify_language(documents([(1, " ".join(german + french))]), docs).collect()
    label = [None] * 60
    for r in row.runs:
        label[r.first : r.end] = [r.lang] * (r.end - r.first)
    assert np.mean([x == "de" for x in label[:30]]) > 0.9 and np.mean([x == "fr" for x in label[30:]]) > 0.9


def test_forward_backward_in_pieces_is_that_of_the_whole():
    rng = np.random.default_rng(0)
    emissions, move = rng.normal(size=(3, 700)), np.exp(rng.normal(size=(3, 3)))
    first, count = np.array([0, 200, 200, 201]), np.array([200, 0, 1, 499])
    got = marginals(emissions, first, count, move)
    for a, c in zip(first, count, strict=True):
        e = np.exp(emissions[:, a : a + c].T)
        alpha, beta = e.copy(), np.ones_like(e)
        for t in range(1, c):
            alpha[t] = (alpha[t - 1] @ move) * e[t]
            alpha[t] /= alpha[t].sum()
        for t in range(c - 2, -1, -1):
            beta[t] = move @ (e[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        both = alpha * beta
        np.testing.assert_allclose(got[:, a : a + c].T, both / both.sum(axis=1, keepdims=True), atol=1e-9)


def some_texts(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "Eps", "zeta9", "eta!", "theta"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))).encode() for _ in range(n)]


def test_coordinate_descent_reaches_the_optimum(monkeypatch):
    """Against the dual problem solved by projected gradient steps over all rows at once."""
    monkeypatch.setattr(quality_module, "PASSES", 400)
    rng = random.Random(2)
    texts = some_texts(rng, 40)
    labels = np.array([int(b"zeta9" in t or rng.random() < 0.2) for t in texts])
    ratios = np.random.default_rng(3).normal(size=quality_module.BUCKETS)
    weights, bias = quality_module.train(texts, labels, ratios)
    x = np.zeros((len(texts), quality_module.BUCKETS + 1))
    for row, found in zip(x, quality_module.indicators(texts), strict=True):
        row[found] = ratios[found]
        row /= np.sqrt(row @ row)
        row[-1] = 1
    sign = np.where(labels == 1, 1.0, -1.0)
    gram = (x @ x.T) * np.outer(sign, sign)
    alpha = np.zeros(len(texts))
    step = 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(40_000):
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, quality_module.COST)
    best = (alpha * sign) @ x
    got = np.append(weights / ratios, bias)
    np.testing.assert_allclose(x @ got, x @ best, atol=2e-3)


def test_joint_training_is_the_plain_one(monkeypatch):
    """Adam over embeddings and softmax, text by text and word by word."""
    monkeypatch.setattr(toxicity_module, "STEPS", 4)
    monkeypatch.setattr(toxicity_module, "TELLING", -1.0)  # every n-gram stays
    monkeypatch.setattr(toxicity_module, "DIMENSIONS", 3)
    rng = random.Random(4)
    texts = some_texts(rng, 12)
    labels = np.array([i % 3 == 0 for i in range(12)], np.int64)
    numbers, bias = toxicity_module.train(texts, labels)

    t = toxicity_module
    grams = {}
    for word in {w for x in texts for w in x.lower().split()}:
        grams[word] = np.concatenate([b for _, b in Words([word], folded=True).ngram_buckets(t.SIZES, t.BITS)]).astype(np.int64)
    start = np.random.default_rng(7)
    n = 1 << t.BITS
    params = [start.normal(0, 0.1, (n, 3)), start.normal(0, 0.1, (3, 2)), np.zeros(2)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    share = labels.mean()
    for step in range(1, t.STEPS + 1):
        vectors, softmax, offset = params
        grads = [t.DECAY / n * vectors, 1e-4 * softmax, np.zeros(2)]
        for text, label in zip(texts, labels, strict=True):
            words = text.lower().split()
            factor = t.SCALE / (len(words) + t.PAD)
            bag = sum(factor * vectors[grams[w]].sum(axis=0) / len(grams[w]) for w in words)
            p = np.exp(bag @ softmax + offset)
            error = (p / p.sum() - np.eye(2)[label]) * (0.5 / (share if label else 1 - share)) / len(texts)
            grads[1] = grads[1] + np.outer(bag, error)
            grads[2] = grads[2] + error
            for w in words:
                np.add.at(grads[0], grams[w], factor * (softmax @ error) / len(grams[w]))
        for i, (g, (m, v)) in enumerate(zip(grads, moments, strict=True)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[i] = params[i] - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    want = t.SCALE * params[0] @ (params[1][:, 1] - params[1][:, 0])
    seen = np.unique(np.concatenate(list(grams.values())))
    np.testing.assert_allclose(numbers[seen] / t.UNIT, want[seen], atol=5e-3 * np.abs(want[seen]).max())
    assert abs(bias - (params[2][1] - params[2][0])) < 1e-3


ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 ... 34"), (5, "x" * 300_000), (6, "wort " * 50_000), (6, "wort"), (None, "a")]


@pytest.mark.parametrize("learn", [[], [(1, "ein wort")], [(1, "ein wort"), (2, "a word"), (3, None)]])
def test_language_odd_inputs(clashing, learn):
    labelled = clashing([(i, t, lang) for (i, t), lang in zip(learn, ("de", "en", "fr"), strict=False)])
    got = identify_language(clashing(ODD), labelled, carry=("doc_id", "score")).collect()
    assert len(got) == len(ODD) and set(got[0].asDict()) == {"doc_id", "lang_pred", "score", "runs"}
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3, 4) or not learn)
    assert identify_language(clashing([]), labelled).collect() == []


@pytest.mark.parametrize("labels", [[], [0], [1], [0, 1, None]])
@pytest.mark.parametrize("operator,label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_inputs(spark, clashing, operator, label, labels):
    rows = [(i, f"text {i}", v) for i, v in enumerate(labels) if v is not None]
    labelled = spark.createDataFrame(rows, f"doc_id long, text string, {label} int")
    got = operator(clashing(ODD), labelled).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    if len(labels) == 1:
        assert all((r.score >= 0.5) == labels[0] for r in got)
    if not labels:
        assert all(r.score == 0.5 for r in got)
    assert operator(clashing([]), labelled).collect() == []


def test_sample_is_the_first_by_hash_of_each_label(spark, documents):
    """One label is rare, ids repeat, most labelled ids have no text."""
    rows = [(i, f"text {i}") for i in range(600)] + [(3, "text 3")] * 200 + [(None, "none"), (601, None)]
    docs = documents(rows)
    marks = [(i, int(i % 50 == 0)) for i in range(6000)] + [(0, 0), (7, None), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, mark int").repartition(3)
    keys = {r.doc_id: r.k for r in labels.select("doc_id", F.xxhash64("doc_id", F.lit(17)).alias("k")).collect()}
    for n in (3, 20, 1000):
        got = [(r.doc_id, r.text, r.mark) for r in sample_per_label(docs, "mark", n, labels)]
        want = []
        for mark in (0, 1):
            ids = sorted({i for i, m in marks if m == mark and i is not None and i < 600}, key=lambda i: keys[i])
            want += [(i, f"text {i}", mark) for i in ids[:n]]
        assert got == want


@pytest.mark.parametrize("query", [op7_quality, op9_toxicity])
def test_no_text_is_shuffled_to_find_labels(spark, query, monkeypatch):
    """Texts meet the chosen ids in a broadcast join; nothing else is shuffled with them, nor ranked."""
    plans = []
    collect = DataFrame.collect

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(DataFrame, "collect", spy)
    query(spark, SMALL)
    with_text = [p for p in plans if "text#" in p]
    assert with_text and all("BroadcastHashJoin" in p and "Window" not in p and "SortMergeJoin" not in p for p in with_text)
    for plan in with_text:  # from the top down: what is above the join is about chosen texts only
        below = plan[plan.index("BroadcastHashJoin") :]
        assert not any("Exchange hashpartitioning" in line or "Exchange range" in line for line in below.splitlines())


@pytest.mark.parametrize("query", [op1_language, op7_quality, op9_toxicity])
def test_scores_do_not_depend_on_partitioning(spark, conf, query):
    seen = set()
    for size in ("64m", "200k"):
        conf("spark.sql.files.maxPartitionBytes", size)
        seen.add(tuple(sorted(map(tuple, query(spark, "/root/testdata/sf0.001").collect()))))
    assert len(seen) == 1


def test_neighbours_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    place = {v: i for i, v in enumerate(ids)}
    by = {}
    for r in op2_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = []
    for q in ids[ids % 20 == 0]:
        found = by[q]
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - x[place[q]] @ x[place[v]]) < 1e-12 for _, v, s in found)
        score = x @ x[place[q]]
        score[place[q]] = -np.inf
        hits.append(len({f[1] for f in found} & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(hits) > 0.9


def brute_search(rows, k):
    width = max(((n, -w) for w, n in __import__("collections").Counter(len(v) for _, v in rows).items()))[1] * -1
    rows = [(i, v) for i, v in rows if len(v) == width]
    out = []
    for q, v in rows:
        if q % 20 == 0:
            others = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(others[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("limits", [(8192, 4096), (40, 3)])
def test_neighbours_with_copies_ties_and_odd_vectors(spark, monkeypatch, limits):
    """A vector with many copies, and blocks far smaller than its copies."""
    monkeypatch.setattr("tarnbeck.llm.neighbours.BLOCK_ROWS", limits[0])
    monkeypatch.setattr("tarnbeck.llm.neighbours.QUERY_ROWS", limits[1])
    monkeypatch.setattr("tarnbeck.llm.neighbours.TARGET", 1.1)
    rng = random.Random(2)
    good = [(i, [float(rng.randint(-2, 2)) for _ in range(5)] + [1.0]) for i in range(500)]
    good += [(i, [1.0, 2.0, 0.0, -1.0, 1.0, 1.0]) for i in range(500, 700)]
    bad = [(1000, None), (1020, []), (1040, [0.0] * 6), (1060, [1.0] * 7), (1080, [float("nan")] + [1.0] * 5),
           (1100, [float("inf")] + [1.0] * 5), (1120, [None] + [1.0] * 5), (None, [1.0] * 6)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    df = df.withColumns({n: F.lit("x") for n in ("part", "block", "score", "query", "rank")}).repartition(5)
    got = sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0, k=7, sample=300).collect()))
    assert got == brute_search(good, 7)


def test_neighbours_with_repeated_ids_among_copies(spark, monkeypatch):
    """The query's id is there several times, in a group of copies and with other vectors."""
    monkeypatch.setattr("tarnbeck.llm.neighbours.TARGET", 1.1)
    rng = random.Random(3)
    copy, far = [1.0, 2.0, 0.0, -1.0], [0.5, 0.5, 0.0, 0.0]
    rows = [(20, copy)] * 3 + [(i, copy) for i in range(21, 28)] + [(31, copy)] * 2
    rows += [(i, far) for i in range(41, 60)] + [(i, [rng.uniform(-0.1, 0.1) for _ in range(4)]) for i in range(61, 80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, search(df, F.col("vec_id") == 20, k=7).collect()))
    assert got == sorted(set(brute_search(rows, 7)))
    x, ids = np.array([[3.0, 0.0], [2.5, 0.0], [2.0, 0.0], [1.5, 0.0], [1.0, 0.0]]), np.array([20, 20, 20, 1, 2])
    assert nearest(x[:1], ids[:1], x, ids, 2)[1].tolist() == [1, 2]


def test_neighbours_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"

    def found(rows):
        return sorted(map(tuple, search(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).collect()))

    assert found([]) == [] and found([(0, None)]) == [] and found([(0, [1.0, 2.0])]) == []
    assert found([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [3.0, 4.0])]) == [(0, 1, 1, 11.0), (0, 2, 2, 11.0)]


def test_clustered_vectors_need_few_parts():
    """Recall over 0.9 with a quarter of the parts or fewer, as the fit itself foresees."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 24)) * 2
    x = centres[rng.integers(0, 60, 12_000)] + 0.4 * rng.normal(size=(12_000, 24))
    model, recall = fit(x[:4096], 5)
    probes = int(np.searchsorted(recall, TARGET)) + 1
    assert probes <= 8
    home = parts_by_probability(x, model, 1)[:, 0]
    queries = np.arange(5000, 12_000, 20)
    ranking = parts_by_probability(x[queries], model, probes)
    hits = []
    for q, parts in zip(queries, ranking, strict=True):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(np.isin(home[np.argsort(-score)[:20]], parts).mean())
    assert np.mean(hits) > 0.9


def test_parts_are_balanced_and_follow_clusters():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 16)) * 5
    x = np.concatenate([c + rng.normal(size=(100, 16)) for c in centres])
    graph = neighbour_graph(x, 10)
    part = balanced_parts(graph, 2)
    assert np.bincount(part).tolist() == [100] * 4
    assert (part[graph] == part[:, None]).mean() > 0.9
