"""The pipeline's stages on odd inputs and with columns of any name."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarnbeck.llm.decontaminate import contaminated
from tarnbeck.llm.language import Field, identify_language
from tarnbeck.llm.mixing import ADDED

SMALLEST = "/root/testdata/sf0.001"
CLASHING = (
    "score lang_pred runs kept n_words n_removed _id _doc _gone _first _first_of_copies _leaking _leaking_id fp component_id "
    "mix_slot mix_block mix_release mix_deadline mix_position _mix_key _mix_bucket _mix_source _column_0_set_aside "
    "text_hash h g anchor part cosine similarity answer item_id"
).split()
PASSAGE = " ".join(f"wort{i}" for i in range(60))
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n", "en", "a"), (4, "12 ... 34", "en", "a"),
    (5, "x" * 1_200_000, "en", "a"), (6, "wort " * 300_000, "de", "b"), (6, "ein wort", "de", "b"), (6, "ein wort", "de", "b"),
    (None, "ein wort mehr", "de", None), (7, PASSAGE + " sieben", "de", "b"), (8, "acht " + PASSAGE, "de", "b"),
    (9, "the cat sat on the mat and the dog", "en", "c"), (10, "the cat sat on the mat and the dog", "en", "c"),
]


def with_clashing(docs):
    return docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_and_clashing_columns(spark, documents, name, stage):
    docs = with_clashing(documents(ROWS))
    got = stage(spark, docs, SMALLEST)
    added = ADDED if name == "mixture" else ()
    assert got.columns == [c for c in docs.columns if c not in added] + list(added)
    rows = got.collect()
    for r in rows:
        mark = "-" if r.doc_id is None else str(r.doc_id)
        assert all(r[c] == c + mark for c in CLASHING if c not in added)
    ids = Counter(r.doc_id for r in rows)
    all_ids = Counter(r[0] for r in ROWS)
    by_id = {r.doc_id: r for r in rows}
    if name == "language":
        assert ids == {i: n for i, n in all_ids.items() if i not in (1, 2, 3, 4)}
        assert {r.text for r in rows} == {r[1] for r in ROWS if r[0] not in (1, 2, 3, 4)}
    elif name == "near_copies":
        assert not {2, 3, 10} & set(ids) and ids[1] == ids[9] == 1 and ids[6] == 3
    elif name == "repeated_passages":
        assert ids == all_ids
        assert (by_id[8].text, by_id[8].n_chars) == ("acht", 4)
        whole = {r[0]: r[1] for r in ROWS}
        assert all(by_id[i].text == whole[i] for i in (1, 2, 3, 4, 5, 7, 9, 10))
    else:
        assert ids == all_ids
    for r in rows:
        assert name == "repeated_passages" or r.text in {x[1] for x in ROWS}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_table(spark, documents, name, stage):
    assert stage(spark, with_clashing(documents([])), SMALLEST).collect() == []


def test_training_leaves_nothing_with_the_driver(documents, monkeypatch):
    def where(texts, languages):
        return Field([str(os.getpid())], np.zeros((1, 1 << 16), np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((1, 1), np.int64), np.ones((1, 1)))

    monkeypatch.setattr("tarnbeck.llm.language.train", where)
    docs = documents([(1, "the cat"), (2, "the dog")])
    got = {r.lang_pred for r in identify_language(docs, docs, runs=False).collect()}
    assert len(got) == 1 and got != {str(os.getpid())}


@pytest.mark.parametrize("chars,most", [(600_000, 25), (50, 80)])
def test_items_are_read_by_few_jobs(spark, documents, conf, monkeypatch, chars, most):
    """As many as parts, not as shuffle partitions."""
    conf("spark.sql.shuffle.partitions", "100")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr("tarnbeck.llm.decontaminate.READ_CHARS", chars)
    items = [(None if i == 3 else i, " ".join(f"{w}{i}" for w in ("ein", "wort", "und", "noch", "mehr", "davon"))) for i in range(40)]
    docs = documents([(i, f"vorher {text} nachher") for i, text in items])
    benchmark = spark.createDataFrame([*items, (40, None), (41, "")], "item_id int, text string").repartition(100, "text")
    spark.sparkContext.setJobGroup(f"items {chars}", "")
    try:
        found = contaminated(docs, benchmark)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"items {chars}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= most
    assert Counter((r.doc_id, r.item_id) for r in found.collect()) == Counter((i, i) for i, _ in items)
