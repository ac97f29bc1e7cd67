"""Bounded samples of labelled documents to fit classifiers on, chosen by id.

Texts take no part in the choice. Only the ids whose hash falls below a bound, worked
out from the number of rows of their label, come to the driver; the texts of those
chosen are then read in one pass over the documents, which holds the chosen ids as a
broadcast table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ids that come to the driver for each one that is chosen, about.
SPARE = 2


def _key() -> Column:
    return F.xxhash64("doc_id", F.lit(17))


def below(key: Column, share: float) -> Column:
    """Whether a 64-bit hash is among this share of the smallest ones."""
    return F.lit(True) if share >= 1 else key < F.lit(int(share * 2.0**64) - 2**63)


def first_ids(texts: DataFrame, label: str, per_label: int, labels: DataFrame | None = None) -> DataFrame:
    """doc_id and label of the first `per_label` documents of each label value, by a hash of the id.

    `labels` gives the labels, by default `texts` itself. The table is a local one of at
    most `per_label` rows for each label value, whatever the size of the input; label
    values are taken to be few. Rows without id or label are not considered, nor ids
    that `texts` does not have. Rows that repeat an id and a label count once; an id
    with several labels is an example of each. The choice depends on ids and labels
    only, not on partitioning.
    """
    spark = texts.sparkSession
    pairs = (texts if labels is None else labels).select("doc_id", label)
    pairs = pairs.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = {r[0]: r[1] for r in pairs.groupBy(label).count().collect()}
    share = {value: SPARE * per_label / n for value, n in rows.items()}
    while True:
        near = F.lit(False)
        for value, part in share.items():
            near = F.when(F.col(label) == F.lit(value), below(_key(), part)).otherwise(near)
        some = pairs.where(near).distinct()
        if labels is not None and share:
            # Bounded: SPARE * per_label ids of each label, about; more only if most have no text.
            known = spark.createDataFrame(some.select("doc_id").distinct().toArrow())
            there = texts.select("doc_id").join(F.broadcast(known), "doc_id").distinct()
            some = some.join(F.broadcast(there), "doc_id")
        found: dict[object, list[tuple]] = {value: [] for value in share}
        for doc_id, value, key in some.select("doc_id", label, _key()).collect():
            found[value].append((key, doc_id))
        short = [v for v, ids in found.items() if len(ids) < per_label and share[v] < 1]
        if not short:
            break
        for value in short:  # many repeated rows, or ids without a text
            share[value] *= 4
    chosen = [(doc_id, value) for value, ids in found.items() for _, doc_id in sorted(ids)[:per_label]]
    return spark.createDataFrame(chosen, T.StructType([pairs.schema["doc_id"], pairs.schema[label]]))


def labelled_texts(texts: DataFrame, ids: DataFrame, label: str, own: bool) -> DataFrame:
    """doc_id, text and label of the rows of `texts` that the small table `ids` names.

    One pass over `texts`, without a shuffle. If the label is the texts' `own` it has to be that of `ids`.
    """
    rows = texts.select("doc_id", "text", *([label] if own else [])).where(F.col("text").isNotNull())
    return rows.join(F.broadcast(ids), ["doc_id", label] if own else "doc_id").select("doc_id", "text", label)


def sample_per_label(texts: DataFrame, label: str, per_label: int, labels: DataFrame | None = None) -> list:
    """Rows (doc_id, text, label) of `first_ids`, in order of label and hash.

    Null texts are left out and not made up for. Of the texts of a repeated id the one
    with the smallest hash is taken; each task sends one at most.
    """
    ids = first_ids(texts, label, per_label, labels)
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))["text"]
    found = labelled_texts(texts, ids, label, labels is None).groupBy("doc_id", label).agg(one.alias("text"))
    rows = found.select("doc_id", "text", label, _key().alias("key")).collect()
    return sorted(rows, key=lambda r: (r[label], r.key, r.doc_id))


def first_rows(rows: DataFrame, key: Column, n: int, total: int | None = None) -> DataFrame:
    """The `n` rows with the smallest 64-bit hash `key`, all of them where there are no more.

    Tasks leave out the rows that are surely beyond before any are sent to the one that picks.
    """
    total = rows.count() if total is None else total
    share = SPARE * n / max(total, 1)
    while share < 1:
        near = rows.where(below(key, share))
        if near.count() >= n:
            return near.orderBy(key).limit(n)
        share *= 4  # many rows with the same key
    return rows.orderBy(key).limit(n)
