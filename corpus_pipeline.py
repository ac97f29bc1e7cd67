"""A training-data pipeline over `documents`: each stage works on all that the one before it kept.

Rows that share a doc_id are taken for one document: a stage keeps or drops them together.
Every stage reads doc_id, text and what its docstring names, whole texts of any length,
and returns all columns of its input under their names. Those it does not name come out
unchanged, whatever they are called. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.decontaminate import contaminated
from tarnbeck.llm.language import UNKNOWN, identify_language
from tarnbeck.llm.mixing import ADDED, mix
from tarnbeck.llm.simhash import near_duplicates
from tarnbeck.llm.store import stored
from tarnbeck.llm.text import in_fold
from tarnbeck.llm.windows import repeated_windows
from tarnbeck.sources.tables import table


def _set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """The same columns in the same order, those not used under names that nothing else has."""
    return docs.toDF(*(c if c in used else f"_column_{i}_set_aside" for i, c in enumerate(docs.columns)))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no language go; `lang` becomes the one found in the others.

    Null, empty and blank texts and those without letters have none. Languages are learnt
    from rows with a lang outside the held-out fold; without such rows all go. Ties go to
    the language first by name, repeated rows are judged each.
    """
    rows = _set_aside(docs, "doc_id", "text", "lang")
    learn = rows.where(~in_fold("doc_id", 4, 2) & F.col("lang").isNotNull())
    found = identify_language(rows, learn, runs=False, carry=tuple(rows.columns)).where(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(rows.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, also through others, the one with the smallest doc_id stays.

    Null, empty and blank texts link with each other. Rows that repeat a doc_id stay or go
    together, and so do rows without one: they go if a document with an id links with them.
    """
    rows = _set_aside(docs, "doc_id", "text")
    found = near_duplicates(rows)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first"))
    return rows.join(first, F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi").toDF(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller doc_id has too are cut from `text`; `n_chars` follows.

    Documents of which nothing is left go; others lose their line breaks if they lose a
    word and are unchanged if not. Null and empty texts stay as they are. Rows that
    repeat a doc_id do not cut each other; a null doc_id is larger than any other.
    """
    rows = _set_aside(docs, "doc_id", "text", "n_chars")
    found = repeated_windows(rows, carry=tuple(rows.columns))
    cut = F.col("n_removed") > 0
    n_chars = F.length("kept").cast(rows.schema["n_chars"].dataType)
    return (
        found.where(~cut | (F.col("kept") != ""))
        .withColumn("n_chars", F.when(cut, n_chars).otherwise(F.col("n_chars")))
        .withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text")))
        .select(rows.columns)
        .toDF(*docs.columns)
    )


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none. If one of several rows of a doc_id holds one, all go,
    and likewise with the rows without a doc_id. Items that tie are all found.
    """
    rows = _set_aside(docs, "doc_id", "text")
    leaks = contaminated(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leaking")).distinct()
    return rows.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leaking")), "left_anti").toDF(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, with its place in a mixture of the sources by the square root of their sizes.

    Texts are not judged: null, empty and repeated rows all stay. A null source is one of
    its own. The columns that `mix` adds come last and replace older ones of their names.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    rows = _set_aside(docs.select(*kept), "doc_id", "text", "source")
    return mix(rows).toDF(*kept, *ADDED)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
]

#: Models and fingerprints are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, stored(docs) if i else docs, sf_dir)
    return docs
