import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows, over several partitions."""

    def make(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


@pytest.fixture
def clashing(documents):
    """The same with columns that have the names operators use inside or add."""

    def make(rows):
        from pyspark.sql import functions as F

        df = documents(rows)
        for name in (
            "_text _gone _id _hash _doc _first _rank _bucket _key _sequence text_hash h g fp node root part bucket "
            "component_id score kept n_words n_removed lang_pred mix_slot mix_block anchor label query hot"
        ).split():
            df = df.withColumn(name, F.lit("x"))
        return df

    return make
