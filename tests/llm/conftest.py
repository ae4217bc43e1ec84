import random

import pytest
from pyspark.sql import types as T

from mercato.llm import shared

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     # Names that the operators use themselves.
                     T.StructField("n", T.StringType()), T.StructField("node", T.StringType()),
                     T.StructField("size", T.StringType()), T.StructField("content", T.StringType())])


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert shared.scratch_path(spark, "x")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (id, text) as a table with extra columns whose names clash."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", None, "7", "y") for i, t in rows], DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randrange(3000)) for _ in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (None, "one two"), (None, None), (4, "one two"), (4, "one two"),
            (5, long), (6, long + " tail"), (7, "É é ß 中文 \U0001f600 words in it"), (8, "a\nb\na\n")]
