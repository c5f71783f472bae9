import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import CLASHING, corpus  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string").repartition(3)
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
