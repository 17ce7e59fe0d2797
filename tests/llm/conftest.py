import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import ODD  # noqa: E402

ODD_NAMES = "h key node fp score start kind block words n a.b a`b flag flag_ mark lost_id lost_mark_ address blob spans clean _clean digest again again_ other keeper text_sha256_ keep_id_ place slot bits p y part x size class".split(" ")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

@pytest.fixture
def docs_of(spark):
    def make(texts, langs=None, sources=None):
        rows = [(i, t, (langs or ["en"] * len(texts))[i], (sources or ["src0"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def odd_docs(docs_of):
    """The odd texts, with extra columns whose names an operator might use itself."""
    docs = docs_of(ODD)
    for name in ODD_NAMES:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
