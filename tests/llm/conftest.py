import os
import sys

import pytest
from llm_cases import DOCS, SF, odd_texts

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, long and repeated texts, null and repeated ids, nulls in every column."""
    rows = [(i, t, None if i % 7 == 0 else ("en", "fr")[i % 2], None if i % 5 == 0 else "src0", 0)
            for i, t in enumerate(odd_texts())]
    rows += [rows[4], rows[4], (None, "no id here", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns whose names meet those of inputs, outputs and helpers."""
    from pyspark.sql import functions as F
    extra = [F.lit(i).alias(n) for i, n in enumerate(
        ["TEXT", "Doc_Id", "n_words", "kept", "fp", "rid", "score", "base_failed", "_0", "_1", "mean_len", "t_lang", "part"])]
    return odd.select("*", *extra)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
