"""Small tables with the awkward rows that every operator must take."""

import random

import pytest
from llm_rows import prose
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(1)
    rows = [(i, prose(rng, 20 + i), "en", f"s{i % 3}", 1, 0.5, "x") for i in range(12)]
    rows += [
        (12, None, "en", "s0", 0, 0.5, "x"),
        (13, "", None, "s1", 0, None, None),
        (14, " \n\t ", "en", None, 0, 0.5, "x"),
        (15, prose(rng, 30_000), "en", None, None, 0.5, "x"),
        (None, prose(rng, 25), "en", "s2", 1, 0.5, "x"),
        (16, rows[3][1], "en", "s1", 1, 0.5, "x"),
        rows[4],
        rows[4],
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, quality double, id string"
    ).withColumns({"toxicity": F.lit("a"), "node": F.lit("b")})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
