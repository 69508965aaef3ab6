from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `group` string, _r string, digest string"
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))


@pytest.fixture(autouse=True, scope="session")
def workers_find_packages(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


def docs_frame(spark, rows):
    """Documents (doc_id, text) with the columns of the table and others whose names operators might use."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, 0.5, "g", "r", "d") for i, t in rows], DOCS)


EDGE_ROWS = [
    (1, None), (2, ""), (3, "one"), (4, "   \n\t "), (5, LONG), (6, LONG), (7, LONG + " end"), (8, "same words here in this text"),
    (9, "same words here in this text"), (9, "same words here in this text"), (None, "without an id but words of its own"), (None, None),
    (12, "été 日本語 😀 ▁ ß\r\nİK"), (13, "a" * 5000),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return docs_frame(spark, EDGE_ROWS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return docs_frame(spark, [])
