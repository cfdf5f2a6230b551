from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from rallymart.sources.session import configure


@pytest.fixture(scope="session")
def spark():
    """The session of the other tests, or one like it."""
    session = (
        configure(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session


DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, part int, size int"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    texts = [
        (1, "the cat sat on the mat today"),
        (1, "the cat sat on the mat today"),
        (1, "something else altogether, really"),
        (2, ""),
        (3, None),
        (None, "a text without an id"),
        (None, None),
        (7, "word " * 30_000),
        (8, "x" * 50_000),
        (9, "The Cat sat on the mat today"),
        (50, "é 漢 \U0001f642 tab\tnew\nline"),
    ]
    rows = [(i, t, "en" if t else None, None, None, "f", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
