from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent.parent.parent))

from pyspark.sql import types as T  # noqa: E402

LONG, TEXT = T.LongType(), T.StringType()
#: Columns of documents, and extra ones with names that operators use inside.
DOCUMENTS = T.StructType(
    [T.StructField("doc_id", LONG), T.StructField("text", TEXT), T.StructField("lang", TEXT), T.StructField("source", TEXT)]
    + [T.StructField(n, TEXT) for n in ("size", "words", "key", "item", "line", "label", "n", "score", "place", "component", "bucket", "epoch")]
)


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text, lang, source) rows."""

    def make(rows):
        return spark.createDataFrame([tuple(r) + (None,) * (4 - len(r)) + ("x",) * 12 for r in rows], DOCUMENTS)

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, size string")

    return make
