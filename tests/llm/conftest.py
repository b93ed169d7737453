from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from zoneflow.llm.common import ship_package

#: extra columns that clash with names the operators use inside
CLASHING = ("key", "node", "line", "band", "word", "range", "z", "text_key", "row", "n", "_id", "class", "doc_text")


@pytest.fixture(scope="session")
def lspark(spark):
    ship_package(spark)
    return spark


@pytest.fixture
def documents(lspark):
    """Build a table like ``documents`` (with clashing extra columns) from (id, text) pairs."""
    def build(rows):
        schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                             *[StructField(c, StringType()) for c in CLASHING], StructField("n_chars", LongType())])
        return lspark.createDataFrame(
            [(i, t, *[None if k % 3 else "x" for k in range(len(CLASHING))], len(t or "")) for i, t in rows], schema)
    return build


LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
ODD_ROWS = [
    (1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "  \n\t "), (5, LONG),
    (6, "One two three four FIVE six seven eight nine ten"), (7, "solo"), (7, "solo"), (8, "solo"),
    (None, "one two three four five six seven eight nine ten"), (None, None), (-9, "é\u0301 ß \U0001f600 \x00 \x02\x03 x"),
]


@pytest.fixture
def odd(documents):
    """Nulls, empty, blank and very long texts, ties, repeated rows, null and negative ids, odd characters."""
    return documents(ODD_ROWS)


@pytest.fixture
def empty(documents):
    return documents([])
