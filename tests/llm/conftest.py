from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tableferry.llm.common import with_package

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use within.
        T.StructField("key", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("a.b", T.StringType()),
    ]
)
PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("host", T.LongType()),
        T.StructField("rule", T.StringType()),
    ]
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, n: int = 80) -> str:
    """Words in a fixed disorder, without repeated windows to speak of."""
    out, x = [], seed * 2654435761 % 2**32
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x >> 16 & 7] + WORDS[x >> 20 & 3] * (x >> 24 & 1) + (".\n" if i % 20 == 19 else ""))
    return " ".join(out)


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, prose(1)),
    (5, prose(1)),
    (5, prose(1)),
    (6, prose(2)),
    (None, prose(3)),
    (None, None),
    (7, "word " * 30_000),
    (8, "x" * 200_000),
    (9, "  two  blanks ▁ é \U0001f600\x00 "),
    (10, "no\nspace"),
]


@pytest.fixture(scope="session")
def spark(spark):
    return with_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, repeated rows, columns with clashing names."""

    def make(rows=ODD):
        return spark.createDataFrame([(i, t, "en" if i != 3 else None, None, None, "k", 0, "d") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(i, u, h, 0, "r") for i, u, h in rows], PAGES)

    return make


def sorted_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
