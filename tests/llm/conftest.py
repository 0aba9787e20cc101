from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of tables that clash with names the operators use.
CLASHING = (
    "kept", "component_id", "n_bytes", "host", "row", "rank", "id", "key", "label", "block", "training",
    "evidence", "h", "c0", "c1", "ranges", "ids", "n_lines", "length", "piece",
)


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) pairs, with extra columns of clashing names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def build(rows, clashing=True):
        df = spark.createDataFrame(list(rows), schema)
        df = df.withColumns({"lang": F.lit("en"), "source": F.lit("src0"), "n_chars": F.length("text").cast("long")})
        return df.withColumns({c: F.lit(1) for c in CLASHING}) if clashing else df

    return build


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Deterministic text of invented words."""
    chosen = random.Random(seed)
    names = ["".join(random.Random(k).choices("abcdeéß", k=2 + k % 7)) for k in range(vocabulary)]
    return " ".join(chosen.choice(names) + chosen.choice(["", "", ",", "."]) for _ in range(words))


@pytest.fixture(scope="session")
def awkward():
    """Rows that every operator must take: nulls, empty, blank, one word, repeated rows, a very long text."""
    long = prose(9, 40_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, prose(1, 120)), (6, prose(1, 120)), (6, prose(1, 120)),
        (None, prose(1, 120)), (None, None), (7, "\n".join(["same line here", "other line"] * 3)), (8, long),
        (9, long), (10, "x" * 30_000), (11, "<|endoftext|> it's 't   　 é\U0001f600\r\n"),
    ]
