from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F, types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators add or use inside; a caller may have them too.
CLASHES = "n_words kept epoch block alpha weight start spans items shard _row _group _s _t _spans signature".split()


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"{'abcdefgh'[i % 8]}{i:x}q" for i in (rng.randrange(vocabulary) for _ in range(words)))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties and copies."""
    rng = random.Random(11)
    long = prose(rng, 60_000, 5_000)
    plain = [prose(rng, rng.randrange(30, 120)) for _ in range(90)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(plain)]
    rows += [
        (100, None, "en", "s0", None),
        (101, "", "en", "s0", 0),
        (102, " \n\t ", None, "s1", 4),
        (103, long, "en", None, len(long)),
        (None, plain[0], None, None, None),
        (None, None, None, None, None),
        (104, plain[1], "en", "s2", 1),
        (104, plain[1], "en", "s2", 1),
        (105, plain[2].upper() + ".", "de", "s2", 1),
        (106, "one two", "en", "s0", 7),
        (107, "one two", "en", "s0", 7),
        (108, "Ünïcode é 日本 \U0001F600 a@b.co +1 234 567 8901", "fr", "s1", 9),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    docs = spark.createDataFrame(edge_rows, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, source=None):
        rows = [(i, t, "en", source(i) if source else "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def bench_items(spark):
    def make(items):
        schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
        return spark.createDataFrame(items, schema)

    return make
