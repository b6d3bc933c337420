from __future__ import annotations

import random

import pytest
from corpora import CLASHES, SCHEMA, words
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Plain, copied, near-copied, empty, null, long and repeated documents."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(words(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 5))), "en", f"s{i % 3}", 1))
    base = words(rng, 120)
    for i in range(60, 80):
        parts = base.split()
        for _ in range(rng.randint(0, 3)):
            parts[rng.randrange(len(parts))] = words(rng, 1)
        rows.append((i, " ".join(parts), "en", "s0", None))
    for i in range(80, 90):
        rows.append((i, rows[3][1].replace(" ", "  "), None, None, 1))
    line = words(rng, 30)
    for i in range(90, 100):
        rows.append((i, f"{words(rng, 20)}\n{line}\n{words(rng, 12)}", "de", "s1", 1))
    rows += [(100, "", "en", "s1", 0), (101, None, "en", "s1", None), (102, " \t\n ", "en", "s1", 4), (103, "one two", "en", "s1", 7)]
    rows += [(104, "One  TWO", "en", "s1", 7), (105, words(rng, 30_000), "en", "s2", 1), (106, "x" * 50_000, "en", "s2", 1)]
    rows += [(107, "é ü ß 中文 ① ▁x <|endoftext|> 'll", "fr", "s2", 1), (107, "other text of the same id", "fr", "s2", 1)]
    rows += [rows[7], rows[7], (None, rows[5][1], "en", "s0", 1), (None, None, None, None, None), (None, "alone without an id here", "en", "s0", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark: SparkSession, corpus: list[tuple]) -> DataFrame:
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs: DataFrame) -> DataFrame:
    """The documents with extra columns whose names the operators use themselves."""
    return docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
