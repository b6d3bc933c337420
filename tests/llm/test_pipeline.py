"""The corpus pipeline, stage by stage against the brute-force versions of its operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import __spark_entry__
import corpus_pipeline
import pytest
from corpora import words
from pyspark.sql import functions as F
from test_dedup import best_of, brute_components, brute_lines, brute_shingles

from changeflow.llm import packing, quality


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, corpus):
    """Documents with ids of their own, copies, shared lines and junk; and labels of some."""
    import random

    rng = random.Random(11)
    rows = {r[0]: r for r in corpus if r[0] is not None and r[0] != 107}
    for i in range(500, 620):
        junk = i % 3 == 0
        text = " ".join(w + "$$$" for w in words(rng, 40).split()) if junk else words(rng, 60)
        rows[i] = (i, text, "en", "s4", len(text))
    root = tmp_path_factory.mktemp("sf")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(list(rows.values()), schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 0 if r[3] == "s4" and i % 3 == 0 else 1, 0) for i, r in rows.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs)
        assert docs.columns == columns or k == len(corpus_pipeline.STAGES) - 1
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(start, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [tuple(r) for r in start.collect()]
    scores = model.scores([r[1] for r in rows])
    kept = [r for r, s in zip(rows, scores, strict=True) if s >= 0.3]
    assert Counter(map(tuple, seen[0].collect())) == Counter(kept)
    junk = [r for r in rows if r[3] == "s4" and r[0] % 3 == 0]
    assert not {r[0] for r in junk} & {r[0] for r in kept}
    assert len(kept) == len(rows) - len(junk)
    groups = defaultdict(list)
    for r in kept:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    kept = [best_of(g) for g in groups.values()]
    assert Counter(map(tuple, seen[1].collect())) == Counter(kept)
    named, _, _ = brute_components(kept)
    first = {c for _, n, c in named if n}
    kept = [r for r in kept if r[0] in first or not brute_shingles(r[1])]
    assert Counter(map(tuple, seen[2].collect())) == Counter(kept)
    clean = brute_lines(kept)
    got = {r["doc_id"]: r["text"] for r in seen[3].collect()}
    assert got == {r[0]: None if r[1] is None else clean[(r[0], r[1])] for r in kept}
    encoder = packing.Encoder(packing.tokenizer_path())
    lengths = {i: len(encoder.ids(text)) // 4 + 1 for i, text in got.items()}
    packed = seen[4].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == lengths
    fill = seen[4].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fill.where("n <> end OR n > 4096").isEmpty()


def test_run_gives_the_last_stage(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n.startswith("op")} == {str(k) for k in range(1, 11)}
    assert set(__spark_entry__.oracle_sql()) <= names
