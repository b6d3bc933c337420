"""The corpus pipeline: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import exact_dedup, jaccard, packing, quality, substring_dedup
from changeflow.llm.common import read
from changeflow.session import new_dir

STAGES = [
    ("quality classifier", quality.stage),
    ("exact dedup", exact_dedup.stage),
    ("n-gram Jaccard join", jaccard.stage),
    ("substring dedup", substring_dedup.stage),
    ("best-fit packing", packing.stage),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
