"""Change sources: tables or file streams of changed hashes and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of the three kinds of change table.
HASH_CHANGES = "n bigint, ms bigint, event string, key string, fields map<string,string>"
DOCUMENT_CHANGES = "n bigint, ms bigint, event string, key string, doc string"
STAGED_WRITES = HASH_CHANGES


def _read(
    spark: SparkSession, path: str, schema: str, fmt: str, stream: bool, options: dict[str, str]
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).options(**options).schema(schema).load(path)


def hash_changes(
    spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False, **options: str
) -> DataFrame:
    """Changed hashes; null ``fields`` means that the key is gone."""
    return _read(spark, path, HASH_CHANGES, fmt, stream, options)


def document_changes(
    spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False, **options: str
) -> DataFrame:
    """Changed documents, each whole; null ``doc`` means that the key is gone."""
    return _read(spark, path, DOCUMENT_CHANGES, fmt, stream, options)


def staged_writes(
    spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False, **options: str
) -> DataFrame:
    """Writes to staging keys ``prefix{key}`` of a write-through source."""
    return _read(spark, path, STAGED_WRITES, fmt, stream, options)
