"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import stored

# White space as the contracts define it: [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]"
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(id_col: str | Column) -> Column:
    """True for the rows that no label is learned from; a null id is not held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def label_sample(labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, in an order that a hash sets.

    Repeated ids count once (the larger label); null ids and labels are left out.
    """
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.max(label).cast("int").alias("sample_label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id")
        .limit(rows)
    )


def blocks(texts: list[str | None], limit: int) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Texts joined to blocks of about ``limit`` characters, each followed by a space.

    Yields the block and (index of the text, begin, end) of each piece. A text longer
    than the limit is cut at white space (inside a word only if that is as long itself),
    so that memory is bounded by the limit and not by the text.
    """
    buffer: list[str] = []
    spans: list[tuple[int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        begin, text = 0, text or ""
        while True:
            end = len(text)
            if end - begin > limit:
                end = begin + limit
                for k in range(end, max(begin, end - 10_000), -1):
                    if text[k].isspace():
                        end = k
                        break
            piece = text[begin:end]
            buffer.append(piece)
            spans.append((i, size, size + len(piece)))
            size += len(piece) + 1
            if size >= limit:
                yield " ".join(buffer) + " ", spans
                buffer, spans, size = [], [], 0
            begin = end
            if begin >= len(text):
                break
    if spans:
        yield " ".join(buffer) + " ", spans


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX[0])
    h ^= h >> np.uint64(33)
    h *= np.uint64(_MIX[1])
    h ^= h >> np.uint64(33)
    return h


def unused(name: str, taken: list[str]) -> str:
    """The name, or one made of it that no column has."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, hash of the text) ``keep`` holds, each such pair once.

    ``keep`` has the columns keep_key, keep_hash and n_rows (how many rows of docs have the
    pair). All columns of ``docs`` stay as they are. Only pairs that stand for several rows
    pay for a second shuffle.
    """
    key, digest, count = (unused(f"keep_{c}", docs.columns) for c in ("key", "hash", "rows"))
    keep = stored(keep.select(F.col("keep_key").alias(key), F.col("keep_hash").alias(digest), F.col("n_rows").alias(count)), "keep-rows")
    matches = docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col(digest))
    repeated = keep.where(F.col(count) > 1)
    if repeated.isEmpty():
        return docs.join(keep, matches, "left_semi")
    return docs.join(keep.where(F.col(count) == 1), matches, "left_semi").unionByName(
        docs.join(repeated, matches, "left_semi").dropDuplicates([id_col, text_col])
    )
