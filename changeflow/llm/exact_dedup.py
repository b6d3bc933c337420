"""Exact dedup by deterministic block naming.

The normalised text of a document is cut into blocks of fixed size. Equal blocks get one
integer name: the distinct blocks are sorted and numbered. Then adjacent pairs of names are
named in the same way, level by level, until one name stands for the whole document. Names
of a level are equal only for equal content, so (number of blocks, last name) is equal only
for equal texts: no digest decides.

At scale: every block is shuffled once, to be told apart (equal blocks meet before the
shuffle, so a text that a third of the rows hold travels once per task). Documents find
their names by a 128-bit key of the block. That the key stands for one block only is
checked on the names themselves; if two blocks shared one, the naming is repeated with
another seed. Levels above the first handle integers only, and a document leaves as soon as
it has one name, so each level has half the rows of the one before. Names are read back from
a stored table: they never change when a lost task is run again.

Edge cases: a null text counts as empty and empty texts are equal to each other; a null id
is kept as null and ranks after all ids; repeated rows are copies of each other, one stays;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import SPACE, keep_rows, read
from changeflow.session import stored

BLOCK_BYTES = 4096
_SEEDS = range(8)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def _blocks(source: Column, size: int, of) -> Column:
    last = F.greatest(F.ceil(F.octet_length(source) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: of(F.substring(source, i * size + 1, size)))


def _key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(block, F.lit(2 * seed)).alias("d1"), F.xxhash64(block, F.lit(2 * seed + 1)).alias("d2"))


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows sorted and numbered where they are; numbers of tasks do not overlap."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(texts: DataFrame, size: int, seed: int) -> DataFrame | None:
    """(d1, d2, name) of each distinct block, or None if a key stands for two blocks."""
    # The outer form, because the plain one computes the blocks again for a filter on their number.
    cells = texts.select(F.explode_outer(_blocks(F.col("bytes"), size, lambda b: b)).alias("block"))
    cells = cells.select("block", _key(F.col("block"), seed).alias("d")).select("d.*", "block")
    names = stored(_numbered(cells.distinct(), ["d1", "d2", "block"]).select("d1", "d2", "name"), "block-names")
    return names if names.count() == names.select("d1", "d2").distinct().count() else None


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: uid, id, n_points, text_hash, text_sha256, n_blocks, name.

    Rows have equal (n_blocks, name) exactly if their normalised texts are equal.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("raw"),
        normalised(F.col(text_col)).cast("binary").alias("bytes"),
    )
    for seed in _SEEDS:
        names = _named_blocks(rows, size, seed)
        if names is not None:
            break
    else:
        raise RuntimeError("no seed tells all blocks apart")
    parts = stored(
        rows.select(
            F.monotonically_increasing_id().alias("uid"),
            "id",
            F.char_length("raw").cast("long").alias("n_points"),
            F.xxhash64("raw").alias("text_hash"),
            F.sha2("bytes", 256).alias("text_sha256"),
            _blocks(F.col("bytes"), size, lambda b: _key(b, seed)).alias("keys"),
        ).withColumn("n_blocks", F.size("keys")),
        "block-keys",
    )
    most = parts.agg(F.max("n_blocks")).first()[0] or 0
    level = stored(
        parts.select("uid", F.col("n_blocks").alias("n"), F.posexplode("keys").alias("pos", "d"))
        .select("uid", "n", "pos", "d.*")
        .join(names, ["d1", "d2"])
        .select("uid", "n", "pos", "name"),
        "names-0",
    )
    ends = [level.where("n = 1").select("uid", "name")]
    while most > 1:
        pairs = (
            level.where("n > 1")
            .groupBy("uid", "n", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                # The last name of an odd number has no neighbour.
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        pairs = stored(pairs, "pairs")
        names = stored(_numbered(pairs.select("left", "right").distinct(), ["left", "right"]), "pair-names")
        level = stored(
            pairs.join(names, ["left", "right"]).select(
                "uid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"
            ),
            "names",
        )
        ends.append(level.where("n = 1").select("uid", "name"))
        most = (most + 1) // 2
    named = ends[0]
    for more in ends[1:]:
        named = named.union(more)
    return parts.drop("keys").join(named, "uid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, text_hash.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    rows = stored(identities(docs, id_col, text_col, size), "identities")
    groups = rows.groupBy("n_blocks", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(-F.col("n_points"), F.col("id").isNull(), "id", "uid")).alias("first"),
    )
    # Stored, so that the join reads two plain exchanges and a large group can be split.
    groups = stored(groups, "groups")
    return rows.join(groups, ["n_blocks", "name"]).select(
        "id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        "text_sha256",
        "text_hash",
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, with all their columns."""
    verdicts = stored(exact_dedup(docs), "verdicts")
    keep = verdicts.groupBy(F.col("id").alias("keep_key"), F.col("text_hash").alias("keep_hash")).agg(
        F.count("*").alias("n_rows"), F.max("kept").alias("kept")
    )
    return keep_rows(docs, keep.where("kept"))


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept,
  sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""
