"""Quality rules: statistics of each text, and lines that too many documents of a host share.

Lines are normalised (lower case, runs of white space to one space, ends trimmed) and hashed.
For each host the distinct documents with a line are counted; documents with equal texts
count once, so copies do not make their own lines frequent. A line in more documents than
``MIN_DOCUMENTS`` is over the limit and is removed; the limit does not grow with the host. A document is rejected if the base rules fail (fewer than 50 words, or more than
half of its words in repeated 3-word windows) or if it is depleted: less than ``LEFT`` of
its words remain.

Built-in functions only. One scan makes a narrow table: statistics, line hashes and words
per line; everything else works on that. Counts are combined before the shuffle, so a line
or a host that a third of all documents have costs one row per task. Lines are joined to the
frequent lines by a join that adaptive execution can split or broadcast by size.

Edge cases: a null text has no words, lines or symbols and fails the base rules; a null host
is the host with the empty name; a null id is kept; repeated rows are judged alike, each on
its own row; ties cannot matter; extra columns are ignored; an empty table gives an empty
result; texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import SPACE, read
from changeflow.session import stored

MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_DOCUMENTS = 10
LEFT = 0.5
WINDOW = 3


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), f"{SPACE}+", " "))


def _repeated(windows: Column) -> Column:
    """The places of the windows that occur twice or more, from (hash, place) in order."""
    def place(k: Column) -> Column:
        own = F.get(windows, k)
        same = (own["h"] == F.get(windows, k - 1)["h"]) | (own["h"] == F.get(windows, k + 1)["h"])
        return F.when(F.coalesce(same, F.lit(False)), own["i"])

    last = F.size(windows) - 1
    places = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), place)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: i.isNotNull())


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The statistics of every row, its host, and its lines as hashes with their words."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("uid"),
        "id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    last = F.size("words") - WINDOW
    at = [lambda i, k=k: F.get(F.col("words"), i + k) for k in range(WINDOW)]
    windows = F.when(
        last >= 0,
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.struct(F.xxhash64(*(f(i) for f in at)).alias("h"), i.alias("i")),
            )
        ),
    )
    rows = rows.withColumn("windows", F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")))
    rows = rows.withColumn("again", _repeated(F.col("windows")))
    covered = F.array_distinct(F.flatten(F.transform("again", lambda i: F.array(*(i + k for k in range(WINDOW))))))
    return rows.select(
        "uid",
        "id",
        "host",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.transform(
            "lines", lambda line: F.struct(F.xxhash64(normalised_line(line)).alias("h"), F.size(words(line)).alias("n"))
        ).alias("lines"),
    )


def frequent_lines(rows: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(host, h) of the lines over the limit, from the rows of ``measured``."""
    texts = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    texts = stored(texts.select("host", F.array_distinct(F.transform("lines", lambda x: x["h"])).alias("hashes")), "host-lines")
    counts = texts.select("host", F.explode("hashes").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > min_documents).select("host", "h")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           min_documents: int = MIN_DOCUMENTS, left: float = LEFT) -> DataFrame:
    """One row per row of ``docs``: the statistics, what is lost, and whether the row is kept."""
    rows = stored(measured(docs, id_col, text_col, host_col), "measured")
    frequent = stored(frequent_lines(rows, min_documents), "frequent-lines")
    lost = (
        rows.select("uid", "host", F.explode("lines").alias("line"))
        .select("uid", "host", "line.*")
        .join(frequent, ["host", "h"])
        .groupBy("uid")
        .agg(F.count("*").alias("n_removed_lines"), F.sum("n").alias("n_removed_words"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        rows.drop("lines")
        .join(lost, "uid", "left")
        .withColumn("n_removed_lines", F.coalesce("n_removed_lines", F.lit(0).cast("long")))
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("n_words") - F.col("n_removed_words") >= left * F.col("n_words")))
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The kept rows of ``docs``, their texts without the lines over the limit."""
    rows = stored(judged(docs, id_col, text_col, host_col), "judged")
    frequent = frequent_lines(measured(docs, id_col, text_col, host_col))
    lines = stored(measured(docs, id_col, text_col, host_col).select("id", "text_hash", "host", F.explode("lines").alias("line")), "lines")
    lost = (
        lines.select("id", "text_hash", "host", F.col("line.h").alias("h"))
        .join(frequent, ["host", "h"])
        .groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
        .agg(F.collect_set("h").alias("__lost"))
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = rows.where("kept").select(F.col("id").alias("__kept_id"), F.col("text_hash").alias("__kept_hash")).distinct()
    stay = docs.join(kept, docs[id_col].eqNullSafe(F.col("__kept_id")) & (F.xxhash64(text) == F.col("__kept_hash")), "left_semi")
    with_lost = stay.join(lost, stay[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    rest = F.filter(F.split(text, "\n"), lambda line: ~F.coalesce(F.array_contains("__lost", F.xxhash64(normalised_line(line))), F.lit(False)))
    return with_lost.select(*(F.array_join(rest, "\n").alias(c) if c == text_col else F.col(c) for c in docs.columns))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_lines", "n_removed_words",
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, text, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT doc_id, host, text, unnest(lines) AS l FROM w)),
frequent AS (
  SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT text) > 10),
lost AS (
  SELECT doc_id, count(*) AS lines, CAST(sum(n) AS BIGINT) AS n FROM lines JOIN frequent USING (host, line) GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    CAST(len(w.lines) - len(list_distinct(w.lines)) AS BIGINT) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(lost.lines, 0) AS n_removed_lines, coalesce(lost.n, 0) AS n_removed_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM s
"""
