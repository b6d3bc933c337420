"""Filter interaction audit: what each filter does in every order of the filters.

A document fails some set of the filters; that set, as a bit mask, and the part of the table
are all that the audit needs of it. So documents are counted per part and mask first, and the
orders are worked out for the cells of that small table only: with five filters a part has 32
cells at most. Each cell folds along every order of a literal array of orders with
``transform`` and ``aggregate``, which gives a struct per order and step, weighted by the
counts of the cell. The cells of a part are merged by sums element by element.

At scale: one scan makes a narrow row per document (id, part, digest of the text, mask). Rows
are combined before each shuffle, so a text or a part that a third of the rows hold leaves a
task as one row. Whether a text stands under a smaller id too is decided per text, not per
document: copies have equal texts, so they differ in that filter alone, and only the smallest id
of the table does not fail it. Nothing but the array of orders travels to all tasks.

Edge cases: a null text is empty; a null part is the empty string; a null id never fails the
copy filter, nor makes another document fail it, and has no labels; rows that repeat an id with
the same text are no copies under a smaller id, so they fail or pass together; of several labels of
an id any 1 counts; a part always has a row for every order and step; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import SPACE, read
from changeflow.session import stored

MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"
#: The measures of a struct, all of them long.
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> list[Column]:
    """Failure of the filters that look at one text: words, distinct words, capitals, symbols."""
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    n_words = F.size(words)
    return [
        n_words < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n_words,
        100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > CAPITALS_PERCENT * F.char_length(text),
        text.rlike(SYMBOLS),
    ]


def _mask(failures: list[Column]) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failures)])


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters that they fail."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        _mask(text_failures(text)).alias("mask"),
    )
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    own = ["digest", "part", "mask"]
    # One scan of the texts for the rows with an id and those without.
    rows = stored(rows.groupBy("id", *own).agg(F.count("*").alias("c")), "audit-rows")
    known = rows.where(F.col("id").isNotNull()).join(marks, "id", "left").na.fill(0, ["good", "toxic"])
    nameless = rows.where(F.col("id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    texts = stored(
        known.unionByName(nameless).groupBy(*own).agg(
            F.sum("c").alias("n"),
            F.sum(F.col("c") * F.col("good")).alias("good"),
            F.sum(F.col("c") * F.col("toxic")).alias("toxic"),
            F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("nameless"),
            F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c", "good", "toxic"))).alias("first"),
        ),
        "audit-texts",
    )
    smallest = texts.groupBy("digest").agg(F.min("first.id").alias("smallest"))
    leads = F.coalesce(F.col("first.id") == F.col("smallest"), F.lit(False))
    first = {c: F.when(leads, F.col(f"first.{c}")).otherwise(0) for c in ("c", "good", "toxic")}
    alone = {"n": first["c"] + F.col("nameless"), "good": first["good"] * first["c"], "toxic": first["toxic"] * first["c"]}
    copy = 1 << len(FILTERS) - 1
    counted = texts.join(smallest, "digest").select(
        "part",
        F.explode(
            F.array(
                F.struct(F.col("mask"), *(c.cast("long").alias(name) for name, c in alone.items())),
                F.struct(F.col("mask").bitwiseOR(F.lit(copy)).alias("mask"), *((F.col(name) - c).cast("long").alias(name) for name, c in alone.items())),
            )
        ).alias("cell"),
    )
    cells = counted.select("part", "cell.*").where("n > 0").groupBy("part", "mask")
    return cells.agg(*(F.sum(c).alias(c) for c in alone))


def _steps(order: Column) -> Column:
    """One struct per step of an order, for the cell of the row."""

    def fails(f: Column) -> Column:
        return F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), f)) != 0

    def weighted(condition: Column, weight: str) -> Column:
        return F.when(condition, F.col(weight)).otherwise(F.lit(0)).cast("long")

    def step(state: Column, f: Column) -> Column:
        gone, now = state["gone"], fails(f)
        lost = now & ~gone
        one = F.struct(
            f.alias("f"),
            weighted(~gone & ~now, "n").alias("kept"),
            weighted(lost, "n").alias("removed"),
            weighted(now & gone, "n").alias("redundant"),
            weighted(F.col("mask") == F.call_function("shiftleft", F.lit(1), f), "n").alias("unique_fails"),
            weighted(lost, "good").alias("good_lost"),
            weighted(lost, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | now).alias("gone"), F.concat(state["steps"], F.array(one)).alias("steps"))

    shape = "array<struct<f:int," + ",".join(f"{m}:bigint" for m in MEASURES) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(shape).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _added(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: F.struct(x["f"].alias("f"), *((x[m] + y[m]).alias(m) for m in MEASURES)))


def audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the cells of :func:`failure_cells`."""
    n = len(filters)
    orders = list(permutations(range(n)))
    array = F.array(*(F.array(*(F.lit(f) for f in order)) for order in orders))
    folded = cells.select("part", F.flatten(F.transform(array, _steps)).alias("steps"))
    # A part has a cell per mask: 2^n lists at most.
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("lists"))
    summed = F.aggregate(F.slice("lists", F.lit(2), F.size("lists")), F.get("lists", F.lit(0)), _added)
    merged = merged.select("part", summed.alias("steps"))

    def total(k: int) -> Column:
        return F.aggregate("steps", F.lit(0).cast("long"), lambda t, s: t + F.when(s["f"] == k, s["removed"]).otherwise(0))

    rows = merged.select("part", F.array(*map(total, range(n))).alias("totals"), F.posexplode("steps").alias("at", "s"))
    names = F.array(*(F.lit("".join(filters[f] for f in order)) for order in orders))
    return rows.select(
        "part",
        F.get(names, F.expr(f"at div {n}").cast("int")).alias("filter_order"),
        (F.col("at") % n + 1).cast("int").alias("step"),
        *(F.col(f"s.{m}").alias(m) for m in MEASURES),
        F.get("totals", F.col("s.f")).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failure_cells(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
m AS (
  SELECT doc_id, part, [
    len(w) < 200,
    100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails
  FROM d),
l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
orders AS (
  SELECT [] :: INT[] AS o
  UNION ALL
  SELECT list_append(o, CAST(f AS INT)) FROM orders, range(1, 6) t(f) WHERE NOT list_contains(o, f) AND len(o) < 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE len(o) = 5),
s AS (
  SELECT part, o, step, o[step] AS f, fails, n, good, toxic, fails[o[step]] AS now,
    len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone
  FROM cells, steps),
r AS (
  SELECT part, o, step, f,
    sum(CASE WHEN NOT now AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN now AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN now AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN now AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN now AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN now AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, o, step, f)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INT) AS step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
