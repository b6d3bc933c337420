"""N-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters.

A document is the set of its distinct 5-word shingles. Documents with the same set are one
class; classes link when 100 * |intersection| >= 75 * |union|.

1. ``members``: one scan gives each document the size of its set and its class, a hash of
   the sorted shingles.
2. ``frequent_sets``: a second scan sends the shingles of the classes to buckets, packed as
   arrays. A bucket finds those that two classes or more have; only they can ever be common
   to two sets. They get keys that ascend with document frequency (its power of two, with
   hot shingles last, then the hash), and go back to their classes. Shingles of one class only come first in the
   rare-first order; it is enough to know how many they are. A class with too few frequent
   shingles for any partner leaves here, which is the prefix filter for rare shingles.
3. ``candidates``: classes meet on the frequent shingles of their prefix. The length filter
   and the positional filter are part of the join condition.
4. ``verified``: each pair once; the suffix filter first, then the exact overlap of the
   frequent shingles.

``links`` gives all links between classes. ``linked_groups`` needs components only and
saves the pairs within a group: first each class is compared with one central class of each
list (the one with the fewest shingles of its own), and then only pairs whose two sides are
in different components so far. No link between components is lost: all such pairs are tried.

At scale: a shingle that many classes of a chunk share is taken out of the bucket traffic.
Its entries travel by class, and one mark per chunk by shingle, so no bucket gets more than
``HOT`` entries per chunk of one shingle. The number of buckets follows the number of
shingles. Joins on prefix keys and on classes are sort-merge joins that adaptive execution
can split. Shingles are 58-bit hashes and classes 64-bit hashes.

Edge cases: null and empty texts have an empty set, no class and no links; a null id is kept
and never names a component that has another id; repeated rows are copies; extra columns are
ignored; an empty table gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from changeflow.llm.common import keep_rows, mix, read
from changeflow.llm.components import components
from changeflow.session import stored

WORDS = 5
PERCENT = 75
GRAM_BITS = 58
HOT = 16
CHUNK_GRAMS = 1_000_000
BUCKET_GRAMS = 1_500_000
# Odd multipliers, one for each place of a shingle.
_PLACES = np.cumprod(np.full(WORDS + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 58-bit hashes of the word shingles of a text.

    Words are runs of other characters than ASCII white space, A-Z lower-cased; with fewer
    words than a shingle has, all of them are one.
    """
    # bytes.lower and bytes.split know ASCII only, which is what is wanted.
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(found))
    total = np.full(len(found) - n + 1, n, np.uint64)
    for i in range(n):
        total += hashes[i : len(found) - n + 1 + i] * _PLACES[i]
    return np.unique(mix(total) >> np.uint64(64 - GRAM_BITS))


def _class_of(grams: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    name = xxh3_64_intdigest(grams.tobytes())
    return name - (1 << 64) if name >= 1 << 63 else name


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n, class) of every row; the class of an empty set is null."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.col(text_col).alias("text"),
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names = [], []
            for text in batch["text"]:
                grams = shingles(text.as_py())
                sizes.append(len(grams))
                names.append(_class_of(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["text_hash"], pa.array(sizes, pa.int64()), pa.array(names, pa.int64())],
                ["id", "text_hash", "n", "class"],
            )

    return rows.mapInArrow(describe, f"id {kind}, text_hash long, n long, class long")


# What travels to a bucket. kind 0: (class, shingle), packed with a table of the classes of the
# chunk; kind 1: (class, hot shingle); kind 2: hot shingles; kind 3: (class, size).
_TRAFFIC = "bucket int, kind int, a binary, b binary, c binary"
_TRAFFIC_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_SETS = "class long, n long, keys array<long>"
_SETS_ARROW = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))])
# The place in the order of a shingle that is hot in any chunk: after all others.
_HOT_LEVEL = 31


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each bucket's entries, in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _planes(values: np.ndarray) -> bytes:
    """The bytes of sorted numbers by significance, which compresses well in a shuffle."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs of equal values in a sorted array."""
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)
    return begins, np.diff(np.append(begins, len(values)))


def _chunk_rows(sets: dict[int, np.ndarray], buckets: int) -> list[tuple]:
    classes = np.fromiter(sets, np.int64, len(sets))
    sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
    grams = np.concatenate(list(sets.values()))
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    begins, counts = _runs(grams)
    hot = np.repeat(counts >= HOT, counts)
    rows = []
    for bucket, part in _split((classes.view(np.uint64) % np.uint64(buckets)).astype(np.int64)):
        rows.append((bucket, 3, classes[part].tobytes(), sizes[part].tobytes(), None))
    if hot.any():
        marks = grams[begins][counts >= HOT]
        for bucket, part in _split((marks % np.uint64(buckets)).astype(np.int64)):
            rows.append((bucket, 2, marks[part].tobytes(), None, None))
        names, values = classes[owner[hot]], grams[hot]
        for bucket, part in _split((names.view(np.uint64) % np.uint64(buckets)).astype(np.int64)):
            rows.append((bucket, 1, names[part].tobytes(), values[part].tobytes(), None))
        grams, owner = grams[~hot], owner[~hot]
    for bucket, part in _split((grams % np.uint64(buckets)).astype(np.int64)):
        table, places = np.unique(owner[part], return_inverse=True)
        places = places.astype(np.uint16 if len(table) <= 1 << 16 else np.uint32)
        rows.append((bucket, 0, _planes(grams[part]), _planes(places), classes[table].tobytes()))
    return rows


def _traffic(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for text in batch["text"]:
                grams = shingles(text.as_py())
                if len(grams) and (name := _class_of(grams)) not in sets:
                    sets[name] = grams
                    size += len(grams)
                    if size >= CHUNK_GRAMS:
                        yield _rows(_chunk_rows(sets, buckets), _TRAFFIC_ARROW)
                        sets, size = {}, 0
        if sets:
            yield _rows(_chunk_rows(sets, buckets), _TRAFFIC_ARROW)

    return docs.select(F.col(text_col).alias("text")).mapInArrow(send, _TRAFFIC)


def _longs(parts: list[bytes | None], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.frombuffer(p, kind) for p in parts]) if parts else np.empty(0, kind)


def _by_gram(table: pa.Table, buckets: int) -> list[tuple]:
    """From the entries of a bucket of shingles to entries of buckets of classes."""
    kinds = table["kind"].to_numpy()
    a, b, c = (table[x].to_pylist() for x in "abc")
    of = lambda kind, values: [values[i] for i in np.flatnonzero(kinds == kind)]
    rows = [(int(table["bucket"][0].as_py()), int(k), a[i], b[i], None) for i, k in enumerate(kinds) if k in (1, 3)]
    marks = _longs(of(2, a), np.uint64)
    grams, names = [], []
    for data, places, classes in zip(of(0, a), of(0, b), of(0, c), strict=True):
        found = _from_planes(data, np.uint64)
        kind = np.uint16 if len(places) == 2 * len(found) else np.uint32
        grams.append(found)
        names.append(np.frombuffer(classes, np.int64)[_from_planes(places, kind)])
    gram = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    name = np.concatenate(names) if names else np.empty(0, np.int64)
    # Only runs of two or more, or with a mark, can be frequent.
    order = np.argsort(gram, kind="stable")
    gram, name = gram[order], name[order]
    begins, counts = _runs(gram)
    marked_run = np.isin(gram[begins], marks)
    again = np.repeat((counts > 1) | marked_run, counts)
    gram, name = gram[again], name[again]
    order = np.lexsort((name, gram))
    gram, name = gram[order], name[order]
    fresh = np.concatenate(([True], (gram[1:] != gram[:-1]) | (name[1:] != name[:-1]))) if len(gram) else np.empty(0, bool)
    gram, name = gram[fresh], name[fresh]
    begins, counts = _runs(gram)
    marked_run = np.isin(gram[begins], marks)
    level = np.where(marked_run, _HOT_LEVEL, np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), _HOT_LEVEL - 1))
    # Of one class only, through copies in several chunks: not frequent.
    keep = np.repeat((counts > 1) | marked_run, counts)
    keys = ((np.repeat(level, counts).astype(np.uint64) << np.uint64(GRAM_BITS)) | gram).view(np.int64)[keep]
    name = name[keep]
    for bucket, part in _split((name.view(np.uint64) % np.uint64(buckets)).astype(np.int64)):
        rows.append((bucket, 0, name[part].tobytes(), keys[part].tobytes(), None))
    return rows


def _least(n: np.ndarray) -> np.ndarray:
    """The shingles that a set of n must share with any partner."""
    return -(-PERCENT * n // 100)


def _by_class(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The frequent shingles of each class that may have a partner."""
    kinds = table["kind"].to_numpy()
    a, b = table["a"].to_pylist(), table["b"].to_pylist()
    of = lambda kind, values: [values[i] for i in np.flatnonzero(kinds == kind)]
    classes, first = np.unique(_longs(of(3, a)), return_index=True)
    sizes = _longs(of(3, b))[first]
    hot = (np.uint64(_HOT_LEVEL << GRAM_BITS) | _longs(of(1, b), np.uint64)).view(np.int64)
    # A class is in several chunks, and a shingle can be hot in one of them and not in another.
    names, keys = np.concatenate((_longs(of(0, a)), _longs(of(1, a)))), np.concatenate((_longs(of(0, b)), hot))
    order = np.lexsort((keys, names))
    names, keys = names[order], keys[order]
    fresh = np.concatenate(([True], (names[1:] != names[:-1]) | (keys[1:] != keys[:-1]))) if len(names) else np.empty(0, bool)
    names, keys = names[fresh], keys[fresh]
    begin, end = np.searchsorted(names, classes), np.searchsorted(names, classes, "right")
    may = np.flatnonzero(end - begin >= _least(sizes))
    for at in range(0, len(may), 2000):
        yield _rows([(int(classes[i]), int(sizes[i]), keys[begin[i] : end[i]]) for i in may[at : at + 2000].tolist()], _SETS_ARROW)


def frequent_sets(docs: DataFrame, total_grams: int, text_col: str = "text") -> DataFrame:
    """(class, n, keys): the classes that may have partners, keys ascending rare-first."""
    buckets = max(1, -(-total_grams // BUCKET_GRAMS))

    def by_gram(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_rows(_by_gram(table, buckets), _TRAFFIC_ARROW)])

    def by_class(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_by_class(table)), _SETS_ARROW)

    traffic = _traffic(docs, text_col, buckets)
    found = traffic.groupBy("bucket").applyInArrow(by_gram, _TRAFFIC).groupBy("bucket").applyInArrow(by_class, _SETS)
    return stored(found, "class-sets")


def _needed(n: Column, m: Column) -> Column:
    """The overlap of two linked sets: 100 * o >= 75 * (n + m - o)."""
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT))


def _possible(a: str, b: str) -> Column:
    """The length filter, and the positional filter at a common shingle of the prefix."""
    n, m, i, j = (F.col(x) for x in (f"n_{a}", f"n_{b}", f"pos_{a}", f"pos_{b}"))
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (1 + F.least(n - i - 1, m - j - 1) >= _needed(n, m))


def prefixes(sets: DataFrame) -> DataFrame:
    """(key, class, n, own, pos): the frequent shingles in each class's prefix.

    ``own`` counts the shingles that no other class has; they come first in the order.
    """
    own = F.col("n") - F.size("keys")
    length = (F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1 - own).cast("int")
    return sets.where(length > 0).select(
        "class", "n", own.alias("own"), F.posexplode(F.slice("keys", F.lit(1), length)).alias("at", "key")
    ).select("key", "class", "n", "own", (F.col("own") + F.col("at")).alias("pos"))


def _side(postings: DataFrame, side: str, *more: str) -> DataFrame:
    return postings.select("key", *more, *(F.col(c).alias(f"{c}_{side}") for c in ("class", "n", "pos")))


def _suffix_may(x: np.ndarray, y: np.ndarray, slack: int, depth: int = 2) -> bool:
    """False if two sorted arrays differ in more than ``slack`` places, judged by halves."""
    if abs(len(x) - len(y)) > slack:
        return False
    if depth == 0 or not len(x) or not len(y):
        return True
    middle = y[len(y) // 2]
    i, j = int(np.searchsorted(x, middle)), len(y) // 2
    left = abs(i - j)
    right = abs((len(x) - i) - (len(y) - j))
    if left + right > slack:
        return False
    return _suffix_may(x[:i], y[:j], slack - right, depth - 1) and _suffix_may(x[i:], y[j:], slack - left, depth - 1)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of each pair (a, b) of classes."""
    x = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    y = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            sides = [(batch[f"keys_{s}"].values.to_numpy(), batch[f"keys_{s}"].offsets.to_numpy(), batch[f"n_{s}"].to_numpy()) for s in "ab"]
            (ka, oa, na), (kb, ob, nb) = sides
            for i in range(batch.num_rows):
                u, v = ka[oa[i] : oa[i + 1]], kb[ob[i] : ob[i + 1]]
                n, m = int(na[i]), int(nb[i])
                needed = -(-PERCENT * (n + m) // (100 + PERCENT))
                # Shingles of one class only are in neither array and differ for sure.
                slack = n + m - 2 * needed - (n - len(u)) - (m - len(v))
                linked.append(slack >= 0 and _suffix_may(u, v, slack) and len(np.intersect1d(u, v, assume_unique=True)) >= needed)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "keys_a", "keys_b").mapInArrow(verify, "a long, b long, linked boolean")


def links(sets: DataFrame) -> DataFrame:
    """(a, b), a < b: every link between two classes."""
    postings = stored(prefixes(sets), "postings")
    condition = (F.col("class_a") < F.col("class_b")) & _possible("a", "b")
    pairs = _side(postings, "a").join(_side(postings, "b").withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & condition)
    pairs = pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
    return verified(pairs, sets).where("linked").select("a", "b")


def linked_groups(sets: DataFrame) -> DataFrame:
    """(node, component) of the classes with links."""
    postings = stored(prefixes(sets), "postings")
    # Sets link only within a factor of 4/3 in size: the same band or a neighbouring one.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)))
    banded = postings.withColumn("band", band)
    central = banded.groupBy("key", "band").agg(F.min(F.struct("own", "class", "n", "pos")).alias("p"))
    central = central.select("key", "band", F.col("p.class").alias("class_b"), F.col("p.n").alias("n_b"), F.col("p.pos").alias("pos_b"))
    reach = _side(banded.withColumn("band", F.explode(F.array(band, band - 1))), "a", "band")
    first = (
        reach.join(central.withColumnsRenamed({"key": "key_b", "band": "band_b"}), (F.col("key") == F.col("key_b")) & (F.col("band") == F.col("band_b")) & (F.col("class_a") != F.col("class_b")) & _possible("a", "b"))
        .select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
        .distinct()
    )
    tried = stored(verified(first, sets), "tried")
    groups = components(tried.where("linked").select("a", "b"))
    named = groups.select(F.col("node").alias("class"), "component")
    postings = stored(postings.join(named, "class", "left").withColumn("component", F.coalesce("component", "class")), "grouped-postings")
    # Only lists with several components are looked at again, and only across components.
    lists = postings.groupBy("key", "component").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos"))
    mixed = lists.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    lists = stored(lists.join(mixed, "key", "left_semi"), "mixed-lists")
    sides = [lists.select(F.col("key").alias(f"key_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in ("component", "low", "high", "pos"))) for s in "ab"]
    a_high, b_high = F.col("high_a"), F.col("high_b")
    apart = sides[0].join(
        sides[1],
        (F.col("key_a") == F.col("key_b"))
        & (F.col("component_a") < F.col("component_b"))
        & (100 * F.least(a_high, b_high) >= PERCENT * F.greatest("low_a", "low_b"))
        # The positional filter for the best that two members of these could be.
        & (F.least(a_high - F.col("pos_a"), b_high - F.col("pos_b")) >= _needed(F.col("low_a"), F.col("low_b"))),
    ).select(F.col("key_a").alias("key"), "component_a", "component_b")
    left = _side(postings.withColumnRenamed("component", "component_a"), "a", "component_a")
    right = _side(postings.withColumnRenamed("component", "component_b"), "b", "component_b").withColumnsRenamed({"key": "key_2", "component_b": "component_2"})
    rest = (
        apart.join(left, ["key", "component_a"])
        .join(right, (F.col("key") == F.col("key_2")) & (F.col("component_b") == F.col("component_2")) & _possible("a", "b"))
        .select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    later = stored(verified(rest, sets).where("linked"), "later-links")
    if later.isEmpty():
        return groups
    # What was joined already is one node now.
    inner = named.select(F.col("class").alias("x"), "component")
    lifted = later.join(inner.withColumnsRenamed({"x": "a", "component": "ca"}), "a", "left").join(inner.withColumnsRenamed({"x": "b", "component": "cb"}), "b", "left")
    joined = components(lifted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    top = joined.select(F.col("node").alias("component"), F.col("component").alias("above"))
    nodes = groups.unionByName(joined.join(groups, "node", "left_anti").select("node", F.col("node").alias("component")))
    return nodes.join(top, "component", "left").select("node", F.coalesce("above", "component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_shingles, class, component_id.

    ``component_id`` is the smallest id that links reach; a document without a set, or without
    links and copies, is its own component.
    """
    rows = stored(members(docs, id_col, text_col), "members")
    total = rows.agg(F.sum("n")).first()[0] or 0
    sets = frequent_sets(docs, total, text_col)
    groups = linked_groups(sets).select(F.col("node").alias("class"), "component")
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("first"))
    classes = stored(classes.join(groups, "class", "left").select("class", "first", F.coalesce("component", "class").alias("component")), "classes")
    # Stored, so that the join reads two plain exchanges and a large component can be split.
    smallest = stored(classes.groupBy("component").agg(F.min("first").alias("component_id")), "smallest-ids")
    named = stored(classes.join(smallest, "component").select("class", "component_id"), "class-components")
    return rows.join(named, "class", "left").select(
        "id", "text_hash", F.col("n").alias("n_shingles"), "class",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one that names it. Without an id: the smallest text hash."""
    found = stored(near_duplicates(docs), "near-duplicates")
    rows = found.groupBy(
        F.col("id").alias("keep_key"), F.col("text_hash").alias("keep_hash"), "n_shingles", "class", "component_id"
    ).agg(F.count("*").alias("n_rows"))
    # Ids may repeat with other texts, and components may have no id at all.
    group = F.when(F.col("class").isNull(), F.struct(F.lit(1).alias("k"), F.col("keep_hash").alias("h"))).otherwise(F.struct(F.lit(0).alias("k"), F.coalesce("component_id", F.col("class")).alias("h")))
    rows = rows.withColumn("g", group)
    lone = rows.where(F.col("class").isNull())
    first = rows.where(F.col("class").isNotNull()).groupBy("g").agg(F.min(F.struct(F.col("keep_key").isNull(), "keep_key", "keep_hash", "n_rows")).alias("f"))
    return keep_rows(docs, first.select("f.keep_key", "f.keep_hash", "f.n_rows").unionByName(lone.select("keep_key", "keep_hash", "n_rows")))


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM d),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM s),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS o
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * o >= 75 * (n + m - o)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id
"""
