"""Codes of vectors: each part of a vector as the index of its nearest codebook entry.

Components become integers (``floor(256 * x)``) and vectors are cut into equal consecutive
parts, each with a codebook of its own, so distances, sums and ties are exact. A round assigns
every part to its nearest entry and moves each entry to the floor of the mean of its parts.

Method: an anchors hierarchy over the values of each part. Anchors are picked one by one, always
the point that is farthest from its own anchor, and take over the points that are nearer to them;
by the triangle inequality only points beyond half the distance of two anchors are looked at.
The anchors' balls are merged from the middle outwards, the pair that makes the smallest ball
first, and anchors with many points are split downwards in the same way. Each ball
caches sum and count of its points. An assignment goes down with a list of candidate entries
that children inherit: an entry is struck off as soon as the whole ball lies on the other side
of the plane between it and the nearest entry. A ball with one candidate left is wholly
owned: its cached sum and count are added, and its points are not looked at.

At scale: a task builds the trees of the vectors it reads, in chunks of at most ``CHUNK`` rows, and
stores them once; all rounds read them. What a round shuffles and gathers is a sum per part,
entry and component, combined in each task: a number that the length of the vectors and the size
of the codebook set, however many vectors there are. Equal vectors are a ball without extent,
so they cost what one does. The first entries come from a sorted limit (64 rows).

Edge cases: a null vector, one without components and one with a null or non-finite component are
dropped, and so are vectors of another length than the most common one (the shorter of two
equally common); a length that is no multiple of the number of parts gives parts that differ by one
component; null ids rank after all others as first entries and are kept in the result; rows that
tie in their id are ranked by vector; with fewer rows than entries the codebook is as small as
that; repeated rows are coded each on their own; integers beyond what keeps the error within a
long (2^27 for 64 components) are held to that bound; ``label_error`` is null if the
sum is beyond a long; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import read
from changeflow.session import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK = 4096
LEAF = 64
_TREE = ("points", "rows", "begin", "end", "left", "right", "center", "radius", "sums")
_KINDS = dict(zip(_TREE, (np.int32, np.int32, np.int32, np.int32, np.int32, np.int32, np.float64, np.float64, np.int64), strict=True))


def _finite(vector: Column) -> Column:
    """Null where the vector is."""
    infinite = F.lit(float("inf"))
    return F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))


def bounds(length: int, parts: int) -> list[tuple[int, int]]:
    return [(length * p // parts, length * (p + 1) // parts) for p in range(parts)]


def integers(vectors: np.ndarray) -> np.ndarray:
    """Components as integers, within what keeps the error of a whole vector in a long."""
    bound = math.isqrt((1 << 62) // max(1, vectors.shape[1])) // 2
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -bound, bound).astype(np.int32)


# Trees


def _anchors(points: np.ndarray) -> list[np.ndarray]:
    """Places of the points, dealt to about sqrt(n) anchors."""
    owner = np.zeros(len(points), np.int64)
    pivots = points[:1]
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    for k in range(1, math.isqrt(len(points) - 1) + 1):
        new = int(far.argmax())
        if far[new] == 0:
            break
        between = np.sqrt(((pivots - points[new]) ** 2).sum(1))
        # Nearer than half the distance of the anchors: cannot be nearer to the new one.
        may = np.flatnonzero(far > between[owner] / 2)
        d = np.sqrt(((points[may] - points[new]) ** 2).sum(1))
        nearer = d < far[may]
        owner[may[nearer]], far[may[nearer]] = k, d[nearer]
        pivots = np.concatenate((pivots, points[new : new + 1]))
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)


def _joined(points: np.ndarray, groups: list[np.ndarray]):
    """The groups as a binary tree: always the pair whose common ball is smallest is joined."""
    nodes: list = list(groups)
    n = np.array([len(g) for g in groups], np.float64)
    center = np.array([points[g].mean(0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(1)).max() for g, c in zip(groups, center, strict=True)])
    common = np.full((len(nodes), len(nodes)), np.inf)

    def measure(i: int) -> None:
        d = np.sqrt(((center - center[i]) ** 2).sum(1))
        row = np.maximum((d + radius + radius[i]) / 2, np.maximum(radius, radius[i]))
        row[n == 0] = np.inf
        row[i] = np.inf
        common[i], common[:, i] = row, row

    for i in range(len(nodes)):
        measure(i)
    for _ in range(len(nodes) - 1):
        i, j = divmod(int(common.argmin()), len(nodes))
        middle = (center[i] * n[i] + center[j] * n[j]) / (n[i] + n[j])
        radius[i] = max(math.dist(middle, center[i]) + radius[i], math.dist(middle, center[j]) + radius[j])
        center[i], nodes[i], n[i], n[j] = middle, (nodes[i], nodes[j]), n[i] + n[j], 0
        common[j], common[:, j] = np.inf, np.inf
        measure(i)
    return nodes[int(n.argmax())]


def _grown(points: np.ndarray, own: np.ndarray):
    """Nested pairs down to arrays of places."""
    here = points[own]
    if len(own) <= LEAF or not (here != here[0]).any():
        return own

    def down(node):
        if isinstance(node, tuple):
            return down(node[0]), down(node[1])
        return _grown(points, own[node])

    return down(_joined(here, _anchors(here)))


def tree(values: np.ndarray) -> dict[str, np.ndarray]:
    """The hierarchy of the rows of an integer matrix: balls as ranges of the reordered points."""
    points = values.astype(np.float64)
    order: list[np.ndarray] = []
    begin, end, left, right = [], [], [], []
    at = 0

    def lay(node) -> int:
        nonlocal at
        me = len(begin)
        begin.append(at)
        for side in (end, left, right):
            side.append(-1)
        if isinstance(node, tuple):
            left[me], right[me] = lay(node[0]), lay(node[1])
        else:
            order.append(node)
            at += len(node)
        end[me] = at
        return me

    lay(_grown(points, np.arange(len(points))))
    rows = np.concatenate(order)
    points, laid = points[rows], values[rows]
    sums = np.concatenate((np.zeros((1, values.shape[1]), np.int64), np.cumsum(laid.astype(np.int64), axis=0)))
    ranges = list(zip(begin, end, strict=True))
    center = np.array([points[b:e].mean(0) for b, e in ranges])
    radius = np.array([np.sqrt(((points[b:e] - c) ** 2).sum(1)).max() for (b, e), c in zip(ranges, center, strict=True)])
    out = (laid, rows, begin, end, left, right, center, radius, [sums[e] - sums[b] for b, e in ranges])
    return {name: np.asarray(x, _KINDS[name]) for name, x in zip(_TREE, out, strict=True)}


def owners(t: dict[str, np.ndarray], entries: np.ndarray) -> Iterator[tuple[int, np.ndarray | int]]:
    """(ball, entry) of the balls that one entry owns, (leaf, entry of each point) of the others."""
    # Of equal entries the first takes all.
    first = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    real = entries.astype(np.float64)
    center, radius, left, right = t["center"], t["radius"], t["left"], t["right"]
    stack = [(0, first)]
    while stack:
        node, held = stack.pop()
        if len(held) > 1:
            e = real[held]
            d = ((e - center[node]) ** 2).sum(1)
            best = int(d.argmin())
            gap = np.sqrt(((e - e[best]) ** 2).sum(1))
            gap[best] = 1
            # How far the centre is on the near side of the plane between the two; the slack covers rounding.
            beyond = (d - d[best]) / (2 * gap)
            held = held[beyond <= radius[node] * (1 + 1e-9) + 1e-6 + 1e-12 * (d + d[best]) / gap]
        if len(held) == 1:
            yield node, int(held[0])
        elif left[node] >= 0:
            stack += [(int(left[node]), held), (int(right[node]), held)]
        else:
            here = t["points"][t["begin"][node] : t["end"][node]].astype(np.int64)
            d = ((here[:, None, :] - entries[held][None]) ** 2).sum(2)
            # Candidates ascend, so the first of equally near ones has the lowest index.
            yield node, held[d.argmin(1)]


# Jobs


def _trees(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, length: int, parts: int) -> DataFrame:
    """One row per chunk: ids and labels of its vectors, and the tree of each part."""
    kinds = {name: vectors.schema[c].dataType.simpleString() for name, c in (("ids", id_col), ("labels", label_col))}
    cuts = bounds(length, parts)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            values = integers(flat.reshape(batch.num_rows, length))
            for at in range(0, batch.num_rows, CHUNK):
                part = values[at : at + CHUNK]
                trees = [tree(part[:, b:e]) for b, e in cuts]
                offsets = pa.array([0, len(part)], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, batch.column(k).slice(at, len(part))) for k in (0, 1)]
                packed = [pa.array([[t[name].tobytes() for t in trees]], pa.list_(pa.binary())) for name in _TREE]
                yield pa.RecordBatch.from_arrays(lists + packed, ["ids", "labels", *_TREE])

    schema = ", ".join([*(f"{n} array<{kind}>" for n, kind in kinds.items()), *(f"{name} array<binary>" for name in _TREE)])
    return vectors.select(F.col(id_col), F.col(label_col), F.col(vector_col)).mapInArrow(build, schema)


def _unpacked(batch: pa.RecordBatch, row: int, part: int, width: int) -> dict[str, np.ndarray]:
    t = {name: np.frombuffer(batch[name][row][part].as_buffer(), _KINDS[name]) for name in _TREE}
    return {name: x.reshape(-1, width) if name in ("points", "center", "sums") else x for name, x in t.items()}


def _moved(trees: DataFrame, book: list[np.ndarray]) -> list[np.ndarray]:
    """The codebook after a round: floors of the means; entries without parts stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(e), e.shape[1] + 1), np.int64) for e in book]
        for batch in batches:
            for row in range(batch.num_rows):
                for p, entries in enumerate(book):
                    t = _unpacked(batch, row, p, entries.shape[1])
                    for node, found in owners(t, entries):
                        b, e = t["begin"][node], t["end"][node]
                        if isinstance(found, int):
                            totals[p][found, :-1] += t["sums"][node]
                            totals[p][found, -1] += e - b
                        else:
                            np.add.at(totals[p][:, :-1], found, t["points"][b:e].astype(np.int64))
                            np.add.at(totals[p][:, -1], found, 1)
        for p, total in enumerate(totals):
            entry, place = np.nonzero(total)
            columns = [np.full(len(entry), p), entry, place, total[entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "total"])

    sums = trees.mapInArrow(add, "part long, entry long, place long, total long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
    totals = [np.zeros((len(e), e.shape[1] + 1), np.int64) for e in book]
    # A row per part, entry and component, and one for each count.
    for r in sums.collect():
        totals[r["part"]][r["entry"], r["place"]] = r["total"]
    return [np.where(t[:, -1:] > 0, t[:, :-1] // np.maximum(t[:, -1:], 1), e) for t, e in zip(totals, book, strict=True)]


def _coded(trees: DataFrame, book: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error) of every vector."""
    kinds = {name: trees.schema[f"{name}s"].dataType.elementType.simpleString() for name in ("id", "label")}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = batch["ids"][row].values, batch["labels"][row].values
                codes = np.zeros((len(ids), len(book)), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for p, entries in enumerate(book):
                    t = _unpacked(batch, row, p, entries.shape[1])
                    own = np.zeros(len(ids), np.int64)
                    for node, found in owners(t, entries):
                        own[t["begin"][node] : t["end"][node]] = found
                    codes[t["rows"], p] = own
                    error[t["rows"]] += ((t["points"].astype(np.int64) - entries[own]) ** 2).sum(1)
                text, width = codes.tobytes().hex(), 2 * len(book)
                names = [text[i : i + width] for i in range(0, len(text), width)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(names, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    schema = ", ".join([*(f"{n} {kind}" for n, kind in kinds.items()), "code string, error long"])
    return trees.mapInArrow(code, schema)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of every kept vector, and the final codebook of each part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    kept = vectors.select(id_col, label_col, vector_col).where(_finite(F.col(vector_col)) & (F.size(vector_col) > 0))
    common = kept.groupBy(F.size(vector_col).alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    length = common["n"] if common else 0
    if length < parts and length:
        raise ValueError(f"vectors of {length} components have no {parts} parts")
    kept = kept.where(F.size(vector_col) == length)
    first = kept.orderBy(F.col(id_col).asc_nulls_last(), vector_col).limit(entries).select(vector_col).collect()
    start = integers(np.array([r[0] for r in first], np.float64).reshape(len(first), length)).astype(np.int64)
    book = [start[:, b:e] for b, e in bounds(length, parts)]
    trees = stored(_trees(kept, id_col, label_col, vector_col, length, parts), "part-trees")
    for _ in range(rounds):
        book = _moved(trees, book)
    return _coded(trees, book), book


def digest(book: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for entries in book for x in entries.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows with the error summed over their label; rows without a label are one group."""
    coded = stored(coded, "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")
    sums = coded.groupBy(F.col("label").alias("of")).agg(total)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = vector_codes(read(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256")
    )


_ROUND = """
a{n} AS (
  SELECT vec_id, p.part, x, min(((x[1] - e[1]) ** 2 + (x[2] - e[2]) ** 2 + (x[3] - e[3]) ** 2 + (x[4] - e[4]) ** 2) * 64 + entry) AS least
  FROM p JOIN c{n} c ON c.part = p.part GROUP BY vec_id, p.part, x),
"""
_MEANS = ", ".join(f"CAST(floor(sum(x[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
_MOVE = """
c{m} AS (
  SELECT c.part, c.entry, coalesce(moved, e) AS e
  FROM c{n} c LEFT JOIN (
    SELECT part, CAST(least AS BIGINT) % 64 AS entry, [{means}] AS moved FROM a{n} GROUP BY ALL) s USING (part, entry)),
"""
OP13_SQL = (
    r"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, CAST(part AS BIGINT) AS part, v[part * 4 + 1:part * 4 + 4] AS x FROM k, range(16) t(part)),
c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e
  FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
"""
    + _ROUND.format(n=0)
    + _MOVE.format(n=0, m=1, means=_MEANS)
    + _ROUND.format(n=1)
    + _MOVE.format(n=1, m=2, means=_MEANS)
    + _ROUND.format(n=2)
    + r"""
s AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
r AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(least AS BIGINT) % 64), '' ORDER BY part) AS code,
    CAST(sum(CAST(least AS BIGINT) // 64) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN k USING (vec_id), s
"""
)
