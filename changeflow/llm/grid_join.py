"""Near-duplicate vectors of one label by an epsilon grid order join.

Vectors are scaled to length one, where a cosine of at least the threshold is a distance of at most
epsilon. They are sorted by the cells of a grid of width epsilon on the leading principal directions
(finer cells break ties), and the sequence is cut into blocks. Intervals of ``FAN`` blocks, of ``FAN``
such intervals and so on make a tree per label. The join starts from the whole sequence against
itself and goes down pair by pair of intervals: a pair is skipped if its boxes on the principal
directions or its balls are provably farther apart than epsilon, settled as a whole if the two
balls provably lie within epsilon of each other, and else replaced by the pairs of its parts.
Pairs of blocks that are still open meet in a task, which goes on in the same way with
sub-blocks and compares what is left in double precision.

At scale: equal vectors of a label are one row with a weight from the start. The order is a range
partitioning by label, cells and a unique number, so a label that a third of the rows have is dealt
to many tasks. A pair of intervals settled as a whole is one row, whatever it holds: a large group of
near copies costs few rows instead of its pairs; the weights of such pairs are handed down the tree
as sums, and their members are tied together by one link each. No pair of vectors leaves a task:
tasks return sums per vector and a spanning forest of the links they saw. Open pairs of blocks are
single groups of two blocks, so memory is bounded by the block. How many stay open depends on
the data: for vectors without any structure in high dimensions no order tells blocks apart, and
the comparisons within a label are then those of all its blocks.

Edge cases: a null label, a null vector, one without components, of length zero or with null or
non-finite components links with nothing and is its own component; vectors of different lengths do not
link; repeated rows are links of each other; a row without an id counts as a link of others, and
a component is named by its smallest id (null if none of its rows has one); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import read
from changeflow.llm.components import components
from changeflow.session import stored

THRESHOLD = 0.93
#: Vectors of a block and of a sub-block, parts of an interval, principal directions, finer cells.
BLOCK = 2048
SUB = 64
FAN = 8
DIRECTIONS = 8
FINER = 8
#: Rows of a range partition, most and least.
_PART_ROWS = (1 << 16, 1 << 12)
#: Bounds are computed in floating point: nothing closer than this to epsilon is settled by a bound.
_SLACK = 1e-7
_GROUP = ["label", "length"]


def epsilon(threshold: float) -> float:
    return math.sqrt(2 - 2 * threshold)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; the largest component first, against overflow."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


# Sequence


def _directions(distinct: DataFrame, longest: int) -> np.ndarray:
    """The leading principal directions of the scaled vectors, shorter ones filled up with zeros."""

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, longest))
            lengths = batch["length"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                out[rows, :length] = scaled(_matrix(batch["vector"].take(pa.array(rows)), int(length)))
            offsets = pa.array(np.arange(0, out.size + 1, longest), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], ["unit"])

    units = distinct.select("length", "vector").mapInArrow(filled, "unit array<double>")
    model = PCA(k=min(DIRECTIONS, longest), inputCol="unit", outputCol="found").fit(units.select(array_to_vector("unit").alias("unit")))
    return np.asarray(model.pc.toArray())


def _placed(distinct: DataFrame, directions: np.ndarray, eps: float) -> DataFrame:
    """The rows with the cells that order them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["length"].to_numpy()
            cells = np.zeros((batch.num_rows, 2 * directions.shape[1]), np.int32)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                at = scaled(_matrix(batch["vector"].take(pa.array(rows)), int(length))) @ directions[:length]
                cells[rows] = np.floor(np.concatenate((at / eps, at * (FINER / eps)), axis=1))
            offsets = pa.array(np.arange(0, cells.size + 1, cells.shape[1]), pa.int32())
            column = pa.ListArray.from_arrays(offsets, pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "cells"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    return distinct.mapInArrow(place, f"{shape}, cells array<int>")


def _blocks(ordered: DataFrame, directions: np.ndarray, size: int) -> DataFrame:
    """Runs of at most ``size`` vectors of one label and length, with their box and ball."""
    label = ordered.schema["label"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, count = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal k, held, count
            rows = pa.Table.from_batches(held).combine_chunks()
            length = rows["length"][0].as_py()
            raw = np.ascontiguousarray(_matrix(rows["vector"].combine_chunks(), length))
            unit = scaled(raw)
            center, at = unit.mean(0), unit @ directions[:length]
            uids, weights = rows["uid"].to_numpy(), rows["weight"].to_numpy()
            one = {
                "label": rows["label"].slice(0, 1).combine_chunks(), "length": [length], "part": [part], "k": [k],
                "weight": [int(weights.sum())], "first": [int(uids[0])],
                "center": [center.tolist()], "radius": [float(np.sqrt(((unit - center) ** 2).sum(1)).max())],
                "low": [at.min(0).tolist()], "high": [at.max(0).tolist()],
                "uids": [uids.tobytes()], "weights": [weights.tobytes()], "raw": [raw.tobytes()],
            }
            k, held, count = k + 1, [], 0
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, kinds[c]) for c, v in one.items()]
            return pa.RecordBatch.from_arrays(arrays, list(one))

        kinds = {
            "length": pa.int32(), "part": pa.int32(), "k": pa.int32(), "weight": pa.int64(), "first": pa.int64(),
            "center": pa.list_(pa.float64()), "radius": pa.float64(), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()),
            "uids": pa.binary(), "weights": pa.binary(), "raw": pa.binary(),
        }
        last = None
        for batch in batches:
            own = list(zip(batch["label"].to_pylist(), batch["length"].to_pylist(), strict=True))
            begin = 0
            for i, key in enumerate(own):
                if key != last or count + i - begin == size:
                    if i > begin:
                        held.append(batch.slice(begin, i - begin))
                    if held:
                        yield block()
                    begin, last = i, key
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
                count += batch.num_rows - begin
        if held:
            yield block()

    return ordered.select("label", "length", "uid", "weight", "vector").mapInArrow(
        cut,
        f"label {label}, length int, part int, k int, weight long, first long, center array<double>, radius double, "
        "low array<double>, high array<double>, uids binary, weights binary, raw binary",
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with their number within their label, without gaps."""
    spark = blocks.sparkSession
    # A row per range partition, that is per 65,536 vectors or so.
    counts = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    starts = spark.createDataFrame(starts, "part int, start long")
    whole = blocks.join(F.broadcast(starts), "part").withColumn("number", F.col("start") + F.col("k")).drop("start", "part", "k")
    first = whole.groupBy(*_GROUP).agg(F.min("number").alias("from"))
    return stored(whole.join(first, _GROUP).withColumn("node", F.col("number") - F.col("from")).drop("number", "from"), "numbered-blocks")


def _parents(nodes: DataFrame) -> DataFrame:
    """The intervals of ``FAN`` nodes each; the group of a parent has that many rows at most."""
    names = [f.name for f in nodes.schema.fields]

    def merge(table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy())
        center, weight, radius = np.array(table["center"].to_pylist()), table["weight"].to_numpy(), table["radius"].to_numpy()
        middle = (center * weight[:, None]).sum(0) / weight.sum()
        out = {
            "label": table["label"].slice(0, 1).combine_chunks(), "length": table["length"].slice(0, 1).combine_chunks(),
            "weight": pa.array([int(weight.sum())]), "first": pa.array([table["first"][int(order[0])].as_py()], pa.int64()),
            "center": pa.array([middle.tolist()]),
            "radius": pa.array([float((np.sqrt(((center - middle) ** 2).sum(1)) + radius).max())]),
            "low": pa.array([np.array(table["low"].to_pylist()).min(0).tolist()]),
            "high": pa.array([np.array(table["high"].to_pylist()).max(0).tolist()]),
            "node": pa.array([int(table["node"][0].as_py()) // FAN], pa.int64()),
        }
        return pa.table([out[c] for c in names], names=names)

    by = F.floor(F.col("node") / FAN)
    return stored(nodes.groupBy(*_GROUP, by.alias("parent")).applyInArrow(merge, nodes.schema), "intervals")


# Pairs of intervals


def _judged(pairs: DataFrame, eps: float) -> DataFrame:
    """Pairs with ``whole``: true if all of the two is within epsilon, false if that is open; others are left out."""
    label = pairs.schema["label"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = np.zeros(batch.num_rows, np.int8)
            lengths = batch["length"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                part = batch.take(pa.array(rows))
                low = [np.array(part[f"low_{s}"].to_pylist()) for s in "ab"]
                high = [np.array(part[f"high_{s}"].to_pylist()) for s in "ab"]
                gap = np.maximum(0, np.maximum(low[0] - high[1], low[1] - high[0]))
                d = np.sqrt(((_matrix(part["center_a"], int(length)) - _matrix(part["center_b"], int(length))) ** 2).sum(1))
                reach = part["radius_a"].to_numpy() + part["radius_b"].to_numpy()
                apart = (np.sqrt((gap**2).sum(1)) > eps + _SLACK) | (d - reach > eps + _SLACK)
                verdicts[rows] = np.where(d + reach <= eps - _SLACK, 2, np.where(apart, 0, 1))
            keep = pa.array(np.flatnonzero(verdicts))
            columns = [batch[c].take(keep) for c in (*_GROUP, "a", "b")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(verdicts[verdicts > 0] == 2)], [*_GROUP, "a", "b", "whole"])

    return pairs.mapInArrow(judge, f"label {label}, length int, a long, b long, whole boolean")


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(
        *_GROUP, F.col("node").alias(side), F.floor(F.col("node") / FAN).alias(f"parent_{side}"),
        *(F.col(c).alias(f"{c}_{side}") for c in ("center", "radius", "low", "high")),
    )


def _descended(levels: list[DataFrame], eps: float) -> tuple[DataFrame, list[DataFrame]]:
    """Open pairs of blocks, and the pairs of each level that are settled as a whole."""
    top = levels[-1]
    both = _side(top, "a").join(_side(top, "b"), _GROUP)
    settled: list[DataFrame] = []
    pairs = stored(_judged(both, eps), "interval-pairs")
    for nodes in reversed(levels[:-1]):
        settled.append(pairs.where("whole"))
        open_pairs = pairs.where("not whole").select(*_GROUP, F.col("a").alias("parent_a"), F.col("b").alias("parent_b"))
        inner = open_pairs.join(_side(nodes, "a"), [*_GROUP, "parent_a"]).join(_side(nodes, "b"), [*_GROUP, "parent_b"]).where("a <= b")
        pairs = stored(_judged(inner, eps), "interval-pairs")
    settled.append(pairs.where("whole"))
    return pairs.where("not whole").drop("whole"), settled[::-1]


# Pairs of vectors


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie the same nodes together, at most one per node."""
    lowest = np.arange(n)
    while True:
        least = np.minimum(lowest[i], lowest[j])
        new = lowest.copy()
        for side in (i, j):
            np.minimum.at(new, side, least)
            np.minimum.at(new, lowest[side], least)
        new = new[new]
        if (new == lowest).all():
            break
        lowest = new
    tied = np.flatnonzero(lowest != np.arange(n))
    return tied, lowest[tied]


def _balls(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.arange(0, len(unit), SUB)
    sizes = np.diff(np.append(starts, len(unit)))
    centers = np.add.reduceat(unit, starts, axis=0) / sizes[:, None]
    d = np.sqrt(((unit - np.repeat(centers, sizes, axis=0)) ** 2).sum(1))
    return np.append(starts, len(unit)), centers, np.maximum.reduceat(d, starts)


def linked(a: np.ndarray, b: np.ndarray, weight_b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two blocks of scaled vectors: the weight of the b's that each a links to, and ties (i, j) over
    the a's followed by the b's."""
    eps = epsilon(threshold)
    (ends_a, ca, ra), (ends_b, cb, rb) = _balls(a), _balls(b)
    d = np.sqrt(((ca[:, None, :] - cb[None]) ** 2).sum(2))
    reach = ra[:, None] + rb[None]
    whole, near = d + reach <= eps - _SLACK, d - reach <= eps + _SLACK
    sub_weights = np.add.reduceat(weight_b, ends_b[:-1])
    gains = np.repeat(whole.astype(np.int64) @ sub_weights, np.diff(ends_a))
    shift = 0 if same else len(a)
    n = len(a) + (0 if same else len(b))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def tie(i: np.ndarray, j: np.ndarray) -> None:
        left.append(i)
        right.append(j)
        if sum(map(len, left)) > 1 << 19:
            i, j = _forest(n, np.concatenate(left), np.concatenate(right))
            left[:], right[:] = [i], [j]

    for i, (begin, end) in enumerate(zip(ends_a[:-1], ends_a[1:], strict=True)):
        if whole[i].any():
            # All of this sub-block and of those it is settled with hang on its first vector.
            tie(np.arange(begin, end), np.full(end - begin, begin))
            for j in np.flatnonzero(whole[i]):
                tie(np.arange(ends_b[j], ends_b[j + 1]) + shift, np.full(ends_b[j + 1] - ends_b[j], begin))
        open_subs = np.flatnonzero(near[i] & ~whole[i])
        if len(open_subs):
            at = np.concatenate([np.arange(ends_b[j], ends_b[j + 1]) for j in open_subs])
            close = a[begin:end] @ b[at].T >= threshold
            gains[begin:end] += close @ weight_b[at]
            x, y = np.nonzero(close)
            if len(x):
                tie(x + begin, at[y] + shift)
    i, j = np.concatenate(left), np.concatenate(right)
    return gains, *_forest(n, i, j)


def _compared(open_pairs: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """(a, b, gain): gain of a vector from the open pairs, or a tie of two vectors (gain null)."""
    pairs = stored(open_pairs.withColumn("pair", F.monotonically_increasing_id()), "open-pairs")
    ends = pairs.select("pair", *_GROUP, F.explode(F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("node"))
    payload = blocks.select(*_GROUP, "node", "uids", "weights", "raw")

    def compare(table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy())
        sides = []
        for r in order.tolist():
            length, raw = table["length"][r].as_py(), table["raw"][r].as_buffer()
            uids = np.frombuffer(table["uids"][r].as_buffer(), np.int64)
            kind = np.float32 if len(raw) == 4 * length * len(uids) else np.float64
            sides.append((uids, np.frombuffer(table["weights"][r].as_buffer(), np.int64), scaled(np.frombuffer(raw, kind).reshape(-1, length))))
        (uids, weights, unit), other = sides[0], sides[-1]
        same = len(sides) == 1
        gains, i, j = linked(unit, other[2], other[1], threshold, same)
        names = uids if same else np.concatenate((uids, other[0]))
        if not same:
            gains = np.concatenate((gains, linked(other[2], unit, weights, threshold, False)[0]))
        some = np.flatnonzero(gains)
        none = pa.nulls(len(some), pa.int64())
        return pa.table(
            [
                pa.chunked_array([pa.array(names[some]), pa.array(names[i])], pa.int64()),
                pa.chunked_array([none, pa.array(names[j])], pa.int64()),
                pa.chunked_array([pa.array(gains[some]), pa.nulls(len(i), pa.int64())], pa.int64()),
            ],
            names=["a", "b", "gain"],
        )

    found = ends.join(payload, [*_GROUP, "node"]).groupBy("pair").applyInArrow(compare, "a long, b long, gain long")
    return stored(found, "compared")


def _handed_down(levels: list[DataFrame], settled: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(node, gain, whole) of the blocks, and ties (a, b) between first vectors of intervals."""
    ties, above = [], None
    for nodes, pairs in zip(reversed(levels), reversed(settled), strict=True):
        named = nodes.select(*_GROUP, "node", "weight", "first")
        other = [named.select(*_GROUP, F.col("node").alias(s), F.col("weight").alias(f"weight_{s}"), F.col("first").alias(f"first_{s}")) for s in "ab"]
        met = stored(pairs.join(other[0], [*_GROUP, "a"]).join(other[1], [*_GROUP, "b"]), "settled")
        ties.append(met.where("a <> b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))
        own = met.select(*_GROUP, F.col("a").alias("node"), F.col("weight_b").alias("gain"))
        own = own.unionByName(met.where("a <> b").select(*_GROUP, F.col("b").alias("node"), F.col("weight_a").alias("gain")))
        if above is not None:
            up = above.withColumnRenamed("node", "parent").withColumnRenamed("first", "first_up")
            below = named.withColumn("parent", F.floor(F.col("node") / FAN)).join(up, [*_GROUP, "parent"])
            ties.append(below.where("first <> first_up").select(F.col("first").alias("a"), F.col("first_up").alias("b")))
            own = own.unionByName(below.select(*_GROUP, "node", "gain"))
        total = own.groupBy(*_GROUP, "node").agg(F.sum("gain").alias("gain"))
        above = stored(total.join(named.select(*_GROUP, "node", "first"), [*_GROUP, "node"]), "gains")
    joined = ties[0]
    for more in ties[1:]:
        joined = joined.union(more)
    return above, joined


def _members(blocks: DataFrame, gained: DataFrame) -> DataFrame:
    """The vectors of settled blocks: gain, and a tie to the first of the block."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                uids = np.frombuffer(batch["uids"][r].as_buffer(), np.int64)
                columns = [uids, np.full(len(uids), batch["first"][r].as_py()), np.full(len(uids), batch["gain"][r].as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "gain"])

    found = blocks.select(*_GROUP, "node", "uids").join(gained, [*_GROUP, "node"])
    return found.select("uids", "first", "gain").mapInArrow(spread, "a long, b long, gain long")


def _linked_vectors(distinct: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(uid, n) of the distinct vectors: weight within epsilon, itself included; ties (a, b) between them."""
    eps = epsilon(threshold)
    n, longest = distinct.agg(F.count("*"), F.max("length")).first()
    spark = distinct.sparkSession
    if n < 2:
        return distinct.select("uid", F.col("weight").alias("n")), spark.createDataFrame([], "a long, b long")
    directions = _directions(distinct, longest)
    most, least = _PART_ROWS
    parts = max(-(-n // most), min(-(-n // least), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = ["label", "length", "cells", "uid"]
    ordered = _placed(distinct, directions, eps).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = _numbered(stored(_blocks(ordered, directions, block), "blocks"))
    levels = [blocks.select(*_GROUP, "weight", "first", "center", "radius", "low", "high", "node")]
    while levels[-1].agg(F.max("node")).first()[0] > 0:
        levels.append(_parents(levels[-1]))
    open_pairs, settled = _descended(levels, eps)
    gained, ties = _handed_down(levels, settled)
    found = _compared(open_pairs, blocks, threshold).unionByName(_members(blocks, gained))
    found = stored(found, "found-links")
    totals = found.where("gain is not null").groupBy(F.col("a").alias("uid")).agg(F.sum("gain").alias("n"))
    return totals, found.where("b is not null").select("a", "b").union(ties)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id) of every row of ``vectors``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    usable = F.col("label").isNotNull() & _usable(F.col("vector"))
    key = [F.when(usable, F.xxhash64(F.lit(k), "label", "vector")).alias(f"k{k}") for k in (1, 2)]
    rows = stored(rows.select("id", *key, F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("vector")).alias("vector")), "vectors")
    # 128 bits stand for a label and a vector.
    distinct = rows.where(F.col("k1").isNotNull()).groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    distinct = stored(distinct.select(F.monotonically_increasing_id().alias("uid"), "*", F.size("vector").alias("length")), "distinct-vectors")
    totals, ties = _linked_vectors(distinct.select("uid", "label", "length", "weight", "vector"), threshold, block)
    # A bijection of the numbers, so that the smallest of a component is a random one.
    groups = components(ties.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")))
    known = distinct.select("uid", "id", "k1", "k2", F.xxhash64("uid").alias("node"))
    tied = stored(known.join(groups, "node").select("uid", "component", "id"), "tied")
    smallest = stored(tied.groupBy("component").agg(F.min("id").alias("component_id")), "smallest-ids")
    named = tied.join(smallest, "component").select("uid", "component_id", F.lit(True).alias("tied"))
    own = known.join(totals, "uid", "left").join(named, "uid", "left").select(
        "k1", "k2", F.col("n"), F.when(F.col("tied"), F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )
    own = stored(own, "vector-links")
    bare = F.col("k1").isNull()
    lone = rows.where(bare).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = rows.where(~bare).select("id", "k1", "k2").join(own, ["k1", "k2"])
    return found.select("id", (F.col("n") - 1).alias("n_links"), "component_id").unionByName(lone)


def op12_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(read(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP12_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT r.x AS vec_id, coalesce(n, 0) AS n_links, min(y) AS component_id, r.x = min(y) AS kept
FROM reach r LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) l ON l.x = r.x
GROUP BY r.x, n
"""
