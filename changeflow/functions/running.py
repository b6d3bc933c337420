"""Running aggregates along the log that do not funnel a hot key into one task.

A plain window sends all rows of a key to one task. Here a key that holds more
than its share of the rows is cut along the log into segments; every segment is
a window partition of its own, and what the earlier segments add up to is
carried in by a join. Cold keys take the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
SEGMENT = "_segment"
_POSITION = "_position"


def log_position(ms: str = "ms", n: str = "n") -> Column:
    """The log id as one double that never falls along the log.

    Only segment borders are drawn with it, so two ids may share a value. The
    logarithm spreads counters of one millisecond over its fraction.
    """
    return F.col(ms).cast("double") + F.log2(F.col(n).cast("double") + 1) / 64


def cut_hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, bool]:
    """Rows with a segment number, and whether any key is hot.

    Counts the rows of each key, so ``df`` had better be cheap to read.
    """
    spark = df.sparkSession
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).persist()
    try:
        total, largest = per_key.agg(F.sum("_rows"), F.max("_rows")).first()
        share = max((total or 0) // most, rows_per_task)
        if (largest or 0) <= share:
            return df.withColumn(SEGMENT, F.lit(-1)), False
        # Each holds more than total / most rows, so there are fewer than `most` of them.
        rows = per_key.where(F.col("_rows") > share).select(*keys, F.lit(True).alias("_hot"))
        hot = spark.createDataFrame(rows.collect(), rows.schema)
    finally:
        per_key.unpersist()
    marked = df.join(F.broadcast(hot), list(keys), "left").withColumn(_POSITION, log_position())
    pieces = min(most, -(-total // share) * 2)
    borders = marked.where("_hot").approxQuantile(
        _POSITION, [i / pieces for i in range(1, pieces)], 1 / (4 * pieces)
    )
    splits = [float("-inf"), *sorted(set(borders)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol=_POSITION, outputCol="_bucket").transform(marked)
    segment = F.when(F.col("_hot"), F.col("_bucket").cast("int")).otherwise(-1)
    return cut.withColumn(SEGMENT, segment).drop("_hot", "_bucket", _POSITION), True


def with_order(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each key from 1 upwards, not without gaps, in log order.

    One number compares faster than an id of two parts. ``df`` comes from
    :func:`cut_hot_keys`; segments leave room for each other's rows.
    """
    w = W.partitionBy(*keys, SEGMENT).orderBy("ms", "n")
    segment = F.shiftleft(F.col(SEGMENT).cast("bigint") + 1, 40)
    return df.withColumn(name, segment + F.row_number().over(w))


def running(
    df: DataFrame,
    keys: Sequence[str],
    hot: bool,
    maxima: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
) -> DataFrame:
    """Add, per row, aggregates over the rows of its key that lie before it.

    ``df`` and ``hot`` come from :func:`cut_hot_keys`. ``maxima`` ignore nulls
    and are null where nothing came before, and so do ``lasts``, the last values;
    ``sums`` start at zero. Order is ``(ms, n)``, ids must be unique within a key.
    Where a key is hot the input is read twice.
    """
    maxima, sums, lasts = maxima or {}, sums or {}, lasts or {}
    before = (W.unboundedPreceding, -1)
    w = W.partitionBy(*keys, SEGMENT).orderBy("ms", "n").rowsBetween(*before)
    if not hot:
        return df.select(
            "*",
            *[F.max(c).over(w).alias(name) for name, c in maxima.items()],
            *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for name, c in sums.items()],
            *[F.last(c, ignorenulls=True).over(w).alias(name) for name, c in lasts.items()],
        )
    across = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(*before)
    within = df.select(
        "*",
        *[F.max(c).over(w).alias(name) for name, c in maxima.items()],
        *[F.sum(c).over(w).alias(name) for name, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(w).alias(name) for name, c in lasts.items()],
    )
    carried = (
        df.where(F.col(SEGMENT) >= 0)
        .groupBy(*keys, SEGMENT)
        .agg(
            *[F.max(c).alias(name) for name, c in maxima.items()],
            *[F.sum(c).alias(name) for name, c in sums.items()],
            *[
                F.max_by(c, F.when(c.isNotNull(), F.struct("ms", "n"))).alias(name)
                for name, c in lasts.items()
            ],
        )
        .select(
            *keys,
            SEGMENT,
            *[F.max(name).over(across).alias(f"_carry_{name}") for name in maxima],
            *[F.sum(name).over(across).alias(f"_carry_{name}") for name in sums],
            *[
                F.last(name, ignorenulls=True).over(across).alias(f"_carry_{name}")
                for name in lasts
            ],
        )
    )
    joined = within.join(carried, [*keys, SEGMENT], "left")
    return joined.select(
        *df.columns,
        *[F.greatest(name, f"_carry_{name}").alias(name) for name in maxima],
        *[
            (F.coalesce(name, F.lit(0)) + F.coalesce(f"_carry_{name}", F.lit(0))).alias(name)
            for name in sums
        ],
        *[F.coalesce(name, f"_carry_{name}").alias(name) for name in lasts],
    )
