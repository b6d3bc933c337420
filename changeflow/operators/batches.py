"""Batches and runs along the log, shard by shard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.running import ROWS_PER_TASK, SEGMENT, cut_hot_keys, running

_SHARD = ["target", "shard"]


def number_batches(log: DataFrame, size: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Number the log of each shard in batches of ``size`` records, from 0."""
    cut, hot = cut_hot_keys(log, _SHARD, rows_per_task)
    counted = running(cut, _SHARD, hot, sums={"_before": F.lit(1)})
    return counted.withColumn("batch_no", F.floor(F.col("_before") / size)).drop("_before", SEGMENT)


def changed_keys(batched: DataFrame) -> DataFrame:
    """Keys that each batch touches, sorted; a batch bounds the list."""
    return batched.groupBy(*_SHARD, "batch_no").agg(
        F.array_sort(F.collect_set("pk")).alias("keys")
    )


def count_batches(batched: DataFrame) -> DataFrame:
    return batched.groupBy(*_SHARD, "batch_no").agg(F.count(F.lit(1)).alias("records"))


def op_runs(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Runs of equal operation in each shard: number, operation, length and ends."""
    cut, hot = cut_hot_keys(log.select(*_SHARD, "ms", "n", "op"), _SHARD, rows_per_task)
    previous = running(cut, _SHARD, hot, maxima={"_previous": F.struct("ms", "n", "op")})
    starts = previous.withColumn(
        "_starts", (~F.col("op").eqNullSafe(F.col("_previous.op"))).cast("int")
    ).drop("_previous")
    numbered = running(starts, _SHARD, hot, sums={"_started": F.col("_starts")})
    ends = F.struct("ms", "n")
    return (
        numbered.groupBy(*_SHARD, (F.col("_started") + F.col("_starts")).alias("run_no"), "op")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min(ends).alias("first"),
            F.max(ends).alias("last"),
        )
        .select(
            *_SHARD,
            "run_no",
            "op",
            "records",
            F.col("first.ms").alias("first_ms"),
            F.col("first.n").alias("first_n"),
            F.col("last.ms").alias("last_ms"),
            F.col("last.n").alias("last_n"),
        )
    )
