"""Tables of a catalog that supports ``MERGE INTO``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.delivery import WATERMARK
from changeflow.spec import DELETE_REPLICATE, ReplicationSpec


class MergeSink:
    """The catalog finds and rewrites the touched files; a second merge moves the positions.

    A crash between the two repeats the batch, which leaves the same rows. Positions only rise.
    """

    transactional = False

    def __init__(self, table: str, spec: ReplicationSpec, positions_table: str | None = None) -> None:
        if spec.exactly_once and positions_table is None:
            raise ValueError("exactly-once delivery needs a table for the positions")
        self.table = table
        self.spec = spec
        self.positions_table = positions_table

    def watermark(self, spark: SparkSession) -> DataFrame:
        if self.positions_table is None:
            return spark.createDataFrame([], WATERMARK)
        applied = spark.table(self.positions_table).where(F.col("target") == self.spec.target)
        return applied.select("target", "shard", "arrived", "ms", "n")

    def apply(self, net: DataFrame, positions: DataFrame | None) -> None:
        spark, spec = net.sparkSession, self.spec
        mapped = {c: F.col(f"net.{c}") for c in spec.columns}
        others = [c for c in spark.table(self.table).columns if c not in (spec.pk, *spec.columns)]
        deleted = F.col("net.op") == DELETE_REPLICATE
        (
            net.alias("net")
            .mergeInto(self.table, F.col(f"{self.table}.{spec.pk}") == F.col("net.pk"))
            .whenMatched(deleted)
            .delete()
            .whenMatched(F.col("net.reset"))
            .update({**mapped, **{c: F.lit(None) for c in others}})
            .whenMatched()
            .update(mapped)
            .whenNotMatched(~deleted)
            .insert({spec.pk: F.col("net.pk"), **mapped})
            .merge()
        )
        if positions is not None:
            self._move(positions)

    def _move(self, positions: DataFrame) -> None:
        held = self.positions_table
        same = (F.col(f"{held}.target") == F.col("new.target")) & (
            F.col(f"{held}.shard") == F.col("new.shard")
        )
        columns = {c: F.col(f"new.{c}") for c in ("arrived", "ms", "n")}
        (
            positions.alias("new")
            .mergeInto(held, same)
            .whenMatched(F.struct(*columns.values()) > F.struct(*(F.col(f"{held}.{c}") for c in columns)))
            .update(columns)
            .whenNotMatched()
            .insert({"target": F.col("new.target"), "shard": F.col("new.shard"), **columns})
            .merge()
        )
